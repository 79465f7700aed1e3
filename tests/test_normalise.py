"""Hand-written examples of the normalisers."""

import datetime

import pytest
from pyspark.sql import functions as F

from quillstone.functions import normalise as n
from quillstone.operators import normalised


def one(spark, make, *values):
    cols = [f"c{i}" for i in range(len(values))]
    df = spark.createDataFrame([tuple(values)], ", ".join(f"{c} string" for c in cols))
    v = df.select(make(*map(F.col, cols)).alias("v")).first()["v"]
    return v.asDict() if hasattr(v, "asDict") else v


@pytest.mark.parametrize(
    ("raw", "want"),
    [("Acme Ltd.", "acme limited"), ("St. Mary & Co", "saint mary company"), ("O'Brien-Smith, INC", "o'brien-smith incorporated"), ("  ", None), (None, None), ("...", None)],
)
def test_name(spark, raw, want):
    assert one(spark, n.name, raw) == want


@pytest.mark.parametrize(
    ("raw", "code", "valid"),
    [("k1a0b1", "K1A 0B1", True), ("K1A-0B1", "K1A 0B1", True), (" k1a 0b1 ", "K1A 0B1", True), ("D1A 0B1", "D1A 0B1", False), ("K1A 0B1 XYZ9", None, False), ("ABC", "ABC", False), ("", None, None), (None, None, None)],
)
def test_postal(spark, raw, code, valid):
    assert one(spark, n.postal, raw) == {"code": code, "valid": valid}


@pytest.mark.parametrize(
    ("raw", "want"),
    [("12 Main st, suite #5", "12 Main STREET, SUITE 5"), ("1 Steeles Ave", "1 SUITE ELES AVENUE"), ("Apartment: 4b 9 king RD", "APT 4B 9 king ROAD"), (" ", None), ("5  Elm   Cres", "5 Elm CRESCENT")],
)
def test_street(spark, raw, want):
    assert one(spark, n.street, raw) == want


@pytest.mark.parametrize(("raw", "want"), [("saint-jean", "Saint-Jean"), ("O'BRIEN town", "O'Brien Town"), ("", None), ("3rd city", "3Rd City"), ("québec", "Québec")])
def test_city(spark, raw, want):
    assert one(spark, n.city, raw) == want


def test_address(spark):
    got = one(spark, n.address, "1 Main St, Unit 2", "toronto", "New South Wales", "m5v1a1")
    assert got["normalised_address"] == "1 Main STREET, UNIT 2, Toronto, M5V 1A1"
    assert got["raw_address"] == "1 Main St, Unit 2, toronto, New South Wales, m5v1a1"
    assert (got["address_line1"], got["address_line2"], got["province"]) == ("1 Main STREET", "UNIT 2", None)
    assert one(spark, n.address, None, "", None, None)["normalised_address"] is None
    assert one(spark, n.province, "British Columbia") == "BC"


@pytest.mark.parametrize(
    ("raw", "want", "valid"),
    [("(416) 555-0123", "+14165550123", True), ("1-604-555-0199", "+16045550199", True), ("604 555 0199 ext. 12", "+16045550199", True), ("800-555-0100", "+18005550100", True), ("212-555-0123", None, False), ("123", None, False), ("N/A", None, None), (None, None, None)],
)
def test_phone(spark, raw, want, valid):
    got = one(spark, n.phone, raw)
    assert (got["e164"], got["valid"]) == (want, valid)


def test_email_and_domain(spark):
    assert one(spark, n.email, " Info@Example.CA ") == {"raw": "Info@Example.CA", "email": "info@example.ca", "valid": True}
    assert one(spark, n.email, "bad@@x") == {"raw": "bad@@x", "email": None, "valid": False}
    assert one(spark, n.email, "none") == {"raw": None, "email": None, "valid": None}
    assert one(spark, n.domain, "https://WWW2.Shop.ca:80/x")["domain"] == "shop.ca"
    assert one(spark, n.domain, "shop.ca/x?y")["domain"] == "shop.ca"
    assert one(spark, n.domain, "localhost") == {"raw": "localhost", "domain": None, "valid": False}


@pytest.mark.parametrize(("raw", "source", "want"), [("Issued", "vancouver", "ACTIVE"), ("REVOKED", "ontario_select_licence", "SUSPENDED"), ("revoked", "x", "INACTIVE"), ("odd", None, "UNKNOWN"), ("", "calgary", "UNKNOWN"), (None, "calgary", "UNKNOWN")])
def test_status(spark, raw, source, want):
    assert one(spark, n.status, raw, source) == want


@pytest.mark.parametrize(
    ("raw", "low", "high", "bucket", "flag"),
    [("385.0", 385, 385, "200-499", None), ("10 to 19", 10, 19, "10-19", None), ("10+", 10, None, "500+", None), ("55 to 99", 55, 99, "50-99", "EMPLOYEE_RANGE_AMBIGUITY"), ("0", 0, 0, None, None), ("4-5", 4, 5, None, None), ("many", None, None, None, None), ("1000", 1000, 1000, "1000+", None)],
)
def test_employee(spark, raw, low, high, bucket, flag):
    got = one(spark, n.employee, raw)
    assert (got["low"], got["high"], got["bucket"], got["flag"]) == (low, high, bucket, flag)


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("03/04/2024", (2024, 4, 3)), ("03/25/2024", (2024, 3, 25)), ("2024-01-05T10:00:00+02:00", (2024, 1, 5, 8)), ("2024-01-05T10:00:00.123456Z", (2024, 1, 5, 10, 0, 0, 123456)), ("january 5, 2024", (2024, 1, 5)),
        ("5 Jan 2024", (2024, 1, 5)), ("20240105", (2024, 1, 5)), ("2024-02-30", None), ("0000-00-00", None), ("2024/01/05", None), (None, None),
    ],
)
def test_date(spark, raw, want):
    got = one(spark, n.date, raw)
    assert got == (datetime.datetime(*want) if want else None)


def test_naics(spark):
    assert one(spark, n.naics, "44-45") == {"source": "44-45", "sector": "44"}
    assert one(spark, n.naics, "9") == {"source": "9", "sector": None}
    assert one(spark, n.naics, "99") == {"source": "99", "sector": None}


def test_payload(spark):
    rows = spark.createDataFrame([("vancouver", {"businessname": "A Ltd", "province": "BC", "odd": "1", "zip": ""}), ("quebec_city_permits", {"NUMERO_PERMIS": "7", "ADRESSE_TRAVAUX": "1 rue X"})], "source_key string, raw_payload map<string,string>")
    a, b = normalised.from_payload(rows).orderBy("source_key").collect()[::-1]
    assert a["legal_name"] == "A Ltd" and a["extra"] == {"businessname": "A Ltd", "odd": "1"}
    assert (b["city"], b["province"], b["street"], b["legal_name"]) == ("Québec", "QC", "1 rue X", None)
    assert b["extra"] == {"numero_permis": "7", "event_type": "MUNICIPAL_PERMIT_ISSUED"}


def test_normalising_twice_changes_nothing(spark):
    names = spark.createDataFrame([("Acme Ltd. & Co",), ("St. John's",), ("x  y",)], "s string")
    once = names.select(n.name(F.col("s")).alias("s"))
    assert once.collect() == once.select(n.name(F.col("s")).alias("s")).collect()
