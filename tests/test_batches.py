"""From landed files to entities: sources in their own forms, records of one batch that belong together, names by rare grams."""

import json
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from quillstone.operators import batch, resolve
from quillstone.operators.normalised import from_payload, normalised
from quillstone.operators.store import Tables, hadoop_path
from quillstone.sources import catalogue, readers
from tests.test_operators import plain_score


@pytest.fixture
def landed(tmp_path):
    def write(name, data):
        path = tmp_path / name
        path.write_bytes(data if isinstance(data, bytes) else data.encode())
        return str(path)

    return write


def resolved(rows):
    """(source_record_id: normalised row) of raw records."""
    return {r["source_record_id"]: r for r in normalised(from_payload(rows)).collect()}


# --- sources -------------------------------------------------------------------------------------
def test_sources_land_with_names_and_identifiers(spark, landed):
    rows = resolved(catalogue.read(spark, "corporations_canada_csv", landed("a.csv", "﻿CORP_NUM,Corp_Nme,Status,City/Town\n12-3,Acme Ltd.,Active,Ottawa\n,Beta Inc,Active,\n")))
    assert rows["12-3"]["legal_name"] == "acme limited" and rows["12-3"]["corp_number"] == "12-3" and rows["12-3"]["record_id"] == "corporations_canada_csv:12-3" and rows["12-3"]["city"] == "Ottawa" and rows["12-3"]["source_class"] == "A"
    assert len(rows) == 2 and {len(k) for k in rows} == {4, 32}
    rows = resolved(catalogue.read(spark, "montreal", landed("m.csv", "ID;NOM;ADRESSE\n7;Café Œuvre;1 rue X\n".encode("cp1252"))))
    assert rows["7"]["legal_name"] == "café œuvre" and rows["7"]["address_line1"] == "1 rue X"
    rows = resolved(catalogue.read(spark, "edmonton", landed("e.csv", "externalid,business_name,business_address\nX1,Acme,1 Main St\n")))
    (row,) = rows.values()
    assert row["external_id"] == "X1" and row["source_record_id"].startswith("X1:") and row["address_line1"] == "1 Main STREET"
    html = "<table><tr><th>Corporation number</th><th>Name of corporation</th><th>Registered office</th><th>Effective date</th></tr><tr><td>55</td><td>Delta Corp</td><td>9 Bay St</td><td>2024-01-02</td></tr></table>"
    rows = resolved(catalogue.read(spark, "corporations_canada_html", landed("h.html", html)))
    assert rows["55"]["legal_name"] == "delta corporation" and rows["55"]["corp_number"] == "55" and rows["55"]["address_line1"] == "9 Bay STREET" and rows["55"]["extra"]["event_type"] == "FEDERAL_INCORPORATION"


def test_compat_leaves_the_added_aliases_out(spark):
    rows = spark.createDataFrame([("montreal", "1", {"nom": "Acme", "adresse": "1 Main"})], "source_key string, source_record_id string, raw_payload map<string,string>")
    row, old = (from_payload(rows, compat=c).first() for c in (False, True))
    assert (row["legal_name"], row["street"], row["extra"]) == ("Acme", "1 Main", None)
    assert (old["legal_name"], old["street"], old["extra"]) == (None, None, {"nom": "Acme", "adresse": "1 Main"})


def test_renamed_headers(spark, landed):
    text = "Business Name,Company Name,Number of Employees,Community,Web Site,Other Thing\nAcme,,55 to 99,Hope,acme.ca,x\n,,,,,\n,Beta,10-19,,,\n"
    rows = {r["source_record_id"]: r["raw_payload"] for r in catalogue.read(spark, "bc_indigenous", landed("b.csv", text)).collect()}
    # The later of two columns of one field counts, as in a row read into a map.
    assert sorted(p["name"] for p in rows.values()) == ["", "Beta"] and len(rows) == 2
    one = next(p for p in rows.values() if p["name"] == "")
    assert (one["employee_range"], one["raw_employee_value"], one["employee_range_anomaly"], one["city"], one["website"], one["other thing"]) == ("55 to 99", "55 to 99", "EMPLOYEE_RANGE_AMBIGUITY", "Hope", "acme.ca", "x")
    import hashlib

    assert {hashlib.sha256(x.encode()).hexdigest()[:32] for x in (":Hope", "Beta:")} == set(rows)
    text = "Plant Name,Licence No,Telephone,Animal Class,Some Header\nMeats,77,n/a,beef,Not Available\n"
    (row,) = catalogue.read(spark, "ontario_meat_plants", landed("o.csv", text)).collect()
    assert row["source_record_id"] == "77" and row["raw_payload"] == {"name": "Meats", "licence_number": "77", "phone": "", "animal_class": "beef", "some_header": ""}
    assert catalogue.read(spark, "OntarioMeatAdapter", landed("p.csv", text)).count() == 1


def test_projected_licences(spark, landed):
    text = "Legal Name,Operating name,Address,Telephone,Licence number,Licence status,Expiry date,Ignored\nAcme,N/A,n/a,None,L1,Issued,-,x\n  ,Shop,1 Main,555,L2,Issued,,x\nBeta,Shop,,555,,Issued,2030-01-01,x\n"
    rows = {r["source_record_id"]: r["raw_payload"] for r in catalogue.read(spark, "ontario_select_licence", landed("s.csv", text)).collect()}
    assert len(rows) == 2 and rows["L1"]["operating_name"] == "" and rows["L1"]["phone"] == "" and rows["L1"]["expiry_date"] == "" and rows["L1"]["address"] == "n/a" and "ignored" not in rows["L1"]
    assert all(len(k) in (2, 32) for k in rows) and set(rows["L1"]) == {"legal_name", "operating_name", "address", "city", "province", "postal_code", "country", "phone", "website", "email", "licence_type", "licence_number", "licence_status", "expiry_date"}


def test_new_business_workbook(spark, tmp_path):
    cells = lambda *xs: "<row>" + "".join(f'<c t="inlineStr"><is><t>{x}</t></is></c>' for x in xs) + "</row>"
    with zipfile.ZipFile(tmp_path / "w.xlsx", "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{cells("Business License Id", "Business Name")}{cells("B9", "Acme")}</sheetData></worksheet>')
    rows = resolved(catalogue.read(spark, "saskatoon_new_biz", str(tmp_path / "w.xlsx")))
    assert rows["B9"]["legal_name"] == "acme" and rows["B9"]["extra"]["event_type"] == "MUNICIPAL_LICENCE_FIRST_ISSUE"


PROFILE = """<html><body><h2>Acme</h2><table>
<tr><th>Company Name:</th><td>Acme &amp; Sons <b>Ltd</b></td></tr><tr><td>Business Number</td><td> 123 </td></tr><tr><td>one</td><td>two</td><td>three</td></tr>
<tr><td>No. of Employees</td><td>about 12 people</td></tr><tr><td>City/Community</td><td>Iqaluit</td></tr><tr><td>Phone</td><td>old</td></tr><tr><td>Phone:</td><td>867-555-0101</td></tr></table>
<p>since <time class="x" datetime="2023-05-06T00:00:00Z">May</time> <time datetime="1999">no</time></p>
<ul class="biz-sectors list"><li>Mining</li><li>Fish <i>&amp;</i> game</li></ul><h3>Goods sold</h3><p>.</p><ul><li>Boats</li></ul></body></html>"""


def test_profile_pages(spark, tmp_path):
    for name, page in (("profile-7.html", PROFILE), ("profile-8.html", "<table><tr><td>Business Name</td><td>Beta</td></tr></table>"), ("none.html", "<table><tr><td>Location</td><td>Igloolik</td></tr></table>"), ("empty-9.html", "")):
        (tmp_path / name).write_text(page)
    rows = {r["source_record_id"]: r["raw_payload"] for r in catalogue.read(spark, "nni", str(tmp_path)).collect()}
    one = rows["123"]
    assert (one["business_name"], one["employee_count"], one["raw_employee_value"], one["community"], one["phone"], one["effective_date"], one["profile_id"]) == ("Acme & Sons Ltd", "12", "about 12 people", "Iqaluit", "867-555-0101", "2023-05-06T00:00:00Z", "7")
    assert json.loads(one["sectors"]) == ["Mining", "Fish & game"] and json.loads(one["goods"]) == ["Boats"] and "services" not in one and "one" not in one
    assert rows["nni:8"]["business_name"] == "Beta" and len(rows) == 3  # an empty file has no row
    with pytest.raises(PermissionError):
        catalogue.read(spark, "nni", str(tmp_path), terms="BLOCKED")


def test_guards_and_limits(spark, landed):
    path = landed("v.csv", "licencersn,businessname,status\n3,C,Issued\n1,A,Issued\n2,B,Issued\n")
    assert [r["source_record_id"] for r in catalogue.read(spark, "vancouver", path, limit=2).orderBy("source_record_id").collect()] == ["1", "2"]
    answers = landed("d.json", "\n".join(json.dumps({"corp_number": n, "http_status": 200, "directors": []}) for n in ("55", "66")))
    assert catalogue.read(spark, "corporations_canada_api", answers, targets=[" 55"]).count() == 1
    with pytest.raises(ValueError):
        catalogue.read(spark, "corporations_canada_api", answers, targets=["5"])
    with pytest.raises(ValueError):
        catalogue.source("nobody")


@pytest.mark.parametrize(("data", "want"), [("a;b\n1;2\n", ("utf-8-sig", ";")), ("a|b\n1|2\n", ("utf-8-sig", "|")), ("né\tb\n1\t2\n".encode("cp1252"), ("cp1252", "\t")), (b"a,b\n\x81,2\n", ("latin-1", ","))])
def test_how_a_table_is_written(spark, landed, data, want):
    assert readers.written_in(spark, landed("t.csv", data)) == want


# --- batches -------------------------------------------------------------------------------------
FIELDS = "record_id string, source_key string, source_record_id string, corp_number string, bn string, legal_name string, trade_name string, normalised_address string, postal_code string, domain string, phone string"


def frame(spark, rows, more=""):
    return spark.createDataFrame(rows, FIELDS + more)


def record(k, source="s", corp=None, bn=None, name=None, trade=None, address=None, code=None, domain=None, phone=None, own=None):
    return (f"{source}:{k}", source, own or f"{k:05d}", corp, bn, name, trade, address, code, domain, phone)


def test_chains_of_identifiers_are_one_business(spark):
    """A chain of 60 records linked pairwise by turns, in any order of rows; a blank identifier links nothing."""
    chain = [record(k, corp=f"C{k // 2}", bn=f"B{(k + 1) // 2}", name=f"chain {k}") for k in range(60)]
    random.Random(1).shuffle(chain)
    rows = [*chain, record(100, corp=" ", bn="", name="alone"), record(101, corp=" ", name="apart"), record(102), record(103, own="00102"), record(104, source="t", own="00102", name="elsewhere")]
    none = frame(spark, [], ", entity_id string")
    want = None
    for seed in range(2):
        random.Random(seed).shuffle(rows)
        got = sorted(map(tuple, batch.resolve_batch(frame(spark, rows).repartition(3), none, fuzzy=False).collect()), key=str)
        want = want or got
        assert got == want
    out = {r[0]: r for r in want}
    assert out["s:0"] == ("s:0", "NEW", None, None, None, None, "s:0")
    assert all(out[f"s:{k}"] == (f"s:{k}", "MATCHED", "EXACT_IDENTIFIER", "HIGH", 100.0, "entity:s:0", "s:0") for k in range(1, 60))
    assert {out[f"s:{k}"][1] for k in (100, 101)} == {"NEW"} and out["t:104"][1] == "NEW"
    assert out["s:102"][1] == out["s:103"][1] == "UNRESOLVED"  # one licence id, but nothing that names a business


def test_known_entities_come_first(spark):
    known = frame(spark, [(*record(1, source="k", corp="C9", name="known", address="1 MAIN", code="V6B 1A1", domain="known.ca"), "e1"), (*record(2, source="k", bn="B9", name="other"), "e0"), (*record(3, source="k", corp="C8", name="third"), "e2")], ", entity_id string")
    rows = [
        record(1, bn="B1", name="joined by another"), record(2, bn="B1", corp="C9"), record(3, bn="B1"),  # one of three is known
        record(4, corp="C8", bn="B9"), record(5, bn="B9"),  # both are known: the corporation number is stronger for the first
        record(6, name="a", domain="known.ca", code="V6B 1A1"), record(7, name="b", domain="known.ca", code="V6B 1A1"),  # candidates of what is known
        record(8, name="c", domain="new.ca", code="V6B 2B2"), record(9, name="d", domain="new.ca", code="V6B 2B2"), record(10, name="zz", phone="+1", code="V6B 2B2", domain="new.ca"),
        record(11, name="c", address="9 OAK"), record(12, trade="c", address="9 OAK"),
    ]
    got = {r[0]: tuple(r)[1:] for r in batch.resolve_batch(frame(spark, rows), known, fuzzy=False).collect()}
    high = ("MATCHED", "EXACT_IDENTIFIER", "HIGH", 100.0)
    assert got["s:1"] == got["s:2"] == got["s:3"] == (*high, "e1", None)
    assert got["s:4"] == (*high, "e2", None) and got["s:5"] == (*high, "e0", None)
    assert got["s:6"] == got["s:7"][:5] + (got["s:6"][5],) == ("CANDIDATE", "DOMAIN_POSTAL", "MEDIUM", 90.0, "e1", "s:6")
    assert got["s:8"] == ("NEW", None, None, None, None, "s:8") and got["s:9"] == ("CANDIDATE", "DOMAIN_POSTAL", "MEDIUM", 90.0, "entity:s:8", "s:9") and got["s:10"][4] == "entity:s:8"
    assert got["s:11"][0] == "NEW" and got["s:12"] == ("CANDIDATE", "NAME_ADDRESS", "MEDIUM", 80.0, "entity:s:11", "s:12")


def test_names_within_a_batch(spark):
    """LOW edges go to known entities or earlier seeds, never to later ones."""
    known = frame(spark, [(*record(1, source="k", name="northern lights bakery", code="V6B 9Z9"), "e1")], ", entity_id string")
    rows = [record(1, name="polar bear plumbing", code="V6B 1A1"), record(2, name="polar bears plumbing", code="V6B 1A1"), record(3, name="northern light bakery", code="V6B 1A1"), record(4, name="quite another", code="V6B 1A1")]
    got = {r[0]: tuple(r)[1:6] for r in batch.resolve_batch(frame(spark, rows), known).collect()}
    assert got["s:1"][0] == "NEW" and got["s:1"][1] is None and got["s:4"][1] is None
    assert got["s:2"][:3] == ("NEW", "FUZZY_NAME", "LOW") and got["s:2"][4] == "entity:s:1" and got["s:3"][4] == "e1"


def test_a_common_identifier_is_no_tasks_load(spark):
    """Half of all records share one number: the components' joins see one row a key on one side."""
    rows = spark.range(4000).select(F.concat(F.lit("s:"), F.col("id")).alias("record_id"), F.lit("s").alias("source_key"), F.format_string("%06d", "id").alias("source_record_id"), F.when(F.col("id") % 2 == 0, "SAME").otherwise(F.concat(F.lit("C"), F.col("id"))).alias("corp_number"), *(F.lit(None).cast("string").alias(c) for c in ("bn", "trade_name", "normalised_address", "postal_code", "domain", "phone")), F.lit("n").alias("legal_name"))
    got = batch.resolve_batch(rows, rows.limit(0).withColumn("entity_id", F.col("record_id")), fuzzy=False)
    assert {tuple(r) for r in got.groupBy("outcome", F.when(F.col("seed") == "s:0", "s:0")).count().collect()} == {("NEW", None, 2000), ("NEW", "s:0", 1), ("MATCHED", "s:0", 1999)}


# --- names ---------------------------------------------------------------------------------------
def names(seed, n):
    r = random.Random(seed)
    words = ["north", "nord", "star", "stars", "bakery", "bakerys", "auto", "a", "b", "co", "customer", "00001234", "00001243", "limited", "ltd", "x"]
    return [(f"r{i}", " ".join(r.choice(words) + r.choice(["", "", "s", "x"]) for _ in range(r.randrange(0, 5))) or None, r.choice(["V6B 1A1", "V6B 2B2", "v6b1a1", "K1", None])) for i in range(n)]


@pytest.mark.parametrize(("threshold", "rungs"), [(88, (96,)), (88, ()), (75, (98, 90, 80)), (60, (90,))])
def test_fuzzy_loses_nothing(spark, threshold, rungs):
    """Short and long names, repeated grams, all rungs: the best of every record, and all pairs, as by brute force."""
    a, b = names(1, 90), names(2, 160)
    records_ = spark.createDataFrame([(i, n, None, c) for i, n, c in a], "record_id string, legal_name string, trade_name string, postal_code string").repartition(3)
    entities = spark.createDataFrame([(f"e{i}", n, None, c) for i, n, c in b], "entity_id string, legal_name string, trade_name string, postal_code string").repartition(3)
    pairs = {}
    for i, n, c in a:
        for j, m, d in b:
            if n and c and d and c[:3].upper() == d[:3].upper() and (s := plain_score(n, m or "", c)) >= threshold:
                pairs[i, f"e{j}"] = s
    assert {(r[0], r[1]): r[2] for r in resolve.fuzzy_pairs(records_, entities, threshold).collect()} == pytest.approx(pairs)
    best = {}
    for (i, e), s in pairs.items():
        best[i] = min(best.get(i, (0, "")), (-s, e))
    assert {r["record_id"]: r["entity_id"] for r in resolve.match_fuzzy(records_, entities, threshold, rungs).collect()} == {i: e for i, (_, e) in best.items()}
    assert len(best) > 20


def test_few_of_a_block_are_compared(spark):
    """In one block of names that share two words, under one pair in a hundred is compared at the first rung."""
    def compared(n):
        r = random.Random(n)
        own = [" ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(3)) + " holdings limited" for _ in range(n)]
        a = spark.createDataFrame([(f"r{i}", x.replace("a", "e", 1), "V6B 1A1") for i, x in enumerate(own)], "record_id string, legal_name string, postal_code string")
        b = spark.createDataFrame([(f"e{i}", x, "V6B 1A1") for i, x in enumerate(own)], "entity_id string, legal_name string, postal_code string")
        rows = resolve.gram_pairs(resolve.names_to_compare(a, "record_id", ("legal_name",)), resolve.names_to_compare(b, "entity_id", ("legal_name",)), 96)
        found = {tuple(x) for x in rows.collect()}
        assert {(f"r{i}", f"e{i}") for i in range(n)} <= found
        return len(found) / n

    few, many = compared(200), compared(800)
    assert few < 2 + 1 and many < 8 + 1, (few, many)  # its own name besides


# --- tables between steps ------------------------------------------------------------------------
def test_tables(spark):
    tables = Tables(spark, "test")
    first = tables.put("x", spark.range(3))
    before = tables.paths["x"]
    second = tables.put("x", first.withColumn("y", F.lit(1)))
    assert second.count() == 3 and tables.paths["x"] != before
    gone = lambda path: not (lambda fs, p: fs.exists(p))(*hadoop_path(spark, path))
    assert gone(before) and not gone(tables.folder)
    tables.drop()
    assert gone(tables.folder)
