"""Landed files of five sources, each written in the form it lands in, from the landing view: what a source-to-entity run reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.operators.normalised import from_payload, normalised
from quillstone.operators.store import Tables
from quillstone.plans.landing import landing
from quillstone.sources import catalogue

#: By source: which rows of the view it takes, its headers and the columns under them, how the file is written.
FILES: dict[str, tuple[str, dict[str, str], dict[str, str]]] = {
    "corporations_canada_csv": (
        "source_key = 'vancouver' AND row_key % 4 = 0",
        {"CORP_NUM": "'C' || lpad(CAST(row_key AS STRING), 7, '0')", "Corp_Nme": "legal_name", "Address": "street", "City": "city", "Province": "province", "Postal_Code": "postal_code", "Phone": "phone", "Email": "email", "Website": "website", "Row": "row_key"},
        {},
    ),
    "montreal": (
        "source_key = 'vancouver' AND row_key % 4 = 1",
        {"ID": "row_key", "NOM": "legal_name || ' é'", "ADRESSE": "street", "City": "city", "Province": "province", "Postal_Code": "postal_code", "Phone": "phone", "Email": "email", "Website": "website", "Row": "row_key"},
        {"sep": ";", "encoding": "ISO-8859-1"},
    ),
    "bc_indigenous": (
        "source_key = 'vancouver' AND row_key % 4 = 2",
        {"Business Name": "legal_name", "Mailing Address": "street", "Community": "city", "Province": "province", "Postal Code": "postal_code", "Telephone": "phone", "Email Address": "email", "Web Site": "website", "Number of Employees": "employees", "Row": "row_key"},
        {},
    ),
    "ontario_select_licence": (
        "source_key = 'vancouver' AND row_key % 4 = 3",
        {"Legal Name": "CASE WHEN row_key % 28 <> 3 THEN legal_name ELSE '  ' END", "Operating name": "coalesce(nullif(trade_name, ''), 'N/A')", "Address": "street", "City": "city", "Province": "province", "Postal code": "coalesce(nullif(postal_code, ''), 'none')",
         "Country": "'-'", "Telephone": "coalesce(phone, 'N/A')", "Website": "coalesce(website, 'null')", "Email": "coalesce(nullif(email, ''), 'n/a')", "Licence type": "'SELECT'", "Licence number": "row_key", "Licence status": "'Issued'", "Expiry date": "'N/A'"},
        {},
    ),
    "calgary": (
        "source_key = 'bc_indigenous'",
        {"LicenceNumber": "row_key", "TradeName": "trade_name", "Address": "street", "City": "city", "Province": "province", "Postal_Code": "postal_code", "Phone": "phone", "Email": "email", "Website": "website", "Corp_Number": "corp_number", "BN": "bn", "JobStatusDesc": "'Issued'", "Row": "row_key"},
        {"sep": "\t"},
    ),
}


def write_landed(rows: DataFrame, folder: str) -> dict[str, str]:
    """Write the view's rows as each source's files below ``folder``; the path by source."""
    paths = {}
    for key, (which, columns, how) in FILES.items():
        paths[key] = f"{folder}/{key}"
        cells = rows.filter(which).select(*(F.expr(e).cast("string").alias(h) for h, e in columns.items()))
        cells.write.options(header=True, quoteAll=True, escape='"', **how).csv(paths[key])
    return paths


def read_landed(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """The normalised records of all landed files, each source read in its own form; encodings and delimiters are found in the files."""
    raw: DataFrame | None = None
    for key, path in paths.items():
        rows = catalogue.read(spark, key, path)
        raw = rows if raw is None else raw.unionByName(rows)
    return normalised(from_payload(raw))


def source_records(spark: SparkSession, sf_dir: str, tables: Tables) -> DataFrame:
    return tables.put("records", read_landed(spark, write_landed(landing(spark, sf_dir), f"{tables.folder}/landed")))

