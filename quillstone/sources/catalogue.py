"""The sources: class, grain, id columns, required fields and date of the incremental cursor."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.functions import tables as t
from quillstone.operators import records
from quillstone.sources import incremental, readers


@dataclass(frozen=True)
class Source:
    key: str
    cls: str
    grain: str
    ids: tuple[str, ...]
    required: tuple[str, ...]
    cursor: str | None = None
    event_type: str | None = None
    event_only: bool = False
    keep_case: bool = False
    gated: bool = False
    #: How it lands: a text table (as it is, with headers renamed, or a projection of it), a workbook, pages with a table, profile pages, filing texts, or JSON
    #: answers, one a line, of directors or credentials.
    form: str = "table"
    #: Values whose hash is the id, where no id column is filled.
    made_of: tuple[str, ...] = ()
    #: Words for absent in a table with renamed headers, and whether unknown headers get underscores.
    absent: tuple[str, ...] = ()
    underscores: bool = True
    #: Ids repeat within a file: the record id also holds a hash of the row and its number among equal rows.
    repeats: bool = False


# --- fixed values: the source catalogue ----------------------------------------------------------
SOURCES = {
    s.key: s
    for s in (
        Source("calgary", "A", "LICENCE", ("licencenumber", "licence_number"), ("tradename", "jobstatusdesc"), "first_iss_dt"),
        Source("edmonton", "A", "LICENCE", ("externalid",), ("business_name",), "originalissuedate", repeats=True),
        Source("vancouver", "A", "LICENCE", ("licencersn", "licence_id"), ("businessname", "status"), "issueddate"),
        Source("winnipeg", "B", "EVENT", ("licence_number", "licencenumber", "licence_id"), ("trade_name", "status"), "issue_date", "LICENCE_STATUS_CHANGE", event_only=True),
        Source("montreal", "A", "ESTABLISHMENT", ("id", "identifiant", "id_uev"), ("nom", "adresse")),
        Source("quebec_city_permits", "B", "EVENT", ("NUMERO_PERMIS",), ("NUMERO_PERMIS", "DATE_DELIVRANCE"), None, "MUNICIPAL_PERMIT_ISSUED", keep_case=True),
        Source("saskatoon_all_biz", "A", "LICENCE", ("bus_lic_acct_id", "licence_number"), ("bus_lic_acct_id", "business_name"), form="workbook"),
        Source("saskatoon_new_biz", "B", "LICENCE", ("business_license_id", "business license id", "bus_lic_acct_id"), ("business name",), None, "MUNICIPAL_LICENCE_FIRST_ISSUE", form="workbook"),
        Source("corporations_canada_csv", "A", "CORPORATION", ("corp_num", "corporation_number"), ("corp_num", "corp_nme", "status")),
        Source("corporations_canada_html", "B", "EVENT", ("corporation number",), ("name of corporation", "effective date"), None, "FEDERAL_INCORPORATION", form="pages"),
        Source("manitoba_weekly_pdf", "B", "EVENT", ("file_no",), ("company_name",), None, "PROVINCIAL_REGISTRATION", form="filings"),
        Source("ontario_select_licence", "C", "LICENCE", ("licence_number",), ("legal_name",), form="projected"),
        *(Source(f"ontario_{k}", "C", "LICENCE", ("licence_number",), ("name",), form="renamed", absent=t.REGULATED_ABSENT) for k in ("dairy_distributors", "dairy_plants", "meat_plants", "tobacco", "fuel", "csbif")),
        Source("bc_indigenous", "C", "CORPORATION", (), ("name",), form="renamed", made_of=("name", "city"), underscores=False),
        Source("nni", "C", "CORPORATION", ("business_number", "profile_key"), ("business_name",), gated=True, form="profiles", made_of=("business_name", "community")),
        Source("bc_orgbook", "C", "CORPORATION", ("topic_id",), ("legal_name",), form="credentials"),
        Source("corporations_canada_api", "C", "CORPORATION", ("source_record_id",), ("corp_number",), form="directors"),
    )
}
# --- fixed values: earlier reader names, by the source that reads them now ------------------------
RENAMED = {
    "OntarioDairyAdapter": "ontario_dairy_distributors", "OntarioDairyPlantsAdapter": "ontario_dairy_plants", "OntarioFuelAdapter": "ontario_fuel", "OntarioMeatAdapter": "ontario_meat_plants",
    "OntarioTobaccoAdapter": "ontario_tobacco", "OntarioCSBIFAdapter": "ontario_csbif",
}


def source(key: str) -> Source:
    try:
        return SOURCES[RENAMED.get(key, key)]
    except KeyError:
        raise ValueError(f"unknown source {key!r}") from None


#: Keys of a business, which an aggregate-only source must not hold.
BUSINESS_KEYS = [*t.ALIASES["legal_name"], *t.ALIASES["trade_name"], *t.CORP_NUMBER_KEYS, *t.BN_KEYS]


def read(spark: SparkSession, key: str, path: str, terms: str = "CLEARED", targets: list[str] | None = None, limit: int | None = None, **options) -> DataFrame:
    """Raw records of a source's landed files, in the form they land in; event-only sources keep status changes only.

    Columns: source_key, source_class, grain, source_record_id, raw_payload. ``terms`` guards gated sources, ``targets`` those that answer lookups (then
    only their answers are read); an aggregate-only source that holds business keys fails. ``limit`` takes so many records, of smallest ids.
    """
    s = source(key)
    if s.gated:
        records.guard_terms(terms)
    if targets is not None:
        records.guard_targets(targets)
    if s.form == "workbook":
        rows, payload = readers.workbooks(spark, path).select("row"), F.col("row")
    elif s.form == "pages":
        rows, payload = readers.page_tables(readers.texts(spark, path), "text", lower=True).select("row"), F.col("row")
    elif s.form == "profiles":
        rows, payload = readers.profiles(readers.texts(spark, path), "text", "path"), F.col("profile")
    else:
        of = {
            "table": lambda: readers.read_table(spark, path, keep_case=s.keep_case, **options), "filings": lambda: readers.filings(readers.texts(spark, path), "path").drop("path"),
            "renamed": lambda: readers.renamed(readers.read_table(spark, path, keep_case=True, **options), t.HEADERS[s.key], s.absent, s.underscores),
            "projected": lambda: readers.projected(readers.read_table(spark, path, keep_case=True, **options), t.SELECT_LICENCE, t.SELECT_LICENCE_ABSENT, "legal_name", t.SELECT_LICENCE_CLEANED),
            "directors": lambda: readers.directors(spark.read.text(path), "value"), "credentials": lambda: readers.latest_credentials(spark.read.text(path), "value"),
        }
        rows = of[s.form]()
        if targets is not None:
            rows = rows.filter(F.lower(F.trim(F.col(s.required[0]))).isin(*(x.strip().lower() for x in targets)))
        if s.event_only:
            rows = records.status_events(rows, rows["status"])
        if s.key == "bc_indigenous" and "employee_range" in rows.columns:
            odd = F.lower("employee_range").isin("55 to 99", "55-99")
            rows = rows.withColumns({"employee_range_anomaly": F.when(odd, "EMPLOYEE_RANGE_AMBIGUITY"), "raw_employee_value": F.col("employee_range")})
        payload = readers.row_map(rows)
        if s.key == "bc_indigenous":
            payload = F.map_filter(payload, lambda k, v: v.isNotNull())
    if s.cls == "D":
        rows = records.guard_aggregate_only(rows, payload, BUSINESS_KEYS)
    if s.event_type and not s.event_only:
        payload = F.map_concat(F.map_filter(payload, lambda k, v: k != "event_type"), F.create_map(F.lit("event_type"), F.lit(s.event_type)))
    out = readers.raw_records(rows, payload, s.key, s.grain, list(s.ids), s.repeats, s.made_of).withColumn("source_class", F.lit(s.cls))
    return out if limit is None else out.orderBy("source_record_id").limit(limit)


def read_since(spark: SparkSession, key: str, path: str, runs: DataFrame | None = None, limit: int | None = None, seen: str | None = None, **options: str) -> DataFrame:
    """Raw records of the files that a source has landed since its last completed run; of all files where none completed or a ``limit`` is set.

    ``runs``: source_key, run_status, completed_at. Files are pruned in planning and streamed (``incremental.landed``), so that tables, archives of them and workbooks of any size can be read. For
    sources whose files are tables or workbooks under their own headers.
    """
    s = source(key)
    if s.form not in ("table", "workbook") or s.keep_case:
        raise ValueError(f"{key} does not land as plain rows")
    since = None
    if runs is not None:
        done = runs.filter((F.col("source_key") == s.key) & (F.col("run_status") == "COMPLETED"))
        since = done.agg(F.max("completed_at")).first()[0]  # one value
    rows = incremental.landed(spark, path, None if since is None else F.lit(since), limit, seen, **options).select("row")
    payload = F.col("row")
    if s.event_only:
        rows = records.status_events(rows, F.col("row")["status"]).select("row")
        payload = F.map_concat(F.map_filter("row", lambda k, v: k != "event_type"), F.create_map(F.lit("event_type"), F.lit("LICENCE_STATUS_CHANGE")))
    elif s.event_type:
        payload = F.map_concat(F.map_filter("row", lambda k, v: k != "event_type"), F.create_map(F.lit("event_type"), F.lit(s.event_type)))
    return readers.raw_records(rows, payload, s.key, s.grain, list(s.ids), s.repeats, s.made_of).withColumn("source_class", F.lit(s.cls))
