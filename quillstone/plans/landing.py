"""Deterministic business records made from the customer and supplier tables.

The test tables hold no business records. This view makes some: two sources whose every field is a
formula of the row's key, with absent, malformed and boundary values among them. The text is SQL that
Spark and DuckDB both read, so a check starts from the same records without sharing any operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillstone.operators.store import spread


def pick(by: str, *values: str) -> str:
    """The value at ``by`` modulo their number."""
    return f"CASE CAST(({by}) % {len(values)} AS INT) " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


def text(e: str) -> str:
    return f"CAST({e} AS STRING)"


def _fields(k: str, own: str, supplier: bool) -> dict[str, str]:
    """Expressions by column; ``k`` is the key that two records of one business share, ``own`` the row's key."""
    base = f"'Customer#' || lpad({text(k)}, 9, '0')"
    letters = "'ABCEGHJKLMNPRSTVXY'"
    packed = f"(substr({letters}, CAST({k} % 18 AS INT) + 1, 1) || {text(f'{k} % 10')} || substr({letters}, CAST({k} % 7 AS INT) + 1, 1) || {text(f'({k} + 3) % 10')} || substr({letters}, CAST({k} % 11 AS INT) + 1, 1) || {text(f'({k} + 7) % 10')})"
    spaced = f"(substr({packed}, 1, 3) || ' ' || substr({packed}, 4, 3))"
    four = f"lpad({text(f'{k} % 10000')}, 4, '0')"
    house = text(f"{k} % 200 + 1")
    unit = text(f"{k} % 30 + 1")
    number = f"lpad({text(k)}, 7, '0')"
    return {
        "legal_name": f"{base} || {pick(own if supplier else k, "' Ltd.'", "' INC'", "' Corp.'", "' & Co'")}",
        "trade_name": pick(own, f"'St. ' || {base}", "CAST(NULL AS STRING)", "''", f"'  Shop {chr(39)}{chr(39)} '".replace("''", "") + f" || {text(f'{k} % 50')} || ', Etc.'"),
        "street": pick(k, f"{house} || ' Main St, Suite ' || {unit}", f"{house} || ' Steeles Ave W'", f"'Unit #' || {unit} || ' ' || {house} || ' King rd.'", f"{house} || ' Lake Shore blvd,  Apt: ' || {unit} || 'b'", "''", f"'PO Box ' || {house}"),
        "city": pick(k, "'toronto'", "'SAINT-JEAN'", "'  st. john town '", "'Montreal'", "''", "'medicine hat'"),
        "province": pick(k, "'AB'", "'bc'", "'Manitoba'", "'NB'", "'NL'", "'NS'", "'ON'", "'Ontario'", "'qc'", "'SK'", "'British Columbia'", "'NEW SOUTH WALES'", "CAST(NULL AS STRING)", "'YT'", "' PE '", "'XX'"),
        "postal_code": pick(k, f"lower({spaced})", f"(substr({packed}, 1, 3) || '-' || substr({packed}, 4, 3))", packed, f"{spaced} || ' EXTRA'", "'ABC'", "''", spaced),
        "phone": pick(k, "'N/A'", f"'(416) 555-' || {four}", f"'+1 604 555 ' || {four}", "'123'", f"'1-800-555-' || {four}", "CAST(NULL AS STRING)", f"'514.555.' || {four} || ' ext 12'", f"'9995550' || {text(f'{k} % 900 + 100')}"),
        "email": pick(k, f"'Info' || {text(k)} || '@Example' || {text(f'{k} % 7')} || '.CA'", "'bad@@x'", "'none'", f"'a.b@shop' || {text(f'{k} % 11')} || '.example.com'", "''"),
        "website": pick(k, f"'https://www.shop' || {text(f'{k} % 50')} || '.example.ca/path?x=1'", f"'WWW2.Store' || {text(f'{k} % 40')} || '.com:8080'", "'n/a'", "'localhost'", "CAST(NULL AS STRING)", f"'http://biz' || {text(f'{k} % 60')} || '.org'"),
        "status": pick(own, "'ACTIVE'", "'Issued'", "'Closed'", "'gone out of business'", "'Suspended'", "'Pending'", "'weird'", "''"),
        "employees": pick(own, "'5'", "'10 to 19'", "'500 plus'", "'55 to 99'", "'0'", "'abc'", "'N/A'", "'385.0'", "'7-2'", "'12+'", "'4 - 5'"),
        "naics": pick(own, "'44-45'", "'722511'", "'9'", "'11abc'", "'99'", "''", "'5415'"),
        "issued_date": pick(own, "'2024-03-15'", "'15/03/2024'", "'03/25/2024'", "'20240110'", "'January 5, 2024'", "'5 Feb 2024'", "'2024-03-15T10:00:00'", "'n/a'", "'garbage'", "'2023-07-09 08:30:00'"),
        "corp_number": pick(own, f"'C' || {number}", "''", "CAST(NULL AS STRING)", f"'C' || {number}") if not supplier else pick(own, f"'C' || {number}", "''", "''", "''"),
        "bn": pick(own, "''", f"'BN' || {number}", "CAST(NULL AS STRING)", "''"),
    }


def landing_sql() -> str:
    """Columns: record_id, source_key, source_class, grain, row_key, run_id, and the raw fields."""
    def rows(table: str, key: str, source: str, cls: str, grain: str, k: str, supplier: bool) -> str:
        fields = ", ".join(f"{e} AS {c}" for c, e in _fields(k, key, supplier).items())
        return f"SELECT '{source}:' || {text(key)} AS record_id, '{source}' AS source_key, '{cls}' AS source_class, '{grain}' AS grain, {key} AS row_key, CAST({key} % 3 AS INT) AS run_id, {fields} FROM {table}"

    shared = "(CASE WHEN s_suppkey % 10 = 9 THEN s_suppkey + 900000 ELSE s_suppkey * 3 END)"
    return rows("customer", "c_custkey", "vancouver", "A", "LICENCE", "c_custkey", False) + " UNION ALL " + rows("supplier", "s_suppkey", "bc_indigenous", "C", "REGISTRATION", shared, True)


def landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view as a frame. Its rows are dear to normalise, so that small tables are spread over the cores first."""
    sql, tables = landing_sql(), {name: spread(spark.read.parquet(f"{sf_dir}/{name}.parquet")) for name in ("customer", "supplier")}
    for name in tables:
        sql = sql.replace(f"FROM {name}", f"FROM {{{name}}}")
    return spark.sql(sql, **tables)
