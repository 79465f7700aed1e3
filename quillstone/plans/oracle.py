"""SQL for DuckDB that gives the registered queries' results, written without the operators."""

from __future__ import annotations

from quillstone.functions import tables as t
from quillstone.plans.batch_sql import batch_oracles
from quillstone.plans.landing import landing_sql

AS_OF = "TIMESTAMP '2024-06-01 00:00:00'"


def _in(values: tuple[str, ...]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _case(key: str, pairs: dict[str, str]) -> str:
    return f"CASE {key} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs.items()) + " END"


def _name(c: str) -> str:
    s = f"upper(trim({c}))"
    for a, b in t.NAME_WORDS.items():
        s = rf"regexp_replace({s}, '\b{a}\b', '{b}', 'g')"
    s = rf"""regexp_replace(lower({s}), '[.,!?;:"#@$%^&*(){{}}<>\[\]|\\~/`]', ' ', 'g')"""
    return rf"nullif(trim(regexp_replace({s}, '\s+', ' ', 'g')), '')"


_STREET = "nullif(trim(street), '')"
for _a, _b in t.STREET_TYPES.items():
    _STREET = rf"regexp_replace({_STREET}, '\b{_a}\b', '{_b}', 'gi')"
_UNIT = r"\b(SUITE|STE|UNIT|APT|APARTMENT|RM|ROOM|BLDG|BUILDING)\s*[#:]?\s*(\w+)\b"
_TITLE = r"list_aggregate(list_transform(regexp_extract_all({c}, '[^a-zA-Z]*[a-zA-Z]*'), lambda w: regexp_extract(w, '^[^a-zA-Z]*') || upper(substr(regexp_extract(w, '[a-zA-Z]*$'), 1, 1)) || lower(substr(regexp_extract(w, '[a-zA-Z]*$'), 2))), 'string_agg', '')"
_SOURCE_STATUS = "CASE " + " ".join(f"WHEN source_key = '{k}' AND upper(trim(status)) = '{w}' THEN '{v}'" for k, words in t.SOURCE_STATUS.items() for w, v in words.items()) + " END"
_DATES = "['%Y-%m-%dT%H:%M:%S', '%Y-%m-%d %H:%M:%S', '%Y-%m-%d', '%d/%m/%Y %H:%M:%S', '%d/%m/%Y', '%m/%d/%Y %H:%M:%S', '%m/%d/%Y', '%Y%m%d', '%B %d, %Y', '%b %d, %Y', '%d %B %Y', '%d %b %Y']"


def _present(c: str, absent: tuple[str, ...]) -> str:
    return f"CASE WHEN lower(trim({c})) NOT IN {_in(absent)} THEN trim({c}) END"


def _bucket(low: str, high: str) -> str:
    mid = f"(({low} + {high}) / 2.0)"
    return f"CASE WHEN {low} IS NOT NULL AND {high} IS NULL THEN '500+' " + " ".join(f"WHEN {mid} >= {a}" + (f" AND {mid} <= {b}" if b else "") + f" THEN '{n}'" for a, b, n in t.BUCKETS) + " END"


BASE = f"""
landing AS ({landing_sql()}),
n1 AS (
  SELECT *, {_name('legal_name')} AS n_legal, {_name('trade_name')} AS n_trade, {_STREET} AS st, nullif(trim(postal_code), '') AS pc, upper(replace(replace(trim(postal_code), '-', ''), ' ', '')) AS packed,
    {_present('phone', t.NO_CONTACT)} AS ph, {_present('email', t.NO_CONTACT)} AS em, {_present('website', t.NO_CONTACT)} AS ws, {_present('employees', t.NO_NUMBER)} AS emp,
    coalesce({_SOURCE_STATUS}, {_case('upper(trim(status))', t.STATUS)}, 'UNKNOWN') AS n_status, nullif(trim(naics), '') AS n_naics, upper(trim(province)) AS pv, nullif(trim(city), '') AS ct,
    CASE WHEN lower(trim(issued_date)) NOT IN {_in(t.NO_DATE)} THEN try_strptime(trim(issued_date), {_DATES}) END AS n_date
  FROM landing
),
n2 AS (
  SELECT *, regexp_split_to_array(st, '(?i){_UNIT}') AS gaps, regexp_extract_all(st, '(?i){_UNIT}', 1) AS labels, regexp_extract_all(st, '(?i){_UNIT}', 2) AS words,
    regexp_matches(packed, '^[A-CEGHJ-NPR-TVXY][0-9][A-Z][0-9][A-Z][0-9]$') AS pc_ok, regexp_replace(ph, '(?i)\\s*(ext\\.?|x|#)\\s*[0-9]{{1,7}}$', '') AS ph2, lower(em) AS em2,
    lower(regexp_replace(split_part(split_part(split_part(CASE WHEN contains(ws, '://') THEN split_part(ws, '://', 2) ELSE ws END, '/', 1), '?', 1), ':', 1), '^(?i)www[0-9]*\\.', '')) AS host,
    coalesce({_case('pv', t.PROVINCE_NAMES)}, pv) AS pv2, {_TITLE.format(c='ct')} AS n_city,
    CASE WHEN regexp_matches(emp, '^[0-9]+(\\.[0-9]+)?$') THEN 1 WHEN regexp_matches(emp, '(?i)^[0-9]+\\s*(plus|\\+)$') THEN 2 WHEN regexp_matches(emp, '(?i)^[0-9]+\\s*(to|-)\\s*[0-9]+$') THEN 3 END AS form
  FROM n1
),
n3 AS (
  SELECT *, nullif(trim(regexp_replace(CASE WHEN len(labels) = 0 THEN st ELSE list_aggregate(list_transform(range(1, len(gaps) + 1), lambda i: gaps[i] || coalesce({_case('upper(labels[i])', t.UNIT_LABELS)} || ' ' || upper(words[i]), '')), 'string_agg', '') END, '\\s+', ' ', 'g')), '') AS n_street,
    CASE WHEN pc_ok THEN substr(packed, 1, 3) || ' ' || substr(packed, 4, 3) WHEN length(pc) <= 7 THEN pc END AS n_postal, CASE WHEN pc IS NOT NULL THEN pc_ok END AS postal_ok,
    regexp_replace(ph2, '[^0-9]', '', 'g') AS dg, CASE WHEN pv2 IN {_in(t.PROVINCES)} THEN pv2 END AS n_province,
    CASE WHEN form IS NOT NULL THEN CAST(regexp_extract(emp, '^([0-9]+)', 1) AS INT) END AS e_low,
    CASE form WHEN 1 THEN CAST(regexp_extract(emp, '^([0-9]+)', 1) AS INT) WHEN 3 THEN CAST(regexp_extract(emp, '([0-9]+)$', 1) AS INT) END AS e_high
  FROM n2
),
n4 AS (
  SELECT *, CASE WHEN length(dg) = 11 AND dg[1] = '1' THEN substr(dg, 2) WHEN length(dg) = 10 AND NOT starts_with(ph2, '+') THEN dg END AS ten, trim(split_part(n_street, ',', 1)) AS line1,
    CASE WHEN contains(n_street, ',') THEN trim(substr(n_street, instr(n_street, ',') + 1)) END AS line2, {_bucket('e_low', 'e_high')} AS e_bucket
  FROM n3
),
norm AS (
  SELECT *, CASE WHEN ph IS NOT NULL THEN coalesce(regexp_matches(ten, '^[2-9][0-9][0-9][2-9][0-9]{{6}}$') AND substr(ten, 1, 3) IN {_in(t.AREA_CODES + t.TOLL_FREE)}, false) END AS ph_ok,
    CASE WHEN em IS NOT NULL THEN regexp_matches(em2, '^[a-z0-9._-]+@[a-z0-9]([a-z0-9-]*[a-z0-9])?(\\.[a-z0-9]([a-z0-9-]*[a-z0-9])?)+$') END AS em_ok,
    CASE WHEN ws IS NOT NULL THEN contains(host, '.') END AS ws_ok,
    nullif(concat_ws(', ', nullif(line1, ''), nullif(line2, ''), n_city, n_province, n_postal), '') AS whole,
    nullif(concat_ws(', ', CASE WHEN trim(street) <> '' THEN street END, CASE WHEN trim(city) <> '' THEN city END, CASE WHEN trim(province) <> '' THEN province END, CASE WHEN trim(postal_code) <> '' THEN postal_code END), '') AS raw_whole,
    CASE WHEN substr(regexp_replace(n_naics, '[^0-9]', '', 'g'), 1, 2) IN {_in(t.SECTORS)} THEN substr(regexp_replace(n_naics, '[^0-9]', '', 'g'), 1, 2) END AS n_sector,
    strftime(n_date, '%Y-%m-%dT%H:%M:%S+00:00') AS n_iso
  FROM n4
),
rec AS (
  SELECT *, CASE WHEN ph_ok THEN '+1' || ten END AS n_phone, CASE WHEN em_ok THEN em2 END AS n_email, CASE WHEN ws_ok THEN host END AS n_domain FROM norm
)"""

STORES = BASE + """,
new AS (SELECT * FROM rec WHERE source_key = 'bc_indigenous'),
known AS (SELECT *, record_id AS entity_id FROM rec WHERE source_key = 'vancouver'),
exact AS (
  SELECT n.record_id, k.entity_id, CASE WHEN nullif(trim(n.corp_number), '') = trim(k.corp_number) THEN 1 ELSE 2 END AS p
  FROM new n JOIN known k ON nullif(trim(n.corp_number), '') = trim(k.corp_number) OR nullif(trim(n.bn), '') = trim(k.bn)
),
m1 AS (SELECT record_id, first(entity_id ORDER BY p, entity_id) AS entity_id, 'EXACT_IDENTIFIER' AS rule, 'HIGH' AS confidence, 100.0::DOUBLE AS score FROM exact GROUP BY record_id),
m2 AS (SELECT n.record_id, min(k.entity_id) AS entity_id, 'DOMAIN_POSTAL' AS rule, 'MEDIUM' AS confidence, 90.0::DOUBLE AS score FROM new n JOIN known k ON n.n_domain = k.n_domain AND n.n_postal = k.n_postal GROUP BY n.record_id),
m3 AS (SELECT n.record_id, min(k.entity_id) AS entity_id, 'PHONE_POSTAL' AS rule, 'MEDIUM' AS confidence, 85.0::DOUBLE AS score FROM new n JOIN known k ON n.n_phone = k.n_phone AND n.n_postal = k.n_postal GROUP BY n.record_id),
m4 AS (
  SELECT n.record_id, min(k.entity_id) AS entity_id, 'NAME_ADDRESS' AS rule, 'MEDIUM' AS confidence, 80.0::DOUBLE AS score
  FROM new n JOIN known k ON n.whole = k.whole AND (n.n_legal IN (k.n_legal, k.n_trade) OR n.n_trade IN (k.n_legal, k.n_trade)) GROUP BY n.record_id
)"""

ENTITIES = BASE + f""",
ent AS (
  SELECT record_id AS entity_id, row_key, source_key, coalesce(n_legal, n_trade, source_key) AS canonical_name, n_legal, CASE WHEN row_key % 3 = 0 THEN 'CORPORATION' END AS entity_type, corp_number, bn, line1, n_city AS city, n_province AS province, n_postal,
    row_key % 6 = 0 AS coords, n_phone, ph_ok, n_email, em_ok, n_domain, e_bucket, coalesce(form = 1, false) AS e_exact, n_naics, n_sector, CASE WHEN row_key % 5 = 0 THEN CAST(row_key % 7 AS INT) ELSE 0 END AS directors, row_key % 4 = 0 AS has_primary,
    CASE WHEN row_key % 8 <> 0 THEN {AS_OF} - to_days(CAST(row_key % 900 AS INT)) END AS verified, row_key % 9 <> 0 AS sourced, source_class, n_status AS status, row_key % 11 = 0 AS dnc, CAST(n_date AS DATE) AS first_seen
  FROM rec
),
parts AS (
  SELECT *, least(100, CASE WHEN canonical_name <> '' THEN 40 ELSE 0 END + CASE WHEN n_legal <> '' THEN 20 ELSE 0 END + CASE WHEN entity_type <> '' THEN 10 ELSE 0 END + CASE WHEN corp_number <> '' THEN 20 WHEN bn <> '' THEN 10 ELSE 0 END) AS identity,
    least(100, CASE WHEN line1 <> '' THEN 30 ELSE 0 END + CASE WHEN city <> '' THEN 20 ELSE 0 END + CASE WHEN province <> '' THEN 20 ELSE 0 END + CASE WHEN n_postal <> '' THEN 15 ELSE 0 END + CASE WHEN coords THEN 5 ELSE 0 END) AS address,
    CASE WHEN n_phone IS NOT NULL THEN CASE WHEN ph_ok THEN 90 ELSE 50 END ELSE 0 END AS phone_score, CASE WHEN n_email IS NOT NULL THEN CASE WHEN em_ok THEN 90 ELSE 50 END ELSE 0 END AS email_score,
    CASE WHEN e_bucket IS NULL THEN 0 WHEN e_exact THEN 100 ELSE 60 END AS employee, CASE WHEN n_naics IS NOT NULL THEN 100 WHEN n_sector IS NOT NULL THEN 60 ELSE 0 END AS industry,
    CASE WHEN directors > 0 THEN least(100, 60 + 10 * directors) WHEN has_primary THEN 40 ELSE 0 END AS contact,
    CASE WHEN verified IS NULL THEN 0 WHEN row_key % 900 <= 30 THEN 100 WHEN row_key % 900 <= 90 THEN 80 WHEN row_key % 900 <= 180 THEN 60 WHEN row_key % 900 <= 365 THEN 40 WHEN row_key % 900 <= 730 THEN 20 ELSE 10 END AS recency,
    CASE WHEN NOT sourced THEN 0 ELSE greatest(CASE source_class WHEN 'A' THEN 100 ELSE 85 END, CASE WHEN row_key % 2 = 0 THEN 70 ELSE 0 END) END AS source_reliability
  FROM ent
),
scored AS (
  SELECT *, CAST(least(100, round_even((identity * 0.25::DOUBLE + address * 0.2::DOUBLE + phone_score * 0.15::DOUBLE + email_score * 0.1::DOUBLE + contact * 0.1::DOUBLE + recency * 0.1::DOUBLE + employee * 0.05::DOUBLE + industry * 0.05::DOUBLE) * (0.7::DOUBLE + (CASE WHEN source_reliability = 0 THEN 50 ELSE source_reliability END) / 100.0::DOUBLE * 0.3::DOUBLE), 0)) AS INT) AS composite,
    coalesce(canonical_name <> '' AND line1 <> '' AND province <> '' AND status = 'ACTIVE' AND (n_phone IS NOT NULL OR n_email IS NOT NULL OR n_domain IS NOT NULL OR directors > 0), false) AND NOT dnc AS sales_ready
  FROM parts
),
contacts AS (SELECT entity_id, 'PHONE' AS kind, n_phone AS value FROM ent WHERE n_phone IS NOT NULL UNION ALL SELECT entity_id, 'EMAIL', n_email FROM ent WHERE n_email IS NOT NULL UNION ALL SELECT entity_id, 'WEBSITE', n_domain FROM ent WHERE n_domain IS NOT NULL),
ev AS (SELECT entity_id, CASE WHEN row_key % 2 = 0 THEN 'BUSINESS_DISCOVERED' ELSE 'STATUS_CHANGED' END AS event_type, first_seen AS event_date FROM ent WHERE first_seen IS NOT NULL)"""

OBS = """
obs AS (
  SELECT user_id % 300 AS entity_id, (['status', 'legal_name', 'address', 'phone', 'city'])[CAST(event_id % 5 + 1 AS INT)] AS field, CAST(CAST(json_extract_string(props, '$.k') AS INT) % 3 AS VARCHAR) AS value, ts AS observed_at, event_id AS observation_id, CAST(event_id % 4 AS INT) AS run_id
  FROM events
),
cur AS (SELECT *, row_number() OVER (PARTITION BY entity_id, field ORDER BY observed_at DESC, observation_id DESC) = 1 AS is_current FROM obs),
mine AS (SELECT * FROM cur WHERE run_id = 1 AND is_current),
before AS (SELECT entity_id, field, last(value ORDER BY observed_at, observation_id) AS old_value FROM cur WHERE run_id <> 1 GROUP BY 1, 2),
seen AS (SELECT entity_id, CAST(max(observed_at) AS DATE) AS last_seen FROM mine GROUP BY 1),
chg AS (SELECT m.entity_id, m.field, b.old_value, m.value AS new_value, m.observed_at FROM mine m JOIN before b USING (entity_id, field) WHERE m.value IS DISTINCT FROM b.old_value)"""


def _w(base: str, select: str) -> str:
    return f"WITH {base.strip()}\n{select}"


def _gaps(table: str, columns: tuple[str, ...]) -> str:
    one = lambda c: f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL OR trim({c}) = '') AS n_missing, round_even(100 * count(*) FILTER (WHERE {c} IS NULL OR trim({c}) = '')::DOUBLE / count(*), 2) AS pct_missing FROM {table}"
    return " UNION ALL ".join(map(one, columns))


_OBSERVED = (
    ("legal_name", "legal_name", "n_legal"), ("trade_name", "trade_name", "n_trade"), ("address", "raw_whole", "whole"), ("postal_code", "postal_code", "n_postal"), ("city", "city", "n_city"), ("province", "province", "n_province"),
    ("phone", "phone", "n_phone"), ("email", "email", "n_email"), ("website", "website", "n_domain"), ("status", "status", "n_status"), ("employee_value", "employees", "e_bucket"), ("naics", "naics", "n_sector"), ("issued_date", "issued_date", "n_iso"),
)
_STEPS = "SELECT * FROM m1 UNION ALL SELECT * FROM m2 WHERE record_id NOT IN (SELECT record_id FROM m1) UNION ALL SELECT * FROM m3 WHERE record_id NOT IN (SELECT record_id FROM m1 UNION SELECT record_id FROM m2) UNION ALL SELECT * FROM m4 WHERE record_id NOT IN (SELECT record_id FROM m1 UNION SELECT record_id FROM m2 UNION SELECT record_id FROM m3)"
_HAS_ID = "coalesce(n_legal, n_trade, nullif(trim(corp_number), ''), nullif(trim(bn), '')) IS NOT NULL"
_ROWHASH = lambda *cs: "substr(sha256(concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '\\N')" for c in cs) + ")), 1, 32)"
_REAL = lambda c: f"CASE WHEN lower(trim({c})) NOT IN {_in(t.NO_CONTACT)} THEN {c} END"
_LABEL = "replace(replace(lower(employees), ' ', ''), ',', '')"
_GROUPS = "(SELECT 'source:' || source_key AS grp, n_legal FROM rec UNION ALL SELECT 'kind:PHONE', n_legal FROM rec WHERE n_phone IS NOT NULL UNION ALL SELECT 'kind:EMAIL', n_legal FROM rec WHERE n_email IS NOT NULL UNION ALL SELECT 'kind:WEBSITE', n_legal FROM rec WHERE n_domain IS NOT NULL)"
_FIRST = f"try_cast(regexp_extract({_LABEL}, '([0-9]+)', 1) AS BIGINT)"

ORACLE_SQL = {
    "norm_name": _w(BASE, "SELECT record_id, n_legal AS legal_name, n_trade AS trade_name FROM rec"),
    "norm_postal": _w(BASE, "SELECT record_id, n_postal AS postal_code, postal_ok AS postal_valid FROM rec"),
    "norm_street": _w(BASE, "SELECT record_id, n_street AS street FROM rec"),
    "norm_address": _w(BASE, "SELECT record_id, whole AS normalised_address, raw_whole AS raw_address, line1 AS address_line1, line2 AS address_line2, n_city AS city, n_province AS province FROM rec"),
    "norm_phone": _w(BASE, "SELECT record_id, ph AS raw_phone, n_phone AS phone, ph_ok AS phone_valid FROM rec"),
    "norm_email": _w(BASE, "SELECT record_id, n_email AS email, em_ok AS email_valid FROM rec"),
    "norm_domain": _w(BASE, "SELECT record_id, n_domain AS domain, ws_ok AS domain_valid FROM rec"),
    "norm_status": _w(BASE, "SELECT record_id, n_status AS status FROM rec"),
    "norm_employee": _w(BASE, "SELECT record_id, e_low AS employee_low, e_high AS employee_high, e_bucket AS employee_bucket, coalesce(form = 1, false) AS employee_exact, CASE WHEN form = 3 AND e_low = 55 AND e_high = 99 THEN 'EMPLOYEE_RANGE_AMBIGUITY' END AS employee_flag FROM rec"),
    "norm_naics": _w(BASE, "SELECT record_id, n_naics AS naics, n_sector AS naics_sector FROM rec"),
    "norm_date": _w(BASE, "SELECT record_id, n_iso AS issued FROM rec"),
    "first_nonempty": _w(BASE, "SELECT record_id, coalesce(nullif(trim(trade_name), ''), nullif(trim(city), ''), nullif(trim(legal_name), '')) AS value FROM landing"),
    "extra_passthrough": _w(BASE, """, x AS (
  SELECT record_id, 'businessname' AS extra_key, trade_name AS extra_value FROM landing WHERE trade_name <> '' UNION ALL SELECT record_id, 'corp_number', corp_number FROM landing WHERE corp_number <> ''
  UNION ALL SELECT record_id, 'event_type', 'MUNICIPAL_PERMIT_ISSUED' FROM landing WHERE row_key % 4 = 0
) SELECT l.record_id, extra_key, extra_value FROM landing l LEFT JOIN x USING (record_id)"""),
    "record_ids": _w(BASE, f"SELECT record_id, coalesce(nullif(trim(corp_number), ''), nullif(trim(bn), ''), {_ROWHASH('legal_name', 'status')}) AS stable_id, substr(sha256(coalesce(legal_name, '') || ':' || coalesce(city, '')), 1, 32) AS composite_id FROM landing"),
    "occurrence_ids": f"SELECT l_orderkey, l_linenumber, l_returnflag || ':' || h || ':' || row_number() OVER (PARTITION BY l_returnflag, h ORDER BY l_orderkey, l_linenumber) AS occurrence_id FROM (SELECT *, {_ROWHASH('l_linestatus', 'l_partkey')} AS h FROM lineitem)",
    "event_only_filter": _w(BASE, f"SELECT record_id, status, 'LICENCE_STATUS_CHANGE' AS event_type FROM landing WHERE lower(trim(status)) IN {_in(t.NON_ACTIVE)}"),
    "validation_report": _w(BASE, """, v AS (SELECT source_key, coalesce(trim(trade_name), '') = '' AS a, coalesce(trim(city), '') = '' AS b, coalesce(trim(status), '') = '' AS c FROM landing)
SELECT source_key, count(*) AS n_rows, count(*) FILTER (WHERE NOT (a OR b OR c)) AS n_valid, count(*) FILTER (WHERE a OR b OR c) AS n_invalid, bool_and(NOT (a OR b OR c)) AS passed, count(*) FILTER (WHERE a) AS missing_trade_name, count(*) FILTER (WHERE b) AS missing_city, count(*) FILTER (WHERE c) AS missing_status FROM v GROUP BY source_key"""),
    "validation_errors": _w(BASE, "SELECT substr(record_id, 1, 12) AS record, field FROM (" + " UNION ALL ".join(f"SELECT record_id, '{c}' AS field FROM landing WHERE coalesce(trim({c}), '') = ''" for c in ("trade_name", "city", "status")) + ")"),
    "incremental_cursor": "SELECT e.event_id, e.event_type AS kind FROM events e JOIN (SELECT event_type, min(ts) + INTERVAL 120 HOUR AS c FROM events GROUP BY 1) r ON e.event_type = r.event_type WHERE e.ts >= r.c",
    "incremental_files": "SELECT event_id, event_type AS kind, user_id, strftime(ts, '%Y-%m-%d') AS day FROM events WHERE CAST(ts AS DATE) >= (SELECT max(CAST(ts AS DATE)) - 10 FROM events)",
    "run_lifecycle": "WITH r AS (SELECT user_id % 200 AS run_id, (['RUNNING', 'FAILED', 'COMPLETED', 'PARTIAL'])[CAST(event_id % 4 + 1 AS INT)] AS run_status, ts AS changed_at FROM events) SELECT run_id, last(run_status ORDER BY changed_at, run_status) AS run_status, max(changed_at) AS changed_at, count(*) FILTER (WHERE run_status = 'FAILED') AS retry_count FROM r GROUP BY run_id",
    "match_exact": _w(STORES, "SELECT * FROM m1"),
    "match_domain_postal": _w(STORES, "SELECT * FROM m2"),
    "match_phone_postal": _w(STORES, "SELECT * FROM m3"),
    "match_name_address": _w(STORES, "SELECT * FROM m4"),
    "resolve_exact_steps": _w(STORES, f""", hit AS ({_STEPS})
SELECT n.record_id, CASE confidence WHEN 'HIGH' THEN 'MATCHED' WHEN 'MEDIUM' THEN 'CANDIDATE' ELSE CASE WHEN {_HAS_ID} THEN 'NEW' ELSE 'UNRESOLVED' END END AS outcome, rule, confidence, score, entity_id AS matched_entity FROM new n LEFT JOIN hit USING (record_id)"""),
    "resolution_entities": _w(STORES, f""", hit AS ({_STEPS})
SELECT 'entity:' || n.record_id AS entity_id, coalesce(n_legal, n_trade, source_key) AS canonical_name, n_legal AS legal_name, n_trade AS trade_name, n_province AS province, coalesce(n_status, 'UNKNOWN') AS status
FROM new n LEFT JOIN hit USING (record_id) WHERE confidence = 'MEDIUM' OR (confidence IS NULL AND {_HAS_ID})"""),
    "resolution_edges": _w(STORES, f""", hit AS ({_STEPS})
SELECT entity_id AS entity_id_a, 'entity:' || record_id AS entity_id_b, confidence, rule AS match_method, score AS match_score, false AS auto_resolved FROM hit WHERE confidence = 'MEDIUM'"""),
    "resolution_observations": _w(STORES, f""", hit AS ({_STEPS}), own AS (
  SELECT n.*, CASE confidence WHEN 'HIGH' THEN h.entity_id ELSE 'entity:' || n.record_id END AS entity_id, confidence FROM new n LEFT JOIN hit h USING (record_id) WHERE confidence IS NOT NULL OR {_HAS_ID}
), o AS (
""" + " UNION ALL ".join(f"SELECT entity_id, record_id, '{f}' AS field, nullif({raw}, '') AS raw_value, {own} AS normalised_value, {c} AS confidence, {late} AS late FROM {table}" for table, c, late in (("known", "NULL", "false"), ("own", "confidence", "true")) for f, raw, own in _OBSERVED) + """
), p AS (SELECT * FROM o WHERE raw_value IS NOT NULL OR normalised_value IS NOT NULL)
SELECT entity_id, record_id, field, normalised_value, confidence, row_number() OVER (PARTITION BY entity_id, field ORDER BY late DESC, record_id DESC) = 1 AS is_current FROM p"""),
    "retry_set": _w(STORES, f""", hit AS ({_STEPS})
SELECT n.record_id, CASE confidence WHEN 'HIGH' THEN 'MATCHED' WHEN 'MEDIUM' THEN 'CANDIDATE' ELSE CASE WHEN {_HAS_ID} THEN 'NEW' ELSE 'UNRESOLVED' END END AS outcome, rule, entity_id AS matched_entity FROM new n LEFT JOIN hit USING (record_id) WHERE run_id = 1 AND row_key % 5 < 2"""),
    "identity_gate": _w(BASE, "SELECT record_id, (row_key % 5 = 0 AND (n_legal IS NOT NULL OR n_trade IS NOT NULL)) OR row_key % 12 BETWEEN 1 AND 7 AS has_identity FROM rec"),
    "entity_children": _w(BASE, """SELECT * FROM (
  SELECT record_id, 'identifier' AS child, 'CORP_NUMBER' AS kind, nullif(trim(corp_number), '') AS value, 'HIGH' AS confidence FROM rec UNION ALL SELECT record_id, 'identifier', 'BN', nullif(trim(bn), ''), 'HIGH' FROM rec
  UNION ALL SELECT record_id, 'identifier', 'LICENCE_ID', record_id, 'HIGH' FROM rec UNION ALL SELECT record_id, 'location', 'OPERATING', whole, 'HIGH' FROM rec
  UNION ALL SELECT record_id, 'contact', 'PHONE', coalesce(n_phone, phone), CASE WHEN ph_ok THEN 'HIGH' ELSE 'LOW' END FROM rec WHERE ph_ok IS NOT NULL
  UNION ALL SELECT record_id, 'contact', 'EMAIL', coalesce(n_email, email), CASE WHEN em_ok THEN 'HIGH' ELSE 'LOW' END FROM rec WHERE em_ok IS NOT NULL UNION ALL SELECT record_id, 'contact', 'WEBSITE', n_domain, 'MEDIUM' FROM rec
) WHERE value IS NOT NULL"""),
    "entity_facts": _w(BASE, """SELECT record_id, 'employee' AS child, employees AS raw_value, e_bucket AS value, e_low AS low, e_high AS high, coalesce(form = 1, false) AS exact FROM rec WHERE e_bucket IS NOT NULL
  UNION ALL SELECT record_id, 'industry', n_naics, n_sector, NULL, NULL, NULL FROM rec WHERE n_naics IS NOT NULL OR n_sector IS NOT NULL
  UNION ALL SELECT record_id, 'flag', employees, 'EMPLOYEE_RANGE_AMBIGUITY', e_low, e_high, NULL FROM rec WHERE form = 3 AND e_low = 55 AND e_high = 99"""),
    "back_references": "SELECT 'vancouver' AS source_key, c_custkey AS source_record_id, min('bc_indigenous:' || s_suppkey) AS entity_id, 'MATCHED' AS outcome FROM supplier JOIN customer ON s_suppkey % 40 = c_custkey GROUP BY c_custkey",
    "back_reference_follow_ups": _w(BASE, """, link AS (
  SELECT record_id, run_id, row_key, coalesce(CASE WHEN row_key % 3 <> 0 THEN coalesce(n_legal, n_trade) END, 'P' || row_key) AS shown, CAST(n_date AS DATE) AS day, l.entity_id FROM rec
  JOIN (SELECT s_suppkey % 40 AS row_key, min('bc_indigenous:' || s_suppkey) AS entity_id FROM supplier GROUP BY 1) l USING (row_key) WHERE source_key = 'vancouver' AND row_key % 4 <> 0
) SELECT entity_id, run_id, 'observation' AS kind, field AS name, normalised_value AS value, CAST(NULL AS DATE) AS event_date FROM link JOIN (""" + " UNION ALL ".join(f"SELECT record_id, '{f}' AS field, nullif({raw}, '') AS raw_value, {own} AS normalised_value FROM rec" for f, raw, own in _OBSERVED) + """) USING (record_id)
  WHERE (raw_value IS NOT NULL OR normalised_value IS NOT NULL) AND NOT (row_key % 3 = 0 AND field IN ('legal_name', 'trade_name'))
UNION ALL SELECT entity_id, run_id, 'observation', 'extra.event_type', 'MUNICIPAL_PERMIT_ISSUED', NULL FROM link
UNION ALL SELECT entity_id, run_id, 'event', 'MUNICIPAL_PERMIT_ISSUED', shown, day FROM link"""),
    "unpivot_observations": _w(BASE, "SELECT * FROM (" + " UNION ALL ".join(f"SELECT record_id, '{f}' AS field, nullif({raw}, '') AS raw_value, {own} AS normalised_value FROM rec" for f, raw, own in _OBSERVED) + ") WHERE raw_value IS NOT NULL OR normalised_value IS NOT NULL"),
    "scd2_current": _w(OBS, "SELECT observation_id, entity_id, field, is_current FROM cur"),
    "scd2_batches": _w(OBS, "SELECT observation_id, entity_id, field, is_current FROM cur"),
    "field_history": _w(OBS, "SELECT entity_id, field, count(*) AS n_observations, last(value ORDER BY observed_at, observation_id) AS current_value, string_agg(coalesce(value, ''), '>' ORDER BY observed_at DESC, observation_id DESC) AS history FROM obs GROUP BY 1, 2"),
    "business_events": _w(BASE, f""", r AS (
  SELECT row_key % 400 AS entity_id, run_id, (['NEW', 'CANDIDATE', 'MATCHED'])[CAST(row_key % 3 + 1 AS INT)] AS st, row_key % 2 = 0 AS is_event, ([{', '.join(f"'{x}'" for x in (*t.TYPED_EVENTS, 'OTHER'))}])[CAST(row_key % 9 + 1 AS INT)] AS kind,
    CAST(n_date AS DATE) AS event_date, CASE WHEN row_key % 5 <> 0 THEN n_legal END AS nm, 'P' || row_key AS permit FROM rec
), e AS (
  SELECT entity_id, run_id, 'BUSINESS_DISCOVERED' AS event_type, event_date, nm AS raw_value FROM r WHERE st = 'NEW'
  UNION SELECT entity_id, run_id, kind, event_date, coalesce(nm, CASE WHEN kind = 'MUNICIPAL_PERMIT_ISSUED' THEN permit END) FROM r WHERE kind <> 'OTHER' AND (is_event OR kind = '{t.FIRST_ISSUE}')
) SELECT * FROM e EXCEPT SELECT entity_id, run_id, 'BUSINESS_DISCOVERED', event_date, nm FROM r WHERE entity_id % 7 = 0"""),
    "field_changes": _w(OBS, "SELECT * FROM chg"),
    "change_events": _w(OBS, """, k AS (
  SELECT 'BUSINESS_UPDATED' AS event_type, * FROM chg UNION ALL SELECT 'STATUS_CHANGED', * FROM chg WHERE field = 'status' UNION ALL SELECT 'NAME_CHANGED', * FROM chg WHERE field IN ('legal_name', 'trade_name')
  UNION ALL SELECT 'LOCATION_CHANGED', * FROM chg WHERE field IN ('address', 'city', 'province', 'postal_code')
) SELECT entity_id, event_type, any_value(last_seen) AS event_date, '{' || string_agg('"' || field || '":' || coalesce('"' || new_value || '"', 'null'), ',' ORDER BY field) || '}' AS raw_value,
  '{' || string_agg('"' || field || '":' || coalesce('"' || old_value || '"', 'null'), ',' ORDER BY field) || '}' AS previous_value FROM k JOIN seen USING (entity_id) GROUP BY 1, 2"""),
    "status_history": _w(OBS, "SELECT entity_id, old_value AS old_status, coalesce(new_value, 'UNKNOWN') AS new_status, observed_at AS changed_at FROM chg WHERE field = 'status'"),
    "event_fields": _w(BASE, f"""SELECT record_id,
  CAST(coalesce(CASE WHEN row_key % 13 = 0 THEN DATE '2020-01-01' END, CASE WHEN row_key % 7 = 0 THEN CAST(n_date AS DATE) END, CASE WHEN row_key % 4 = 0 THEN CAST(n_date AS DATE) END, CASE WHEN row_key % 3 = 0 THEN DATE '2024-02-01' END) AS DATE) AS event_date,
  coalesce(CASE WHEN row_key % 5 = 0 THEN n_legal END, CASE WHEN row_key % 11 = 0 THEN n_trade END, CASE WHEN row_key % 2 = 0 THEN legal_name END, CASE WHEN row_key % 3 = 0 THEN 'named' END) AS display_name,
  'P' || row_key AS permit_number, CASE WHEN row_key % 3 = 0 THEN 'REGISTRY_FILING' WHEN row_key % 7 = 0 THEN '{t.FIRST_ISSUE}' END AS event_type FROM rec"""),
    "quality_scores": _w(ENTITIES, "SELECT entity_id, identity, address, phone_score, email_score, employee, industry, contact, recency, source_reliability, composite, sales_ready FROM scored"),
    "quality_assembled": _w(ENTITIES, "SELECT entity_id, identity, address, phone_score, email_score, employee, industry, contact, recency, source_reliability, composite, sales_ready FROM scored"),
    "quality_upserts": _w(ENTITIES, "SELECT entity_id, composite, sales_ready, DATE '2024-06-01' AS scored_at FROM scored WHERE composite >= 50 UNION ALL SELECT entity_id, 0, false, DATE '2024-01-01' FROM scored WHERE row_key % 2 = 0 AND composite < 50"),
    "quality_badges": _w(ENTITIES, "SELECT CASE WHEN composite >= 70 THEN 'good' WHEN composite >= 40 THEN 'fair' ELSE 'poor' END AS badge, count(*) AS n, count(*) FILTER (WHERE sales_ready) AS n_ready FROM scored GROUP BY 1"),
    "list_businesses": _w(ENTITIES, """SELECT entity_id, canonical_name, province, city, composite, sales_ready, first_seen FROM scored
WHERE status = 'ACTIVE' AND n_phone IS NOT NULL AND n_email IS NULL AND NOT dnc AND first_seen >= DATE '2024-01-01' ORDER BY first_seen DESC NULLS LAST, entity_id LIMIT 50"""),
    "list_businesses_total": _w(ENTITIES, """, n AS (SELECT count(*) AS total FROM scored WHERE status = 'ACTIVE' AND NOT dnc)
SELECT total, 1 AS page, 10 AS page_size, CASE WHEN total > 10 THEN 2 END AS next_cursor FROM n UNION ALL SELECT total, 2, 10, CASE WHEN total > 20 THEN 3 END FROM n UNION ALL SELECT total, 1000000, 500, NULL FROM n"""),
    "business_sources": _w(BASE, """SELECT row_key % 100 AS entity_id, record_id, source_key, run_id, CAST(DATE '2024-01-01' + CAST(row_key % 5 AS INT) AS DATE) AS created_at
FROM landing WHERE row_key % 10 <> 9 AND row_key % 100 < 50 ORDER BY entity_id, created_at DESC, record_id"""),
    "list_businesses_members": _w(ENTITIES, "SELECT entity_id, canonical_name, composite FROM scored WHERE province = 'ON' AND n_domain IS NOT NULL AND directors = 0 AND row_key % 2 = 1 AND first_seen IS NOT NULL"),
    "business_detail": _w(ENTITIES, "SELECT e.entity_id, canonical_name, coalesce((SELECT string_agg(kind || ':' || value, '|' ORDER BY kind, value) FROM contacts c WHERE c.entity_id = e.entity_id), '') AS contacts, CASE WHEN first_seen IS NULL THEN 0::BIGINT ELSE 1 END AS n_events, CASE WHEN dnc THEN 1::BIGINT ELSE 0 END AS n_flags FROM ent e"),
    "business_detail_rows": _w(ENTITIES, """, ready AS (SELECT * FROM scored WHERE sales_ready)
SELECT entity_id, 'locations' AS child, CAST(json_object('address_line1', line1, 'city', city, 'province', province, 'postal_code', n_postal) AS VARCHAR) AS value FROM ready
UNION ALL SELECT entity_id, 'identifiers', CAST(json_object('kind', 'CORP_NUMBER', 'value', corp_number) AS VARCHAR) FROM ready WHERE corp_number IS NOT NULL
UNION ALL SELECT entity_id, 'identifiers', CAST(json_object('kind', 'BN', 'value', bn) AS VARCHAR) FROM ready WHERE bn IS NOT NULL
UNION ALL SELECT entity_id, 'contacts', CAST(json_object('kind', kind, 'value', value) AS VARCHAR) FROM contacts WHERE entity_id IN (SELECT entity_id FROM ready)
UNION ALL SELECT entity_id, 'persons', CAST(json_object('role_type', 'DIRECTOR', 'place', unnest(range(1, directors + 1))) AS VARCHAR) FROM ready
UNION ALL SELECT entity_id, 'employee_data', CAST(json_object('employee_bucket', e_bucket, 'employee_exact', e_exact) AS VARCHAR) FROM ready WHERE e_bucket IS NOT NULL
UNION ALL SELECT entity_id, 'industries', CAST(json_object('naics', n_naics, 'naics_sector', n_sector) AS VARCHAR) FROM ready WHERE n_naics IS NOT NULL OR n_sector IS NOT NULL
UNION ALL SELECT entity_id, 'quality_score', CAST(json_object('composite', composite, 'sales_ready', sales_ready) AS VARCHAR) FROM ready"""),
    "flag_updates": _w(ENTITIES, "SELECT entity_id, 'DNC' AS flag_type FROM ent WHERE dnc AND row_key % 2 <> 0 UNION ALL SELECT entity_id, 'VIP' FROM ent WHERE row_key % 13 = 0"),
    "list_events": _w(ENTITIES, "SELECT entity_id, event_type, event_date FROM ev WHERE event_type = 'BUSINESS_DISCOVERED' AND event_date BETWEEN DATE '2024-01-01' AND DATE '2024-03-31' AND entity_id IN (SELECT entity_id FROM ent WHERE province = 'ON') ORDER BY event_date DESC NULLS FIRST, entity_id LIMIT 100"),
    "source_status": """WITH r AS (SELECT 's' || user_id % 30 AS source_key, last(event_id ORDER BY ts, event_id) AS last_run, last(event_type ORDER BY ts, event_id) AS last_status, max(ts) AS last_started FROM events GROUP BY 1)
SELECT source_key, last_run, last_status, last_started FROM (SELECT DISTINCT 's' || s_suppkey % 40 AS source_key FROM supplier) LEFT JOIN r USING (source_key)""",
    "stats_totals": _w(ENTITIES, "SELECT count(*) AS n_businesses, count(*) FILTER (WHERE sales_ready) AS n_sales_ready, count(*) FILTER (WHERE first_seen >= DATE '2024-03-02') AS n_recent FROM scored"),
    "stats_by_province": _w(ENTITIES, "SELECT coalesce(province, 'UNKNOWN') AS province, count(*) AS n, count(*) FILTER (WHERE sales_ready AND province IS NOT NULL) AS n_ready, CASE province WHEN 'NU' THEN 'CONFIRMED' WHEN 'YT' THEN 'PARTIAL' WHEN 'QC' THEN 'DEFERRED' END AS gap FROM scored GROUP BY province"),
    "stats_by_source": _w(BASE, "SELECT source_key, count(DISTINCT n_legal) AS n_entities FROM rec GROUP BY 1"),
    "stats_merged": _w(BASE, "SELECT grp, count(DISTINCT n_legal) AS n FROM " + _GROUPS + " WHERE n_legal IS NOT NULL GROUP BY grp"),
    "overlaps_merged": _w(BASE, "SELECT a.grp AS a, b.grp AS b, count(*) AS n_both FROM (SELECT DISTINCT grp, n_legal FROM " + _GROUPS + ") a JOIN (SELECT DISTINCT grp, n_legal FROM " + _GROUPS + ") b ON a.n_legal = b.n_legal AND a.grp < b.grp GROUP BY 1, 2"),
    "contact_fill_rates": _w(ENTITIES, "SELECT kind, count(DISTINCT entity_id) AS n, round_even(count(DISTINCT entity_id)::DOUBLE / (SELECT count(*) FROM ent), 4) AS rate FROM contacts GROUP BY 1"),
    "export_rows": _w(ENTITIES, "SELECT entity_id, coalesce(canonical_name, '') AS canonical_name, coalesce(province, '') AS province, coalesce(city, '') AS city, status, n_phone AS phone, coalesce(n_email, '') AS email, coalesce(n_domain, '') AS domain, CASE WHEN composite = 0 THEN '' ELSE CAST(composite AS VARCHAR) END AS composite, CAST(sales_ready AS VARCHAR) AS sales_ready FROM scored WHERE NOT dnc AND n_phone IS NOT NULL"),
    "missingness": _w(BASE, _gaps("landing", ("trade_name", "street", "city", "province", "postal_code", "phone", "email"))),
    "value_distribution": _w(BASE, "SELECT coalesce(trim(province), '<MISSING>') AS value, count(*) AS n FROM landing GROUP BY 1 ORDER BY n DESC, value LIMIT 30"),
    "large_values": "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 20",
    "duplicate_rows": _w(BASE, "SELECT record_id, n_trade AS dup_key, n AS n_rows FROM (SELECT record_id, n_trade, count(*) OVER (PARTITION BY n_trade) AS n FROM rec WHERE n_trade IS NOT NULL) WHERE n > 1"),
    "cross_tab": "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2",
    "value_shares": "SELECT o_orderpriority, count(*) AS n, round_even(100 * count(*)::DOUBLE / (SELECT count(*) FROM orders), 2) AS pct FROM orders GROUP BY 1",
    "field_fill_rates": _w(BASE, " UNION ALL ".join(f"SELECT '{c}' AS column_name, round_even(100 * count({_REAL(c)})::DOUBLE / count(*), 1) AS pct_filled, count(DISTINCT {_REAL(c)}) AS n_distinct FROM landing" for c in ("phone", "email", "website", "employees", "naics"))),
    "date_profile": _w(BASE, """, d AS (SELECT nullif(trim(issued_date), '') AS v, n_date FROM rec)
SELECT count(v) AS n_given, count(*) FILTER (WHERE v IS NOT NULL AND n_date IS NULL) AS n_malformed, CAST(min(n_date) AS DATE) AS first_date, CAST(max(n_date) AS DATE) AS last_date, count(DISTINCT v) AS n_distinct,
  (SELECT string_agg(v, '|' ORDER BY v) FROM (SELECT DISTINCT v FROM d WHERE v IS NOT NULL ORDER BY v LIMIT 5)) AS smallest, (SELECT string_agg(v, '|' ORDER BY v) FROM (SELECT DISTINCT v FROM d WHERE v IS NOT NULL ORDER BY v DESC LIMIT 5)) AS largest FROM d"""),
    "numeric_profile": "SELECT count(c_acctbal) AS n_given, count(c_acctbal) AS n_numeric, count(*) FILTER (WHERE c_acctbal = 0) AS n_zero, count(*) FILTER (WHERE c_acctbal < 0) AS n_negative, count(*) FILTER (WHERE c_acctbal > 0) AS n_positive, min(c_acctbal) AS min_value, max(c_acctbal) AS max_value, list_sort(list(c_acctbal))[count(*) // 2 + 1] AS upper_median FROM customer",
    "bucket_histogram": "SELECT CASE WHEN p_size = 0 THEN '0' " + " ".join(f"WHEN p_size BETWEEN {a} AND {b or 10**9} THEN '{x}'" for a, b, x in t.BUCKETS) + " END AS bucket, count(*) AS n FROM part GROUP BY 1 HAVING bucket IS NOT NULL",
    "multi_value_groups": "SELECT count(*) AS n_keys, count(*) FILTER (WHERE d > 1) AS n_inconsistent, round_even(100 * count(*) FILTER (WHERE d > 1)::DOUBLE / count(*), 1) AS pct_inconsistent FROM (SELECT p_type, count(DISTINCT p_size) AS d FROM part GROUP BY 1)",
    "recency_buckets": _w(BASE, "SELECT count(n_date) AS n_dated, " + ", ".join(f"count(*) FILTER (WHERE DATE '2024-04-01' - CAST(n_date AS DATE) BETWEEN 0 AND {d}) AS last_{d}" for d in (30, 90, 365)) + " FROM rec"),
    "set_overlap": """WITH s AS (SELECT DISTINCT l_returnflag AS f, p_name AS i FROM lineitem JOIN part ON l_partkey = p_partkey), z AS (SELECT f, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.f AS a, b.f AS b, a.i FROM s a JOIN s b ON a.i = b.i AND a.f < b.f), r AS (SELECT *, row_number() OVER (PARTITION BY a, b ORDER BY i) AS k FROM p)
SELECT a, b, count(*) AS n_common, round_even(100 * count(*)::DOUBLE / any_value(za.n), 2) AS pct_of_a, round_even(100 * count(*)::DOUBLE / any_value(zb.n), 2) AS pct_of_b, string_agg(i, '|' ORDER BY i) FILTER (WHERE k <= 10) AS examples
FROM r JOIN z za ON za.f = a JOIN z zb ON zb.f = b GROUP BY a, b""",
    "set_difference": "SELECT 'first' AS side, doc_id FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels) UNION ALL SELECT 'second', doc_id FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents)",
    "membership_rate": _w(STORES, """, k AS (SELECT DISTINCT regexp_replace(lower(legal_name), '[^a-z0-9]', '', 'g') AS k FROM known)
SELECT count(*) AS n_rows, count(k.k) AS n_members, round_even(100 * count(k.k)::DOUBLE / count(*), 2) AS pct_members FROM new n LEFT JOIN k ON regexp_replace(lower(n.legal_name), '[^a-z0-9]', '', 'g') = k.k"""),
    "grain_profile": "SELECT (SELECT count(*) FROM orders) AS n_rows, (SELECT count(DISTINCT o_orderkey) FROM orders) AS n_licences, count(*) AS n_entities, count(*) FILTER (WHERE n > 1) AS n_repeated, count(*) FILTER (WHERE d > 1) AS n_multi_kind FROM (SELECT o_custkey, count(*) AS n, count(DISTINCT o_orderpriority) AS d FROM orders GROUP BY 1)",
    "contact_quality": _w(BASE, "SELECT count(*) AS n, count(ph) AS phone_present, count(*) FILTER (WHERE ph_ok) AS phone_valid, count(em) AS email_present, count(*) FILTER (WHERE em_ok) AS email_valid, count(ws) AS url_present, count(*) FILTER (WHERE ws_ok) AS url_valid, count(*) FILTER (WHERE ph_ok AND em_ok AND ws_ok) AS all_three FROM rec"),
    "stream_counters": _w(BASE, "SELECT source_key, count(*) AS n, count(*) FILTER (WHERE n_province IS NULL) AS no_province, count(*) FILTER (WHERE n_status = 'ACTIVE') AS n_active, count(DISTINCT n_province) AS n_provinces FROM rec GROUP BY 1"),
    "province_distribution": _w(BASE, "SELECT n_province AS province, count(*) AS n, round_even(100 * count(*)::DOUBLE / sum(count(*)) OVER (), 2) AS pct FROM rec WHERE n_province IS NOT NULL GROUP BY 1"),
    "dimension_profile": " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_values, min(CAST({c} AS VARCHAR)) AS first_value, max(CAST({c} AS VARCHAR)) AS last_value FROM part" for c in ("p_brand", "p_type", "p_size")),
    "dimension_values": " UNION ALL ".join(f"SELECT '{c}' AS column_name, trim(CAST({c} AS VARCHAR)) AS value, count(*) AS n FROM part GROUP BY 2" for c in ("p_brand", "p_type", "p_size")),
    "label_buckets": _w(BASE, f"SELECT DISTINCT employees, CASE WHEN {_LABEL} = '' THEN NULL " + " ".join(f"WHEN contains({_LABEL}, '{x}') OR contains('{x}', {_LABEL}) THEN '{x}'" for _, _, x in t.BUCKETS) + " " + " ".join(f"WHEN {_FIRST} >= {a} THEN '{x}'" for a, _, x in reversed(t.BUCKETS)) + " END AS bucket FROM landing"),
    "coverage_matrix": _w(BASE, f"SELECT p AS province, count(DISTINCT source_key) AS n_sources, count(source_key) = 0 AS gap FROM (SELECT unnest([{', '.join(repr(p) for p in t.PROVINCES)}]) AS p) LEFT JOIN rec ON n_province = p GROUP BY p"),
    "field_matrix": _w(BASE, "SELECT source_key, " + ", ".join(f"avg(CASE WHEN coalesce(trim({c}), '') <> '' THEN 1.0 ELSE 0 END) > 0.5 AS has_{c}" for c in ("trade_name", "street", "phone", "corp_number", "naics")) + " FROM landing GROUP BY 1"),
    "resource_pick": "SELECT p_partkey, CASE WHEN p_partkey % 2 <> 0 THEN 'https://data.example.ca/3/' || p_partkey WHEN p_partkey % 3 = 0 THEN 'https://data.example.ca/4/' || p_partkey END AS url FROM part",
    "page_mailto": r"""SELECT page_id, coalesce(list_aggregate(list_sort(list_distinct(regexp_extract_all(html || '<a href="MAILTO:Info@' || page_id || '.example.com">x</a><a href="mailto:a.b@c.example.ca?subject=x">y</a>', '(?i)mailto:([a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,})', 1))), 'string_agg', '|'), '') AS emails FROM pages""",
}

# --- enrichment ----------------------------------------------------------------------------------
_LANDING = f"WITH landing AS ({landing_sql()})"
_ANSWERS = _LANDING + ", answers AS (SELECT record_id AS entity_id, legal_name || '0' AS legal_name, status, issued_date FROM landing WHERE row_key % 3 = 0)"
_PHONE = r"(?:\+?1[-.\s]?)?\(?\d{3}\)?[-.\s]\d{3}[-.\s]\d{4}"
ORACLE_SQL |= {
    "enrich_directors": _LANDING + """
SELECT DISTINCT e.record_id AS entity_id, 'Director ' || (f.row_key % 7) AS person_name, 'DIRECTOR' AS role_type, 'HIGH' AS confidence
FROM landing f JOIN landing e ON e.corp_number = f.corp_number
WHERE e.corp_number <> '' AND f.row_key % 2 = 0 AND f.row_key % 5 <> 0 AND NOT (e.row_key % 3 = 0 AND e.row_key % 7 = f.row_key % 7)""",
    "enrich_register": _ANSWERS + """
SELECT entity_id, field, value, 'bc_orgbook' AS enrichment_source, 'MEDIUM' AS confidence FROM (
  SELECT entity_id, 'legal_name' AS field, legal_name AS value FROM answers UNION ALL SELECT entity_id, 'status', status FROM answers UNION ALL SELECT entity_id, 'registration_date', issued_date FROM answers
) WHERE trim(value) <> ''""",
    "enrich_register_updates": _w(BASE, f"""
SELECT record_id AS entity_id, CASE WHEN row_key % 3 = 0 AND trim(status) <> '' THEN trim(status) ELSE n_status END AS status,
  CASE WHEN row_key % 3 = 0 AND trim(status) <> '' THEN {AS_OF} WHEN row_key % 8 <> 0 THEN {AS_OF} - to_hours(CAST(row_key % 900 * 24 AS INT)) END AS last_verified_at
FROM rec"""),
    "enrich_website_phones": f"""
WITH pages_ AS (SELECT page_id, html || '<p>(416) 555-' || lpad(CAST(page_id % 10000 AS VARCHAR), 4, '0') || ' or +1 604.555.0199; 416.555.' || lpad(CAST(page_id % 10000 AS VARCHAR), 4, '0') || ', 999-555-0100</p>' AS html FROM pages),
raw AS (SELECT page_id, unnest(regexp_extract_all(html, '{_PHONE}')) AS raw_value FROM pages_),
ten AS (SELECT *, right(regexp_replace(raw_value, '[^0-9]', '', 'g'), 10) AS ten FROM raw)
SELECT page_id AS entity_id, 'PHONE' AS kind, min(raw_value) AS raw_value, '+1' || ten AS value, 'LOW' AS confidence FROM ten
WHERE regexp_matches(ten, '^[2-9][0-9][0-9][2-9]') AND substr(ten, 1, 3) IN {_in((*t.AREA_CODES, *t.TOLL_FREE))} AND NOT (page_id % 4 = 0 AND ten = '6045550199') GROUP BY page_id, ten""",
    "enrich_directors_due": _LANDING + """
SELECT 'e' || record_id AS event_id, record_id AS entity_id, corp_number FROM landing WHERE corp_number <> '' AND row_key % 2 = 0 AND row_key % 3 <> 0 ORDER BY event_id, corp_number LIMIT 50 OFFSET 10""",
    "enrich_registers_due": _w(BASE, """
SELECT record_id AS entity_id, CASE WHEN row_key % 11 <> 0 THEN n_legal END AS business_name, CASE WHEN row_key % 2 = 0 THEN CAST(row_key AS VARCHAR) END AS bc_reg_id FROM rec
WHERE n_province = 'BC' AND NOT (row_key % 5 <> 0 AND row_key % 7 < 3) AND (row_key % 2 = 0 OR (row_key % 11 <> 0 AND n_legal IS NOT NULL)) ORDER BY entity_id, bc_reg_id LIMIT 25"""),
}


def _sql(pattern: str) -> str:
    return pattern.replace("'", "''")


def _text(html: str) -> str:
    bare = rf"regexp_replace(regexp_replace({html}, '(?is)<script\b.*?</script\s*>', ' ', 'g'), '(?is)<style\b.*?</style\s*>', ' ', 'g')"
    return rf"trim(regexp_replace(regexp_replace({bare}, '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'))"


_ASSETS = " AND ".join(f"NOT lower(e) LIKE '%{s}'" for s in t.ASSET_SUFFIXES)
_HOST = r"regexp_replace(lower(regexp_extract(u, '^https?://([^/?#]+)', 1)), '^www\.', '')"
_STOPPED = " OR ".join(f"contains(lower(x.w), '{w}') OR contains(lower(x.a || ' ' || x.b), '{w}')" for w in t.PERSON_STOP)

ORACLE_SQL |= {
    "page_emails": rf"""WITH p AS (SELECT page_id, html, {_text("html")} AS body FROM pages),
e AS (SELECT page_id, unnest(regexp_extract_all(body, '{t.EMAIL_IN_TEXT}')) AS e FROM p UNION SELECT page_id, unnest(regexp_extract_all(html, '{t.MAILTO}', 1)) FROM p
  UNION SELECT page_id, CASE WHEN json_valid(b) THEN json_extract_string(b, '$.email') END FROM (SELECT page_id, unnest(regexp_extract_all(html, '{_sql(t.LD_JSON)}', 1)) AS b FROM p)),
r AS (SELECT page_id, e, row_number() OVER (PARTITION BY page_id ORDER BY e) AS k FROM e WHERE e IS NOT NULL AND {_ASSETS})
SELECT p.page_id, coalesce(string_agg(e, '|' ORDER BY e), '') AS emails FROM p LEFT JOIN r ON p.page_id = r.page_id AND k <= 10 GROUP BY p.page_id""",
    "page_leadership": rf"""SELECT page_id, array_to_string(list_transform(list_filter(string_split({_text("html || '<p>Our president is here. No.</p>'")}, '.'), lambda s: regexp_matches(s, '{t.LEADERS}'))[1:5], lambda s: substr(trim(s), 1, 200)), '|') AS sentences FROM pages""",
    "page_persons": rf"""WITH p AS (SELECT page_id, html || '<p>Jane Smith, President of us. Privacy Terms - Manager</p>' AS h FROM pages),
x AS (SELECT page_id, list_zip({", ".join(f"regexp_extract_all(h, '{t.PERSON}', {g})" for g in range(4))}) AS z FROM p)
SELECT page_id, array_to_string(list_transform(list_filter(list_transform(z, lambda y: {{'w': y[1], 'a': y[2], 'b': y[3], 'r': y[4]}}), lambda x: NOT ({_STOPPED})), lambda x: x.a || ' ' || x.b || ':' || x.r), '|') AS persons FROM x""",
    "page_link_domains": rf"""WITH p AS (SELECT page_id, html || '<a class="r" href="/l/?uddg=https%3A%2F%2Fwww.shop' || (page_id % 9) || '.example.ca%2Fx&amp;rut=1">a</a><a href="https://www.facebook.com/x">b</a><a href="' || coalesce(url, '') || '">c</a>' AS h FROM pages),
l AS (SELECT page_id, unnest(regexp_extract_all(h, '(?i)<a\b[^>]*?\bhref=["'']([^"'']*)["'']', 1)) AS href, generate_subscripts(regexp_extract_all(h, '(?i)<a\b[^>]*?\bhref=["'']([^"'']*)["'']', 1), 1) AS k FROM p),
d AS (SELECT page_id, k, CASE WHEN contains(href, '/l/?uddg=') OR contains(href, '/l/?kh=') THEN url_decode(regexp_extract(replace(href, '&amp;', '&'), '[?&](?:uddg|u)=([^&]*)', 1)) WHEN href LIKE 'http%' THEN href END AS w FROM l),
u AS (SELECT page_id, k, regexp_extract(w, '^(https?://[^/?#]+)', 1) AS u FROM d WHERE w IS NOT NULL),
f AS (SELECT page_id, u, min(k) AS k FROM u WHERE contains({_HOST}, '.') AND NOT ({" OR ".join(f"contains({_HOST}, '{x}')" for x in t.EXCLUDED_DOMAINS)}) GROUP BY page_id, u),
r AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY k) AS place FROM f)
SELECT p.page_id, coalesce(string_agg(u, '|' ORDER BY place), '') AS domains FROM p LEFT JOIN r ON p.page_id = r.page_id AND place <= 8 GROUP BY p.page_id""",
    "domain_verification": rf"""WITH p AS (SELECT page_id, lower({_text("html")}) AS body, list_filter(regexp_split_to_array(lower('The ' || substr(html, 200, 12) || ' article Inc'), '\W+'), lambda w: length(w) > 2 AND w NOT IN {_in(t.NAME_NOISE)}) AS words FROM pages)
SELECT page_id, CASE WHEN len(list_filter(words, lambda w: contains(body, w))) >= 2 AND (contains(body, 'nowhere') OR contains(body, 'the')) THEN 'VERIFIED' WHEN len(list_filter(words, lambda w: contains(body, w))) >= 1 THEN 'PLAUSIBLE' ELSE 'NOT_VERIFIED' END AS verdict FROM p""",
}
ORACLE_SQL |= batch_oracles(BASE, STORES, _STEPS, _HAS_ID)
