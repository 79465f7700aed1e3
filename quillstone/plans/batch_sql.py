"""SQL for DuckDB of name similarity, batch resolution and the way from landed files to entities."""

from __future__ import annotations


def _masks(x: str, y: str) -> str:
    return f"list_transform(string_split({y}, ''), lambda c: list_sum(list_transform(range(1, length({x}) + 1), lambda i: CASE WHEN substr({x}, i, 1) = c THEN CAST(1 AS HUGEINT) << CAST(i - 1 AS INT) ELSE CAST(0 AS HUGEINT) END))::HUGEINT)"


def ratio_sql(source: str, x: str = "x", y: str = "y") -> str:
    """Rows of ``source`` (names of up to 120 letters) with ``score``: 200 times the longest common subsequence, by rows of bits, over both lengths."""
    full = f"((CAST(1 AS HUGEINT) << CAST(length({x}) AS INT)) - 1)"
    row = f"list_reduce(list_prepend({full}, {_masks(x, y)}), lambda r, m: ((r + (r & m)) | (r - (r & m))) & {full})"
    return f"SELECT *, 200.0::DOUBLE * (length({x}) - bit_count({row})) / (length({x}) + length({y})) AS score FROM {source}"


def keyed_name(name: str, code: str) -> str:
    return f"list_aggregate(list_sort(list_filter(string_split_regex(lower({name}) || ' ' || upper({code}), '\\s+'), lambda w: w <> '')), 'string_agg', ' ')"


def fuzzy_sql(new: str, known: str, name: str, pairs: str, where: str = "TRUE") -> str:
    """CTEs: ``name`` with the best known entity of each new record by name."""
    return f"""
{pairs} AS (
  SELECT n.record_id, k.entity_id, {keyed_name('coalesce(n.n_legal, n.n_trade)', 'n.n_postal')} AS x, {keyed_name("coalesce(k.n_legal, k.n_trade, '')", 'n.n_postal')} AS y
  FROM {new} n JOIN {known} k ON upper(substr(n.n_postal, 1, 3)) = upper(substr(k.n_postal, 1, 3)) WHERE coalesce(n.n_legal, n.n_trade) IS NOT NULL AND {where}
),
{name} AS (
  SELECT record_id, first(entity_id ORDER BY score DESC, entity_id) AS entity_id, 'FUZZY_NAME' AS rule, 'LOW' AS confidence, round(max(score), 2) AS score FROM ({ratio_sql(pairs)}) WHERE score >= 88 GROUP BY record_id
)"""


def batch_ctes(batch: str, snap: str, own: str, fuzzy: bool = True) -> str:
    """CTEs up to ``answer``: the resolution of ``batch`` (ordered by source and ``own``) against ``snap``; columns as in the normalised view."""
    keys = lambda rows, who: f"""
  SELECT {who}, 1 AS step, n_domain AS a, n_postal AS b FROM {rows} WHERE n_domain IS NOT NULL AND n_postal IS NOT NULL UNION ALL SELECT {who}, 2, n_phone, n_postal FROM {rows} WHERE n_phone IS NOT NULL AND n_postal IS NOT NULL
  UNION ALL SELECT {who}, 3, n_legal, whole FROM {rows} WHERE n_legal IS NOT NULL AND whole IS NOT NULL UNION ALL SELECT {who}, 3, n_trade, whole FROM {rows} WHERE n_trade IS NOT NULL AND whole IS NOT NULL"""  # noqa: E731
    return f"""
strong AS (SELECT record_id, 'C' AS kind, trim(corp_number) AS v, 1 AS p FROM {batch} WHERE trim(corp_number) <> '' UNION ALL SELECT record_id, 'B', trim(bn), 2 FROM {batch} WHERE trim(bn) <> ''),
known_ids AS (SELECT entity_id, 'C' AS kind, trim(corp_number) AS v FROM {snap} WHERE trim(corp_number) <> '' UNION ALL SELECT entity_id, 'B', trim(bn) FROM {snap} WHERE trim(bn) <> ''),
edge AS (SELECT DISTINCT x.record_id AS a, y.record_id AS b FROM strong x JOIN strong y USING (kind, v)),
reach AS (SELECT record_id, record_id AS other FROM {batch} UNION SELECT r.record_id, e.b FROM reach r JOIN edge e ON r.other = e.a),
placed AS (SELECT *, row_number() OVER (ORDER BY coalesce(n_legal, n_trade, nullif(trim(corp_number), ''), nullif(trim(bn), '')) IS NULL, source_key, {own}, record_id) AS place, coalesce(n_legal, n_trade, nullif(trim(corp_number), ''), nullif(trim(bn), '')) IS NULL AS nameless FROM {batch}),
rooted AS (SELECT r.record_id, min(p.place) AS seed FROM reach r JOIN placed p ON r.other = p.record_id GROUP BY r.record_id),
direct AS (SELECT s.record_id, first(k.entity_id ORDER BY p, k.entity_id) AS own_entity FROM strong s JOIN known_ids k USING (kind, v) GROUP BY s.record_id),
anchored AS (SELECT seed, min(own_entity) AS anchor FROM rooted JOIN direct USING (record_id) GROUP BY seed),
tied AS (
  SELECT p.*, r.seed, coalesce(d.own_entity, a.anchor) AS entity, s.record_id AS seed_record, s.nameless AS seed_nameless
  FROM placed p JOIN rooted r USING (record_id) JOIN placed s ON s.place = r.seed LEFT JOIN direct d ON d.record_id = p.record_id LEFT JOIN anchored a ON a.seed = r.seed
),
free AS (SELECT *, 'entity:' || record_id AS entity_id FROM tied WHERE entity IS NULL AND seed = place AND NOT nameless),
own_keys AS ({keys('free', 'record_id, entity_id, place')}),
all_keys AS ({keys(snap, 'entity_id, 0 AS place')}
  UNION ALL SELECT entity_id, place, step, a, b FROM own_keys),
met AS (SELECT o.record_id, o.step, k.place, k.entity_id FROM own_keys o JOIN all_keys k USING (step, a, b) WHERE k.place < o.place),
weaker AS (
  SELECT record_id, first(entity_id ORDER BY step, place, entity_id) AS entity_id, (['DOMAIN_POSTAL', 'PHONE_POSTAL', 'NAME_ADDRESS'])[CAST(min(step) AS INT)] AS rule, 'MEDIUM' AS confidence, ([90.0, 85.0, 80.0])[CAST(min(step) AS INT)]::DOUBLE AS score
  FROM met GROUP BY record_id
),
pool AS (SELECT entity_id, n_legal, n_trade, n_postal, 0 AS place FROM {snap} UNION ALL SELECT entity_id, n_legal, n_trade, n_postal, place FROM free),
unmet AS (SELECT * FROM free WHERE record_id NOT IN (SELECT record_id FROM weaker)),{fuzzy_sql('unmet', 'pool', 'low', 'low_pairs', 'k.place < n.place')},
found AS (SELECT * FROM weaker{' UNION ALL SELECT * FROM low' if fuzzy else ''}),
answer AS (
  SELECT t.record_id, t.source_key, CASE WHEN strongly THEN 'MATCHED' WHEN t.nameless THEN 'UNRESOLVED' WHEN f.confidence = 'MEDIUM' THEN 'CANDIDATE' ELSE 'NEW' END AS outcome, CASE WHEN strongly THEN 'EXACT_IDENTIFIER' ELSE f.rule END AS rule,
    CASE WHEN strongly THEN 'HIGH' ELSE f.confidence END AS confidence, CASE WHEN strongly THEN 100.0::DOUBLE ELSE f.score END AS score, coalesce(t.entity, CASE WHEN strongly THEN 'entity:' || seed_record END, f.entity_id) AS matched_entity,
    CASE WHEN t.entity IS NULL AND NOT seed_nameless THEN seed_record END AS seed
  FROM (SELECT *, entity IS NOT NULL OR (seed <> place AND NOT seed_nameless) AS strongly FROM tied) t LEFT JOIN found f USING (record_id)
)"""


def landed_ctes() -> str:
    """CTEs ``arrived`` and ``nothing``: the records of the landed files as normalised, and no known entity."""
    number = "CAST(row_key AS VARCHAR)"
    empty = "CAST(NULL AS VARCHAR)"
    rows = []
    fields = "n_domain, n_phone, n_postal, whole"
    named = {
        "corporations_canada_csv": (f"'C' || lpad({number}, 7, '0')", "n_legal", empty, f"'C' || lpad({number}, 7, '0')", empty, "source_key = 'vancouver' AND row_key % 4 = 0"),
        "montreal": (number, "n_legal || ' é'", empty, empty, empty, "source_key = 'vancouver' AND row_key % 4 = 1"),
        "bc_indigenous": ("substr(sha256(trim(legal_name) || ':' || coalesce(trim(city), '')), 1, 32)", "n_legal", empty, empty, empty, "source_key = 'vancouver' AND row_key % 4 = 2"),
        "ontario_select_licence": (number, "n_legal", "CASE WHEN trade_name <> '' THEN n_trade END", empty, empty, "source_key = 'vancouver' AND row_key % 4 = 3 AND row_key % 28 <> 3"),
        "calgary": (number, empty, "n_trade", "nullif(corp_number, '')", "nullif(bn, '')", "source_key = 'bc_indigenous'"),
    }
    for key, (rid, legal, trade, corp, bn, where) in named.items():
        rows.append(f"SELECT '{key}' AS source_key, row_key, {rid} AS own_id, {legal} AS n_legal, {trade} AS n_trade, {corp} AS corp_number, {bn} AS bn, {fields} FROM rec WHERE {where}")
    return "given AS (" + "\n UNION ALL ".join(rows) + "),\narrived AS (SELECT *, source_key || ':' || own_id AS record_id FROM given),\nnothing AS (SELECT *, record_id AS entity_id FROM arrived WHERE FALSE)"


def batch_oracles(base: str, stores: str, steps: str, has_id: str) -> dict[str, str]:
    fuzzy = fuzzy_sql("new", "known", "low", "low_pairs")
    return {
        "match_fuzzy": f"WITH {stores.strip()},{fuzzy}\nSELECT * FROM low",
        "resolve_outcomes": f"""WITH {stores.strip()},{fuzzy}, high AS ({steps}), hit AS (SELECT * FROM high UNION ALL SELECT * FROM low WHERE record_id NOT IN (SELECT record_id FROM high))
SELECT n.record_id, CASE confidence WHEN 'HIGH' THEN 'MATCHED' WHEN 'MEDIUM' THEN 'CANDIDATE' ELSE CASE WHEN {has_id} THEN 'NEW' ELSE 'UNRESOLVED' END END AS outcome, rule, confidence, score, entity_id AS matched_entity FROM new n LEFT JOIN hit USING (record_id)""",
        "resolve_batch": f"""WITH RECURSIVE {base.strip()},
batch AS (SELECT * FROM rec WHERE source_key = 'bc_indigenous' OR row_key % 2 = 0), snap AS (SELECT *, record_id AS entity_id FROM rec WHERE source_key = 'vancouver' AND row_key % 2 = 1),{batch_ctes('batch', 'snap', 'record_id')}
SELECT record_id, outcome, rule, confidence, score, matched_entity, seed FROM answer""",
        "source_to_entity": f"""WITH RECURSIVE {base.strip()},
{landed_ctes()},{batch_ctes('arrived', 'nothing', 'own_id')}
SELECT a.record_id, a.source_key, a.outcome, a.rule, a.confidence, a.score, CASE outcome WHEN 'MATCHED' THEN matched_entity WHEN 'UNRESOLVED' THEN NULL ELSE 'entity:' || a.record_id END AS entity_id, CASE WHEN outcome IN ('CANDIDATE', 'NEW') THEN coalesce(g.n_legal, g.n_trade, g.source_key) END AS canonical_name, g.corp_number, g.whole AS normalised_address
FROM answer a JOIN arrived g USING (record_id)""",
        "run_stages": f"""WITH RECURSIVE {stores.strip()},{batch_ctes('new', 'known', 'record_id', fuzzy=False)},
made AS (SELECT a.*, n.n_date, coalesce(n.n_legal, n.n_trade) AS own_name FROM answer a JOIN new n USING (record_id)),
counts AS (
  SELECT 'normalise' AS stage, 1 AS attempts, 'records' AS table_name, (SELECT count(*) FROM new) AS n_rows UNION ALL SELECT 'resolve', 2, 'records', (SELECT count(*) FROM made)
  UNION ALL SELECT 'resolve', 2, 'entities', (SELECT count(*) FROM made WHERE outcome IN ('CANDIDATE', 'NEW')) UNION ALL SELECT 'resolve', 2, 'edges', (SELECT count(*) FROM made WHERE confidence IN ('MEDIUM', 'LOW'))
  UNION ALL SELECT 'events', 1, 'events', (SELECT count(*) FROM made WHERE outcome = 'NEW') UNION ALL SELECT 'quality', 1, 'scores', (SELECT count(*) FROM made WHERE outcome IN ('CANDIDATE', 'NEW'))
)
SELECT stage, 'COMPLETED' AS state, attempts, table_name, n_rows FROM counts""",
    }
