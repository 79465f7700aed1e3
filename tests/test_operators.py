"""Resolution, history, records, readers, extraction and streaming on small fixtures."""

import io
import json
import random
import re
import zipfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillstone.functions import tables as t
from quillstone.operators import enrich, extract, history, listing, profile, records, resolve
from quillstone.plans import queries as q
from quillstone.sources import catalogue, readers
from quillstone.streaming import changes


@settings(max_examples=200, deadline=None)
@given(st.text("abc ", max_size=12), st.text("abc ", max_size=12))
def test_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    assert resolve.lcs(a, b) == row[-1]


def plain_score(name, other, code):
    """Similarity of two names, each with the same code behind it, words sorted: by the textbook distance of insertions and deletions."""
    x, y = (" ".join(sorted(f"{s.lower().strip()} {code.upper().strip()}".split())) for s in (name, other))
    row = list(range(len(y) + 1))
    for i, p in enumerate(x):
        new = [i + 1]
        for j, q in enumerate(y):
            new.append(row[j] if p == q else 1 + min(row[j + 1], new[-1]))
        row = new
    return 100 * (1 - row[-1] / (len(x) + len(y)))


def test_fuzzy_against_brute_force(spark, sf):
    new, known = q.stores(spark, sf)
    made = [("n1", "acme limited", None, "V6B 1A1"), ("n2", None, "b", "V6B 1A1"), ("n3", "acme limited", None, None), ("n4", None, None, "V6B 1A1"), ("n5", "one two three four", None, "v6b2b2"), ("n6", "solo", None, "V6B 1A1")]
    kept = [("e1", "acme limted", None, "x", "V6B 9Z9"), ("e2", None, "acme  limitd", "x", "V6B 9Z9"), ("e3", None, None, "four three two one", "V6B 9Z9"), ("e4", None, None, None, "V6B 9Z9"), ("e5", "acme limited", None, "x", "V6C 1A1"), ("e6", None, None, "sola", "V6B 9Z9"), ("e0", "acme limted", None, "x", "V6B 9Z9")]
    cases = [(new.limit(100), known.limit(400).withColumn("canonical_name", F.lit("unused"))), (spark.createDataFrame(made, "record_id string, legal_name string, trade_name string, postal_code string"), spark.createDataFrame(kept, "entity_id string, legal_name string, trade_name string, canonical_name string, postal_code string"))]
    some = 0
    for records_, entities in cases:
        got = {r["record_id"]: (r["entity_id"], r["score"], r["confidence"]) for r in resolve.match_fuzzy(records_, entities).collect()}
        a, b = records_.select("record_id", "legal_name", "trade_name", "postal_code").collect(), entities.select("entity_id", "legal_name", "trade_name", "canonical_name", "postal_code").collect()
        want = {}
        for x in a:
            name, code = x["legal_name"] or x["trade_name"], x["postal_code"]
            if name and code:
                scores = [(-plain_score(name, y["legal_name"] or y["trade_name"] or y["canonical_name"] or "", code), y["entity_id"]) for y in b if (y["postal_code"] or "").upper()[:3] == code[:3].upper()]
                best = min((s for s in scores if s[0] <= -resolve.THRESHOLD), default=None)
                if best:
                    want[x["record_id"]] = (best[1], round(-best[0], 2), "LOW")
        assert {k: (e, c) for k, (e, _, c) in got.items()} == {k: (e, c) for k, (e, _, c) in want.items()}
        assert all(abs(got[k][1] - want[k][1]) <= 0.011 for k in got)
        some += len(got)
    assert set(got) == {"n1", "n5", "n6"} and got["n1"][0] == "e0" and some > 3


def test_plans_are_linear(spark, sf):
    """Scans and regular expressions of the record plans, counted: they must not multiply with the steps that read them."""
    text = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    count = lambda df: (text(df).count("Relation ["), len(__import__("re").findall(r"regexp_|RLIKE|split\(", text(df))))
    spark.conf.set("spark.sql.maxPlanStringLength", str(1 << 30))
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    assert count(q.QUERIES["norm_address"](spark, sf))[1] <= 80
    scans, patterns = count(q.QUERIES["resolve_exact_steps"](spark, sf))
    assert scans <= 6 and patterns <= 600


def test_each_record_has_one_outcome(spark, sf):
    new, known = q.stores(spark, sf)
    rows = resolve.resolve(new, known).collect()
    assert len(rows) == new.count() == len({r["record_id"] for r in rows})
    assert {r["outcome"] for r in rows} <= {"MATCHED", "CANDIDATE", "NEW", "UNRESOLVED"}
    assert all((r["matched_entity"] is None) == (r["rule"] is None) for r in rows)


def test_missing_field_is_no_change(spark):
    rows = [(1, "status", "A", 1, 1, 0), (1, "status", "B", 2, 2, 1), (1, "city", "x", 1, 3, 0), (2, "city", "y", 1, 4, 1), (3, "phone", None, 1, 5, 0), (3, "phone", "1", 2, 6, 1)]
    obs = spark.createDataFrame(rows, "entity_id int, field string, value string, observed_at int, observation_id int, run_id int").withColumn("observed_at", F.timestamp_seconds("observed_at"))
    got = {(r["entity_id"], r["field"], r["old_value"], r["new_value"]) for r in history.changes(history.with_current(obs), 1).collect()}
    assert got == {(1, "status", "A", "B"), (3, "phone", None, "1")}


def test_events_deduplicate_null_dates(spark):
    rows = spark.createDataFrame([(1, 1, "NEW", "EVENT", "PROVINCIAL_REGISTRATION", None, "a", None), (1, 1, "NEW", "EVENT", "PROVINCIAL_REGISTRATION", None, "a", None), (2, 1, "CANDIDATE", "EVENT", "MUNICIPAL_PERMIT_ISSUED", None, None, "P1")], "entity_id int, run_id int, resolution_status string, grain string, event_type string, event_date date, display_name string, permit_number string")
    done = history.new_business_events(rows)
    assert done.count() == 3 and done.filter("raw_value = 'P1'").count() == 1
    assert history.new_business_events(rows, done).count() == 0


def test_guards(spark):
    bad = spark.createDataFrame([({"bn": "1"},)], "p map<string,string>")
    with pytest.raises(Exception, match="aggregate-only"):
        records.guard_aggregate_only(bad, F.col("p"), ["bn"]).collect()
    assert records.guard_aggregate_only(bad, F.col("p"), ["name"]).count() == 1
    with pytest.raises(ValueError):
        records.guard_targets(["a"])
    with pytest.raises(PermissionError):
        records.guard_terms("BLOCKED")


def test_numeric_profile_of_nothing_and_ties(spark):
    df = spark.createDataFrame([("1",), ("1",), ("2",), ("x",), (None,), ("9",)], "v string")
    r = profile.numeric_profile(df, F.col("v")).first()
    assert (r["n_given"], r["n_numeric"], r["upper_median"]) == (5, 4, 2.0)
    assert profile.numeric_profile(df.limit(0), F.col("v")).first()["upper_median"] is None


def test_extraction(spark):
    html = """<p>Call (416) 555-0199 or 416.555.0199; +1 604 555 0100 no 1234567890123</p>
    <script type="application/ld+json">{"@graph":[{"@type":"Person","name":"A B","jobTitle":"CEO"},{"x":{"Email":"z@y.ca"}}]}</script><script type="application/ld+json">{bad</script>
    <a href="mailto:B@x.ca">m</a><a href='https://www.bing.com/'>n</a> Jane Smith, Owner"""
    r = spark.createDataFrame([(html,), (None,)], "h string").select(extract.phones(F.col("h")).alias("p"), extract.ld_emails(F.col("h")).alias("e"), extract.ld_persons(F.col("h")).alias("d"), extract.page_emails(F.col("h")).alias("m"), extract.persons(F.col("h")).alias("j"), extract.link_domains(F.col("h"), ("bing.com",)).alias("l")).collect()
    assert r[0]["p"] == ["416-555-0199", "604-555-0100"]
    assert r[0]["e"] == ["z@y.ca"] and r[0]["d"] == ["A B|CEO"] and r[0]["m"] == ["B@x.ca"] and r[0]["l"] == []
    assert [(x["name"], x["role"]) for x in r[0]["j"]] == [("Jane Smith", "Owner")]


def test_readers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('ExternalId, Business_Name \n1,"A, ""x"" Ltd"\n1,"A, ""x"" Ltd"\n2,\n')
    rows = readers.read_table(spark, str(tmp_path / "a.csv"))
    assert rows.columns == ["externalid", "business_name"] and rows.filter("business_name = ''").count() == 1
    raw = readers.as_payload(rows, "edmonton", "LICENCE", ["externalid"]).collect()
    assert raw[0]["raw_payload"]["business_name"] == 'A, "x" Ltd'
    ids = records.with_occurrence(rows.withColumn("pos", F.monotonically_increasing_id()), F.col("externalid"), [F.col("business_name")], F.col("pos")).select("occurrence_id").collect()
    assert len({r[0] for r in ids}) == 3
    (tmp_path / "w.csv").write_text("licence_number,trade_name,status\n1,a,Active\n2,b,Expired\n")
    got = catalogue.read(spark, "winnipeg", str(tmp_path / "w.csv")).collect()
    assert [(r["source_record_id"], r["raw_payload"]["event_type"]) for r in got] == [("2", "LICENCE_STATUS_CHANGE")]
    with pytest.raises(PermissionError):
        catalogue.read(spark, "nni", str(tmp_path / "w.csv"), terms="UNRESOLVED")
    assert readers.sniff("a;b\n1;2\n".encode()) == ("utf-8-sig", ";")
    assert readers.sniff("né\t2\n".encode("cp1252"))[0] == "cp1252"


def test_json_readers(spark):
    docs = spark.createDataFrame([(json.dumps({"corp_number": "1", "directors": [{"firstName": "A", "lastName": "B"}]}),), (json.dumps({"corp_number": "2", "directors": []}),)], "json string")
    assert sorted(((r["corp_number"], r["director_name"]) for r in readers.directors(docs).collect())) == [("1", "A B"), ("2", None)]
    cred = {"topic_id": "t", "credentials": [{"latest": True, "names": [{"text": "Old"}], "attributes": [{"type": "entity_status", "value": "HIS"}]}, {"latest": True, "names": [{"text": " "}], "attributes": [{"type": "entity_status", "value": "act"}]}, {"latest": False, "names": [{"text": "No"}]}]}
    r = readers.latest_credentials(spark.createDataFrame([(json.dumps(cred),), (json.dumps({"topic_id": "u"}),)], "json string")).orderBy("topic_id").collect()
    assert (r[0]["legal_name"], r[0]["status"], r[0]["n_credentials"]) == ("Old", "ACTIVE", 3) and r[1]["legal_name"] is None


def test_page_tables_and_filings(spark):
    html = "<table><tr><td>x</td></tr></table><table><tr><th>Corporation Number</th><th>Name of Corporation</th><th>Registered  Office</th><th>Effective Date</th></tr><tr><td>1</td><td>A &amp; B</td><td>QC</td><td>2024-01-01</td></tr><tr><td>ragged</td></tr></table>"
    rows = readers.page_tables(spark.createDataFrame([(7, html), (8, None)], "page_id int, html string")).collect()
    assert [(r["page_id"], r["row"]["Name of Corporation"]) for r in rows] == [(7, "A & B")]
    text = "Notice\nINCORPORATIONS\nFile No. 123\nACME LIMITED\nRegistered Office: 1 Main\nDate of incorporation: 2024-01-02\nFile No. 123\nTWICE LTD\nFile No. 9\nOTHER INC\nAmendments\nFile No. 55\nNOT THIS\n"
    got = readers.filings(spark.createDataFrame([(1, text)], "id int, text string"), "id").orderBy("file_no").collect()
    assert [(r["file_no"], r["company_name"], r["incorporation_date"]) for r in got] == [("123", "ACME LIMITED", "2024-01-02"), ("9", "OTHER INC", None)]


def test_workbook(spark, tmp_path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    sheet = f'<worksheet {ns}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="inlineStr"><is><t>Name</t></is></c></row><row r="2"/><row r="3"><c r="A3"><v>5</v></c><c r="B3" t="s"><v>1</v></c></row></sheetData></worksheet>'
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>ID</t></si><si><t>b</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", sheet)
    (tmp_path / "b.xlsx").write_bytes(data.getvalue())
    assert [r["row"] for r in readers.workbooks(spark, str(tmp_path)).collect()] == [{"id": "5", "col_1": "b", "name": ""}]


def test_sinks(spark, sf, tmp_path):
    rows, contacts, _, flags, _ = q.listed(spark, sf)
    out = listing.export(rows, contacts, flags)
    listing.write_csv(out, str(tmp_path / "csv"))
    listing.write_json(out, str(tmp_path / "json"))
    n = out.count()
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == n == spark.read.json(str(tmp_path / "json")).count()


def test_streams(spark, tmp_path):
    rows = [(1, "status", "A", 1, 1), (1, "status", "A", 2, 2), (1, "status", "B", 3, 3), (2, "city", "x", 4, 4), (2, "city", "x", 4, 4)]
    schema = "entity_id bigint, field string, value string, observed_at timestamp, observation_id bigint"
    df = spark.createDataFrame(rows, "entity_id long, field string, value string, at int, observation_id long").select("entity_id", "field", "value", F.timestamp_seconds("at").alias("observed_at"), "observation_id")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))

    def run(make, mode):
        q = make(spark.readStream.schema(schema).parquet(str(tmp_path / "in"))).writeStream.format("memory").queryName(f"q_{make.__name__}").outputMode(mode).start()
        try:
            q.processAllAvailable()
            return spark.table(f"q_{make.__name__}").collect()
        finally:
            q.stop()

    assert [(r["entity_id"], r["old_value"], r["new_value"]) for r in run(changes.changed_values, "update")] == [(1, "A", "B")]
    assert len(run(changes.deduplicated, "append")) == 4
    assert {(r["field"], r["n"]) for r in run(changes.windowed, "update")} == {("status", 3), ("city", 2)}


def test_enrichment(spark):
    numbers = spark.createDataFrame([(1, "CORP_NUMBER", "C1"), (2, "CORP_NUMBER", "C2"), (3, "BN", "C1")], "entity_id long, id_type string, id_value string")
    found = spark.createDataFrame([("C1", " Ann Lee "), ("C1", "Ann Lee"), ("C1", "Bo"), ("C2", ""), ("C2", None), ("C9", "Cy"), (None, "Di")], "corp_number string, director_name string")
    people = spark.createDataFrame([(1, "Bo", "DIRECTOR"), (1, "Ann Lee", "OWNER")], "entity_id long, person_name string, role_type string")
    assert [(r["entity_id"], r["person_name"]) for r in enrich.new_directors(found, numbers, people).collect()] == [(1, "Ann Lee")]

    told = spark.createDataFrame([(1, 1, "Late", "HISTORICAL", None, None), (1, 0, "First", " ", "2020-01-01", None), (2, 0, None, "ACTIVE", None, None)], "entity_id long, position int, legal_name string, status string, registration_date string, entity_type string")
    assert {(r["entity_id"], r["field"], r["value"]) for r in enrich.register_observations(told).collect()} == {(1, "legal_name", "First"), (1, "registration_date", "2020-01-01"), (2, "status", "ACTIVE")}
    known = spark.createDataFrame([(1, "UNKNOWN", None), (2, "UNKNOWN", None), (3, None, None)], "entity_id long, status string, last_verified_at date")
    day = F.lit("2024-01-01").cast("date")
    assert [(r["entity_id"], r["status"], str(r["last_verified_at"])) for r in enrich.register_updates(known, told, day).orderBy("entity_id").collect()] == [(1, "UNKNOWN", "None"), (2, "ACTIVE", "2024-01-01"), (3, None, "None")]

    pages = spark.createDataFrame([(1, "416-555-0199, (416) 555-0199 and 604.555.0100"), (1, None), (2, "123-456-7890 4165550199")], "entity_id long, html string")
    contacts = spark.createDataFrame([(1, "PHONE", "+16045550100"), (2, "EMAIL", "x")], "entity_id long, kind string, value string")
    assert [(r["entity_id"], r["raw_value"], r["value"]) for r in enrich.website_phones(pages, contacts).collect()] == [(1, "(416) 555-0199", "+14165550199")]

    events = spark.createDataFrame([(10, 1, "FEDERAL_INCORPORATION", None), (11, 2, "FEDERAL_INCORPORATION", enrich.ATTEMPTED), (12, 2, "OTHER", None), (13, 3, "FEDERAL_INCORPORATION", None)], "event_id long, entity_id long, event_type string, raw_value string")
    due = enrich.directors_due(events, numbers)
    assert [tuple(r) for r in due.collect()] == [(10, 1, "C1")]
    assert enrich.directors_due(enrich.mark_attempted(events, due), numbers).count() == 0

    entities = spark.createDataFrame([(1, "BC", "a"), (2, "BC", None), (3, "AB", "c"), (4, "BC", "d"), (5, None, "e")], "entity_id long, province string, canonical_name string")
    seen = spark.createDataFrame([(1, "legal_name", True, enrich.REGISTER), (4, "legal_name", True, None), (4, "legal_name", False, enrich.REGISTER)], "entity_id long, field string, is_current boolean, enrichment_source string")
    assert [r["entity_id"] for r in enrich.registers_due(entities, numbers, seen).collect()] == [4]
    assert enrich.registers_due(entities.limit(0), numbers, seen).count() == 0 and enrich.website_phones(pages.limit(0), contacts).count() == 0


def test_sources_in_the_form_they_land_in(spark, tmp_path):
    """Repeated ids, pages, filing texts and JSON answers become raw records through the catalogue."""
    def landed(name, text):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.txt").write_text(text)
        return str(tmp_path / name)

    rows = catalogue.read(spark, "edmonton", landed("e", "externalid,business_name\n7,A\n7,A\n7,B\n,C\n")).collect()
    ids = sorted(r["source_record_id"].split(":") for r in rows)
    assert len({r["source_record_id"] for r in rows}) == 4 and [i[0] for i in ids] == ["", "7", "7", "7"] and sorted(i[2] for i in ids) == ["1", "1", "1", "2"]
    head = "".join(f"<th>{h}</th>" for h in ("Corporation number", "Name of corporation", "Registered office", "Effective date"))
    rows = catalogue.read(spark, "corporations_canada_html", landed("h", f"<table><tr>{head}</tr><tr><td>12</td><td>Acme</td><td>Ottawa</td><td>2024-01-02</td></tr></table>")).collect()
    assert [(r["source_record_id"], r["raw_payload"]["name of corporation"], r["raw_payload"]["event_type"]) for r in rows] == [("12", "Acme", "FEDERAL_INCORPORATION")]
    rows = catalogue.read(spark, "manitoba_weekly_pdf", landed("m", "INCORPORATIONS\nFile No. 55-A\nACME WORKS LTD.\nRegistered office: 1 Main\nDate: 2024-01-02\nDISSOLUTIONS\nFile No. 9\n")).collect()
    assert [(r["source_record_id"], r["raw_payload"]["company_name"], r["raw_payload"]["event_type"]) for r in rows] == [("55-A", "ACME WORKS LTD.", "PROVINCIAL_REGISTRATION")]
    answer = json.dumps({"corp_number": "5", "http_status": 200, "directors": [{"firstName": "A", "lastName": "B", "serviceAddress": "x"}]})
    rows = catalogue.read(spark, "corporations_canada_api", landed("d", answer + "\n" + json.dumps({"corp_number": "6", "http_status": 404, "directors": []}))).collect()
    assert sorted((r["raw_payload"]["corp_number"], r["raw_payload"]["director_name"] or "", r["source_record_id"][-3:]) for r in rows)[1] == ("6", "", "ors")
    rows = catalogue.read(spark, "bc_orgbook", landed("o", json.dumps({"topic_id": "BC1", "credentials": [{"latest": True, "names": [{"text": "Acme"}], "attributes": [{"type": "entity_status", "value": "ACT"}]}]}))).collect()
    assert [(r["source_record_id"], r["raw_payload"]["legal_name"], r["raw_payload"]["status"]) for r in rows] == [("BC1", "Acme", "ACTIVE")]


def test_page_contacts_against_plain(spark, sf):
    """Numbers of all pages against the standard library's patterns; null pages and addresses hold nothing."""
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = {r["page_id"]: r for r in q.page_contacts(spark, sf).collect()}
    for i, html in pages.items():
        html += q.PROBED
        text = re.sub(r"\s+", " ", re.sub("<[^>]*>", " ", re.sub(r"(?is)<(script|style)\b.*?</\1\s*>", " ", html)))
        want = {m[0].strip() for m in re.finditer(t.PROBED_PHONE, text)} | {m[1].strip() for m in re.finditer(r"(?i)<a\b[^>]*?\bhref=[\"'](?-i:tel:)([^\"']*)", html)}
        for m in re.finditer(t.LD_JSON, html):
            want |= {str(json.loads(m[1])["telephone"])} if json.loads(m[1]).get("telephone") else set()
        assert got[i]["phones"] == "|".join(sorted(want)[:10]) and got[i]["name"] == "Ann Co" and got[i]["leader_page"] == (i % 3 == 0), i
        said = [s.strip()[:200] for s in text.strip().split(".") if re.search(t.PROBED_TITLES, s)]
        assert got[i]["sentences"] == "|".join(said[:5]), i
        assert {"(604) 555 0199", "+1.604.555.0123", "1-604-555-0100", "555"} <= want and "6045550199" not in want
    none = spark.createDataFrame([(None, None)], "h string, u string").select(extract.page_contacts(F.col("h"), F.col("u")).alias("c")).collect()[0]["c"]
    assert not none["phones"] and not none["emails"] and not none["leader_page"]


def test_filing_names_keep_their_digits(spark):
    """Lines lose the white space at their ends, and nothing else, wherever they stand."""
    text = "INCORPORATIONS\nFile No: A-1\n  1ST STREET BAKERY 11 \r\nFile No: A-2\nlower case\n\t22 SECOND AVENUE 2\n"
    got = readers.filings(spark.createDataFrame([(1, text), (2, None), (3, "")], "id int, text string"), "id").orderBy("file_no").collect()
    assert [(r["file_no"], r["company_name"]) for r in got] == [("A-1", "1ST STREET BAKERY 11"), ("A-2", "22 SECOND AVENUE 2")]


def test_current_of_a_hot_entity_and_nulls(spark):
    """One entity holds most rows; null keys and times form groups of their own; a batch expires only what it observes."""
    rows = [(1, "status", str(i % 3), i % 50, i) for i in range(300)] + [(2, "city", "x", None, 1), (2, "city", "y", None, 2), (None, "city", "z", 5, 3), (None, None, "w", 1, 4)]
    df = spark.createDataFrame(rows, "entity_id int, field string, value string, observed_at int, observation_id int")
    now = {(r["entity_id"], r["field"], r["observation_id"]) for r in history.with_current(df).filter("is_current").collect()}
    assert now == {(1, "status", 299), (2, "city", 2), (None, "city", 3), (None, None, 4)}
    batch = spark.createDataFrame([(1, "status", "9", 99, 900), (3, "city", "q", 1, 901)], df.schema)
    after = history.appended(history.with_current(df), batch)
    assert after.count() == len(rows) + 2
    assert {r["observation_id"] for r in after.filter("is_current").collect()} == {900, 901, 2, 3, 4}


def plain_ld(blocks):
    """Emails and people of JSON-LD blocks, by recursion."""
    emails, people = set(), []

    def emails_in(x):
        for k, v in x.items() if isinstance(x, dict) else ():
            if k.lower() == "email" and isinstance(v, str) and "@" in v:
                emails.add(v.strip())
        for v in x.values() if isinstance(x, dict) else x if isinstance(x, list) else ():
            emails_in(v)

    def people_in(x):
        if isinstance(x, dict) and str(x.get("@type")).lower() == "person":
            if x.get("name"):
                people.append(f"{x['name']}|{x.get('jobTitle', x.get('roleName', ''))}")
            return
        for v in x.values() if isinstance(x, dict) else x if isinstance(x, list) else ():
            people_in(v)

    for b in blocks:
        try:
            found = json.loads(b)
        except ValueError:
            continue
        emails_in(found)
        people_in(found)
    return sorted(emails), people


def test_json_ld_and_phones_against_plain(spark, sf):
    """All pages, and random nested blocks, broken ones among them; numbers by the standard library's patterns."""
    r = random.Random(3)

    def made(depth):
        kind = r.random()
        if depth == 0 or kind < 0.3:
            return r.choice(["a@b.ca", " c@d.ca ", "none", 5, None, True])
        if kind < 0.55:
            return [made(depth - 1) for _ in range(r.randrange(4))]
        keys = r.sample(["email", "Email", "@type", "name", "jobTitle", "roleName", "founder", "member"], r.randrange(1, 6))
        return {k: r.choice(["Person", "person", "Organization"]) if k == "@type" else r.choice(["Ann Lee", "Bo", ""]) if k == "name" else r.choice(["CEO", "Owner"]) if k in ("jobTitle", "roleName") else made(depth - 1) for k in keys}

    pages = [x["html"] for x in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    for _ in range(1500):
        blocks = [json.dumps(made(4)) for _ in range(r.randrange(3))] + r.choice([[], ["{broken"]])
        digits = "".join(r.choice(["4", "16", "555", "0199", "-", ".", " ", "(", ")", "+1", "1", "x"]) for _ in range(60))
        pages.append(f"<p>{digits}</p>" + "".join(f"<SCRIPT id=x type='application/ld+json'>{b}</script>" for b in blocks))
    df = spark.createDataFrame(list(enumerate(pages)), "i int, h string")
    got = df.select("i", extract.ld_emails(F.col("h")).alias("e"), extract.ld_persons(F.col("h")).alias("p"), extract.phones(F.col("h")).alias("n")).collect()
    for row in got:
        html = pages[row["i"]]
        emails, people = plain_ld(re.findall(t.LD_JSON, html))
        assert (row["e"], row["p"]) == (emails, people), html
        assert row["n"] == list(dict.fromkeys("-".join(m.groups()) for m in re.finditer(t.PAGE_PHONE, html, re.ASCII))), html
    assert sum(bool(x["p"]) for x in got) > 20 and sum(bool(x["n"]) for x in got) > 5


def test_credential_history(spark):
    """Every credential stays, in order, whatever is absent from it; topics without any have an empty history."""
    full = {"id": 7, "credential_type": {"description": "registration"}, "effective_date": "2020-01-01", "revoked": True, "revoked_date": "2021-01-01", "names": [{"type": "other", "text": "a"}, {"type": "entity_name", "text": "b"}], "attributes": [{"type": "Entity_Status", "value": "ACT"}]}
    answers = [json.dumps({"topic_id": "t", "credentials": [full, {"latest": True, "credential_type": "plain", "names": [{"text": "c"}]}, {}]}), json.dumps({"topic_id": "u"}), None]
    got = {r["topic_id"]: r for r in readers.latest_credentials(spark.createDataFrame([(a,) for a in answers], "json string")).collect()}
    first, second, third = json.loads(got["t"]["credential_history"])
    assert (first["credential_id"], first["credential_type"], first["revoked"], first["latest"], first["legal_name"]) == ("7", "registration", True, False, "b")
    assert first["attributes"] == [{"type": "entity_status", "value": "ACT"}] and first["revoked_date"] == "2021-01-01"
    assert (second["credential_type"], second["latest"], second["legal_name"], second["effective_date"]) == ("plain", True, "c", None)
    assert (third["legal_name"], third["attributes"], third["inactive"]) == ("", [], False)
    assert got["t"]["legal_name"] == "c" and got["t"]["n_credentials"] == 3 and got["u"]["credential_history"] == "[]"
