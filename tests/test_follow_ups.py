"""What a record of an earlier run gets when a resolved one names it, and children of an entity as rows."""

import json

from pyspark.sql import functions as F

from quillstone.operators import listing, resolve

EARLIER = (
    "source_key string, source_record_id string, record_id string, run_id int, resolution_status string, entity_id string, grain string, legal_name string, raw_legal_name string, trade_name string, raw_trade_name string, city string, raw_city string, "
    "issued_date timestamp, raw_issued_date string, incorporation_date timestamp, raw_incorporation_date string, extra map<string,string>, raw_payload map<string,string>"
)


def permit(source="permits", key="Q1", record="r1", run=1, status="UNRESOLVED", entity=None, kind="MUNICIPAL_PERMIT_ISSUED", city="Quebec"):
    return (source, key, record, run, status, entity, "EVENT", None, None, None, None, city, city, None, None, None, None, {"event_type": kind} if kind else None, {"permit_number": "P7", "issue_date": "2024-01-05"})


def given(spark, rows, named=(("b1", "permits", "Q1"),), existing=None):
    matched = spark.createDataFrame([("b1", "e1"), ("b2", "e2")], "record_id string, entity_id string")
    references = spark.createDataFrame(list(named), "record_id string, source_key string, source_record_id string")
    return [sorted(map(tuple, x.collect())) for x in (lambda r, o, e: (r.select("record_id", "entity_id", "run_id", "resolution_status", "confidence"), o.select("entity_id", "run_id", "record_id", "confidence", "field", "normalised_value"), e.select("entity_id", "run_id", "event_type", F.col("event_date").cast("string"), "raw_value")))(*resolve.follow_ups(matched, references, spark.createDataFrame(rows, EARLIER), existing))]


def test_only_what_is_named_attaches(spark):
    rows, seen, events = given(spark, [permit(), permit(source="another", record="r2"), permit(key="Q2", record="r3"), permit(record="r4", status="MATCHED", entity="e9"), permit(record="r5", status="PENDING")])
    assert rows == [("r1", "e1", 1, "MATCHED", "HIGH")]
    assert seen == [("e1", 1, "r1", "HIGH", "city", "Quebec"), ("e1", 1, "r1", "HIGH", "extra.event_type", "MUNICIPAL_PERMIT_ISSUED")]
    assert events == [("e1", 1, "MUNICIPAL_PERMIT_ISSUED", "2024-01-05", "P7")]


def test_runs_ties_nulls_and_repeats(spark):
    """Rows of one id attach in their own runs, the least entity takes what two name, a repeated reference counts once, nulls name nothing."""
    named = [("b2", "permits", "Q1"), ("b1", "permits", "Q1"), ("b1", "permits", "Q1"), ("b1", None, None), ("b9", "permits", "Q1")]
    rows, _, events = given(spark, [permit(run=1), permit(record="r2", run=2), permit(source=None, key=None, record="r3")], named)
    assert [r[:3] for r in rows] == [("r1", "e1", 1), ("r2", "e1", 2)]
    assert [(e[0], e[1]) for e in events] == [("e1", 1), ("e1", 2)]


def test_an_event_is_made_once(spark):
    existing = spark.createDataFrame([("e1", 1, "MUNICIPAL_PERMIT_ISSUED", "2024-01-05", "P7")], "entity_id string, run_id int, event_type string, event_date string, raw_value string").withColumn("event_date", F.col("event_date").cast("date"))
    assert given(spark, [permit(), permit()], existing=existing)[2] == []
    assert len(given(spark, [permit(), permit()])[2]) == 1  # alike rows give one event


def test_nothing_earlier(spark):
    assert given(spark, []) == [[], [], []]
    assert given(spark, [permit()], named=()) == [[], [], []]
    assert given(spark, [permit(kind=None)])[2] == []


def test_detail_rows(spark):
    a = spark.createDataFrame([(1, "x", None), (1, "x", None), (2, "y", "z"), (3, "q", "q")], "entity_id int, kind string, value string")
    b = spark.createDataFrame([(2, True)], "entity_id int, ready boolean")
    got = [(r["entity_id"], r["child"], json.loads(r["value"])) for r in listing.detail_rows(spark.createDataFrame([(1,), (2,)], "entity_id int"), a=a, b=b).collect()]
    assert got == [(1, "a", {"kind": "x", "value": None})] * 2 + [(2, "a", {"kind": "y", "value": "z"}), (2, "b", {"ready": True})]
