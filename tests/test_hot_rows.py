"""Numbers of alike rows where one key holds a third of them."""

from collections import defaultdict

from pyspark.sql import functions as F

from quillstone.operators import records
from quillstone.operators.store import Tables
from quillstone.sources import readers


def test_a_hot_key_is_numbered_in_ranges(spark):
    rows = spark.range(9000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, F.lit(None)).otherwise((F.col("id") % 1000).cast("string")).alias("external"), F.lit("x").alias("value"), F.when(F.col("id") > 0, (F.col("id") * 7919) % 9001).alias("place"), F.col("id").alias("_range_like"))
    rows = rows.repartition(6)
    numbered = lambda *more: {(r["external"], r["place"], r["_range_like"]): r["occurrence_id"] for r in records.with_occurrence(rows, F.col("external"), [F.col("value")], F.col("place"), *more).collect()}
    tables = Tables(spark, "hot-test")
    split, whole = numbered(tables, 200), numbered()
    assert split == whole and len(whole) == 9000
    held = spark.read.parquet(tables.paths["ranges"]).groupBy("_external", "_digest", "_range").count()
    assert held.filter("_external = 'hot'").count() > 8 and held.agg(F.max("count")).first()[0] <= 600
    by = defaultdict(list)
    for (external, place, _), oid in whole.items():
        by[external].append((-1 if place is None else place, int(oid.rpartition(":")[2])))
    assert all([n for _, n in sorted(x)] == list(range(1, len(x) + 1)) for x in by.values())
    assert records.with_occurrence(rows.limit(0), F.col("external"), [F.col("value")], F.col("place"), tables, 200).count() == 0
    tables.drop()


def test_repeated_raw_records_are_counted_not_sorted(spark):
    rows = spark.range(70_000).select(F.lit("1").alias("id"), F.lit("same").alias("name")).unionByName(spark.createDataFrame([("2", "a"), ("2", "a"), ("2", "b"), (None, None)], "id string, name string"))
    out = readers.as_payload(rows, "s", "LICENCE", ["id"], repeats=True)
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
    got = out.groupBy(F.substring_index("source_record_id", ":", 1).alias("id")).agg(F.count("*").alias("n"), F.countDistinct("source_record_id").alias("d"), F.max(F.substring_index("source_record_id", ":", -1).cast("int")).alias("top"))
    assert {(r["id"], r["n"], r["d"], r["top"]) for r in got.collect()} == {("1", 70_000, 70_000, 70_000), ("2", 3, 3, 2), ("", 1, 1, 1)}
