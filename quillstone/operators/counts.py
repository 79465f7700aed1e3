"""Distinct counts that add up: entities get dense numbers, each group keeps exact bitmaps over them, and a delta is merged in.

A bitmap covers 32,768 numbers in 4 KB, so a group costs an eighth of a byte for each number it may hold, however often its rows repeat. Counts
and overlaps after a delta are those of a recount over everything, and need the delta and the bitmaps only. Nothing is taken out again: where
entities leave a group, its bitmaps are made anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.operators.store import Tables


def numbered(tables: Tables, entities: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(entity_id, number) of ``known`` and, behind its numbers, of the entities it lacks, without gaps from 1; null entities get none.

    Rows are numbered in their partitions, and partitions by the counts of those before them: one row a partition goes through the driver.
    """
    new = entities.select("entity_id").filter("entity_id is not null").distinct()
    if known is not None:
        new = new.join(known.select("entity_id"), "entity_id", "left_anti")
    placed = tables.put("placed", new.withColumn("place", F.monotonically_increasing_id()))  # stored: the same on every reading
    part, bits = F.shiftright("place", 33), (1 << 33) - 1
    start = 0 if known is None else known.agg(F.max("number")).first()[0] or 0
    offsets = []
    for r in sorted(placed.groupBy(part.alias("part")).count().collect()):
        offsets.append((r["part"], start))
        start += r["count"]
    of = tables.spark.createDataFrame(offsets, "part long, before long")
    made = placed.withColumn("part", part).join(F.broadcast(of), "part").select("entity_id", (F.col("before") + F.col("place").bitwiseAND(F.lit(bits)) + 1).alias("number"))  # a row a partition
    return tables.put("numbers", made if known is None else known.select("entity_id", "number").unionByName(made))


def bitmaps(members: DataFrame, numbers: DataFrame, by: list[str]) -> DataFrame:
    """(``by``, chunk, bits) of the entities in each group; members without a number are in none. Repeated rows are reduced before they move."""
    rows = members.select(*by, "entity_id").filter("entity_id is not null").distinct().join(numbers, "entity_id")
    return rows.groupBy(*by, F.bitmap_bucket_number("number").alias("chunk")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))


def merged(kept: DataFrame, delta: DataFrame, by: list[str]) -> DataFrame:
    return kept.unionByName(delta).groupBy(*by, "chunk").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(maps: DataFrame, by: list[str]) -> DataFrame:
    """(``by``, n): the distinct entities of each group that has any."""
    return maps.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias("n"))


def overlaps(maps: DataFrame, by: str) -> DataFrame:
    """(a, b, n_both) of the pairs of groups that share entities, a before b.

    Pairs of a chunk's bitmaps, so for groups that are few (sources, kinds): their number squared times the chunks, not times the entities.
    """
    a, b = (maps.select(F.col(by).alias(x), "chunk", F.col("bits").alias(f"bits_{x}")) for x in ("a", "b"))
    pairs = a.join(b, "chunk").filter("a < b")
    sides = pairs.select("a", "b", "chunk", F.explode(F.array("bits_a", "bits_b")).alias("bits"))
    both = sides.groupBy("a", "b", "chunk").agg(F.bitmap_and_agg("bits").alias("bits"))
    return both.groupBy("a", "b").agg(F.sum(F.bitmap_count("bits")).alias("n_both")).filter("n_both > 0")
