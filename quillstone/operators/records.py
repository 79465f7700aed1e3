"""Operators on raw records: identity, checks, tags, cursors and run logs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstone.functions import normalise as n
from quillstone.functions import tables as t
from quillstone.operators.store import Tables


def row_hash(*columns: Column) -> Column:
    """32 hex digits that depend on all values, nulls included."""
    return F.substring(F.sha2(F.concat_ws("|", *(F.coalesce(c.cast("string"), F.lit("\\N")) for c in columns)), 256), 1, 32)


def record_id(ids: list[Column], columns: list[Column]) -> Column:
    """The first non-empty id, else a hash of the row."""
    return F.coalesce(*(n.blank_to_null(F.trim(c)) for c in ids), row_hash(*columns))


def composite_id(*columns: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws(":", *(F.coalesce(c, F.lit("")) for c in columns)), 256), 1, 32)


#: A key of more alike rows than this is numbered in ranges of its own; the sketch that finds such keys tracks TRACKED of them.
MOST_ALIKE = 1_000_000
TRACKED = 100_000


def with_occurrence(df: DataFrame, external: Column, columns: list[Column], position: Column, tables: Tables | None = None, most: int = MOST_ALIKE) -> DataFrame:
    """``occurrence_id`` = id:rowhash:occurrence, so that repeated rows stay apart.

    Rows that are alike are told apart by their place in the file, which is one row's alone. Only those share a window; with ``tables``, keys of more
    than ``most`` rows are found by a sketch in one pass, sorted into ranges that tasks share, and numbered there behind the ranges before. The numbers
    are the same either way. Null and empty ids are alike, a null place comes first, an empty table gives none.
    """
    out = df.withColumns({"_external": F.coalesce(external, F.lit("")), "_digest": row_hash(*columns), "_place": position})
    key, same = F.xxhash64("_external", "_digest"), ("_external", "_digest")
    numbered = lambda rows, *more: rows.withColumn("_number", F.row_number().over(Window.partitionBy(*same, *more).orderBy("_place")).cast("long"))
    hot = {} if tables is None else {r["item"]: r["count"] for r in out.agg(F.call_function("approx_top_k", key, F.lit(1000), F.lit(TRACKED))).first()[0] if r["count"] > most}
    if not hot:
        rows = numbered(out)
    else:
        ranges = out.filter(key.isin(*hot)).repartitionByRange(1 + sum(hot.values()) // most, *same, "_place").withColumn("_range", F.spark_partition_id())
        ranges = tables.put("ranges", ranges)  # stored: a row's range is the same on every reading
        before = F.coalesce(F.sum("count").over(Window.partitionBy(*same).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        offsets = ranges.groupBy(*same, "_range").count().select(*same, "_range", before.alias("_before"))  # a row a range
        split = numbered(ranges, "_range").join(offsets, [*same, "_range"]).withColumn("_number", F.col("_number") + F.col("_before"))
        rows = numbered(out.filter(~key.isin(*hot))).unionByName(split.drop("_range", "_before"))
    return rows.withColumn("occurrence_id", F.concat_ws(":", *same, F.col("_number").cast("string"))).drop(*same, "_place", "_number")


def status_events(df: DataFrame, status: Column) -> DataFrame:
    """Only rows of a non-active status, tagged as status changes."""
    return df.filter(F.lower(F.trim(status)).isin(*t.NON_ACTIVE)).withColumn("event_type", F.lit("LICENCE_STATUS_CHANGE"))


def validation(df: DataFrame, id_col: str, required: list[str], by: list[str]) -> DataFrame:
    """Per group: valid and invalid rows, whether all passed, and the errors per required field."""
    missing = [F.coalesce(F.trim(F.col(c)), F.lit("")) == "" for c in required]
    bad = reduce(lambda a, b: a | b, missing)
    return df.groupBy(*by).agg(
        F.count("*").alias("n_rows"), F.count_if(~bad).alias("n_valid"), F.count_if(bad).alias("n_invalid"), F.min(~bad).alias("passed"),
        *(F.count_if(m).alias(f"missing_{c}") for m, c in zip(missing, required, strict=True)),
    )


def validation_errors(df: DataFrame, id_col: str, required: list[str]) -> DataFrame:
    """(record, field) of every missing required value; records by the first 12 characters of their id."""
    gaps = F.array_compact(F.array(*(F.when(F.coalesce(F.trim(F.col(c)), F.lit("")) == "", F.lit(c)) for c in required)))
    return df.select(F.substring(F.col(id_col), 1, 12).alias("record"), F.explode(gaps).alias("field"))


def guard_aggregate_only(df: DataFrame, payload: Column, entity_keys: list[str]) -> DataFrame:
    """Fails when a row of an aggregate-only source holds a key of a business."""
    found = F.arrays_overlap(F.map_keys(payload), F.array(*map(F.lit, entity_keys)))
    return df.filter(F.when(found, F.raise_error(F.lit("an aggregate-only source must not hold business keys")).cast("boolean")).otherwise(True))


def guard_targets(targets: list[str], most: int = 500) -> list[str]:
    """Checked targets of a lookup source: at most ``most``, each of two characters or more."""
    if len(targets) > most or any(len(x.strip()) < 2 for x in targets):
        raise ValueError(f"a lookup takes at most {most} targets of two characters or more")
    return targets


def guard_terms(status: str) -> None:
    if status != "CLEARED":
        raise PermissionError(f"terms are {status}")


def since(df: DataFrame, runs: DataFrame, when: str, source: str | None = None) -> DataFrame:
    """Rows at or after the completion of the last completed run (of their source); all rows where none completed."""
    done = runs.filter(F.col("run_status") == "COMPLETED")
    if source is None:
        last = done.agg(F.max("completed_at").alias("cursor"))
        return df.join(F.broadcast(last)).filter(F.col("cursor").isNull() | (F.col(when) >= F.col("cursor"))).drop("cursor")  # one row
    last = done.groupBy(source).agg(F.max("completed_at").alias("cursor"))
    return df.join(last, source, "left").filter(F.col("cursor").isNull() | (F.col(when) >= F.col("cursor"))).drop("cursor")


def latest_runs(log: DataFrame) -> DataFrame:
    """The last state of each run of an append-only run log, with the number of failures before it."""
    return log.groupBy("run_id").agg(F.max_by("run_status", F.struct("changed_at", "run_status")).alias("run_status"), F.max("changed_at").alias("changed_at"), F.count_if(F.col("run_status") == "FAILED").alias("retry_count"))
