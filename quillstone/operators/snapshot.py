"""Observations kept between runs: what is current, in buckets of entities, and what has expired, by batch.

A batch rewrites the current rows of the buckets its entities fall into and adds what expires to the history; no other file is touched and the
history is never read. A batch counts once its row in the list of commits is there, written last: readers see all of a batch or nothing, what a
killed one left is never read, and giving it again is safe. One writer at a time.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstone.operators.history import with_current
from quillstone.operators.store import hadoop_path, removed

COMMITS = "place long, batch string, attempt string, buckets array<int>"


class Observations:
    """The observations below ``folder``, which driver and executors share, in ``buckets`` buckets, fixed once rows are there.

    ``schema``: entity_id, field, observed_at, observation_id and any others but is_current. The newest of an (entity, field) by time and id is
    current, in whatever order batches arrive; rows alike in both are so together, null entities, fields and times are values like others.
    A bucket should hold what one task can write: a batch rewrites whole buckets of current values, so their number grows with the entities.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, buckets: int = 256):
        self.spark, self.folder, self.buckets = spark, folder.rstrip("/"), buckets
        self.columns = schema.names
        self.schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in schema.fields), T.StructField("attempt", T.StringType()), T.StructField("is_current", T.BooleanType()), T.StructField("bucket", T.IntegerType())])

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("entity_id"), F.lit(self.buckets)).cast("int")

    def commits(self) -> DataFrame:
        """(place, batch, attempt, buckets) of all batches, in order of ``place``."""
        fs, path = hadoop_path(self.spark, f"{self.folder}/commits")
        return self.spark.read.schema(COMMITS).parquet(f"{self.folder}/commits") if fs.exists(path) else self.spark.createDataFrame([], COMMITS)

    def _commit(self, place: int, batch: str, attempt: str, buckets: list[int]) -> None:
        self.spark.createDataFrame([(place, batch, attempt, buckets)], COMMITS).coalesce(1).write.mode("append").parquet(f"{self.folder}/commits")

    def _newest(self) -> dict[int, str]:
        """The attempt that holds each bucket's current rows: one row a bucket."""
        rows = self.commits().select("place", "attempt", F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.max_by("attempt", "place").alias("attempt"))
        return {r["bucket"]: r["attempt"] for r in rows.collect()}

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("basePath", f"{self.folder}/rows").parquet(*paths)

    def _current(self, buckets: set[int] | None = None) -> DataFrame:
        return self._read([f"{self.folder}/rows/attempt={a}/is_current=true/bucket={b}" for b, a in sorted(self._newest().items()) if buckets is None or b in buckets])

    def current(self) -> DataFrame:
        """The current rows; none of the history is listed or read."""
        return self._current().select(*self.columns)

    def history(self) -> DataFrame:
        """All rows, with ``is_current``."""
        fs, _ = hadoop_path(self.spark, self.folder)
        paths = [f"{self.folder}/rows/attempt={r['attempt']}/is_current=false" for r in self.commits().select("attempt").collect()]  # one row a batch
        expired = self._read([p for p in paths if fs.exists(hadoop_path(self.spark, p)[1])])
        return self._current().unionByName(expired).select(*self.columns, "is_current")

    def append(self, batch: str, added: DataFrame) -> list[int]:
        """Take in a batch, once for its name; the buckets it rewrote. An empty batch rewrites none."""
        commits = self.commits().select("place", "batch", "buckets").collect()  # one row a batch
        for r in commits:
            if r["batch"] == batch:
                return r["buckets"]
        attempt, keys = f"a{uuid4().hex}", ("entity_id", "field")
        order, given = F.struct("observed_at", "observation_id"), f"{self.folder}/given/{attempt}"
        with_current(added.select(*self.columns)).withColumn("bucket", self._bucket()).write.parquet(given)
        rows = self.spark.read.parquet(given)
        touched = sorted(r["bucket"] for r in rows.select("bucket").distinct().collect())  # no more than there are buckets
        if touched:
            same = lambda a, b: F.col(f"{a}.entity_id").eqNullSafe(F.col(f"{b}.entity_id")) & F.col(f"{a}.field").eqNullSafe(F.col(f"{b}.field"))
            before = self._current(set(touched))
            now = rows.filter("is_current").select(*keys, order.alias("now")).distinct()
            stood = before.select(*keys, order.alias("stood")).distinct()
            old = before.alias("o").join(now.alias("n"), same("o", "n"), "left").select(*(F.col(f"o.{c}") for c in (*self.columns, "bucket")), (F.col("n.now").isNull() | (F.struct("o.observed_at", "o.observation_id") >= F.col("n.now"))).alias("is_current"))
            new = rows.alias("o").join(now.alias("n").join(stood.alias("s"), same("n", "s")).filter(F.col("s.stood") > F.col("n.now")).select("n.*").alias("late"), same("o", "late"), "left")
            new = new.select(*(F.col(f"o.{c}") for c in (*self.columns, "bucket")), (F.col("o.is_current") & F.col("late.now").isNull()).alias("is_current"))
            spread = old.unionByName(new).hint("rebalance", "is_current", "bucket")  # large buckets are split, small ones share a task
            spread.write.partitionBy("is_current", "bucket").parquet(f"{self.folder}/rows/attempt={attempt}")
        self._commit(len(commits), batch, attempt, touched)
        removed(self.spark, given)
        return touched

    def vacuum(self) -> int:
        """Remove current rows of buckets that a later batch holds and what killed batches left; the number of folders removed. For times without readers."""
        fs, rows = hadoop_path(self.spark, f"{self.folder}/rows")
        removed(self.spark, f"{self.folder}/given")
        if not fs.exists(rows):
            return 0
        newest, committed, gone = self._newest(), {r["attempt"] for r in self.commits().select("attempt").collect()}, []
        for f in fs.listStatus(rows):
            attempt = f.getPath().getName().partition("=")[2]
            if attempt not in committed:
                gone.append(f.getPath().toString())
                continue
            _, held = hadoop_path(self.spark, f"{self.folder}/rows/attempt={attempt}/is_current=true")
            for b in fs.listStatus(held) if fs.exists(held) else []:
                if newest[int(b.getPath().getName().partition("=")[2])] != attempt:
                    gone.append(b.getPath().toString())
        for path in gone:
            removed(self.spark, path)
        return len(gone)
