"""Scratch tables in the folder that all executors share, and small helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = b" \t\n\x0b\x0c\r"


def scratch_root(spark: SparkSession) -> str:
    """Folder for this application's scratch tables, below ``spark.checkpoint.dir``.

    Only a single-machine session may leave that setting empty; it then gets a local folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"file://{tempfile.gettempdir()}/quillstone"
    return f"{qualified(spark, base).rstrip('/')}/quillstone-{spark.sparkContext.applicationId}"


def qualified(spark: SparkSession, folder: str) -> str:
    """``folder`` with the scheme that Spark reads it by: one without belongs to Hadoop's default file system, not to each machine's disk."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    whole = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return f"file://{whole[5:]}" if whole.startswith("file:/") and not whole.startswith("file://") else whole


#: The scratch paths of the job that runs in this context, if it keeps account of them.
_scope: ContextVar[set[str] | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch_scope() -> Iterator[set[str]]:
    """The set of scratch paths that are made inside, by this job alone: others in the session, or in other threads, have scopes of their own."""
    own: set[str] = set()
    token = _scope.set(own)
    try:
        yield own
    finally:
        _scope.reset(token)


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    if (own := _scope.get()) is not None:
        own.add(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a scratch table and read it again: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop(df: DataFrame) -> None:
    """Delete a scratch table that nothing will read again."""
    _delete(df.sparkSession, df.scratch)


def release(spark: SparkSession, own: set[str], keep: DataFrame) -> None:
    """Delete the scratch of a scope, but for the table ``keep``: for a caller that has stored all it needs."""
    for path in own - {keep.scratch}:
        _delete(spark, path)


def purge(spark: SparkSession) -> None:
    """Delete all scratch tables of this application, once no frame made from them is needed."""
    _delete(spark, scratch_root(spark))


def file_system(uri: str):
    """A pyarrow file system and the path in it, for files that Spark has no reader or writer for."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def rows_fit(df: DataFrame, row_bytes: int, limit_bytes: int) -> bool:
    """Whether a stored table of narrow rows is small enough to broadcast."""
    return df.count() * row_bytes <= limit_bytes


def maybe_broadcast(df: DataFrame, row_bytes: int, limit_bytes: int = 8 << 20) -> DataFrame:
    """Mark a stored table for broadcast only when its counted size is under the limit."""
    return F.broadcast(df) if rows_fit(df, row_bytes, limit_bytes) else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sorted_runs(batches, keys: int = 1):
    """Arrow tables of whole runs of equal leading ``keys`` columns (integers), from sorted batches.

    Several runs may share a table; no run is cut. Yields (table, first row of each run).
    """
    import numpy as np
    import pyarrow as pa

    def starts(table):
        new = np.zeros(table.num_rows, dtype=bool)
        new[:1] = True
        for k in range(keys):
            c = table.column(k).to_numpy()
            new[1:] |= c[1:] != c[:-1]
        return np.flatnonzero(new)

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        same = np.logical_and.reduce([c == c[-1] for c in cols])
        goes_on = held and all(held[-1].column(k)[-1].as_py() == c[0] for k, c in enumerate(cols))
        if held and not goes_on:
            table = pa.Table.from_batches(held)
            yield table, starts(table)
            held = []
        cut = 0 if same.all() else int(np.flatnonzero(~same)[-1]) + 1  # the last run may go on in the next batch
        if cut:
            table = pa.Table.from_batches([*held, batch.slice(0, cut)])
            yield table, starts(table)
            held = []
        held.append(batch.slice(cut))
    if held:
        table = pa.Table.from_batches(held)
        yield table, starts(table)
