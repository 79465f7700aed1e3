"""Tables between the steps of a job, in the folder that all executors share."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The application's folder below ``spark.checkpoint.dir``; a session of one machine alone may leave that unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    master = spark.sparkContext.master
    if not base and (not master.startswith("local") or master.startswith("local-cluster")):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return f"{(base or f'file://{tempfile.gettempdir()}/quillstone-tables').rstrip('/')}/records-{spark.sparkContext.applicationId}"


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of Hadoop for a path that Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def removed(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` over all cores, where what they are read from gives fewer tasks; as they are otherwise. For costly work on the rows of small files."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


class Tables:
    """The intermediate tables of one job: written, read back, and removed when their names are given again or the job is left.

    A table that is read back has no lineage, so that a lost executor costs no more than the step it was lost in.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder = spark, f"{shared_folder(spark)}/{name}-{uuid4().hex[:12]}"
        self.paths: dict[str, str] = {}

    def put(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` as a table; the one of this name before it goes once this one is written."""
        path, before = f"{self.folder}/{name}-{uuid4().hex[:8]}", self.paths.get(name)
        df.write.parquet(path)
        if before:
            removed(self.spark, before)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        """Remove all tables of the job, once nothing made from them is needed."""
        removed(self.spark, self.folder)
        self.paths.clear()
