"""Staged tables in the cluster's shared folder (``spark.checkpoint.dir``).

A staged table is a written Parquet table: it cuts lineage, survives a lost
executor, is read back with its known schema (no extra job), and its measured
size is what Spark uses to choose or refuse a broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterwise.session import scratch_path


class Scratch:
    """The staged tables of one operator call; :meth:`clear` deletes those no longer read."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.name = name
        self.paths: list[str] = []

    def stage(self, df: DataFrame, name: str, keep: bool = False) -> DataFrame:
        """Write ``df`` and return it as read back; with ``keep`` it outlives :meth:`clear`."""
        path = scratch_path(self.spark, f"{self.name}-{name}")
        df.write.parquet(path)
        if not keep:
            self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def folder(self, name: str) -> str:
        """A fresh folder of the shared store, kept for the caller."""
        return scratch_path(self.spark, f"{self.name}-{name}")

    def clear(self) -> None:
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        for p in self.paths:
            path = jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(conf).delete(path, True)
        self.paths = []
