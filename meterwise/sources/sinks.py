"""File sinks (K1-K3, K6, K7).

The save mode is always explicit (D9). Parquet can be laid out by year and
month so that later month filters prune whole folders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.schemas import TIME
from meterwise.session import shuffle_width


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] | None = None) -> str:
    """Parquet dataset; ``mode='errorifexists'`` is ``write.parquet(p)`` (K1, K2, K7)."""
    writer = df.write.mode(mode).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def with_month_partitions(df: DataFrame, ts: str = TIME) -> DataFrame:
    """Add ``year``/``month`` columns for a partitioned layout (pruning, §4)."""
    return df.withColumn("year", F.year(ts)).withColumn("month", F.month(ts))


def reload_months(df: DataFrame, path: str, ts: str = TIME) -> str:
    """Replace the months that ``df`` holds in a year/month layout; other months' files stay (K1, K7).

    Loading the same rows again changes nothing. Rows without a time go to the default month folder.
    """
    laid_out = with_month_partitions(df, ts).repartitionByRange(
        shuffle_width(df), "year", "month", ts, F.monotonically_increasing_id())
    (laid_out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("year", "month").parquet(path))
    return path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = False) -> str:
    """Folder of CSV parts; no header line unless asked (K3)."""
    df.write.mode(mode).option("header", header).csv(path)
    return path


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).json(path)
    return path


def write_text(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Folder of text parts from a single string column (K6)."""
    if len(df.columns) != 1:
        raise ValueError("write_text needs exactly one string column")
    df.write.mode(mode).text(path)
    return path
