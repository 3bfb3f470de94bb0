"""A global row position without a single-partition window.

``row_number() over (order by ...)`` with no partition key moves every row into
one task. Here the frame is range-partitioned and sorted by ``order`` (a
distributed sort), each row gets its partition and in-partition position as
columns, the result is written as a table in the shared folder (fixing those
values, and cutting the lineage so a lost executor does not re-run the sort),
and a per-partition
offset table - one row per partition, so its size is bounded by the partition
count, not the data - turns local positions into global ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterwise.session import ensure_checkpoint_dir, scratch_path, shuffle_width

_PID, _MID, _N, _OFF = "_ri_pid", "_ri_mid", "_ri_n", "_ri_offset"


def with_row_index(df: DataFrame, order: Sequence[str | Column], name: str = "row_index") -> DataFrame:
    """Append a 0-based position in ``order``; give ``order`` unique keys for a stable answer."""
    ensure_checkpoint_dir(df.sparkSession)
    # A row-unique last sort key lets the range bounds split a run of equal keys
    # (e.g. exact copies making up a third of the table) across tasks; rows tied
    # on ``order`` are interchangeable to the caller, so the answer is unchanged.
    tie = "_ri_tie"
    keys = [*order, F.col(tie)]
    # Global order = range partitions (sized to the input, see shuffle_width)
    # each sorted locally; the same plan orderBy makes, with the width chosen.
    sorted_rows = (df.withColumn(tie, F.monotonically_increasing_id())
                     .repartitionByRange(shuffle_width(df), *keys)
                     .sortWithinPartitions(*keys)
                     .drop(tie)
                     .withColumn(_PID, F.spark_partition_id())
                     .withColumn(_MID, F.monotonically_increasing_id()))
    # A written table in the shared folder cuts the lineage in one job (a
    # checkpoint would run the sort once to count and again to save). Partition
    # and position are stored as columns, so how the table is read back later
    # does not matter.
    path = scratch_path(df.sparkSession, "row-index")
    sorted_rows.write.mode("errorifexists").parquet(path)
    tagged = df.sparkSession.read.parquet(path)
    # monotonically_increasing_id = (partition index << 33) + position in partition.
    offsets = (tagged.groupBy(_PID).agg(F.count(F.lit(1)).alias(_N))
               .withColumn(_OFF, F.coalesce(
                   F.sum(_N).over(Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)))
               .select(_PID, _OFF))
    local = F.col(_MID) - F.shiftleft(F.col(_PID).cast("long"), 33)
    return (tagged.join(offsets, _PID)
                  .withColumn(name, F.col(_OFF) + local)
                  .drop(_PID, _MID, _OFF))

