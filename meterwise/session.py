"""Session set-up (C2) and the shared scratch location.

Jobs take ``spark`` from the caller; only job entry points and tests build one.
Scratch data (staged tables, round trips, ML checkpoints) always lives under the
shared folder the cluster names in ``spark.checkpoint.dir``; a private temp
folder is used only when that setting is absent and Spark runs in local mode.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale; every one is a plain Spark option.
CLUSTER_DEFAULTS: dict[str, str] = {
    # Runtime re-planning: coalesce small shuffle partitions, split skewed ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Wall-clock readings: keep every calendar function zone-stable.
    "spark.sql.session.timeZone": "UTC",
    # Large scan splits for columnar files; CSV splits follow the same bound.
    "spark.sql.files.maxPartitionBytes": "256m",
    # Arrow for the few places that hand a small, aggregated frame to pandas.
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "meterwise", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the scale settings above.

    ``shuffle_partitions`` is the initial count before AQE coalescing; on a
    cluster size it to about input bytes / 128 MB for the widest shuffle.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(CLUSTER_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only when unset.

    On a cluster the folder must come from ``spark.checkpoint.dir`` (a shared
    file system such as HDFS or an object store); a machine-local folder would
    lose data together with an executor, so that case raises instead.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(hdfs://, s3a://, gs://, ...) before running these jobs")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="meterwise-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    # The checkpoint dir is a per-application sub-folder; keep scratch next to it.
    return f"{base}/meterwise-scratch/{name}-{uuid.uuid4().hex[:12]}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def input_bytes(df) -> int:
    """Bytes of the tables that ``df`` reads, from the plan's statistics (0 if unknown). Runs no job."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(n for n in sizes if n < 1 << 60)  # Spark's mark for an unknown size is larger


def shuffle_width(df) -> int:
    """Partition count for a shuffle that moves every row of ``df``.

    As many partitions as its input has splits of ``spark.sql.files.maxPartitionBytes``,
    and never fewer than ``spark.sql.shuffle.partitions``: a full-data sort or layout
    then keeps partitions near the split size at any scale, instead of squeezing
    100 TB into the fixed shuffle-partition count.
    """
    conf = df.sparkSession.conf
    split = int(df.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    return max(int(conf.get("spark.sql.shuffle.partitions")), -(-input_bytes(df) // split))
