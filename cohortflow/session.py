"""Session settings for the cohort jobs, and the shared checkpoint folder."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

# Settings the plans are written for: AQE re-plans joins from measured sizes
# (that runtime size check is the only way a data-derived side gets
# broadcast), coalesces small shuffles and splits skewed join partitions even
# when that costs an extra shuffle downstream.
RECOMMENDED_CONF = {
    # No broadcast from optimizer estimates (a projected file size says little
    # about the hash table it becomes); AQE broadcasts a side only after its
    # shuffle output has been measured below the threshold.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10485760",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


# Target bytes per shuffle partition on a cluster: large enough to keep task
# overhead small, small enough to sort/aggregate in executor memory without
# heavy spills.
PARTITION_BYTES = 256 * 1024 * 1024
# More partitions than this cost more on the driver (map output tracking is
# partitions x partitions) than larger ones cost on the executors.
MAX_PARTITIONS = 32_768


def size_for_input(spark: SparkSession, input_bytes: int, partition_bytes: int = PARTITION_BYTES) -> dict[str, str]:
    """Shuffle and scan sizing for a run over `input_bytes` of facts.

    The initial shuffle partition count is the fact volume over the target
    partition size, at most MAX_PARTITIONS (AQE then coalesces small ones and
    splits skewed ones); scans split files at the target size. Returns the
    settings applied.
    """
    n = min(MAX_PARTITIONS, max(spark.sparkContext.defaultParallelism, -(-input_bytes // partition_bytes)))
    conf = {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf


def build_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "cohortflow") -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The cluster's shared checkpoint folder (`spark.checkpoint.dir`).

    Read from the session; `fallback` is only used where the setting is unset
    (tests), and is then installed on the context so `DataFrame.checkpoint()`
    writes there too.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if fallback is None:
        raise RuntimeError("spark.checkpoint.dir is not set; pass a shared folder")
    if "://" not in fallback:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"{fallback} is not a shared folder")
        os.makedirs(fallback, exist_ok=True)
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback


# Rows of an Arrow batch of texts: 10,000 (Spark's default) of a few KB each fill
# tens of MB on both sides of every worker.
TEXT_BATCH_ROWS = 1_000


def prepare_workers(spark: SparkSession) -> None:
    """Make the session fit for Python workers that read whole texts.

    Small Arrow batches, and this package on every worker, once per
    application: workers import the functions they run by name, and a package
    that lies only on the driver's path is not there for them.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_BATCH_ROWS))
    context = spark.sparkContext
    if getattr(context, "_cohortflow_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="cohortflow-"), "cohortflow")
    context.addPyFile(shutil.make_archive(target, "zip", os.path.dirname(package), os.path.basename(package)))
    context._cohortflow_shipped = True
