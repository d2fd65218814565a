"""Intermediate tables in the shared checkpoint folder.

A step that is read more than once, or that ends a long lineage, is written
once as Parquet under the folder the cluster names in `spark.checkpoint.dir`
and read back. The files survive lost executors, and unlike
`DataFrame.checkpoint()` the step is computed only once.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_dir


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path for one table or folder of files below the shared folder.

    Where `spark.checkpoint.dir` is unset, a plain local session (tests) gets a
    temporary folder; any other session must name a shared one.
    """
    master = spark.sparkContext.master
    local = master == "local" or master.startswith("local[")
    base = checkpoint_dir(spark, fallback=_local_folder() if local else None)
    return f"{base.rstrip('/')}/cohortflow/{label}-{uuid.uuid4().hex}"


def _local_folder() -> str:
    global _LOCAL
    if _LOCAL is None:
        _LOCAL = tempfile.mkdtemp(prefix="cohortflow-")
    return _LOCAL


_LOCAL: str | None = None


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once and return the written table."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table made by `materialize` that nothing reads any more."""
    spark = df.sparkSession
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
