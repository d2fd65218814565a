"""Sinks: the event store tables and the dataset output."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .schemas import NATIVE_TABLES


def table_path(base_path: str, name: str) -> str:
    return f"{base_path.rstrip('/')}/{name}"


def read_table_if_exists(spark: SparkSession, base_path: str, name: str) -> DataFrame | None:
    """A stored native table, or None before its first write. Any other failure is
    raised. The tables that batches are appended to are read in their published version."""
    if name in VERSIONED:
        version = store_version(spark, base_path)
        if version.number:
            return read_parts(spark, base_path, name, version.parts[name])
    try:
        return spark.read.schema(NATIVE_TABLES[name]).parquet(table_path(base_path, name))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _hadoop_path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files below `path`; 0 when there are none."""
    store, target = _hadoop_path(spark, path)
    return store.getContentSummary(target).getLength() if store.exists(target) else 0


# Versions of the store. A batch is written as one new folder (a part) per table, which
# no reader looks at, and becomes visible, events and attendees together, when a manifest of
# all parts is renamed to the next version number. The rename fails where another run has
# published that number first. A run that dies before leaves folders that nothing names.
VERSIONED = ("program_event", "event_attendees")
_MANIFESTS = "_versions"
# The part of files that lie in the table's own folder, as a store without versions has them.
_PLAIN = "."


class StaleVersion(Exception):
    """Another run has published a version since the one that was read."""


@dataclass(frozen=True)
class StoreVersion:
    number: int  # 0: nothing is published
    parts: dict[str, tuple[str, ...]]


def _manifest(base_path: str, number: int) -> str:
    return f"{table_path(base_path, _MANIFESTS)}/{number:010d}"


def store_version(spark: SparkSession, base_path: str) -> StoreVersion:
    """The newest published version of the store."""
    store, folder = _hadoop_path(spark, table_path(base_path, _MANIFESTS))
    names = [s.getPath().getName() for s in store.listStatus(folder)] if store.exists(folder) else []
    number = max((int(name) for name in names if name.isdigit()), default=0)
    parts: dict[str, list[str]] = {name: [] for name in VERSIONED}
    if number:
        lines = spark.read.text(_manifest(base_path, number)).collect()  # one line per part
        for line in lines:
            name, part = line.value.split("\t")
            parts[name].append(part)
    else:
        for name in VERSIONED:
            store, folder = _hadoop_path(spark, table_path(base_path, name))
            files = store.listStatus(folder) if store.exists(folder) else []
            if any(f.isFile() and not f.getPath().getName().startswith(("_", ".")) for f in files):
                parts[name].append(_PLAIN)
    return StoreVersion(number, {name: tuple(found) for name, found in parts.items()})


def read_parts(spark: SparkSession, base_path: str, name: str, parts: tuple[str, ...]) -> DataFrame | None:
    """The rows of some parts of a table; None where there is no part."""
    if not parts:
        return None
    folders = [table_path(base_path, name) if part == _PLAIN else f"{table_path(base_path, name)}/{part}" for part in parts]
    return spark.read.schema(NATIVE_TABLES[name]).parquet(*folders)


def write_part(df: DataFrame, base_path: str, name: str) -> str | None:
    """Write rows as a new part and return its name; None, and no part, without rows."""
    part, seen = f"batch={uuid.uuid4().hex}", Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{table_path(base_path, name)}/{part}")
    if seen.get["rows"]:
        return part
    drop_part(df.sparkSession, base_path, name, part)
    return None


def drop_part(spark: SparkSession, base_path: str, name: str, part: str | None) -> None:
    """Remove a part that no version names."""
    if part:
        store, folder = _hadoop_path(spark, f"{table_path(base_path, name)}/{part}")
        store.delete(folder, True)


def publish(spark: SparkSession, base_path: str, seen: StoreVersion, added: dict[str, str | None]) -> StoreVersion:
    """Make new parts visible, all at once, as the version after `seen`. Raises
    StaleVersion, and changes nothing, when another run has published that one."""
    if not any(added.values()):
        return seen
    parts = {name: (*seen.parts[name], *([added[name]] if added.get(name) else [])) for name in VERSIONED}
    store, draft = _hadoop_path(spark, f"{table_path(base_path, _MANIFESTS)}/draft-{uuid.uuid4().hex}")
    stream = store.create(draft, False)
    stream.write("".join(f"{name}\t{part}\n" for name in VERSIONED for part in parts[name]).encode())
    stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    keep = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    keep[0] = hadoop.Options.Rename.NONE  # never over a manifest that is there
    context = hadoop.FileContext.getFileContext(draft.toUri() if draft.toUri().getScheme() else store.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(store.makeQualified(draft), store.makeQualified(hadoop.Path(_manifest(base_path, seen.number + 1))), keep)
    except Py4JJavaError as error:
        store.delete(draft, False)
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        raise StaleVersion(f"version {seen.number + 1} of {base_path} is another run's") from None
    return StoreVersion(seen.number + 1, parts)


def dataset_name(run_date: dt.date) -> str:
    """Dated output name, event_dataset_MM-DD-YYYY."""
    return f"event_dataset_{run_date.strftime('%m-%d-%Y')}"


def write_dataset(df: DataFrame, output_dir: str, run_date: dt.date, fmt: str = "parquet") -> str:
    """The wide dataset, partitioned by fiscal year (parquet), or CSV with a header.

    No row-index column: a distributed table has no row order to number.
    Before the write the rows are rebalanced by fiscal year, so a small year is one
    file and a large one several of the advisory size, not one per task or one in
    all. A parquet run replaces the fiscal years it has rows of and leaves the
    others; a CSV run replaces the folder.
    An empty result partitioned by FY leaves no data files; read it back with
    the dataset schema (`profiles.DATASET_COLUMNS` order).
    """
    path = f"{output_dir.rstrip('/')}/{dataset_name(run_date)}"
    if fmt == "csv":
        df.hint("rebalance").write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)
    else:
        writer = df.hint("rebalance", F.col("FY")).write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy("FY").parquet(path)
    return path
