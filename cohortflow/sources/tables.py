"""Input container and readers for the native tables."""

from __future__ import annotations

import csv
from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import NATIVE_TABLES, REGISTRATIONS_CSV


@dataclass(frozen=True)
class CohortInputs:
    """The member, event and fact tables the cohort metrics read."""

    program_event: DataFrame
    program_event_type: DataFrame
    event_attendees: DataFrame
    members: DataFrame
    org_units: DataFrame
    sessions: DataFrame
    attendance: DataFrame
    mentorships: DataFrame
    outreach_outcomes: DataFrame
    study_groups: DataFrame
    study_schedules: DataFrame
    contact_chart: DataFrame

    def replace(self, **changes: DataFrame) -> "CohortInputs":
        values = {f.name: getattr(self, f.name) for f in fields(self)}
        values.update(changes)
        return CohortInputs(**values)


#: Column with the text of a line that is no row of the file's columns; null for all others.
MALFORMED = "malformed"


def registration_columns(df: DataFrame, id_column: str = "member_id") -> DataFrame:
    """The four registration columns, taken by header name (any order, extra
    columns pruned), typed as REGISTRATIONS_CSV; an unreadable id becomes null.
    `id_column` names the file's member-id column. A malformed line keeps its
    text in MALFORMED and nothing else: how far it could be split says nothing
    about where its values belong."""
    source = {"member_id": id_column}
    whole = F.col(MALFORMED).isNull() if MALFORMED in df.columns else F.lit(True)
    own = []
    for f in REGISTRATIONS_CSV.fields:
        value = F.col(source.get(f.name, f.name))
        own.append(F.when(whole, value if f.dataType == T.StringType() else value.try_cast(f.dataType)).alias(f.name))
    return df.select(*own, *([MALFORMED] if MALFORMED in df.columns else []))


def text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def csv_options(header: list[str]) -> tuple[T.StructType, dict[str, object]]:
    """Schema and reader options of registration files with this header.

    Every value is read as text (no inference); a quote inside a quoted value
    is doubled. A line with another number of values than the header has, or
    with a quote that is not closed, keeps its text in MALFORMED (Q17); for that
    a line is split whole, also where only some columns are wanted. The header of
    each file must be this one.
    """
    options = {
        "header": True, "enforceSchema": False, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED,
        "escape": '"', "unescapedQuoteHandling": "STOP_AT_CLOSING_QUOTE", "columnPruning": False,
    }
    return text_schema([*header, MALFORMED]), options


def read_registrations_csv(spark: SparkSession, path: str, id_column: str = "member_id") -> DataFrame:
    """The registration files below `path`. Each file's columns are matched by
    its own header and cast explicitly; a malformed line is a row of its own,
    with its text in MALFORMED. `id_column` names the member-id column when it is
    not called member_id. A file without one of the four columns raises."""
    parts = []
    for header, files in registration_headers(spark, path):
        schema, options = csv_options(header)
        parts.append(registration_columns(spark.read.schema(schema).options(**options).csv(files), id_column))
    if not parts:
        return spark.createDataFrame([], T.StructType([*REGISTRATIONS_CSV.fields, T.StructField(MALFORMED, T.StringType())]))
    return reduce(DataFrame.unionByName, parts)


def registration_headers(spark: SparkSession, path: str) -> list[tuple[list[str], list[str]]]:
    """The different headers of the files below `path`, each with its files.

    Only the first line of each file is read, through the file system of the
    path; a compressed file is decompressed as far as that.
    """
    by_header: dict[tuple[str, ...], list[str]] = {}
    for file in sorted(spark.read.text(path).inputFiles()):
        line = first_line(spark, file)
        if line is not None:
            by_header.setdefault(tuple(next(csv.reader([line.removeprefix("\ufeff")]))), []).append(file)
    return [(list(names), files) for names, files in by_header.items()]


def first_line(spark: SparkSession, file: str) -> str | None:
    """The first line of a text file; None when the file is empty."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    stream = path.getFileSystem(conf).open(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    stream = stream if codec is None else codec.createInputStream(stream)
    try:
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()


def read_native_tables(spark: SparkSession, base_path: str, fmt: str = "parquet", versioned: dict[str, DataFrame | None] | None = None) -> CohortInputs:
    """One directory per table under `base_path` (parquet by default).

    Columns are selected by name in schema order, so extra columns in the files
    are pruned at the scan. `versioned` has tables that are read in a published
    version (`sinks.read_table_if_exists`); None stands for a table without rows.
    """
    versioned = versioned or {}
    frames = {}
    for name, schema in NATIVE_TABLES.items():
        if name in versioned:
            frames[name] = spark.createDataFrame([], schema) if versioned[name] is None else versioned[name]
            continue
        df = spark.read.format(fmt).load(f"{base_path}/{name}")
        frames[name] = df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
    return CohortInputs(**frames)


def read_catalog_tables(spark: SparkSession, database: str) -> CohortInputs:
    """S2/S3 from a catalog database holding tables with the native names."""
    frames = {}
    for name, schema in NATIVE_TABLES.items():
        df = spark.table(f"{database}.{name}")
        frames[name] = df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
    return CohortInputs(**frames)
