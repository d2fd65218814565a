"""Registration files as a stream: each new file (or group of files) is one batch.

A file-source stream over the registration folder feeds `foreachBatch`, which
runs the same idempotent event and attendee appends as the batch job. The
stream's checkpoint records which files were taken; a replayed micro-batch
appends nothing new, so the store sees each registration once. Rows with
unreadable dates and malformed lines go to `registration_rejects` in the store, one folder per
micro-batch, which a replay overwrites.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.registration import TypeId
from ..plans.job import register_batch
from ..session import checkpoint_dir
from ..sources.schemas import REGISTRATIONS_CSV
from ..sources.sinks import table_path
from ..sources.tables import csv_options, registration_columns, text_schema

REJECTS = "registration_rejects"


def registration_stream(
    spark: SparkSession,
    source_dir: str,
    file_schema: StructType | None = None,
    max_files_per_trigger: int | None = None,
    id_column: str = "member_id",
) -> DataFrame:
    """The registration files as a stream of typed rows.

    A file stream needs its schema up front: `file_schema` is the files'
    full column list (all text); by default the header of the files already
    there is used, else the four registration columns. Columns are then taken
    by name; a file with another header stops the stream.
    """
    if file_schema is None:
        try:
            file_schema = spark.read.option("header", True).option("inferSchema", False).csv(source_dir).schema
        except AnalysisException as error:  # no file is there yet
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            file_schema = text_schema([id_column if f.name == "member_id" else f.name for f in REGISTRATIONS_CSV.fields])
    # A file whose header differs from the schema raises; its columns are never taken by position.
    schema, options = csv_options(file_schema.fieldNames())
    reader = spark.readStream.schema(schema).options(**options)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return registration_columns(reader.csv(source_dir), id_column)


def start_registration_ingest(
    spark: SparkSession,
    source_dir: str,
    store_path: str,
    type_id: TypeId,
    checkpoint_location: str | None = None,
    available_now: bool = True,
    id_column: str = "member_id",
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the ingest; `available_now` processes what is there and stops.

    The stream checkpoint goes under the cluster's `spark.checkpoint.dir`
    unless a location is given.
    """
    location = checkpoint_location or f"{checkpoint_dir(spark).rstrip('/')}/registration_ingest"

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        registered = register_batch(batch.sparkSession, batch, store_path, type_id)
        registered.rejects.write.mode("overwrite").parquet(f"{table_path(store_path, REJECTS)}/epoch_id={epoch_id}")

    stream = registration_stream(spark, source_dir, max_files_per_trigger=max_files_per_trigger, id_column=id_column)
    writer = stream.writeStream.foreachBatch(upsert).option("checkpointLocation", location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
