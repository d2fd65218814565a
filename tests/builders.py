"""Small hand-made native tables for unit cases."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

from cohortflow.sources.schemas import NATIVE_TABLES
from cohortflow.sources.tables import CohortInputs

D = dt.date


def make_inputs(spark: SparkSession, **tables: list[tuple]) -> CohortInputs:
    frames = {name: spark.createDataFrame(tables.get(name, []), schema) for name, schema in NATIVE_TABLES.items()}
    return CohortInputs(**frames)


def member(uid: int, campus: int | None = 1, year: int | None = 1, role: int | None = 1) -> tuple:
    return (uid, f"F{uid}", f"L{uid}", year, campus, role, None)
