"""Calendar generators. Rows come from ``spark.range`` so that the days are
spread over partitions instead of exploded from one row."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _d(x: str | dt.date) -> dt.date:
    return x if isinstance(x, dt.date) else dt.date.fromisoformat(x)


def calendar(spark: SparkSession, start: str | dt.date, n_days: int, name: str = "date_day") -> DataFrame:
    """``n_days`` consecutive days from ``start`` (a row generator)."""
    return spark.range(n_days).select(F.date_add(F.lit(_d(start).isoformat()).cast("date"), F.col("id").cast("int")).alias(name))


def date_spine(spark: SparkSession, start: str | dt.date, end_exclusive: str | dt.date, name: str = "date_day") -> DataFrame:
    """Every day from ``start`` up to, not including, ``end_exclusive``."""
    n = (_d(end_exclusive) - _d(start)).days
    return calendar(spark, start, max(n, 0), name)
