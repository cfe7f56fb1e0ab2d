"""Readers for build-tool run-results files (one JSON document per attempt).

Each file becomes one row ``(source_file, doc)``; ``operators.runlog``
parses and explodes the documents on the executors. A document lists one
attempt's nodes, so a row is bounded by the size of a project, not by data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_run_results(spark: SparkSession, path: str) -> DataFrame:
    """Whole JSON documents under ``path`` (a file, folder or glob)."""
    return spark.read.text(path, wholetext=True).select(
        F.input_file_name().alias("source_file"), F.col("value").alias("doc"))
