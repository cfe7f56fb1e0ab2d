"""Counts of several distinct values beside sums, without expanding the rows once per count."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sums_and_distincts(df: DataFrame, key: str, sums: dict[str, Column], distincts: dict[str, str]) -> DataFrame:
    """One row for each ``key``: the sums, and for each of ``distincts`` (name to column) how many different values it has.

    Each column is grouped with the key first and its values counted then, so that a shuffle moves a key's values of one
    column once, pre-aggregated; the first column's groups carry the sums. The parts meet on the key, by which they
    are all partitioned. A NULL key is a group, NULL values are not counted.
    """
    parts = []
    for name, column in distincts.items():
        carried = {} if parts else sums
        values = df.groupBy(key, F.col(column).alias("_value")).agg(F.lit(1).alias("_one"), *[F.sum(c).alias(n) for n, c in carried.items()])
        parts.append(values.groupBy(key).agg(*[F.sum(n).alias(n) for n in carried], F.count("_value").alias(name)))

    def beside(a: DataFrame, b: DataFrame) -> DataFrame:
        return a.join(b.withColumnRenamed(key, "_key"), F.col(key).eqNullSafe(F.col("_key"))).drop("_key")

    return reduce(beside, parts)
