"""Latest-record deduplication (ROW_NUMBER() ... = 1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_first(col: str = "_loaded_at") -> Column:
    """Warehouse DESC order: NULL stamps sort first (they rank highest)."""
    return F.col(col).desc_nulls_first()


def dedup_latest(
    df: DataFrame,
    keys: list[str],
    order: list[Column] | None = None,
    tie_break: list[str] | None = None,
) -> DataFrame:
    """Keep one row per key: the first by ``order`` (default ``_loaded_at``
    DESC NULLS FIRST), then ``tie_break`` columns DESC as a deterministic
    total order.

    ``row_number() = 1`` plans as a WindowGroupLimit: a partial top-1 per
    key runs before the shuffle, so a hot key sends one row per input
    partition across the network rather than all of its rows.
    """
    order = list(order) if order else [latest_first()]
    order += [F.col(c).desc_nulls_last() for c in (tie_break or [])]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
