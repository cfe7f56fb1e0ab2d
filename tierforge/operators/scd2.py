"""Slowly changing dimension, type 2, check strategy.

History columns: the source columns plus ``scd_id``, ``updated_at``,
``valid_from`` and ``valid_to`` (NULL on the open version).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import surrogate_key_ts
from ..sources.tables import TABLE_ATTR
from .incremental import merge_upsert

META = ["scd_id", "updated_at", "valid_from", "valid_to"]


def _new_versions(df: DataFrame, key: str, ts: Column) -> DataFrame:
    return df.select(
        "*",
        surrogate_key_ts(F.col(key), ts).alias("scd_id"),
        ts.alias("updated_at"),
        ts.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
    )


def scd2_apply(
    history: DataFrame | None,
    source: DataFrame,
    key: str,
    check_cols: list[str],
    run_ts: str,
    hard_deletes: bool = False,
) -> DataFrame:
    """Next version of the history table.

    * first load: every source row opens a version at ``run_ts``;
    * a key whose check columns differ (NULL-safe) from its open version:
      the open version closes at ``run_ts`` and a new one opens at ``run_ts``;
    * a new key, or a key returning after a hard delete: a version opens;
    * with ``hard_deletes``, an open key missing from the source closes.

    Changes in other columns open no version. One full outer join of the
    open versions with the source on the key yields the versions that close
    and those that open; these alone are merged into the history (by
    ``scd_id``). A stored history with ``open_until="valid_to"`` reads and
    rewrites partitions of open versions only; closed ones are added.
    """
    ts = F.lit(run_ts).cast("timestamp_ntz")
    if history is None:
        return _new_versions(source, key, ts)

    # One column list: new source columns are NULL in old versions, vanished ones NULL in new versions.
    gone = [c for c in history.columns if c not in source.columns and c not in META]
    source = source.select("*", *[F.lit(None).cast(history.schema[c].dataType).alias(c) for c in gone])
    cols = source.columns
    had = set(history.columns)
    aligned = lambda df: df.select(
        *[F.col(c).cast(source.schema[c].dataType).alias(c) if c in had else F.lit(None).cast(source.schema[c].dataType).alias(c) for c in cols], *META)
    history_now, table = aligned(history), getattr(history, TABLE_ATTR, None)
    if table:
        setattr(history_now, TABLE_ATTR, table)
    now_open = aligned(table[0].read(table[1], still_open=True)) if table else history_now

    c = now_open.filter(F.col("valid_to").isNull()).select(F.col(key).alias("_k"), F.struct(*[F.col(x) for x in cols + META]).alias("_c"))
    s = source.select(F.col(key).alias("_k"), F.struct(*[F.col(x) for x in cols]).alias("_s"))
    j = c.join(s, on="_k", how="full_outer")

    differs = reduce(lambda a, b: a | b, [~F.col(f"_c.{x}").eqNullSafe(F.col(f"_s.{x}")) for x in check_cols])
    changed = F.col("_c").isNotNull() & F.col("_s").isNotNull() & differs
    close_now = changed | (F.col("_c").isNotNull() & F.col("_s").isNull() & F.lit(hard_deletes))
    closed = F.when(close_now, F.struct(
        *[F.col(f"_c.{x}").alias(x) for x in cols + ["scd_id", "updated_at", "valid_from"]], ts.alias("valid_to")))
    opened = F.when(F.col("_s").isNotNull() & (F.col("_c").isNull() | changed), F.struct(
        *[F.col(f"_s.{x}").alias(x) for x in cols],
        surrogate_key_ts(F.col("_s").getField(key), ts).alias("scd_id"),
        ts.alias("updated_at"),
        ts.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
    ))
    moved = j.select(F.explode(F.array_compact(F.array(closed, opened))).alias("_v")).select("_v.*")
    return merge_upsert(history_now, moved, [key], check_duplicates=False, match=["scd_id"])


def current_versions(history: DataFrame) -> DataFrame:
    """Open versions only (``valid_to IS NULL``)."""
    return history.filter(F.col("valid_to").isNull())
