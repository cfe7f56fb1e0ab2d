"""Incremental loading: high-water marks, look-back windows, append of
unseen keys, keyed merge (upsert) and schema sync.

All operators take the previous target (``None`` on the first run) and
return the rows to write. Driver round trips carry scalars only: the
high-water mark (a scan of that one column of the target), which goes into
the plan as a typed literal so Parquet scans see a pushed-down comparison,
and whether a merge batch has duplicate keys.
A merge writes its batch once below the checkpoint folder, because the
check, the key side and the insert side read it.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from ..sources.tables import CODEC, MERGE_ATTR


class DuplicateMergeKeyError(ValueError):
    """More than one update row matches one target row (a merge must not
    pick one of them arbitrarily)."""


def _max_text(df: DataFrame, col: str) -> str | None:
    # Max as text: avoids a Python datetime round trip (time zones) and lets
    # the literal be re-typed exactly.
    return df.agg(F.max(F.col(col)).cast("string").alias("m")).first()["m"]


def high_water(target: DataFrame | None, col: str, floor: str | None = None):
    """MAX(col) of the target, or ``floor`` where the target has no rows.

    Returns a typed literal Column, or ``None`` when there is neither a max
    nor a floor (an empty target with the strict rule).
    """
    if target is None:
        return None
    m = _max_text(target, col)
    if m is None:
        m = floor
    if m is None:
        return None
    return F.lit(m).cast(target.schema[col].dataType)


def newer_than(src: DataFrame, target: DataFrame | None, col: str = "_loaded_at", floor: str | None = None) -> DataFrame:
    """Rows of ``src`` stamped after the target's high-water mark.

    * first run (``target is None``): all rows;
    * strict rule (``floor=None``): an existing but empty target has a NULL
      max, so ``col > NULL`` selects nothing;
    * floored rule: ``col > coalesce(max, floor)``.
    """
    if target is None:
        return src
    hw = high_water(target, col, floor)
    if hw is None:
        return src.filter(F.lit(False))
    return src.filter(F.col(col) > hw.cast(src.schema[col].dataType))


def lookback(src: DataFrame, target: DataFrame | None, date_col: str, days: int = 3, floor: str = "1900-01-01") -> DataFrame:
    """Rows with ``date_col >= max(target.date_col) - days`` (late arrivals
    inside the window are recomputed); ``floor`` when the target is empty.
    NULL dates never qualify."""
    if target is None:
        return src
    m = _max_text(target, date_col)
    cutoff = date.fromisoformat(m[:10]) - timedelta(days) if m is not None else date.fromisoformat(floor)
    return src.filter(F.col(date_col) >= F.lit(cutoff))


def append_new(src: DataFrame, target: DataFrame | None, keys: list[str]) -> DataFrame:
    """Rows of ``src`` whose key is not yet in the target (NOT EXISTS).

    Plain equality: a NULL key never matches, so such rows are appended on
    every run, as with NOT EXISTS. No dedup within ``src``.
    """
    if target is None:
        return src
    return src.join(target.select(*keys), on=keys, how="left_anti")


def _align(updates: DataFrame, target: DataFrame, sync_schema: bool) -> tuple[DataFrame, DataFrame]:
    """Bring target and updates to one column list.

    ``sync_schema`` (add new, drop vanished): the updates' columns win and
    old rows get NULL for new columns. Otherwise the target keeps its
    columns; new update columns are ignored, missing ones are NULL.
    """
    if sync_schema:
        cols = updates.columns
        tdt = {f.name: f.dataType for f in target.schema.fields}
        t = target.select(
            *[F.col(c) if c in tdt else F.lit(None).cast(updates.schema[c].dataType).alias(c) for c in cols]
        )
        return t, updates
    cols = target.columns
    udt = set(updates.columns)
    u = updates.select(
        *[F.col(c) if c in udt else F.lit(None).cast(target.schema[c].dataType).alias(c) for c in cols]
    )
    return target, u


def check_merge_keys(target: DataFrame, updates: DataFrame, keys: list[str]) -> None:
    """Raise if two update rows share a key that exists in the target.

    Duplicate keys that are new are all inserted, as a warehouse MERGE does;
    duplicates that would update one target row are an error there. The
    target is only read when the batch has duplicate keys at all.
    """
    twice = updates.filter(_all_not_null(keys)).groupBy(*keys).count().filter(F.col("count") > 1).select(*keys)
    if twice.isEmpty():
        return
    row = target.select(*keys).join(twice, on=keys, how="left_semi").limit(1).collect()
    if row:
        raise DuplicateMergeKeyError(f"duplicate update rows for existing key {row[0].asDict()}")


def _all_not_null(keys: list[str]) -> Column:
    c = F.lit(True)
    for k in keys:
        c = c & F.col(k).isNotNull()
    return c


def merge_upsert(
    target: DataFrame | None,
    updates: DataFrame,
    keys: list[str],
    sync_schema: bool = False,
    check_duplicates: bool = True,
    match: list[str] | None = None,
) -> DataFrame:
    """Keyed MERGE: matched target rows are replaced by the update row,
    unmatched update rows are inserted, other target rows stay.

    ``target LEFT ANTI updates(keys) UNION ALL updates``; the planner and AQE
    choose the join by the sides' bytes. NULL keys never match, so NULL-keyed
    updates are inserted again each run. The result carries its update rows,
    so the table store overwrites the partitions they touch and no others.
    ``match`` names the columns that identify a row where these are not
    ``keys`` (a version of a key).
    """
    if target is None:
        return updates
    t, u = _align(updates, target, sync_schema)
    u = stored(u, "merge-batch", CODEC)
    on = match or keys
    if check_duplicates:
        check_merge_keys(t, u, on)
    out = t.join(u.select(*on), on=on, how="left_anti").select(*t.columns).unionByName(u)
    setattr(out, MERGE_ATTR, (target, u, keys, match))
    return out
