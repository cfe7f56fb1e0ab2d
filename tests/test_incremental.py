import pytest
from pyspark.sql import functions as F

from tierforge.operators.incremental import (
    DuplicateMergeKeyError, append_new, lookback, merge_upsert, newer_than,
)

SCHEMA = "k int, v string, _loaded_at timestamp_ntz"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def ntz(s):
    import datetime as dt
    return dt.datetime.fromisoformat(s)


def test_strict_high_water_empty_target_selects_nothing(spark):
    src = frame(spark, [(1, "a", ntz("2024-01-02 00:00:00"))])
    empty = src.limit(0)
    assert newer_than(src, empty, "_loaded_at").count() == 0          # MAX NULL -> no rows
    assert newer_than(src, empty, "_loaded_at", floor="1900-01-01 00:00:00").count() == 1
    assert newer_than(src, None, "_loaded_at").count() == 1            # first run: no filter


def test_high_water_excludes_equal_and_null(spark):
    tgt = frame(spark, [(1, "a", ntz("2024-01-01 00:00:00"))])
    src = frame(spark, [(1, "x", ntz("2024-01-01 00:00:00")), (2, "y", None), (3, "z", ntz("2024-01-01 00:00:01"))])
    got = [r.k for r in newer_than(src, tgt, "_loaded_at", floor="1900-01-01 00:00:00").collect()]
    assert got == [3]


def test_high_water_literal_is_pushed_to_scan(spark, tmp_path):
    src = frame(spark, [(1, "x", ntz("2024-01-02 00:00:00"))])
    src.write.parquet(str(tmp_path / "s"))
    scan = spark.read.parquet(str(tmp_path / "s"))
    plan = newer_than(scan, src, "_loaded_at")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(_loaded_at" in plan


def test_lookback_window_inclusive_and_null_dates_excluded(spark):
    import datetime as dt
    tgt = spark.createDataFrame([(1, dt.date(2020, 1, 10))], "k int, d date")
    src = spark.createDataFrame([(1, dt.date(2020, 1, 7)), (2, dt.date(2020, 1, 6)), (3, None)], "k int, d date")
    assert sorted(r.k for r in lookback(src, tgt, "d", 3).collect()) == [1]
    assert lookback(src, tgt.limit(0), "d", 3).count() == 2  # floor 1900-01-01


def test_append_new_is_idempotent_and_keeps_null_keys(spark):
    src = frame(spark, [(1, "a", None), (2, "b", None), (None, "n", None)])
    first = append_new(src, None, ["k"])
    again = append_new(src, first, ["k"])
    assert first.count() == 3
    assert [r.v for r in again.collect()] == ["n"]  # NOT EXISTS never matches a NULL key


def test_merge_match_insert_and_null_key(spark):
    tgt = frame(spark, [(1, "old", None), (2, "keep", None), (None, "n1", None)])
    upd = frame(spark, [(1, "new", None), (3, "ins", None), (None, "n2", None)])
    got = sorted((r.k or -1, r.v) for r in merge_upsert(tgt, upd, ["k"]).collect())
    assert got == [(-1, "n1"), (-1, "n2"), (1, "new"), (2, "keep"), (3, "ins")]


def test_merge_is_idempotent(spark):
    tgt = frame(spark, [(1, "a", None), (2, "b", None)])
    upd = frame(spark, [(2, "c", None)])
    once = merge_upsert(tgt, upd, ["k"])
    twice = merge_upsert(once, upd, ["k"])
    assert sorted(once.collect()) == sorted(twice.collect())


def test_merge_duplicate_update_key_raises(spark):
    tgt = frame(spark, [(1, "a", None)])
    upd = frame(spark, [(1, "x", None), (1, "y", None)])
    with pytest.raises(DuplicateMergeKeyError):
        merge_upsert(tgt, upd, ["k"])
    # duplicates of a new key are both inserted
    upd2 = frame(spark, [(5, "x", None), (5, "y", None)])
    assert merge_upsert(tgt, upd2, ["k"]).count() == 3


def test_merge_schema_sync_adds_and_drops_columns(spark):
    tgt = spark.createDataFrame([(1, "a", "gone")], "k int, v string, old string")
    upd = spark.createDataFrame([(2, "b", 7)], "k int, v string, extra int")
    synced = merge_upsert(tgt, upd, ["k"], sync_schema=True)
    assert synced.columns == ["k", "v", "extra"]
    assert sorted((r.k, r.extra) for r in synced.collect()) == [(1, None), (2, 7)]
    kept = merge_upsert(tgt, upd, ["k"], sync_schema=False)
    assert kept.columns == ["k", "v", "old"]
    assert sorted((r.k, r.old) for r in kept.collect()) == [(1, "gone"), (2, None)]


def test_composite_key_merge(spark):
    tgt = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "o int, l int, v string")
    upd = spark.createDataFrame([(1, 2, "B"), (2, 1, "c")], "o int, l int, v string")
    got = sorted(tuple(r) for r in merge_upsert(tgt, upd, ["o", "l"]).collect())
    assert got == [(1, 1, "a"), (1, 2, "B"), (2, 1, "c")]
