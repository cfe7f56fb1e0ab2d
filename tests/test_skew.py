"""Hot keys: one key / one (model, minute) holding a large share of rows.
Results are checked against brute force."""

import datetime as dt
import random

from tierforge.operators import runlog as L
from tierforge.operators.dedup import dedup_latest


def test_dedup_with_a_hot_key(spark):
    rows = [(0, i, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i)) for i in range(3000)]  # a third: key 0
    rows += [(k, k, dt.datetime(2024, 1, 1)) for k in range(1, 6001)]
    df = spark.createDataFrame(rows, "k long, v long, _loaded_at timestamp_ntz").repartition(8)
    got = {r.k: r.v for r in dedup_latest(df, ["k"]).collect()}
    assert len(got) == 6001 and got[0] == 2999


def test_rows_written_with_a_hot_minute(spark):
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1, 12, 0, 0)
    ev, hist = [], []
    for i in range(400):  # one model, one minute: the hot group
        s = base + dt.timedelta(seconds=rnd.randint(0, 59), microseconds=rnd.randint(0, 999999))
        e = s + dt.timedelta(seconds=rnd.randint(-60 if i % 5 == 0 else 0, 30))  # some end before they start
        ev.append((i, "d", "stg_tpch__hot_run", "success" if i % 9 else "error", None if i % 31 == 1 else s, None if i % 37 == 2 else e))
    for j in range(400):
        e = base + dt.timedelta(seconds=rnd.randint(-30, 120), microseconds=rnd.randint(0, 999999))
        ok = j % 7 != 0
        hist.append((j, e, f"MERGE INTO STG_TPCH__HOT x{j}", "SUCCESS" if ok else "FAIL",
                     "MERGE" if j % 5 else "SELECT", j % 13 if j % 3 else None, j % 4 if j % 2 else None))
    e_df = spark.createDataFrame(ev, "event_id long, dag_id string, task_id string, status string, start_date timestamp_ntz, end_date timestamp_ntz")
    h_df = spark.createDataFrame(hist, "query_id long, end_time timestamp_ntz, query_text string, execution_status string, "
                                       "query_type string, rows_inserted long, rows_updated long")
    got = {r.event_id: r.rows_affected for r in L.rows_written(e_df, h_df).collect()}

    def trunc(t):
        return t.replace(microsecond=0)

    for (i, _, _, status, s, e) in ev:
        if s is None or e is None:
            assert got[i] is None
            continue
        lo, hi = trunc(s - dt.timedelta(seconds=10)), trunc(e + dt.timedelta(seconds=10))
        m = [(ins or 0) + (upd or 0) for (_, t, txt, st, qt, ins, upd) in hist
             if st == "SUCCESS" and qt in L.WRITE_QUERY_TYPES and lo <= t <= hi and "stg_tpch__hot" in txt.lower()]
        want = sum(m) if (status == "success" and m) else None
        assert got[i] == want, (i, got[i], want)


def test_underscore_in_a_model_name_matches_any_character(spark):
    t = dt.datetime(2024, 1, 1, 12, 0, 0)
    ev = [(i, "d", m, "success", t, t) for i, m in enumerate(["stg_a", "STG_B_run", "x_", "none_run"])]
    hist = [(0, t, "insert into stg_a", 1), (1, t, "merge STG-A x", 2), (2, t, "merge stgXb", 4), (3, t, "stga stg b", 8), (4, t, "the x", 16)]
    e_df = spark.createDataFrame(ev, "event_id long, dag_id string, task_id string, status string, start_date timestamp_ntz, end_date timestamp_ntz")
    h_df = spark.createDataFrame([(q, e, x, "SUCCESS", "MERGE", n, None) for q, e, x, n in hist],
                                 "query_id long, end_time timestamp_ntz, query_text string, execution_status string, query_type string, rows_inserted long, rows_updated long")
    got = {r.event_id: r.rows_affected for r in L.rows_written(e_df, h_df).collect()}
    assert got == {0: 3, 1: 12, 2: 4, 3: None}
