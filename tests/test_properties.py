"""Property tests: merge against a plain reference, SCD2 invariants."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tierforge.operators.incremental import merge_upsert
from tierforge.operators.scd2 import scd2_apply

keys = st.one_of(st.none(), st.integers(0, 6))
vals = st.sampled_from(["a", "b", "c"])
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(target=st.lists(st.tuples(keys, vals), max_size=8), updates=st.dictionaries(st.integers(0, 6), vals, max_size=5),
       null_updates=st.lists(vals, max_size=2))
def test_merge_matches_reference(spark, target, updates, null_updates):
    upd_rows = list(updates.items()) + [(None, v) for v in null_updates]
    t = spark.createDataFrame(target, "k int, v string")
    u = spark.createDataFrame(upd_rows, "k int, v string")
    got = sorted(merge_upsert(t, u, ["k"]).collect(), key=repr)
    expected = [r for r in target if r[0] is None or r[0] not in updates] + upd_rows
    assert [tuple(r) for r in got] == sorted(expected, key=repr)


@SETTINGS
@given(day1=st.dictionaries(st.integers(0, 8), st.one_of(st.none(), vals), max_size=8),
       day2=st.dictionaries(st.integers(0, 8), st.one_of(st.none(), vals), max_size=8),
       hard=st.booleans())
def test_scd2_invariants(spark, day1, day2, hard):
    s1 = spark.createDataFrame(list(day1.items()), "k int, a string")
    s2 = spark.createDataFrame(list(day2.items()), "k int, a string")
    h = scd2_apply(scd2_apply(None, s1, "k", ["a"], "2024-01-01 00:00:00"), s2, "k", ["a"], "2024-01-02 00:00:00", hard_deletes=hard)
    rows = h.collect()
    open_ = {}
    for r in rows:
        if r.valid_to is None:
            assert r.k not in open_, "two open versions of one key"
            open_[r.k] = r.a
        else:
            assert r.valid_from < r.valid_to
    # open state equals the latest source, plus keys missing from it unless hard deletes
    expect = dict(day2)
    if not hard:
        for k, v in day1.items():
            expect.setdefault(k, v)
    assert open_ == expect
    changed = {k for k in day1 if k in day2 and day1[k] != day2[k]}
    gone = set(day1) - set(day2) if hard else set()
    assert sum(1 for r in rows if r.valid_to is not None) == len(changed) + len(gone)
    assert len(rows) == len(day1) + len(changed) + len(set(day2) - set(day1))
