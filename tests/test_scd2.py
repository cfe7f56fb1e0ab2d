from pyspark.sql import functions as F

from tierforge.operators.scd2 import scd2_apply

S = "k int, a string, b string, noise string"
T1, T2, T3 = "2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00"


def versions(h):
    return sorted(((r.k, str(r.a), str(r.b), str(r.valid_from), str(r.valid_to)) for r in h.collect()), key=str)


def test_scd2_transitions(spark):
    day1 = spark.createDataFrame([
        (1, "x", "y", "n"),   # unchanged
        (2, "x", "y", "n"),   # changed a
        (3, None, "y", "n"),  # NULL -> value
        (4, "x", "y", "n"),   # value -> NULL
        (5, "x", "y", "n"),   # only a non-checked column changes
        (6, "x", "y", "n"),   # deleted
    ], S)
    day2 = spark.createDataFrame([
        (1, "x", "y", "n"), (2, "X", "y", "n"), (3, "v", "y", "n"), (4, None, "y", "n"), (5, "x", "y", "CHANGED"),
        (7, "new", "y", "n"),
    ], S)
    h1 = scd2_apply(None, day1, "k", ["a", "b"], T1)
    assert h1.filter(F.col("valid_to").isNull()).count() == 6
    h2 = scd2_apply(h1, day2, "k", ["a", "b"], T2)
    v = versions(h2)
    closed = {r[0] for r in v if r[4] != "None"}
    assert closed == {2, 3, 4}
    opened_day2 = {r[0] for r in v if r[3].startswith("2024-01-02")}
    assert opened_day2 == {2, 3, 4, 7}
    assert any(r[0] == 6 and r[4] == "None" for r in v)  # no hard deletes: stays open
    # at most one open version per key; periods do not overlap
    assert h2.filter("valid_to is null").groupBy("k").count().filter("count > 1").count() == 0

    h2d = scd2_apply(h1, day2, "k", ["a", "b"], T2, hard_deletes=True)
    assert h2d.filter("k = 6 and valid_to is not null").count() == 1
    # key reappearing after a hard delete opens a new version
    day3 = day2.unionByName(spark.createDataFrame([(6, "x", "y", "n")], S))
    h3 = scd2_apply(h2d, day3, "k", ["a", "b"], T3, hard_deletes=True)
    assert h3.filter("k = 6").count() == 2
    assert h3.filter("k = 6 and valid_to is null").first().valid_from.isoformat().startswith("2024-01-03")


def test_scd2_ids_are_unique(spark):
    day1 = spark.createDataFrame([(1, "x", "y", "n"), (2, "x", "y", "n")], S)
    day2 = spark.createDataFrame([(1, "z", "y", "n"), (2, "x", "y", "n")], S)
    h = scd2_apply(scd2_apply(None, day1, "k", ["a"], T1), day2, "k", ["a"], T2)
    assert h.select("scd_id").distinct().count() == h.count() == 3


def test_new_and_vanished_columns(spark):
    day1 = spark.createDataFrame([(1, "x", "old"), (2, "x", "old")], "k int, a string, gone string")
    day2 = spark.createDataFrame([(1, "y", 5), (2, "x", 6), (3, "z", 7)], "k int, a string, fresh int")
    h = scd2_apply(scd2_apply(None, day1, "k", ["a"], T1), day2, "k", ["a"], T2)
    got = {(r.k, str(r.valid_to) != "None"): (r.a, r.gone, r.fresh) for r in h.collect()}
    assert got == {(1, True): ("x", "old", None), (1, False): ("y", None, 5), (2, False): ("x", "old", None), (3, False): ("z", None, 7)}
    again = scd2_apply(h, day2, "k", ["a"], T3)
    assert again.count() == 4
