import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tierforge.functions import exprs as X
from tierforge.operators.calendar import calendar, date_spine


def test_try_number_parsing(spark):
    vals = ["12.345", "12.7", " 7 ", "1e2", "1,000", "", None, "x", "123456789.00"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = df.select(X.try_number("s").alias("n0"), X.try_number("s", 10, 2).alias("n2")).collect()
    n0 = [r.n0 for r in got]
    n2 = [r.n2 for r in got]
    assert n0 == [Decimal(12), Decimal(13), Decimal(7), Decimal(100), None, None, None, None, Decimal(123456789)]
    assert n2[:4] == [Decimal("12.35"), Decimal("12.70"), Decimal("7.00"), Decimal("100.00")]
    assert n2[4:] == [None] * 5  # bad text and overflow of decimal(10,2)


def test_day_diff_counts_boundaries(spark):
    rows = [("2016-01-01 23:59:00", "2016-01-02 00:01:00"), ("2016-01-01 01:00:00", "2016-01-01 23:00:00"),
            ("2016-01-05 00:00:00", "2016-01-01 00:00:00"), (None, "2016-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "a string, b string")
    got = [r.d for r in df.select(X.day_diff(X.try_timestamp_ntz("a"), X.try_timestamp_ntz("b")).alias("d")).collect()]
    assert got == [1, 0, -4, None]


def test_initcap_splits_on_punctuation(spark):
    df = spark.createDataFrame([("sao paulo-sp d'oeste",), ("  RIO de janeiro",), ("",), (None,)], "s string")
    got = [r.c for r in df.select(X.initcap_words("s").alias("c")).collect()]
    assert got == ["Sao Paulo-Sp D'oeste", "  Rio De Janeiro", "", None]


def test_pct_half_up_is_exact(spark):
    df = spark.createDataFrame([(1, 80), (3, 20000), (0, 0), (1, 3), (2, 3)], "k long, n long")
    got = [r.p for r in df.select(X.pct_half_up("k", "n").alias("p")).collect()]
    assert got == [1.25, 0.02, None, 33.33, 66.67]


def test_surrogate_key_matches_md5_of_joined_text(spark):
    import hashlib
    df = spark.createDataFrame([(5, dt.datetime(2024, 1, 1))], "k long, t timestamp_ntz")
    got = df.select(X.surrogate_key_ts("k", "t").alias("h")).first().h
    assert got == hashlib.md5(b"5-2024-01-01 00:00:00.000").hexdigest()
    nul = spark.createDataFrame([(None,)], "k long").select(X.surrogate_key("k").alias("h")).first().h
    assert nul == hashlib.md5(X.SURROGATE_NULL.encode()).hexdigest()


def test_calendar_bounds(spark):
    spine = {r.d for r in date_spine(spark, "1992-01-01", "1998-12-31", "d").collect()}
    assert len(spine) == 2556
    assert dt.date(1992, 1, 1) in spine and dt.date(1998, 12, 30) in spine and dt.date(1998, 12, 31) not in spine
    cal = {r.d for r in calendar(spark, "2016-01-01", 1461, "d").collect()}
    assert dt.date(2016, 2, 29) in cal and dt.date(2019, 12, 31) in cal and dt.date(2020, 1, 1) not in cal


def test_dayofweek_sunday_zero_and_iso_week(spark):
    df = spark.createDataFrame([(dt.date(2016, 1, 3),)], "d date")
    r = df.select(X.dow_sunday0("d").alias("w"), F.weekofyear("d").alias("iso")).first()
    assert (r.w, r.iso) == (0, 53)


def test_literal_case_lookup_defaults(spark):
    df = spark.createDataFrame([("SP",), ("ZZ",), (None,)], "s string")
    got = [r.r for r in df.select(X.map_lookup("s", X.STATE_REGION, "Unknown").alias("r")).collect()]
    assert got == ["Southeast", "Unknown", "Unknown"]
    st = spark.createDataFrame([("O",), ("P",), ("X",)], "s string")
    got = [r.r for r in st.select(X.map_lookup("s", X.ORDER_STATUS_LABEL, "Unknown").alias("r")).collect()]
    assert got == ["Open", "Partially Filled", "Unknown"]
