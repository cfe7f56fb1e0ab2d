"""Physical-plan properties the design relies on."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tierforge.operators.dedup import dedup_latest
from tierforge.operators.incremental import merge_upsert
from tierforge.plans import tpch
from tierforge.sources import fixtures as fx


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_limits_before_the_shuffle(spark):
    df = dedup_latest(fx.fixture(spark, SF_SMALL, "fx_lineitem"), ["order_key", "line_number"], tie_break=["part_key"])
    p = plan(df)
    assert "WindowGroupLimit" in p and "Partial" in p and "Final" in p
    # the partial limit sits below the exchange
    assert p.index("Final") < p.index("Exchange") < p.index("Partial")


def test_small_merge_batch_streams_the_target(spark, tmp_path):
    spark.range(100_000).selectExpr("id as k", "id * 2 as v").write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    upd = spark.range(10).selectExpr("id * 7 as k", "-1L as v")
    out = merge_upsert(target, upd, ["k"])
    p = plan(out)
    assert "BroadcastHashJoin" in p and "LeftAnti" in p
    assert out.count() == 100_000 and out.filter("v = -1").count() == 10


def test_high_water_filter_reaches_the_scan(spark, tmp_path):
    li = fx.fixture(spark, SF_SMALL, "fx_lineitem")
    li.write.parquet(str(tmp_path / "bronze"))
    bronze = spark.read.parquet(str(tmp_path / "bronze"))
    s1 = tpch.silver_lineitem(fx.day_slice(bronze, 1), None)
    s1.write.parquet(str(tmp_path / "silver"))
    silver = spark.read.parquet(str(tmp_path / "silver"))
    src = tpch.newer_than(bronze, silver, "_loaded_at", floor=tpch.FLOOR_TS)
    assert "GreaterThan(_loaded_at,2024-01-01T00:00)" in plan(src)


def test_mart_broadcasts_the_calendar_and_aggregates_before_joining(spark):
    d = tpch.dim_date(spark)
    fact = spark.createDataFrame([(1, 1, dt.date(1995, 1, 2), 1.0, 1.0, 1.0)],
                                 "order_key long, customer_key long, order_date date, quantity double, net_revenue double, gross_revenue double")
    cust = spark.createDataFrame([(1, "R", "N", "S", True)], "customer_key long, region_name string, nation_name string, market_segment string, is_current boolean")
    p = plan(tpch.mart_sales_summary(fact, cust, d))
    assert "BroadcastHashJoin" in p
    assert p.count("HashAggregate") >= 4  # per-order partial/final + mart partial/final


def test_daily_run_reads_only_what_is_newer(spark, tmp_path):
    """The filter on the target's mark reaches the scan of the stored table that a model reads."""
    from tierforge.sources.tables import TableStore
    store = TableStore(spark, str(tmp_path / "store"))
    li = fx.fixture(spark, SF_SMALL, "fx_lineitem")
    store.write("bronze", li, keys=["order_key", "line_number"])
    store.write("silver", tpch.silver_lineitem(fx.day_slice(store.read("bronze"), 1), None), month_of="ship_date")
    src = tpch.newer_than(store.read("bronze"), store.read("silver"), "_loaded_at", floor=tpch.FLOOR_TS)
    assert "GreaterThan(_loaded_at,2024-01-01T00:00)" in plan(src)


def test_kpi_mart_counts_orders_without_a_distinct(spark):
    from tierforge.plans import retail
    from tierforge.plans.runner import built
    get = built(spark, SF_SMALL, "retail").get
    df = retail.mart_revenue_kpis(get("fct_orders"), get("dim_customer_retail"), get("stg_order_items"), get("dim_product"), get("dim_date_retail"))
    p = plan(df)
    assert "Expand" not in p and "LeftSemi" in p


def test_source_filter_reaches_the_source_scan(spark):
    """Sources are views over the given files: no staged copy stands between."""
    src = fx.fixture(spark, SF_SMALL, "src_customer").filter("c_nationkey = 3").select("c_custkey")
    p = plan(src)
    assert "EqualTo(c_nationkey,3)" in p and "ReadSchema: struct<c_custkey:bigint,c_nationkey" in p


def test_second_day_filters_by_mark_in_the_scan(spark, tmp_path):
    """A model that reads a stored table by mark has the mark in the scan, after one run or several."""
    from tierforge.operators.incremental import lookback, newer_than
    from tierforge.sources.tables import TableStore
    store = TableStore(spark, str(tmp_path / "store"), buckets=16)
    src = spark.range(1000).selectExpr("id as k", "cast('2024-01-01' as timestamp_ntz) as _loaded_at", "date_add(date'2024-01-01', cast(id % 300 as int)) as order_date")
    store.write("silver", src, keys=["k"])
    store.write("fact", store.read("silver"), month_of="order_date", keys=["k"])
    for day in (2, 3):
        upd = src.filter(f"k = {day}").withColumn("_loaded_at", F.expr(f"cast('2024-01-0{day}' as timestamp_ntz)"))
        store.write("silver", merge_upsert(store.read("silver"), upd, ["k"]))
    new = newer_than(store.read("silver"), store.read("fact"), "_loaded_at")
    assert sorted(r.k for r in new.collect()) == [2, 3] and "GreaterThan(_loaded_at,2024-01-01T00:00)" in plan(new)
    late = lookback(store.read("fact"), store.read("fact"), "order_date", 3)
    assert late.count() == 12 and "GreaterThanOrEqual(order_date,2024-10-23)" in plan(late)


def test_distinct_counts_do_not_expand(spark):
    from tierforge.plans import ops
    p = plan(ops.a5_multi_count_distinct(spark, SF_SMALL))
    assert "Expand" not in p


def test_history_joins_open_partitions_only(spark, tmp_path):
    from tierforge.operators.scd2 import scd2_apply
    from tierforge.sources.tables import TableStore
    store = TableStore(spark, str(tmp_path / "store"), buckets=4)
    for day, v in ((1, "x"), (2, "y"), (3, "z")):
        src = spark.range(50).selectExpr("id as k", f"if(id % 5 = 0, '{v}', 'x') as a")
        store.write("h", scd2_apply(store.read("h"), src, "k", ["a"], f"2024-01-0{day} 00:00:00"), keys=["k"], open_until="valid_to")
    current = store.read("h", still_open=True)
    assert current.count() == 50 and "StartsWith(_p" in plan(current) and "PartitionFilters: [isnotnull(_p" in plan(current)
    assert store.read("h").count() == 70


def test_only_needed_models_run(spark):
    """A query of one table runs what the table is made from, and no other model."""
    from tierforge.plans.runner import Run, needed

    run = Run(spark, SF_SMALL).run(domains=("retail",), only=needed(["dim_product"]))
    assert [(day, name) for day, _, name, *_ in run.log] == [(d, n) for d in (1, 2) for n in ("stg_products", "dim_product")]
    assert needed(["mart_customer_segment"]) == {
        "mart_customer_segment", "fact_orders", "fact_lineitem", "silver_lineitem", "silver_orders", "bronze_lineitem", "bronze_orders",
        "dim_customer", "snap_customer", "silver_customer", "bronze_customer", "silver_nation_region", "bronze_nation", "bronze_region"}


def test_declared_reads_are_those_of_the_models(spark):
    """``READS`` names each stored table that a model reads, and no other."""
    from pyspark.sql import functions as F

    from tierforge.plans import runner

    empty = spark.range(0).withColumn("in_day1", F.lit(True)).withColumn("_loaded_at", F.lit(None).cast("timestamp_ntz"))
    for family in runner.FAMILIES.values():
        seen: list[str] = []

        def stored(name):
            seen.append(name)
            return empty

        for models in family(1, lambda n: empty, stored).values():
            for name, build in models:
                seen.clear()
                try:
                    build()
                except Exception:  # the tables lack columns; all are read before the first is used
                    pass
                assert set(seen) - {name} == set(runner.READS.get(name, ())), name


def test_domains_of_quality_queries_run_together(spark, tmp_path, monkeypatch):
    """The tested tables come from both domains, whose runs don't wait for each other."""
    import threading

    from tierforge.plans import ops, runner

    both = threading.Barrier(2, timeout=30)

    class FakeRun:
        def __init__(self, spark, sf_dir):
            pass

        def run(self, domains, only):
            both.wait()  # broken if the other domain only starts after this one
            self.domain = domains[0]
            return self

        def get(self, name):
            return self.domain, name

    monkeypatch.setattr(runner, "Run", FakeRun)
    got = ops.clean_tables(spark, str(tmp_path), "dim_part", "dim_product")
    assert got == {"dim_part": ("tpch", "dim_part"), "dim_product": ("retail", "dim_product")}
