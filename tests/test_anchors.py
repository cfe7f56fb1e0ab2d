"""Measured anchor values (first run over all fixture rows, sf0.001)."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tierforge.plans import tpch
from tierforge.sources import fixtures as fx


def test_tpch_first_run_anchors(spark):
    f = lambda n: fx.fixture(spark, SF_SMALL, n)
    sl = tpch.silver_lineitem(f("fx_lineitem"), None)
    r = sl.agg(F.count(F.lit(1)).alias("n"), F.sum("net_revenue").alias("net"), F.sum("gross_revenue").alias("gross"),
               F.sum("days_late").alias("late")).first()
    assert (r.n, str(r.net), str(r.gross), r.late) == (4272, "223334454.11", "232307603.22", 20375)

    so = tpch.silver_orders(f("fx_orders"), None, fx.DAY2_DATE)
    fl = tpch.fact_lineitem(sl, so, None)
    assert fl.filter(F.col("customer_key").isNull()).count() == 0
    fo = tpch.fact_orders(fl, None)
    r = fo.agg(F.count(F.lit(1)).alias("n"), F.sum("line_item_count").alias("li")).first()
    assert (r.n, r.li) == (1464, 4272)

    nr = tpch.silver_nation_region(f("fx_nation"), f("fx_region"), None)
    dc = tpch.dim_customer(tpch.snapshot_customer(None, tpch.silver_customer(f("fx_customer"), None), fx.DAY1_TS), nr)
    ds = tpch.dim_supplier(tpch.snapshot_supplier(None, tpch.silver_supplier(f("fx_supplier"), None), fx.DAY1_TS), nr)
    ms = tpch.mart_sales_summary(fl, dc, tpch.dim_date(spark))
    r = ms.agg(F.count(F.lit(1)).alias("g"), F.sum("order_count").alias("o"), F.sum("total_quantity").alias("q")).first()
    assert (r.g, r.o, str(r.q)) == (1041, 1464, "107392.00")
    mp = tpch.mart_supplier_performance(fl, ds)
    r = mp.agg(F.count(F.lit(1)).alias("s"), F.sum("lines_shipped").alias("l")).first()
    assert (r.s, r.l) == (9, 4272)


def test_fixture_anchors(spark):
    v1, v2 = fx.fixture(spark, SF_SMALL, "fx_customer"), fx.fixture(spark, SF_SMALL, "fx_customer_v2")
    deleted = v1.join(v2, "customer_key", "left_anti").count()
    j = v1.alias("a").join(v2.alias("b"), "customer_key")
    changed = j.filter(~F.col("a.customer_address").eqNullSafe(F.col("b.customer_address"))
                       | ~F.col("a.customer_phone").eqNullSafe(F.col("b.customer_phone"))).count()
    assert (deleted, changed, j.count() - changed) == (14, 29, 107)
    st = {r.status: r["count"] for r in fx.fixture(spark, SF_SMALL, "fx_run_results").groupBy("status").count().collect()}
    assert (st["error"], st["pass"], st["skipped"], st["success"]) == (201, 210, 199, 390)


def test_large_sums_keep_their_cents(spark):
    """Stored marts hold exact decimals, also above 2**53 cents."""
    import datetime as dt
    from decimal import Decimal

    from tierforge.plans import tpch

    big = Decimal("90071992547409.93")
    fact = spark.createDataFrame([(7, big, 1, i) for i in range(3)], "supplier_key long, net_revenue decimal(18,2), days_late int, k int").withColumn("d", tpch.F.lit(dt.date(2024, 1, 1)))
    sup = spark.createDataFrame([(7, "S", "N", "R", True)], "supplier_key long, supplier_name string, nation_name string, region_name string, is_current boolean")
    assert tpch.mart_supplier_performance(fact, sup).first()["net_revenue"] == 3 * big
