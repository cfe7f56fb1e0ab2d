"""TPC-H sales model: bronze (append of unseen keys), silver (validated,
deduplicated, merged), SCD2 snapshots, gold star schema and marts.

Every model is a pure function of DataFrames plus the run's timestamp /
date and the previous version of its own table (``target``, ``None`` on
the first run). Writing is the caller's job (see ``plans.runner``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators.calendar import date_spine
from ..operators.dedup import dedup_latest
from ..operators.incremental import append_new, lookback, merge_upsert, newer_than
from ..operators.scd2 import scd2_apply

# --- fixed values ------------------------------------------------------------
FLOOR_TS = "1900-01-01 00:00:00"  # high-water floor of the silver / fact models
SPINE_START, SPINE_END = "1992-01-01", "1998-12-31"  # calendar, end exclusive

# source column -> bronze column, per TPC-H table
BRONZE_COLUMNS = {
    "customer": [("c_custkey", "customer_key"), ("c_name", "customer_name"), ("c_address", "customer_address"),
                 ("c_nationkey", "nation_key"), ("c_phone", "customer_phone"), ("c_acctbal", "account_balance"),
                 ("c_mktsegment", "market_segment"), ("c_comment", "customer_comment")],
    "lineitem": [("l_orderkey", "order_key"), ("l_partkey", "part_key"), ("l_suppkey", "supplier_key"),
                 ("l_linenumber", "line_number"), ("l_quantity", "quantity"), ("l_extendedprice", "extended_price"),
                 ("l_discount", "discount"), ("l_tax", "tax"), ("l_returnflag", "return_flag"),
                 ("l_linestatus", "line_status"), ("l_shipdate", "ship_date"), ("l_commitdate", "commit_date"),
                 ("l_receiptdate", "receipt_date"), ("l_shipinstruct", "ship_instructions"), ("l_shipmode", "ship_mode")],
    "nation": [("n_nationkey", "nation_key"), ("n_name", "nation_name"), ("n_regionkey", "region_key")],
    "orders": [("o_orderkey", "order_key"), ("o_custkey", "customer_key"), ("o_orderstatus", "order_status"),
               ("o_totalprice", "total_price"), ("o_orderdate", "order_date"), ("o_orderpriority", "order_priority"),
               ("o_clerk", "clerk"), ("o_shippriority", "ship_priority")],
    "part": [("p_partkey", "part_key"), ("p_name", "part_name"), ("p_mfgr", "manufacturer"), ("p_brand", "brand"),
             ("p_type", "part_type"), ("p_size", "part_size"), ("p_container", "container"),
             ("p_retailprice", "retail_price")],
    "partsupp": [("ps_partkey", "part_key"), ("ps_suppkey", "supplier_key"), ("ps_availqty", "available_qty"),
                 ("ps_supplycost", "supply_cost")],
    "region": [("r_regionkey", "region_key"), ("r_name", "region_name")],
    "supplier": [("s_suppkey", "supplier_key"), ("s_name", "supplier_name"), ("s_address", "supplier_address"),
                 ("s_nationkey", "nation_key"), ("s_phone", "supplier_phone"), ("s_acctbal", "account_balance")],
}
BRONZE_KEYS = {
    "customer": ["customer_key"], "lineitem": ["order_key", "line_number"], "nation": ["nation_key"],
    "orders": ["order_key"], "part": ["part_key"], "partsupp": ["part_key", "supplier_key"],
    "region": ["region_key"], "supplier": ["supplier_key"],
}
CUSTOMER_CHECK = ["customer_name", "customer_address", "nation_key", "customer_phone", "account_balance", "market_segment"]
SUPPLIER_CHECK = ["supplier_name", "supplier_address", "nation_key", "supplier_phone", "account_balance"]
# Deterministic tie-breaks after _loaded_at DESC (the source order is not total).
TIE_BREAK = {
    "lineitem": ["extended_price", "part_key", "supplier_key"],
    "orders": ["total_price", "customer_key"],
    "customer": ["account_balance", "customer_name"],
    "part": ["retail_price", "part_name"],
    "partsupp": ["supply_cost", "available_qty"],
    "supplier": ["account_balance", "supplier_name"],
    "nation_region": ["region_key"],
}


def ts_lit(ts: str):
    return F.lit(ts).cast("timestamp_ntz")


# ---------------------------------------------------------------- bronze ----

def bronze(table: str, src: DataFrame, target: DataFrame | None, run_ts: str) -> DataFrame:
    """Rename to readable names, stamp the load, keep only unseen keys."""
    out = src.select(
        *[F.col(a).alias(b) for a, b in BRONZE_COLUMNS[table] if a in src.columns],
        ts_lit(run_ts).alias("_loaded_at"),
    )
    return append_new(out, target, BRONZE_KEYS[table])


# ---------------------------------------------------------------- silver ----

def _silver(bronze_df, target, keys, valid, project, table):
    src = newer_than(bronze_df, target, "_loaded_at", floor=FLOOR_TS)
    rows = src.filter(valid).select(*project)
    return merge_upsert(target, dedup_latest(rows, keys, tie_break=TIE_BREAK[table]), keys)


def silver_customer(bronze_df: DataFrame, target: DataFrame | None) -> DataFrame:
    valid = (
        F.col("customer_key").isNotNull()
        & (F.trim("customer_name") != "")
        & F.col("account_balance").isNotNull()
    )
    project = [
        "customer_key", F.trim("customer_name").alias("customer_name"),
        F.trim("customer_address").alias("customer_address"), "nation_key", "customer_phone", "account_balance",
        F.upper(F.trim("market_segment")).alias("market_segment"), "_loaded_at",
    ]
    return _silver(bronze_df, target, ["customer_key"], valid, project, "customer")


def silver_lineitem(bronze_df: DataFrame, target: DataFrame | None) -> DataFrame:
    valid = X.all_of([
        F.col("order_key").isNotNull(),
        F.col("line_number").isNotNull(),
        F.col("quantity") > 0,
        F.col("extended_price") >= 0,
        F.col("discount").between(0, 1),
        F.col("tax").between(0, 1),
        F.col("return_flag").isin("A", "N", "R"),
        F.col("line_status").isin("O", "F"),
        F.col("ship_date").isNotNull(),
        F.col("receipt_date") >= F.col("ship_date"),
    ])
    net = F.col("extended_price") * (1 - F.col("discount"))
    project = [
        "order_key", "part_key", "supplier_key", "line_number", "quantity", "extended_price", "discount", "tax",
        "return_flag", "line_status", "ship_date", "commit_date", "receipt_date", "ship_instructions", "ship_mode",
        F.round(net, 2).cast("decimal(18,2)").alias("net_revenue"),
        F.round(net * (1 + F.col("tax")), 2).cast("decimal(18,2)").alias("gross_revenue"),
        X.day_diff("commit_date", "receipt_date").cast("int").alias("days_late"),
        "_loaded_at",
    ]
    return _silver(bronze_df, target, ["order_key", "line_number"], valid, project, "lineitem")


def silver_orders(bronze_df: DataFrame, target: DataFrame | None, run_date: str) -> DataFrame:
    valid = X.all_of([
        F.col("order_key").isNotNull(),
        F.col("customer_key").isNotNull(),
        F.col("total_price") >= 0,
        F.col("order_date").isNotNull(),
        F.col("order_date") <= F.lit(run_date).cast("date"),
    ])
    project = [
        "order_key", "customer_key", X.map_lookup("order_status", X.ORDER_STATUS_LABEL, "Unknown").alias("order_status"),
        "total_price", "order_date", "order_priority", "clerk", "ship_priority",
        F.year("order_date").alias("order_year"), F.month("order_date").alias("order_month"), "_loaded_at",
    ]
    return _silver(bronze_df, target, ["order_key"], valid, project, "orders")


def silver_part(bronze_df: DataFrame, target: DataFrame | None) -> DataFrame:
    valid = F.col("part_key").isNotNull() & (F.col("retail_price") >= 0)
    project = ["part_key", "part_name", "manufacturer", "brand", "part_type", "part_size", "container", "retail_price", "_loaded_at"]
    return _silver(bronze_df, target, ["part_key"], valid, project, "part")


def silver_partsupp(bronze_df: DataFrame, target: DataFrame | None) -> DataFrame:
    valid = (F.col("available_qty") >= 0) & (F.col("supply_cost") >= 0)
    project = ["part_key", "supplier_key", "available_qty", "supply_cost", "_loaded_at"]
    return _silver(bronze_df, target, ["part_key", "supplier_key"], valid, project, "partsupp")


def silver_supplier(bronze_df: DataFrame, target: DataFrame | None) -> DataFrame:
    valid = F.col("supplier_key").isNotNull() & (F.trim("supplier_name") != "")
    project = [
        "supplier_key", F.trim("supplier_name").alias("supplier_name"),
        F.trim("supplier_address").alias("supplier_address"), "nation_key", "supplier_phone", "account_balance", "_loaded_at",
    ]
    return _silver(bronze_df, target, ["supplier_key"], valid, project, "supplier")


def silver_nation_region(nation: DataFrame, region: DataFrame, target: DataFrame | None) -> DataFrame:
    """Full recompute each run (no high-water filter), merged on nation_key.
    Nation and region are fixed-size TPC-H tables (25 and 5 rows)."""
    n = nation.select("nation_key", "nation_name", "region_key", "_loaded_at")
    r = region.select("region_key", "region_name")
    joined = n.join(r, "region_key").select("nation_key", "nation_name", "region_key", "region_name", "_loaded_at")
    return merge_upsert(target, dedup_latest(joined, ["nation_key"], tie_break=TIE_BREAK["nation_region"]), ["nation_key"])


# ------------------------------------------------------------- snapshots ----

def snapshot_customer(history: DataFrame | None, silver: DataFrame, run_ts: str) -> DataFrame:
    return scd2_apply(history, silver, "customer_key", CUSTOMER_CHECK, run_ts)


def snapshot_supplier(history: DataFrame | None, silver: DataFrame, run_ts: str) -> DataFrame:
    return scd2_apply(history, silver, "supplier_key", SUPPLIER_CHECK, run_ts)


# ------------------------------------------------------------------ gold ----

def _scd2_dim(snap: DataFrame, nation_region: DataFrame, key: str, cols: list[str], sk: str) -> DataFrame:
    nr = nation_region.select("nation_key", "nation_name", "region_name")
    return snap.join(nr, "nation_key", "left").select(
        X.surrogate_key_ts(key, "valid_from").alias(sk),
        key, *cols, "nation_name", "region_name",
        F.col("valid_from").alias("effective_from"),
        F.col("valid_to").alias("effective_to"),
        F.col("valid_to").isNull().alias("is_current"),
    )


def dim_customer(snap: DataFrame, nation_region: DataFrame) -> DataFrame:
    return _scd2_dim(snap, nation_region, "customer_key",
                     ["customer_name", "customer_address", "customer_phone", "account_balance", "market_segment"],
                     "customer_sk")


def dim_supplier(snap: DataFrame, nation_region: DataFrame) -> DataFrame:
    return _scd2_dim(snap, nation_region, "supplier_key",
                     ["supplier_name", "supplier_address", "supplier_phone", "account_balance"], "supplier_sk")


def dim_part(part: DataFrame, partsupp: DataFrame, target: DataFrame | None) -> DataFrame:
    """Part attributes with supply cost average and total availability.

    partsupp is aggregated to one row per part before the join (equal to
    join-then-group since the part columns are functionally dependent on
    part_key, and it shuffles partial aggregates instead of every row).
    """
    ps = partsupp.groupBy("part_key").agg(
        F.sum("supply_cost").alias("_cost_sum"),
        F.count("supply_cost").alias("_cost_n"),
        F.sum("available_qty").cast("bigint").alias("total_available_qty"),
    )
    out = part.join(ps, "part_key", "left").select(
        "part_key", "part_name", "manufacturer", "brand", "part_type", "part_size", "container", "retail_price",
        (F.col("_cost_sum").cast("double") / F.nullif(F.col("_cost_n"), F.lit(0)).cast("double")).alias("avg_supply_cost"),
        "total_available_qty",
    )
    return merge_upsert(target, out, ["part_key"])


def dim_date(spark) -> DataFrame:
    d = date_spine(spark, SPINE_START, SPINE_END, "date_key")
    return d.select(
        "date_key",
        F.year("date_key").alias("year"),
        F.quarter("date_key").alias("quarter"),
        F.month("date_key").alias("month"),
        F.date_format("date_key", "MMM").alias("month_name"),
        F.dayofmonth("date_key").alias("day"),
        F.date_format("date_key", "EEE").alias("day_name"),
        F.weekofyear("date_key").alias("week_of_year"),
    )


FACT_LINEITEM_COLUMNS = [
    "order_key", "line_number", "part_key", "supplier_key", "customer_key", "ship_date", "commit_date",
    "receipt_date", "order_date", "quantity", "extended_price", "discount", "tax", "net_revenue", "gross_revenue",
    "return_flag", "line_status", "ship_mode", "days_late", "order_status", "order_priority", "_loaded_at",
]


def fact_lineitem(silver_lineitem_df: DataFrame, silver_orders_df: DataFrame, target: DataFrame | None) -> DataFrame:
    """New silver lines enriched with their order, deduplicated, merged.

    The latest line per (order_key, line_number) is picked before the join
    and the order side is made unique per order_key, so the left join is
    1:1 and equals joining first and deduplicating after. Picking first
    keeps the top-1 partial before its shuffle and leaves nothing above the
    join that needs its partitioning, so AQE can split a hot order_key; the
    order-side dedup reuses the join's exchange on order_key.
    """
    li = newer_than(silver_lineitem_df, target, "_loaded_at", floor=FLOOR_TS)
    li = dedup_latest(li, ["order_key", "line_number"], tie_break=TIE_BREAK["lineitem"])
    o = dedup_latest(
        silver_orders_df.select("order_key", "customer_key", "order_date", "order_status", "order_priority", "_loaded_at"),
        ["order_key"], tie_break=["customer_key", "order_date"],
    ).drop("_loaded_at")
    out = li.join(o, "order_key", "left").select(*FACT_LINEITEM_COLUMNS)
    return merge_upsert(target, out, ["order_key", "line_number"])


def fact_orders(fact_lineitem_df: DataFrame, target: DataFrame | None) -> DataFrame:
    """Order grain from the line fact; incremental runs recompute orders
    dated within 3 days of the latest one already in the table."""
    src = lookback(fact_lineitem_df, target, "order_date", days=3)
    out = src.groupBy("order_key", "customer_key", "order_date", "order_status", "order_priority").agg(
        F.countDistinct("line_number").alias("line_item_count"),
        F.sum("quantity").cast("decimal(38,2)").alias("total_quantity"),
        F.sum("net_revenue").cast("decimal(38,2)").alias("total_net_revenue"),
        F.sum("gross_revenue").cast("decimal(38,2)").alias("total_gross_revenue"),
        X.avg_exact("discount").alias("avg_discount"),
        F.max("receipt_date").alias("last_receipt_date"),
    )
    return merge_upsert(target, out, ["order_key"])


def mart_sales_summary(fact: DataFrame, dim_cust: DataFrame, dim_dt: DataFrame) -> DataFrame:
    """Sales by year, quarter and customer geography / segment.

    Lines are first summed per (customer, date, order): the join to the
    customer dimension then moves one row per order, not per line.
    """
    per_order = fact.groupBy("customer_key", "order_date", "order_key").agg(
        F.sum("quantity").alias("q"), F.sum("net_revenue").alias("n"), F.sum("gross_revenue").alias("g"),
    )
    cust = current_versions_dim(dim_cust).select("customer_key", "region_name", "nation_name", "market_segment")
    d = dim_dt.select("date_key", "year", "quarter")
    j = per_order.join(cust, "customer_key").join(d, per_order["order_date"] == d["date_key"])
    return j.groupBy("year", "quarter", "region_name", "nation_name", "market_segment").agg(
        F.countDistinct("order_key").alias("order_count"),
        F.sum("q").cast("decimal(38,2)").alias("total_quantity"),
        F.sum("n").cast("decimal(38,2)").alias("net_revenue"),
        F.sum("g").cast("decimal(38,2)").alias("gross_revenue"),
        (F.sum("g") - F.sum("n")).cast("decimal(38,2)").alias("tax_collected"),
    )


def current_versions_dim(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("is_current"))


def mart_supplier_performance(fact: DataFrame, dim_sup: DataFrame) -> DataFrame:
    """Per current supplier: lines, revenue, lateness.

    The fact is reduced to one partial row per supplier before the join;
    the dimension has one current row per supplier, so the join output is
    already at the final grain.
    """
    per_sup = fact.groupBy("supplier_key").agg(
        F.count(F.lit(1)).alias("lines_shipped"),
        F.sum("net_revenue").cast("decimal(38,2)").alias("net_revenue"),
        F.sum("days_late").alias("_days_sum"),
        F.count("days_late").alias("_days_n"),
        F.sum(F.when(F.col("days_late") > 0, 1).otherwise(0)).cast("bigint").alias("late_shipment_count"),
    )
    sup = current_versions_dim(dim_sup).select("supplier_key", "supplier_name", "nation_name", "region_name")
    return per_sup.join(sup, "supplier_key").select(
        "supplier_key", "supplier_name", "nation_name", "region_name", "lines_shipped", "net_revenue",
        (F.col("_days_sum").cast("double") / F.nullif(F.col("_days_n"), F.lit(0)).cast("double")).alias("avg_days_late"),
        "late_shipment_count",
        X.pct_half_up("late_shipment_count", "lines_shipped").alias("late_shipment_pct"),
    )


def mart_customer_segment(fact_ord: DataFrame, dim_cust: DataFrame) -> DataFrame:
    cust = current_versions_dim(dim_cust).select("customer_key", "market_segment", "region_name", "nation_name")
    j = fact_ord.join(cust, "customer_key")
    return j.groupBy("market_segment", "region_name", "nation_name").agg(
        F.countDistinct("order_key").alias("order_count"),
        F.sum("total_net_revenue").cast("decimal(38,2)").alias("net_revenue"),
        X.avg_exact("total_net_revenue").alias("avg_order_value"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )
