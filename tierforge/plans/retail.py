"""Online-retail orders model: typed and deduplicated silver tables from raw
text, SCD1 dimensions, a calendar, the order fact, its SCD2 snapshot and
the revenue KPI mart.

Silver rules: rows newer than the target's strict high-water mark, latest
row per raw key (dedup runs before the key check), parse text with
``try_*`` casts, merge on the parsed key with schema sync.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators.calendar import calendar
from ..operators.dedup import dedup_latest
from ..operators.distinct import sums_and_distincts
from ..operators.incremental import merge_upsert, newer_than
from ..operators.scd2 import scd2_apply

# --- fixed values ------------------------------------------------------------
META = ["_source_file", "_source_system", "_loaded_at", "_load_date", "_batch_id"]
CALENDAR_START, CALENDAR_DAYS = "2016-01-01", 1461
TIE_BREAK = {
    "customers": ["customer_zip_code_prefix", "customer_unique_id"],
    "order_items": ["price", "product_id", "seller_id"],
    "orders": ["order_status", "customer_id"],
    "payments": ["payment_value", "payment_type"],
    "products": ["product_weight_g", "product_category_name"],
}
ORDER_SNAPSHOT_CHECK = ["order_status", "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date"]
ORDER_SNAPSHOT_COLUMNS = [
    "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
    "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date",
    "actual_delivery_days", "is_late_delivery", "total_payment_value", "total_order_value", "order_date",
    "order_year", "order_month_num", "_loaded_at",
]


def _stage(raw: DataFrame, target: DataFrame | None, raw_keys: list[str], table: str) -> DataFrame:
    src = newer_than(raw, target, "_loaded_at")  # strict: empty target -> nothing
    return dedup_latest(src, raw_keys, tie_break=TIE_BREAK[table])


def stg_customers(raw: DataFrame, target: DataFrame | None) -> DataFrame:
    d = _stage(raw, target, ["customer_id"], "customers").filter(F.col("customer_id").isNotNull())
    state = F.upper(F.trim("customer_state"))
    out = d.select(
        "customer_id", "customer_unique_id", "customer_zip_code_prefix",
        X.initcap_words(F.trim("customer_city")).alias("customer_city"),
        state.alias("customer_state"),
        X.map_lookup(state, X.STATE_REGION, "Unknown").alias("customer_region"),
        *META,
    )
    return merge_upsert(target, out, ["customer_id"], sync_schema=True)


def stg_order_items(raw: DataFrame, target: DataFrame | None) -> DataFrame:
    d = _stage(raw, target, ["order_id", "order_item_id"], "order_items").filter(
        F.col("order_id").isNotNull() & F.col("order_item_id").isNotNull()
    )
    price, freight = X.try_number("price", 10, 2), X.try_number("freight_value", 10, 2)
    out = d.select(
        "order_id", X.try_number("order_item_id").alias("order_item_id"), "product_id", "seller_id",
        X.try_timestamp_ntz("shipping_limit_date").alias("shipping_limit_date"),
        price.alias("price"), freight.alias("freight_value"), (price + freight).alias("total_item_value"),
        *META,
    )
    return merge_upsert(target, out, ["order_id", "order_item_id"], sync_schema=True)


def stg_orders(raw: DataFrame, target: DataFrame | None) -> DataFrame:
    d = _stage(raw, target, ["order_id"], "orders").filter(F.col("order_id").isNotNull())
    ts = {c: X.try_timestamp_ntz(c) for c in (
        "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
        "order_delivered_customer_date", "order_estimated_delivery_date")}
    out = d.select(
        "order_id", "customer_id", F.upper(F.trim("order_status")).alias("order_status"),
        *[v.alias(k) for k, v in ts.items()],
        X.day_diff(ts["order_purchase_timestamp"], ts["order_delivered_customer_date"]).alias("actual_delivery_days"),
        X.day_diff(ts["order_purchase_timestamp"], ts["order_estimated_delivery_date"]).alias("estimated_delivery_days"),
        X.flag(ts["order_delivered_customer_date"] > ts["order_estimated_delivery_date"]).alias("is_late_delivery"),
        *META,
    )
    return merge_upsert(target, out, ["order_id"], sync_schema=True)


def stg_payments(raw: DataFrame, target: DataFrame | None) -> DataFrame:
    d = _stage(raw, target, ["order_id", "payment_sequential"], "payments").filter(F.col("order_id").isNotNull())
    ptype = F.upper(F.trim("payment_type"))
    inst = X.try_number("payment_installments")
    out = d.select(
        "order_id", X.try_number("payment_sequential").alias("payment_sequential"), ptype.alias("payment_type"),
        inst.alias("payment_installments"), X.try_number("payment_value", 10, 2).alias("payment_value"),
        X.flag(ptype == "CREDIT_CARD").alias("is_credit_card"), X.flag(inst > 1).alias("is_installment"),
        *META,
    )
    return merge_upsert(target, out, ["order_id", "payment_sequential"], sync_schema=True)


def stg_products(raw: DataFrame, target: DataFrame | None) -> DataFrame:
    d = _stage(raw, target, ["product_id"], "products").filter(F.col("product_id").isNotNull())
    w = X.try_number("product_weight_g")
    out = d.select(
        "product_id", F.lower(F.trim("product_category_name")).alias("product_category_name"),
        X.try_number("product_name_lenght").alias("product_name_length"),
        X.try_number("product_description_lenght").alias("product_description_length"),
        X.try_number("product_photos_qty").alias("product_photos_qty"),
        w.alias("product_weight_g"),
        X.try_number("product_length_cm").alias("product_length_cm"),
        X.try_number("product_height_cm").alias("product_height_cm"),
        X.try_number("product_width_cm").alias("product_width_cm"),
        F.when(w < 500, "Light").when(w < 2000, "Medium").when(w < 5000, "Heavy").otherwise("Very Heavy").alias("weight_class"),
        *META,
    )
    return merge_upsert(target, out, ["product_id"], sync_schema=True)


def dim_customer(stg: DataFrame) -> DataFrame:
    return stg.select("customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city",
                      "customer_state", "customer_region", "_loaded_at")


def dim_product(stg: DataFrame) -> DataFrame:
    return stg.select("product_id", "product_category_name", "product_photos_qty", "product_weight_g",
                      "product_length_cm", "product_height_cm", "product_width_cm", "weight_class", "_loaded_at")


def dim_date(spark) -> DataFrame:
    d = calendar(spark, CALENDAR_START, CALENDAR_DAYS, "date_id")
    dow = X.dow_sunday0("date_id")
    return d.select(
        "date_id",
        F.year("date_id").alias("year"),
        F.month("date_id").alias("month_num"),
        F.date_format("date_id", "MMM").alias("month_name"),
        F.quarter("date_id").alias("quarter"),
        F.weekofyear("date_id").alias("week_num"),
        dow.alias("day_of_week"),
        F.date_format("date_id", "EEE").alias("day_name"),
        dow.isin(0, 6).alias("is_weekend"),
        F.trunc("date_id", "month").alias("first_day_of_month"),
        F.trunc("date_id", "quarter").alias("first_day_of_quarter"),
    )


def fct_orders(orders: DataFrame, items: DataFrame, payments: DataFrame, target: DataFrame | None) -> DataFrame:
    """One row per order with item and payment rollups.

    Children are aggregated to order grain before the joins (no fan-out).
    On incremental runs they are first semi-joined to the new orders, so
    only the affected orders' children are aggregated.
    """
    o = newer_than(orders, target, "_loaded_at")
    if target is not None:
        ids = o.select("order_id")
        items = items.join(ids, "order_id", "left_semi")
        payments = payments.join(ids, "order_id", "left_semi")
    p = payments.groupBy("order_id").agg(
        F.sum("payment_value").alias("total_payment_value"),
        F.max("payment_installments").alias("max_installments"),
        F.countDistinct("payment_type").alias("payment_type_count"),
        F.max(F.when(F.col("is_credit_card"), 1).otherwise(0)).alias("has_credit_card"),
    )
    i = sums_and_distincts(
        items, "order_id",
        {"item_count": F.lit(1), "total_items_price": F.col("price"), "total_freight_value": F.col("freight_value"), "total_order_value": F.col("total_item_value")},
        {"distinct_products": "product_id", "distinct_sellers": "seller_id"},
    )
    z = F.lit(0)
    out = o.join(i, "order_id", "left").join(p, "order_id", "left").select(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
        "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date",
        "actual_delivery_days", "estimated_delivery_days", "is_late_delivery",
        F.coalesce("item_count", z).alias("item_count"),
        F.coalesce("total_items_price", z).cast("decimal(38,2)").alias("total_items_price"),
        F.coalesce("total_freight_value", z).cast("decimal(38,2)").alias("total_freight_value"),
        F.coalesce("total_order_value", z).cast("decimal(38,2)").alias("total_order_value"),
        F.coalesce("distinct_products", z).alias("distinct_products"),
        F.coalesce("distinct_sellers", z).alias("distinct_sellers"),
        F.coalesce("total_payment_value", z).cast("decimal(38,2)").alias("total_payment_value"),
        F.coalesce("max_installments", z).cast("decimal(38,0)").alias("max_installments"),
        F.coalesce("payment_type_count", z).alias("payment_type_count"),
        F.coalesce("has_credit_card", z).alias("has_credit_card"),
        F.to_date("order_purchase_timestamp").alias("order_date"),
        F.date_trunc("month", "order_purchase_timestamp").cast("timestamp_ntz").alias("order_month"),
        F.year("order_purchase_timestamp").alias("order_year"),
        F.month("order_purchase_timestamp").alias("order_month_num"),
        "_loaded_at",
    )
    return merge_upsert(target, out, ["order_id"], sync_schema=True)


def snapshot_orders(history: DataFrame | None, fct: DataFrame, run_ts: str) -> DataFrame:
    """SCD2 of the order fact; orders gone from the fact are closed."""
    return scd2_apply(history, fct.select(*ORDER_SNAPSHOT_COLUMNS), "order_id", ORDER_SNAPSHOT_CHECK, run_ts, hard_deletes=True)


def mart_revenue_kpis(fct: DataFrame, dim_cust: DataFrame, items: DataFrame, dim_prod: DataFrame, dim_dt: DataFrame) -> DataFrame:
    """Delivered-order KPIs by month, customer state/region and category.

    The source joins every item to its order, so sums, averages and counts
    are item-weighted. Here items are resolved to their category and
    counted per (order, category) first; the order side then joins that
    reduced set and each order row carries its item count ``w``: COUNT(*)
    becomes SUM(w), SUM(x) becomes SUM(x * w), AVG(x) becomes
    SUM(x * w) / SUM(w where x is not NULL). An order without items is one
    row of weight 1 with a NULL category, as in the left join. Items of other
    orders are left out before the product join, and as each (order, category)
    is one row, orders are counted without a distinct. Results are equal.
    """
    f = fct.filter(F.col("order_status") == "DELIVERED").select(
        "order_id", "customer_id", "order_date", "order_year", "order_month_num", "total_payment_value",
        "total_freight_value", "actual_delivery_days", "is_late_delivery")
    c = dim_cust.select("customer_id", "customer_state", "customer_region")
    p = dim_prod.select("product_id", "product_category_name")
    per_cat = (
        items.select("order_id", "product_id").join(f.select("order_id"), "order_id", "left_semi").join(p, "product_id", "left")
        .groupBy("order_id", "product_category_name").agg(F.count(F.lit(1)).alias("_w"))
    )
    d = dim_dt.select(F.col("date_id").alias("order_date"), "month_name")
    j = (f.join(c, "customer_id", "left").join(per_cat, "order_id", "left").join(d, "order_date", "left")
         .withColumn("_w", F.coalesce("_w", F.lit(1))))
    w = F.col("_w")

    def wsum(x: str):
        return F.sum(F.col(x) * w)

    def wavg(x: str):
        return wsum(x).cast("double") / F.nullif(F.sum(F.when(F.col(x).isNotNull(), w)), F.lit(0)).cast("double")

    late = F.when(F.col("is_late_delivery"), 1).otherwise(0)
    g = j.groupBy("order_year", "order_month_num", "month_name", "customer_state", "customer_region", "product_category_name").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.countDistinct("customer_id").alias("unique_customers"),
        wsum("total_payment_value").cast("decimal(38,2)").alias("total_revenue"),
        wavg("total_payment_value").alias("avg_order_value"),
        wsum("total_freight_value").cast("decimal(38,2)").alias("total_freight"),
        wavg("actual_delivery_days").alias("avg_delivery_days"),
        F.sum(late * w).cast("bigint").alias("late_deliveries"),
        F.sum(w).alias("_n"),
    )
    return g.select(
        "order_year", "order_month_num", "month_name", "customer_state", "customer_region", "product_category_name",
        "total_orders", "unique_customers", "total_revenue", "avg_order_value", "total_freight",
        X.pct_half_up("total_freight", "total_revenue", scale_to_int=100).alias("freight_pct_of_revenue"),
        "avg_delivery_days", "late_deliveries",
        X.pct_half_up("late_deliveries", "_n").alias("late_delivery_pct"),
    )
