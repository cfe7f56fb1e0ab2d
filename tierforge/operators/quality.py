"""Data-quality checks. Each check returns the violating rows (empty =
pass); ``run_suite`` runs many checks and returns one summary row each.

Counting failures never collects rows: every check is an aggregate that
Spark computes on the executors, and a suite is one union of them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique(df: DataFrame, col: str) -> DataFrame:
    """Values occurring more than once (NULLs ignored)."""
    return (
        df.filter(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def not_null(df: DataFrame, col: str) -> DataFrame:
    """Rows where ``col`` is NULL."""
    return df.filter(F.col(col).isNull())


def null_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """NULL count of many columns in one pass (one row, one column each)."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def accepted_values(df: DataFrame, col: str, values: list[str]) -> DataFrame:
    """Values outside ``values`` with their row counts (NULL is not a violation)."""
    return df.filter(~F.col(col).isin(*values)).groupBy(col).agg(F.count(F.lit(1)).alias("n_records"))


def relationships(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Non-NULL child keys with no parent row (anti join)."""
    p = parent.select(F.col(parent_col).alias(col))
    return child.filter(F.col(col).isNotNull()).join(p, col, "left_anti")


def unique_combination(df: DataFrame, cols: list[str]) -> DataFrame:
    """Key combinations occurring more than once."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1)


@dataclass(frozen=True)
class Check:
    model: str
    kind: str  # unique | not_null | accepted_values | relationships | unique_combination
    column: str  # column, or comma-joined columns for unique_combination
    arg: tuple = ()  # accepted values, or (parent_model, parent_column)

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.model}_{self.column.replace(',', '__')}"


def violations(check: Check, tables: dict[str, DataFrame]) -> DataFrame:
    df = tables[check.model]
    if check.kind == "unique":
        return unique(df, check.column)
    if check.kind == "not_null":
        return not_null(df, check.column)
    if check.kind == "accepted_values":
        return accepted_values(df, check.column, list(check.arg))
    if check.kind == "relationships":
        return relationships(df, check.column, tables[check.arg[0]], check.arg[1])
    if check.kind == "unique_combination":
        return unique_combination(df, check.column.split(","))
    raise ValueError(check.kind)


def run_suite(checks: list[Check], tables: dict[str, DataFrame]) -> DataFrame:
    """One row per check: name, model, kind, column, failures, status.

    All not_null checks of one model share a single scan (one aggregate with
    a NULL count per column); the other checks are one aggregate each.
    """

    def summary(c: Check, failures) -> list:
        return [F.lit(c.name).alias("test_name"), F.lit(c.model).alias("model"), F.lit(c.kind).alias("kind"),
                F.lit(c.column).alias("column_name"), failures.cast("bigint").alias("failures")]

    parts = []
    by_model: dict[str, list[Check]] = {}
    for c in checks:
        if c.kind == "not_null":
            by_model.setdefault(c.model, []).append(c)
        else:
            parts.append(violations(c, tables).agg(F.count(F.lit(1)).alias("_n")).select(*summary(c, F.col("_n"))))
    for m, cs in by_model.items():
        counts = null_counts(tables[m], [c.column for c in cs])
        parts.append(counts.select(F.explode(F.array(*[F.struct(*summary(c, F.col(c.column))) for c in cs])).alias("_s")).select("_s.*"))
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


# --- fixed values: the declared tests of the two model families ------------
ORDER_STATUSES = ("DELIVERED", "SHIPPED", "CANCELED", "UNAVAILABLE", "INVOICED", "PROCESSING", "CREATED", "APPROVED")
DECLARED_TESTS = [
    Check("stg_orders", "unique", "order_id"),
    Check("stg_orders", "not_null", "order_id"),
    Check("stg_orders", "not_null", "customer_id"),
    Check("stg_orders", "not_null", "order_status"),
    Check("stg_orders", "accepted_values", "order_status", ORDER_STATUSES),
    Check("stg_orders", "not_null", "order_purchase_timestamp"),
    Check("stg_orders", "not_null", "is_late_delivery"),
    Check("fct_orders", "unique", "order_id"),
    Check("fct_orders", "not_null", "order_id"),
    Check("fct_orders", "not_null", "customer_id"),
    Check("fct_orders", "not_null", "order_status"),
    Check("fct_orders", "not_null", "total_payment_value"),
    Check("dim_customer_retail", "unique", "customer_id"),
    Check("dim_customer_retail", "not_null", "customer_id"),
    Check("dim_product", "unique", "product_id"),
    Check("dim_product", "not_null", "product_id"),
    Check("dim_date_retail", "unique", "date_id"),
    Check("dim_date_retail", "not_null", "date_id"),
    Check("dim_customer", "unique", "customer_sk"),
    Check("dim_customer", "not_null", "customer_sk"),
    Check("dim_customer", "not_null", "customer_key"),
    Check("dim_supplier", "unique", "supplier_sk"),
    Check("dim_supplier", "not_null", "supplier_sk"),
    Check("dim_supplier", "not_null", "supplier_key"),
    Check("dim_part", "unique", "part_key"),
    Check("dim_part", "not_null", "part_key"),
    Check("fact_lineitem", "unique_combination", "order_key,line_number"),
    Check("fact_lineitem", "relationships", "part_key", ("dim_part", "part_key")),
    Check("fact_orders", "unique", "order_key"),
    Check("fact_orders", "not_null", "order_key"),
]
