"""Query catalogue: one entry per model (M-rows of the survey) and per
operator, each a Spark callable ``(spark, sf_dir) -> DataFrame`` plus the
SQL that computes the same table in DuckDB.

Outputs are normalised the same way on both sides (``finalize`` /
``oracle_wrap``): decimals become doubles (exact sums cast once), zone-less
timestamps stay timestamps, so both engines return one schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import prepare
from . import oracle, ops
from .runner import built
from .specs import SPECS

# query name -> (domain, stored table, oracle block)
MODELS = {
    "m01_stg_customers": ("retail", "stg_customers", "rcu_2"),
    "m02_stg_order_items": ("retail", "stg_order_items", "roi_2"),
    "m03_stg_orders": ("retail", "stg_orders", "rod_2"),
    "m04_stg_payments": ("retail", "stg_payments", "rpy_2"),
    "m05_stg_products": ("retail", "stg_products", "rpr_2"),
    "m06_dim_customer": ("retail", "dim_customer_retail", "rdimc"),
    "m07_dim_product": ("retail", "dim_product", "rdimp"),
    "m08_dim_date": ("retail", "dim_date_retail", "rdimd"),
    "m09_fct_orders": ("retail", "fct_orders", "rfo_2"),
    "m10_mart_revenue_kpis": ("retail", "mart_revenue_kpis", "rkpi"),
    "m11_bronze_customer": ("tpch", "bronze_customer", "brz_customer_2"),
    "m12_bronze_lineitem": ("tpch", "bronze_lineitem", "brz_lineitem_2"),
    "m13_bronze_nation": ("tpch", "bronze_nation", "brz_nation_2"),
    "m14_bronze_orders": ("tpch", "bronze_orders", "brz_orders_2"),
    "m15_bronze_part": ("tpch", "bronze_part", "brz_part_2"),
    "m16_bronze_partsupp": ("tpch", "bronze_partsupp", "brz_partsupp_2"),
    "m17_bronze_region": ("tpch", "bronze_region", "brz_region_2"),
    "m18_bronze_supplier": ("tpch", "bronze_supplier", "brz_supplier_2"),
    "m19_silver_customer": ("tpch", "silver_customer", "scu_2"),
    "m20_silver_lineitem": ("tpch", "silver_lineitem", "sli_2"),
    "m21_silver_nation_region": ("tpch", "silver_nation_region", "snr_2"),
    "m22_silver_orders": ("tpch", "silver_orders", "sor_2"),
    "m23_silver_part": ("tpch", "silver_part", "spa_2"),
    "m24_silver_partsupp": ("tpch", "silver_partsupp", "sps_2"),
    "m25_silver_supplier": ("tpch", "silver_supplier", "ssu_2"),
    "m26_snapshot_customer": ("tpch", "snap_customer", "snc_2"),
    "m27_snapshot_supplier": ("tpch", "snap_supplier", "sns_2"),
    "m28_snapshot_orders": ("retail", "scd_fct_orders", "rscd_2"),
    "m29_dim_customer": ("tpch", "dim_customer", "dimc_2"),
    "m30_dim_supplier": ("tpch", "dim_supplier", "dims_2"),
    "m31_dim_part": ("tpch", "dim_part", "dimp_2"),
    "m32_dim_date": ("tpch", "dim_date", "dimd"),
    "m33_fact_lineitem": ("tpch", "fact_lineitem", "fli_2"),
    "m34_fact_orders": ("tpch", "fact_orders", "fo_2"),
    "m35_mart_sales_summary": ("tpch", "mart_sales_summary", "mart_sales"),
    "m36_mart_supplier_performance": ("tpch", "mart_supplier_performance", "mart_supplier"),
    "m37_mart_customer_segment": ("tpch", "mart_customer_segment", "mart_segment"),
}

_SPARK_TYPE = {"ts": "timestamp_ntz"}
_DUCK_TYPE = {"ts": "timestamp", "string": "varchar", "int": "integer"}


def spec_of(df: DataFrame) -> list[tuple[str, str]]:
    """Normalised output schema: decimal -> double, timestamp_ntz -> ts."""
    out = []
    for f in df.schema.fields:
        t = f.dataType
        if isinstance(t, T.DecimalType):
            s = "double"
        elif isinstance(t, (T.TimestampNTZType, T.TimestampType)):
            s = "ts"
        else:
            s = t.simpleString()
        out.append((f.name, s))
    return out


def finalize(df: DataFrame, spec: list[tuple[str, str]] | None = None) -> DataFrame:
    spec = spec or spec_of(df)
    return df.select(*[F.col(c).cast(_SPARK_TYPE.get(t, t)).alias(c) for c, t in spec])


def oracle_wrap(sql: str, spec: list[tuple[str, str]]) -> str:
    cols = ", ".join(f"cast(q.{c} as {_DUCK_TYPE.get(t, t)}) as {c}" for c, t in spec)
    return f"select {cols} from (\n{sql}\n) q"


def _model_query(name: str):
    domain, table, _ = MODELS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = built(spark, sf_dir, domain, table).get(table)
        return finalize(df, SPECS.get(name))

    run.__name__ = name
    return run


def model_sql(name: str) -> str:
    _, _, blk = MODELS[name]
    return oracle_wrap(oracle.sql_for(f"select * from {blk}"), SPECS[name])


def _op_query(name: str):
    fn = ops.OPS[name][0]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return finalize(fn(spark, sf_dir), SPECS.get(name))

    run.__name__ = name
    return run


def queries() -> dict:
    out = {n: _model_query(n) for n in MODELS}
    out.update({n: _op_query(n) for n in ops.OPS})
    return out


def oracle_sql() -> dict:
    out = {n: model_sql(n) for n in MODELS if n in SPECS}
    for n, (_, sql) in ops.OPS.items():
        if sql is not None and n in SPECS:
            out[n] = oracle_wrap(sql(), SPECS[n])
    return out
