"""Operator-level queries: data-quality checks (D), run-log analytics (L)
and state operators not visible in a model's final table (H5 hard deletes,
S8 schema sync, S9 clustered layout). Each has a Spark callable and, where
the result is layout-independent, its DuckDB SQL."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators import runlog as L
from ..operators.incremental import merge_upsert
from ..operators.scd2 import scd2_apply
from ..sources import fixtures as fx
from . import oracle as O
from . import tpch
from .runner import built

# stored table of each tested model (Spark) and its oracle block (SQL)
TEST_TABLES = {
    "stg_orders": ("retail", "stg_orders", "rod_2"),
    "fct_orders": ("retail", "fct_orders", "rfo_2"),
    "dim_customer_retail": ("retail", "dim_customer_retail", "rdimc"),
    "dim_product": ("retail", "dim_product", "rdimp"),
    "dim_date_retail": ("retail", "dim_date_retail", "rdimd"),
    "dim_customer": ("tpch", "dim_customer", "dimc_2"),
    "dim_supplier": ("tpch", "dim_supplier", "dims_2"),
    "dim_part": ("tpch", "dim_part", "dimp_2"),
    "fact_lineitem": ("tpch", "fact_lineitem", "fli_2"),
    "fact_orders": ("tpch", "fact_orders", "fo_2"),
}


# Violations put into a copy of each tested table: of every 40th key (by remainder) the row comes twice (3), has NULL
# in the listed columns (7) or the listed wrong values (11).
DIRT = {
    "stg_orders": ("cast(order_id as bigint)", ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "is_late_delivery"], {"order_status": "'LOST'"}),
    "fct_orders": ("cast(order_id as bigint)", ["order_id", "customer_id", "order_status", "total_payment_value"], {}),
    "dim_customer_retail": ("cast(customer_id as bigint)", ["customer_id"], {}),
    "dim_product": ("cast(product_id as bigint)", ["product_id"], {}),
    "dim_date_retail": ("day(date_id)", ["date_id"], {}),
    "dim_customer": ("customer_key", ["customer_sk", "customer_key"], {}),
    "dim_supplier": ("supplier_key", ["supplier_sk", "supplier_key"], {}),
    "dim_part": ("part_key", ["part_key"], {}),
    "fact_lineitem": ("order_key", ["part_key"], {"part_key": "-part_key"}),
    "fact_orders": ("order_key", ["order_key"], {}),
}


def clean_tables(spark: SparkSession, sf_dir: str, *models: str) -> dict[str, DataFrame]:
    """The tested tables, or ``models`` of them, of one run a domain that makes these and what they need; the domains' runs share
    the cores."""
    by_domain: dict[str, list[str]] = {}
    for m in models or TEST_TABLES:
        by_domain.setdefault(TEST_TABLES[m][0], []).append(m)
    with ThreadPoolExecutor(len(by_domain)) as pool:
        started = {d: pool.submit(built, spark, sf_dir, d, *[TEST_TABLES[m][1] for m in ms]) for d, ms in by_domain.items()}
        runs = {d: r.result() for d, r in started.items()}
    return {m: runs[d].get(TEST_TABLES[m][1]) for d, ms in by_domain.items() for m in ms}


def _tables(spark: SparkSession, sf_dir: str, checks: list[Q.Check] = Q.DECLARED_TESTS) -> dict[str, DataFrame]:
    """The tables that ``checks`` read, with violations of every declared test."""
    models = {c.model for c in checks} | {c.arg[0] for c in checks if c.kind == "relationships"}
    out = {}
    for name, df in clean_tables(spark, sf_dir, *sorted(models)).items():
        key, nulls, wrong = DIRT[name]
        of = lambda r: df.filter(F.expr(f"{key} % 40 = {r}"))  # noqa: E731, B023
        out[name] = (df.unionByName(of(3))
                     .unionByName(of(7).withColumns({c: F.lit(None).cast(df.schema[c].dataType) for c in nulls}))
                     .unionByName(of(11).withColumns({c: F.expr(v).cast(df.schema[c].dataType) for c, v in wrong.items()})))
    return out


def _dirty_sql(name: str) -> str:
    """The same in SQL."""
    key, nulls, wrong = DIRT[name]
    t = TEST_TABLES[name][2]
    replaced = lambda xs: f"select * replace ({', '.join(xs)})" if xs else "select *"
    return (f"(select * from {t} union all by name select * from {t} where {key} % 40 = 3 "
            f"union all by name {replaced([f'null as {c}' for c in nulls])} from {t} where {key} % 40 = 7 "
            f"union all by name {replaced([f'{v} as {c}' for c, v in wrong.items()])} from {t} where {key} % 40 = 11)")


def _checks(kind: str) -> list[Q.Check]:
    return [c for c in Q.DECLARED_TESTS if c.kind == kind]


# ---------------------------------------------------------------- quality ----

def d1_unique(spark, sf_dir):
    t = _tables(spark, sf_dir, _checks("unique"))
    parts = [Q.unique(t[c.model], c.column).select(F.lit(c.name).alias("test_name"), F.col(c.column).cast("string").alias("value"), "n_records")
             for c in _checks("unique")]
    return reduce(DataFrame.unionByName, parts)


def d2_not_null(spark, sf_dir):
    """NULL counts of every not_null test, one scan per model."""
    t = _tables(spark, sf_dir, _checks("not_null"))
    by_model: dict[str, list[Q.Check]] = {}
    for c in _checks("not_null"):
        by_model.setdefault(c.model, []).append(c)
    parts = []
    for m, cs in by_model.items():
        counts = Q.null_counts(t[m], [c.column for c in cs])
        parts.append(counts.select(F.explode(F.array(*[
            F.struct(F.lit(c.name).alias("test_name"), F.col(c.column).cast("bigint").alias("null_rows")) for c in cs
        ])).alias("s")).select("s.*"))
    return reduce(DataFrame.unionByName, parts)


def d3_accepted_values(spark, sf_dir):
    t = _tables(spark, sf_dir, _checks("accepted_values"))
    parts = [Q.accepted_values(t[c.model], c.column, list(c.arg))
             .select(F.lit(c.name).alias("test_name"), F.col(c.column).cast("string").alias("value"), "n_records")
             for c in _checks("accepted_values")]
    return reduce(DataFrame.unionByName, parts)


def d4_relationships(spark, sf_dir):
    t = _tables(spark, sf_dir, _checks("relationships"))
    parts = [Q.relationships(t[c.model], c.column, t[c.arg[0]], c.arg[1]).groupBy(F.col(c.column).cast("string").alias("value"))
             .agg(F.count(F.lit(1)).alias("n_records")).select(F.lit(c.name).alias("test_name"), "value", "n_records")
             for c in _checks("relationships")]
    return reduce(DataFrame.unionByName, parts)


def d5_unique_combination(spark, sf_dir):
    t = _tables(spark, sf_dir, _checks("unique_combination"))
    parts = []
    for c in _checks("unique_combination"):
        cols = c.column.split(",")
        parts.append(Q.unique_combination(t[c.model], cols).select(
            F.lit(c.name).alias("test_name"), F.concat_ws("|", *[F.col(x).cast("string") for x in cols]).alias("value"), "n_records"))
    return reduce(DataFrame.unionByName, parts)


def d6_quality_suite(spark, sf_dir):
    return Q.run_suite(Q.DECLARED_TESTS, _tables(spark, sf_dir, Q.DECLARED_TESTS))


def _viol_sql(c: Q.Check) -> str:
    t = _dirty_sql(c.model)
    if c.kind == "unique":
        return f"select {c.column} as value, count(*) as n_records from {t} where {c.column} is not null group by {c.column} having count(*) > 1"
    if c.kind == "not_null":
        return f"select * from {t} where {c.column} is null"
    if c.kind == "accepted_values":
        vals = ", ".join(f"'{v}'" for v in c.arg)
        return f"select {c.column} as value, count(*) as n_records from {t} where {c.column} not in ({vals}) group by {c.column}"
    if c.kind == "relationships":
        p = _dirty_sql(c.arg[0])
        return (f"select c.{c.column} as value, count(*) as n_records from {t} c where c.{c.column} is not null and not exists "
                f"(select 1 from {p} p where p.{c.arg[1]} = c.{c.column}) group by c.{c.column}")
    cols = c.column.split(",")
    return (f"select concat_ws('|', {', '.join(f'cast({x} as varchar)' for x in cols)}) as value, count(*) as n_records "
            f"from {t} group by {', '.join(cols)} having count(*) > 1")


def _union_sql(parts: list[str]) -> str:
    return "\nunion all\n".join(parts)


def d_sql(kind: str) -> str:
    cs = _checks(kind)
    if kind == "not_null":
        body = _union_sql([f"select '{c.name}' as test_name, cast((select count(*) from ({_viol_sql(c)})) as bigint) as null_rows" for c in cs])
    else:
        body = _union_sql([f"select '{c.name}' as test_name, cast(value as varchar) as value, n_records from ({_viol_sql(c)})" for c in cs])
    return O.sql_for(body)


def d6_sql() -> str:
    """A relationships test fails by rows, the others by what ``_viol_sql`` lists."""
    failures = lambda c: "coalesce(sum(n_records), 0)" if c.kind == "relationships" else "count(*)"
    body = _union_sql([
        f"select '{c.name}' as test_name, '{c.model}' as model, '{c.kind}' as kind, '{c.column}' as column_name, "
        f"{failures(c)} as failures, case when count(*) = 0 then 'pass' else 'fail' end as status from ({_viol_sql(c)})"
        for c in Q.DECLARED_TESTS
    ])
    return O.sql_for(body)


# ---------------------------------------------------------------- run log ----

def _fx(spark, sf_dir, name):
    return fx.fixture(spark, sf_dir, name)


def l1_run_rollup(spark, sf_dir):
    results = _fx(spark, sf_dir, "fx_run_results").withColumn("part", F.floor(F.col("result_id") / 40))
    return L.rollup(L.flatten_results(L.results_documents(results, ["run_id", "layer", "part"])))


def l2_flatten_results(spark, sf_dir):
    return L.flatten_results(L.results_documents(_fx(spark, sf_dir, "fx_run_results"), ["result_id", "run_id", "layer"]))


def l3_infer_layer(spark, sf_dir):
    return L.with_model(_fx(spark, sf_dir, "fx_task_events")).select("event_id", "model_name", "layer")


def l4_base_model_name(spark, sf_dir):
    return L.with_model(_fx(spark, sf_dir, "fx_task_events")).select("event_id", "task_id", "model_name")


def l5_last_attempt_state(spark, sf_dir):
    return L.last_attempt_state(spark, _fx(spark, sf_dir, "fx_run_results"))


def l6_rows_written(spark, sf_dir):
    return L.rows_written(_fx(spark, sf_dir, "fx_task_events"), _fx(spark, sf_dir, "fx_query_history"))


def l7_cycle_state(spark, sf_dir):
    return L.cycle_state(_fx(spark, sf_dir, "fx_task_events"))


def l8_pending(spark, sf_dir):
    ev = _fx(spark, sf_dir, "fx_task_events")
    return L.pending(ev, L.cycle_state(ev, key="task_id"))


def l9_clear_dag(spark, sf_dir):
    return L.clear_dag(L.cycle_state(_fx(spark, sf_dir, "fx_task_events")), "dag0")


def l10_durations(spark, sf_dir):
    return L.durations(_fx(spark, sf_dir, "fx_task_events"))


# --- fixed values of the SQL side, spelled out and not shared with the operators
_SUFFIXES = ("_run", "_test", "_snapshot")
_PREFIXES = (("stg_tpch__", "bronze"), ("snap_tpch_", "snapshot"), ("tpch_silver_", "silver"), ("tpch_dim_", "gold"),
             ("tpch_fact_", "gold"), ("tpch_mart_", "gold"), ("tpch_date", "gold"))
_ERRORS, _FAILURES = "'error', 'fail'", "'error', 'fail', 'skipped'"


def _model_sql(col: str = "task_id") -> str:
    n = f"split_part({col}, '.', 1)"
    for s in _SUFFIXES:
        n = f"(case when ends_with({n}, '{s}') then left({n}, length({n}) - {len(s)}) else {n} end)"
    return n


def _layer_sql(m: str) -> str:
    whens = " ".join(f"when starts_with({m}, '{p}') then '{lay}'" for p, lay in _PREFIXES)
    return f"case {whens} else 'unknown' end"


EV = f"(select *, {_model_sql()} as model_name from fx_task_events)"
STATE_SQL = f"""select dag_id, {{key}}, {_layer_sql('model_name')} as layer,
 case when status = 'success' then 'SUCCESS' else 'FAILED' end as status, end_date as updated_at
 from {EV} qualify row_number() over (partition by dag_id, {{key}} order by end_date desc, event_id desc) = 1"""


def l_sql(name: str) -> str:
    err, bad = _ERRORS, _FAILURES
    if name == "l1_run_rollup":
        body = f"""select run_id, layer, count(*) as models_total, count(*) filter (where status = 'success') as models_success,
 count(*) filter (where status in ({err})) as models_error, count(*) filter (where status = 'skipped') as models_skipped,
 case when count(*) filter (where status in ({err})) = 0 and count(*) filter (where status = 'skipped') = 0 then 'SUCCESS' else 'FAILED' end as status
 from fx_run_results group by run_id, layer"""
    elif name == "l2_flatten_results":
        msg = "substr(coalesce(message, ''), 1, 4000)"
        body = f"""select result_id, run_id, layer, split_part(coalesce(unique_id, ''), '.', -1) as model_name,
 case when coalesce(unique_id, '') = '' then 'unknown' else split_part(unique_id, '.', 1) end as resource_type, status,
 coalesce(execution_time, 0.0) as execution_time_seconds, cast(rows_affected as bigint) as rows_affected,
 case when status in ({err}) and {msg} != '' then {msg} end as error_message from fx_run_results"""
    elif name == "l3_infer_layer":
        body = f"select event_id, model_name, {_layer_sql('model_name')} as layer from {EV}"
    elif name == "l4_base_model_name":
        body = f"select event_id, task_id, model_name from {EV}"
    elif name == "l5_last_attempt_state":
        layers = "('bronze'), ('silver'), ('snapshot'), ('gold')"
        body = f"""select layer, last_run_id, state, case state when 'NONE' then 'BUILD' when 'FAILED' then 'RETRY' else 'SKIP' end as next_action from (
 select l.layer, t.last_run_id, case when t.last_run_id is null then 'NONE' when t.bad = 1 then 'FAILED' else 'SUCCESS' end as state
 from (values {layers}) l(layer) left join (
   select layer, max(run_id) as last_run_id, arg_max(bad, run_id) as bad from (
     select layer, run_id, max(case when status in ({bad}) then 1 else 0 end) as bad from fx_run_results group by layer, run_id)
   group by layer) t on l.layer = t.layer)"""
    elif name == "l6_rows_written":
        types, pad = "'INSERT', 'MERGE', 'CREATE_TABLE_AS_SELECT', 'UPDATE'", 10
        body = f"""select e.event_id, e.model_name, case when e.status = 'success' and e.start_date is not null and e.end_date is not null then (
   select cast(sum(coalesce(q.rows_inserted, 0) + coalesce(q.rows_updated, 0)) as bigint) from fx_query_history q
   where q.execution_status = 'SUCCESS' and q.query_type in ({types})
     and q.end_time >= date_trunc('second', e.start_date - interval {pad} second)
     and q.end_time <= date_trunc('second', e.end_date + interval {pad} second)
     and q.query_text ilike '%' || e.model_name || '%') end as rows_affected
 from {EV} e"""
    elif name == "l7_cycle_state":
        body = STATE_SQL.format(key="model_name")
    elif name == "l8_pending":
        body = (f"select distinct dag_id, task_id from fx_task_events m where not exists (select 1 from ({STATE_SQL.format(key='task_id')}) s "
                "where s.status = 'SUCCESS' and s.dag_id = m.dag_id and s.task_id = m.task_id)")
    elif name == "l9_clear_dag":
        body = f"select * from ({STATE_SQL.format(key='model_name')}) where dag_id != 'dag0'"
    elif name == "l10_durations":
        body = f"select event_id, dag_id, model_name, (epoch_us(end_date) - epoch_us(start_date)) / 1e6 as duration_seconds from {EV}"
    else:
        raise KeyError(name)
    return O.sql_for(body)


# ------------------------------------------------------- state operators ----

def h5_scd2_hard_deletes(spark, sf_dir):
    """Customer history over two loads where the second load lacks every
    11th key: with hard-delete invalidation those versions close."""
    h1 = scd2_apply(None, _fx(spark, sf_dir, "fx_customer"), "customer_key", tpch.CUSTOMER_CHECK, fx.DAY1_TS)
    return scd2_apply(h1, _fx(spark, sf_dir, "fx_customer_v2"), "customer_key", tpch.CUSTOMER_CHECK, fx.DAY2_TS, hard_deletes=True)


O.block("hcu_1", "select * from fx_customer")
O.block("hcu_2", "select * from fx_customer_v2")
O.scd2("hsc", "hcu", "customer_key", O.CUSTOMER_CHECK, True)


def s8_schema_sync(spark, sf_dir):
    """Merge whose update rows gained a column and lost one: the table takes
    the new column list; untouched rows get NULL in the new column."""
    part = _fx(spark, sf_dir, "fx_part")
    target = part
    updates = part.filter(F.col("part_key") % 3 == 0).drop("container").withColumn(
        "size_band", F.when(F.col("part_size") < 25, "S").otherwise("L"))
    return merge_upsert(target, updates, ["part_key"], sync_schema=True)


S8_SQL_BODY = """select * from (
 select t.* exclude (container), cast(null as varchar) as size_band from fx_part t
 where not exists (select 1 from fx_part u where u.part_key % 3 = 0 and u.part_key = t.part_key)
 union all by name
 select * exclude (container), case when part_size < 25 then 'S' else 'L' end as size_band from fx_part where part_key % 3 = 0)"""


def s4_view_sink(spark, sf_dir):
    """The stored silver customers, read through the registered view."""
    return spark.table(built(spark, sf_dir, "tpch", "silver_customer").store.view("silver_customer"))


def s9_clustered_layout(spark, sf_dir):
    """Per ship month of the two month-clustered line tables: rows, and how many of the files that hold them also
    hold another month."""
    run = built(spark, sf_dir, "tpch", "silver_lineitem", "fact_lineitem")
    out = []
    for name in ("silver_lineitem", "fact_lineitem"):
        per = run.get(name).groupBy(F.input_file_name().alias("file"), F.date_format("ship_date", "yyyy-MM").alias("ship_month")).agg(F.count(F.lit(1)).alias("n"))
        mixed = per.groupBy("file").agg(F.count(F.lit(1)).alias("months"))
        out.append(per.join(mixed, "file").groupBy("ship_month").agg(
            F.sum("n").alias("rows"), F.sum(F.when(F.col("months") > 1, 1).otherwise(0)).cast("bigint").alias("mixed_files"))
            .select(F.lit(name).alias("table_name"), "ship_month", "rows", "mixed_files"))
    return out[0].unionByName(out[1])


S9_SQL_BODY = """select 'silver_lineitem' as table_name, strftime(ship_date, '%Y-%m') as ship_month, count(*) as rows, cast(0 as bigint) as mixed_files from sli_2 group by all
 union all select 'fact_lineitem', strftime(ship_date, '%Y-%m'), count(*), cast(0 as bigint) from fli_2 group by all"""


def h_scd2_new_column(spark, sf_dir):
    """Customer history over a second load that gained a column and lost one."""
    first = _fx(spark, sf_dir, "fx_customer")
    second = _fx(spark, sf_dir, "fx_customer_v2").drop("market_segment").withColumn("tier", F.when(F.col("account_balance") > 5000, "A").otherwise("B"))
    check = ["customer_address", "customer_phone"]
    h1 = scd2_apply(None, first, "customer_key", check, fx.DAY1_TS)
    return scd2_apply(h1, second, "customer_key", check, fx.DAY2_TS)


O.block("hnc_1", "select *, cast(null as varchar) as tier from fx_customer")
O.block("hnc_2", "select * replace (cast(null as varchar) as market_segment), case when account_balance > 5000 then 'A' else 'B' end as tier from fx_customer_v2")
O.scd2("hnv", "hnc", "customer_key", ["customer_address", "customer_phone"], False)


OPS = {
    "d1_unique": (d1_unique, lambda: d_sql("unique")),
    "d2_not_null": (d2_not_null, lambda: d_sql("not_null")),
    "d3_accepted_values": (d3_accepted_values, lambda: d_sql("accepted_values")),
    "d4_relationships": (d4_relationships, lambda: d_sql("relationships")),
    "d5_unique_combination": (d5_unique_combination, lambda: d_sql("unique_combination")),
    "d6_quality_suite": (d6_quality_suite, d6_sql),
    "h5_scd2_hard_deletes": (h5_scd2_hard_deletes, lambda: O.sql_for("select * from hsc_2")),
    "s4_view_sink": (s4_view_sink, lambda: O.sql_for("select * from scu_2")),
    "s8_schema_sync": (s8_schema_sync, lambda: O.sql_for(S8_SQL_BODY)),
    "s9_clustered_layout": (s9_clustered_layout, lambda: O.sql_for(S9_SQL_BODY)),
    "h_scd2_new_column": (h_scd2_new_column, lambda: O.sql_for("select * from hnv_2")),
}
for _n in ("l1_run_rollup", "l2_flatten_results", "l3_infer_layer", "l4_base_model_name", "l5_last_attempt_state",
           "l6_rows_written", "l7_cycle_state", "l8_pending", "l9_clear_dag", "l10_durations"):
    OPS[_n] = (globals()[_n], (lambda n=_n: l_sql(n)))


# ------------------------------------------------- single-operator queries ----
# Each applies one operator to whole fixture tables; day 1 / day 2 follow the
# batch stamps (``_loaded_at``) as in the models.
from ..functions import exprs as X  # noqa: E402
from ..operators.dedup import dedup_latest  # noqa: E402
from ..operators.distinct import sums_and_distincts  # noqa: E402
from ..operators.incremental import append_new, lookback, newer_than  # noqa: E402


def _day1(spark, sf_dir, name):
    return fx.day_slice(_fx(spark, sf_dir, name), 1)


def f1_high_water_strict(spark, sf_dir):
    return newer_than(_fx(spark, sf_dir, "fx_raw_order_items"), _day1(spark, sf_dir, "fx_raw_order_items"), "_loaded_at")


def f2_high_water_floor(spark, sf_dir):
    li = _fx(spark, sf_dir, "fx_lineitem")
    return newer_than(li, li.filter(F.lit(False)), "_loaded_at", floor=tpch.FLOOR_TS)


def f3_lookback_window(spark, sf_dir):
    return lookback(_fx(spark, sf_dir, "fx_orders"), _day1(spark, sf_dir, "fx_orders"), "order_date", days=3)


def j1_anti_join(spark, sf_dir):
    return append_new(_fx(spark, sf_dir, "fx_orders"), _day1(spark, sf_dir, "fx_orders"), ["order_key"])


def j2_anti_join_composite(spark, sf_dir):
    return append_new(_fx(spark, sf_dir, "fx_lineitem"), _day1(spark, sf_dir, "fx_lineitem"), ["order_key", "line_number"])


def w1_dedup_latest(spark, sf_dir):
    both = _fx(spark, sf_dir, "fx_customer").unionByName(_fx(spark, sf_dir, "fx_customer_v2"))
    return dedup_latest(both, ["customer_key"], tie_break=O.TIE["customer"])


def w2_dedup_composite(spark, sf_dir):
    return dedup_latest(_fx(spark, sf_dir, "fx_lineitem"), ["order_key", "line_number"], tie_break=tpch.TIE_BREAK["lineitem"])


def s6_merge_single_key(spark, sf_dir):
    return merge_upsert(_fx(spark, sf_dir, "fx_customer"), _fx(spark, sf_dir, "fx_customer_v2"), ["customer_key"])


def s7_merge_composite_key(spark, sf_dir):
    li = _fx(spark, sf_dir, "fx_lineitem")
    keys, tie = ["order_key", "line_number"], tpch.TIE_BREAK["lineitem"]
    t = dedup_latest(fx.day_slice(li, 1), keys, tie_break=tie)
    u = dedup_latest(li.filter(F.col("_loaded_at") > F.lit(fx.DAY1_TS).cast("timestamp_ntz")), keys, tie_break=tie)
    return merge_upsert(t, u, keys)


def a5_multi_count_distinct(spark, sf_dir):
    return sums_and_distincts(_fx(spark, sf_dir, "fx_raw_order_items"), "order_id", {"items": F.lit(1)},
                              {"distinct_products": "product_id", "distinct_sellers": "seller_id"})


def x3_initcap(spark, sf_dir):
    return _fx(spark, sf_dir, "fx_raw_customers").select("customer_id", X.initcap_words(F.trim("customer_city")).alias("customer_city"))


def x4_try_number(spark, sf_dir):
    p = _fx(spark, sf_dir, "fx_raw_products")
    return p.select("product_id", *[X.try_number(c).alias(c) for c in (
        "product_weight_g", "product_name_lenght", "product_photos_qty", "product_length_cm")])


def x5_try_decimal(spark, sf_dir):
    oi = _fx(spark, sf_dir, "fx_raw_order_items")
    price, freight = X.try_number("price", 10, 2), X.try_number("freight_value", 10, 2)
    return oi.select("order_id", "order_item_id", "product_id", "seller_id", "_loaded_at", price.alias("price"),
                     freight.alias("freight_value"), (price + freight).alias("total_item_value"))


def x7_day_diff(spark, sf_dir):
    o = _fx(spark, sf_dir, "fx_raw_orders")
    p, d, e = (X.try_timestamp_ntz(c) for c in ("order_purchase_timestamp", "order_delivered_customer_date", "order_estimated_delivery_date"))
    return o.select("order_id", p.alias("purchased"), d.alias("delivered"), X.day_diff(p, d).alias("actual_delivery_days"),
                    X.day_diff(p, e).alias("estimated_delivery_days"), X.flag(d > e).alias("is_late_delivery"))


def x22_surrogate_key(spark, sf_dir):
    c = _fx(spark, sf_dir, "fx_customer")
    return c.select("customer_key", X.surrogate_key_ts("customer_key", "_loaded_at").alias("customer_sk"),
                    X.surrogate_key("customer_key", "nation_key").alias("key_nation_sk"))


_TS1 = O.TS[1]
_LI_TIE = O.TIE["lineitem"]
_TOK = f"'{X.SURROGATE_NULL}'"
SINGLE_SQL = {
    "f1_high_water_strict": f"select * from fx_raw_order_items where _loaded_at > (select max(_loaded_at) from fx_raw_order_items where _loaded_at <= {_TS1})",
    "f2_high_water_floor": f"select * from fx_lineitem where _loaded_at > (select coalesce(max(_loaded_at), {O.FLOOR}) from fx_lineitem where false)",
    "f3_lookback_window": f"select * from fx_orders where order_date >= (select cast(max(order_date) - 3 as date) from fx_orders where _loaded_at <= {_TS1})",
    "j1_anti_join": f"select * from fx_orders s where not exists (select 1 from fx_orders t where t._loaded_at <= {_TS1} and t.order_key = s.order_key)",
    "j2_anti_join_composite": (f"select * from fx_lineitem s where not exists (select 1 from fx_lineitem t where t._loaded_at <= {_TS1} "
                               "and t.order_key = s.order_key and t.line_number = s.line_number)"),
    "w1_dedup_latest": O.dedup("(select * from fx_customer union all by name select * from fx_customer_v2)", ["customer_key"], O.TIE["customer"]),
    "w2_dedup_composite": O.dedup("fx_lineitem", ["order_key", "line_number"], _LI_TIE),
    "s6_merge_single_key": O.merge("fx_customer", "fx_customer_v2", ["customer_key"]),
    "s7_merge_composite_key": O.merge(f"({O.dedup(f'(select * from fx_lineitem where _loaded_at <= {_TS1})', ['order_key', 'line_number'], _LI_TIE)})",
                                      f"({O.dedup(f'(select * from fx_lineitem where _loaded_at > {_TS1})', ['order_key', 'line_number'], _LI_TIE)})",
                                      ["order_key", "line_number"]),
    "a5_multi_count_distinct": ("select order_id, count(*) as items, count(distinct product_id) as distinct_products, "
                                "count(distinct seller_id) as distinct_sellers from fx_raw_order_items group by order_id"),
    "x3_initcap": f"select customer_id, {O.initcap('trim(customer_city)')} as customer_city from fx_raw_customers",
    "x4_try_number": "select product_id, " + ", ".join(f"try_cast({c} as decimal(38,0)) as {c}" for c in (
        "product_weight_g", "product_name_lenght", "product_photos_qty", "product_length_cm")) + " from fx_raw_products",
    "x5_try_decimal": ("select order_id, order_item_id, product_id, seller_id, _loaded_at, try_cast(price as decimal(10,2)) as price, "
                       "try_cast(freight_value as decimal(10,2)) as freight_value, "
                       "try_cast(price as decimal(10,2)) + try_cast(freight_value as decimal(10,2)) as total_item_value from fx_raw_order_items"),
    "x7_day_diff": ("select order_id, p as purchased, d as delivered, cast(datediff('day', p, d) as int) as actual_delivery_days, "
                    "cast(datediff('day', p, e) as int) as estimated_delivery_days, coalesce(d > e, false) as is_late_delivery from ("
                    "select order_id, try_cast(order_purchase_timestamp as timestamp) as p, try_cast(order_delivered_customer_date as timestamp) as d, "
                    "try_cast(order_estimated_delivery_date as timestamp) as e from fx_raw_orders)"),
    "x22_surrogate_key": (f"select customer_key, {O.sk('customer_key', '_loaded_at')} as customer_sk, "
                          f"md5(concat_ws('-', coalesce(cast(customer_key as varchar), {_TOK}), coalesce(cast(nation_key as varchar), {_TOK}))) as key_nation_sk "
                          "from fx_customer"),
}
for _n in SINGLE_SQL:
    OPS[_n] = (globals()[_n], (lambda n=_n: O.sql_for(SINGLE_SQL[n])))


# ------------------------------------------------------- scalar functions ----

def x1_trim_upper_lower(spark, sf_dir):
    o = _fx(spark, sf_dir, "fx_raw_orders")
    s = F.trim("order_status")
    return o.select("order_id", s.alias("trimmed"), F.upper(s).alias("upper_status"), F.lower(s).alias("lower_status"))


def x8_simple_case(spark, sf_dir):
    c = _fx(spark, sf_dir, "fx_raw_customers")
    st = F.upper(F.trim("customer_state"))
    return c.select("customer_id", st.alias("customer_state"), X.map_lookup(st, X.STATE_REGION, "Unknown").alias("customer_region"))


def x9_searched_case(spark, sf_dir):
    p = _fx(spark, sf_dir, "fx_raw_products")
    w = X.try_number("product_weight_g")
    return p.select("product_id", w.alias("product_weight_g"), F.when(w < 500, "Light").when(w < 2000, "Medium")
                    .when(w < 5000, "Heavy").otherwise("Very Heavy").alias("weight_class"))


def x10_boolean_flags(spark, sf_dir):
    p = _fx(spark, sf_dir, "fx_raw_payments")
    return p.select("order_id", "payment_sequential", X.flag(F.upper(F.trim("payment_type")) == "CREDIT_CARD").alias("is_credit_card"),
                    X.flag(X.try_number("payment_installments") > 1).alias("is_installment"))


def x13_round_money(spark, sf_dir):
    li = _fx(spark, sf_dir, "fx_lineitem")
    net = F.col("extended_price") * (1 - F.col("discount"))
    return li.select("order_key", "line_number", "part_key", "supplier_key", "_loaded_at",
                     F.round(net, 2).cast("decimal(18,2)").alias("net_revenue"),
                     F.round(net * (1 + F.col("tax")), 2).cast("decimal(18,2)").alias("gross_revenue"))


def x16_x17_date_parts(spark, sf_dir):
    o = _fx(spark, sf_dir, "fx_raw_orders")
    ts = X.try_timestamp_ntz("order_purchase_timestamp")
    return o.select("order_id", F.to_date(ts).alias("order_date"),
                    F.date_trunc("month", ts).cast("timestamp_ntz").alias("order_month"),
                    F.trunc(F.to_date(ts), "quarter").alias("first_day_of_quarter"),
                    F.year(ts).alias("order_year"), F.month(ts).alias("order_month_num"),
                    X.dow_sunday0(ts).alias("day_of_week"), F.weekofyear(ts).alias("week_num"))


def x18_x19_calendar_names(spark, sf_dir):
    o = _fx(spark, sf_dir, "fx_orders")
    d = F.col("order_date")
    return o.select("order_key", F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
                    F.date_format(d, "MMM").alias("month_name"), F.dayofmonth(d).alias("day"),
                    F.date_format(d, "EEE").alias("day_name"), F.weekofyear(d).alias("week_of_year"))


def x20_date_add(spark, sf_dir):
    o = _fx(spark, sf_dir, "fx_orders")
    return o.select("order_key", F.date_add("order_date", 3).alias("plus_3"), F.date_sub("order_date", 3).alias("minus_3"))


def x24_predicates(spark, sf_dir):
    li = _fx(spark, sf_dir, "fx_lineitem")
    return li.select(
        "order_key", "line_number", "part_key", "supplier_key", "_loaded_at",
        X.flag(F.col("discount").between(0, 1)).alias("discount_ok"),
        X.flag(F.col("return_flag").isin("A", "N", "R")).alias("flag_ok"),
        F.col("ship_date").isNotNull().alias("shipped"),
        X.flag(F.col("receipt_date") >= F.col("ship_date")).alias("receipt_ok"),
        X.flag(F.col("ship_mode") != "AIR").alias("not_air"))


_STATE = "upper(trim(customer_state))"
_W = "try_cast(product_weight_g as decimal(38,0))"
_TSQ = "try_cast(order_purchase_timestamp as timestamp)"
_NET = "extended_price * (1 - discount)"
SCALAR_SQL = {
    "x1_trim_upper_lower": "select order_id, trim(order_status) as trimmed, upper(trim(order_status)) as upper_status, lower(trim(order_status)) as lower_status from fx_raw_orders",
    "x8_simple_case": f"select customer_id, {_STATE} as customer_state, {O.case_map(_STATE, X.STATE_REGION, 'Unknown')} as customer_region from fx_raw_customers",
    "x9_searched_case": (f"select product_id, {_W} as product_weight_g, case when {_W} < 500 then 'Light' when {_W} < 2000 then 'Medium' "
                         f"when {_W} < 5000 then 'Heavy' else 'Very Heavy' end as weight_class from fx_raw_products"),
    "x10_boolean_flags": ("select order_id, payment_sequential, coalesce(upper(trim(payment_type)) = 'CREDIT_CARD', false) as is_credit_card, "
                          "coalesce(try_cast(payment_installments as decimal(38,0)) > 1, false) as is_installment from fx_raw_payments"),
    "x13_round_money": (f"select order_key, line_number, part_key, supplier_key, _loaded_at, cast(round({_NET}, 2) as decimal(18,2)) as net_revenue, "
                        f"cast(round({_NET} * (1 + tax), 2) as decimal(18,2)) as gross_revenue from fx_lineitem"),
    "x16_x17_date_parts": (f"select order_id, cast({_TSQ} as date) as order_date, date_trunc('month', {_TSQ}) as order_month, "
                           f"cast(date_trunc('quarter', cast({_TSQ} as date)) as date) as first_day_of_quarter, cast(year({_TSQ}) as int) as order_year, "
                           f"cast(month({_TSQ}) as int) as order_month_num, cast(dayofweek({_TSQ}) as int) as day_of_week, "
                           f"cast(weekofyear({_TSQ}) as int) as week_num from fx_raw_orders"),
    "x18_x19_calendar_names": ("select order_key, cast(year(order_date) as int) as year, cast(quarter(order_date) as int) as quarter, "
                               "cast(month(order_date) as int) as month, strftime(order_date, '%b') as month_name, cast(day(order_date) as int) as day, "
                               "strftime(order_date, '%a') as day_name, cast(weekofyear(order_date) as int) as week_of_year from fx_orders"),
    "x20_date_add": "select order_key, cast(order_date + 3 as date) as plus_3, cast(order_date - 3 as date) as minus_3 from fx_orders",
    "x24_predicates": ("select order_key, line_number, part_key, supplier_key, _loaded_at, coalesce(discount between 0 and 1, false) as discount_ok, "
                       "coalesce(return_flag in ('A','N','R'), false) as flag_ok, ship_date is not null as shipped, "
                       "coalesce(receipt_date >= ship_date, false) as receipt_ok, coalesce(ship_mode != 'AIR', false) as not_air from fx_lineitem"),
}
for _n in SCALAR_SQL:
    OPS[_n] = (globals()[_n], (lambda n=_n: O.sql_for(SCALAR_SQL[n])))
