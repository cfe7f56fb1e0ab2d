"""Run-log analytics as Spark jobs over accumulating log tables.

Inputs: per-node build results (``run_id, layer, unique_id, status,
execution_time, message, rows_affected, started_at`` or the JSON
documents they come in), per-task events (``event_id, dag_id, task_id,
status, start_date, end_date``) and the warehouse query history
(``query_id, end_time, query_text, execution_status, query_type,
rows_inserted, rows_updated``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored

# --- fixed values ------------------------------------------------------------
LAYERS = ("bronze", "silver", "snapshot", "gold")
# (name prefix, layer); the first matching prefix wins
LAYER_PREFIXES = [
    ("stg_tpch__", "bronze"),
    ("snap_tpch_", "snapshot"),
    ("tpch_silver_", "silver"),
    ("tpch_dim_", "gold"),
    ("tpch_fact_", "gold"),
    ("tpch_mart_", "gold"),
    ("tpch_date", "gold"),
]
TASK_SUFFIXES = ("_run", "_test", "_snapshot")  # stripped in this order
ERROR_STATUSES = ("error", "fail")
FAILED_STATUSES = ("error", "fail", "skipped")
WRITE_QUERY_TYPES = ("INSERT", "MERGE", "CREATE_TABLE_AS_SELECT", "UPDATE")
MESSAGE_MAX = 4000
WINDOW_PAD_SECONDS = 10

RESULTS_DOC_SCHEMA = T.StructType([
    T.StructField("results", T.ArrayType(T.StructType([
        T.StructField("unique_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("execution_time", T.DoubleType()),
        T.StructField("message", T.StringType()),
        T.StructField("adapter_response", T.StructType([T.StructField("rows_affected", T.LongType())])),
    ]))),
])


def infer_layer(model_name: Column) -> Column:
    """Layer from the model name's prefix, else 'unknown'."""
    out = F.lit("unknown")
    for prefix, layer in reversed(LAYER_PREFIXES):
        out = F.when(model_name.startswith(prefix), F.lit(layer)).otherwise(out)
    return out


def base_model_name(task_id: Column) -> Column:
    """Text before the first '.', then the task suffixes stripped in order
    (each only at the end; several may apply)."""
    name = F.split(task_id, r"\.", 2).getItem(0)
    for s in TASK_SUFFIXES:
        name = F.when(name.endswith(s), F.substring(name, F.lit(1), F.length(name) - len(s))).otherwise(name)
    return name


def results_documents(results: DataFrame, by: list[str]) -> DataFrame:
    """One run-results JSON document for each value of ``by``, shaped like the build tool's file:
    ``{"results": [{...}, ...]}``. The columns ``by`` stay beside ``doc``; choose them so that a document is one
    attempt's nodes."""
    item = F.struct(
        "unique_id", "status", "execution_time", "message",
        F.struct(F.col("rows_affected").cast("long").alias("rows_affected")).alias("adapter_response"),
    )
    return results.groupBy(*by).agg(F.to_json(F.struct(F.collect_list(item).alias("results"))).alias("doc"))


def flatten_results(docs: DataFrame) -> DataFrame:
    """Parse run-results documents into one log row per node.

    model_name is the last '.'-part of unique_id, resource_type the first
    ('unknown' when unique_id is empty); the error message is kept only
    for error/fail and cut to 4000 characters; empty messages are NULL.
    """
    r = docs.select("*", F.explode(F.from_json("doc", RESULTS_DOC_SCHEMA).getField("results")).alias("r")).drop("doc")
    uid = F.coalesce(F.col("r.unique_id"), F.lit(""))
    msg = F.substring(F.coalesce(F.col("r.message"), F.lit("")), 1, MESSAGE_MAX)
    return r.select(
        *[c for c in docs.columns if c != "doc"],
        F.element_at(F.split(uid, r"\."), -1).alias("model_name"),
        F.when(uid == "", F.lit("unknown")).otherwise(F.split(uid, r"\.").getItem(0)).alias("resource_type"),
        F.col("r.status").alias("status"),
        F.coalesce(F.col("r.execution_time"), F.lit(0.0)).alias("execution_time_seconds"),
        F.col("r.adapter_response.rows_affected").alias("rows_affected"),
        F.when(F.col("r.status").isin(*ERROR_STATUSES) & (msg != ""), msg).alias("error_message"),
    )


def rollup(results: DataFrame, keys: tuple[str, ...] = ("run_id", "layer")) -> DataFrame:
    """Totals per run and layer; FAILED when any error or skipped node.
    'pass' and 'warn' count in the total only."""
    s = F.col("status")
    g = results.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("models_total"),
        F.count_if(s == "success").alias("models_success"),
        F.count_if(s.isin(*ERROR_STATUSES)).alias("models_error"),
        F.count_if(s == "skipped").alias("models_skipped"),
    )
    return g.withColumn(
        "status",
        F.when((F.col("models_error") == 0) & (F.col("models_skipped") == 0), "SUCCESS").otherwise("FAILED"),
    )


def last_attempt_state(spark: SparkSession, results: DataFrame, layers: tuple[str, ...] = LAYERS) -> DataFrame:
    """NONE / FAILED / SUCCESS per layer from each layer's latest run.

    Per (layer, run) one partial aggregate, then per layer the flag of the
    run with the highest run_id (``max_by``), right-joined to the layer list.
    """
    per_run = results.groupBy("layer", "run_id").agg(F.max(F.col("status").isin(*FAILED_STATUSES).cast("int")).alias("bad"))
    latest = per_run.groupBy("layer").agg(F.max("run_id").alias("last_run_id"), F.max_by("bad", "run_id").alias("bad"))
    names = spark.createDataFrame([(x,) for x in layers], "layer string")
    state = F.when(F.col("last_run_id").isNull(), "NONE").when(F.col("bad") == 1, "FAILED").otherwise("SUCCESS")
    return F.broadcast(names).join(latest, "layer", "left").select(
        "layer", "last_run_id", state.alias("state"), next_action(state).alias("next_action"))


def next_action(state: Column) -> Column:
    """What a layer run does next: build when never run, retry the failed
    nodes after a failure, skip after a clean attempt."""
    return F.when(state == "NONE", "BUILD").when(state == "FAILED", "RETRY").otherwise("SKIP")


def last_attempt_state_docs(spark: SparkSession, docs: DataFrame, order_col: str,
                            layers: tuple[str, ...] = LAYERS) -> DataFrame:
    """NONE / FAILED / SUCCESS per layer from run-results documents
    (``layer, <order_col>, doc``): the latest document of a layer decides;
    a document with an empty result list is SUCCESS, a missing one NONE."""
    results = F.from_json("doc", RESULTS_DOC_SCHEMA).getField("results")
    bad = F.exists(F.coalesce(results, F.array()), lambda r: r.getField("status").isin(*FAILED_STATUSES))
    latest = docs.groupBy("layer").agg(F.max_by(bad.cast("int"), F.col(order_col)).alias("bad"))
    names = spark.createDataFrame([(x,) for x in layers], "layer string")
    state = F.when(F.col("bad").isNull(), "NONE").when(F.col("bad") == 1, "FAILED").otherwise("SUCCESS")
    return F.broadcast(names).join(latest, "layer", "left").select("layer", state.alias("state"), next_action(state).alias("next_action"))


def with_model(task_events: DataFrame) -> DataFrame:
    m = base_model_name(F.col("task_id"))
    return task_events.select("*", m.alias("model_name"), infer_layer(m).alias("layer"))


def durations(task_events: DataFrame) -> DataFrame:
    """Seconds from start to end of each task attempt."""
    secs = (F.unix_micros(F.col("end_date").cast("timestamp")) - F.unix_micros(F.col("start_date").cast("timestamp"))) / 1e6
    return with_model(task_events).select("event_id", "dag_id", "model_name", secs.alias("duration_seconds"))


def _grams(chars: Column, size: int) -> Column:
    """All stretches of ``size`` characters."""
    starts = F.when(F.size(chars) >= size, F.sequence(F.lit(1), F.greatest(F.size(chars) - size + 1, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.concat(*[F.element_at(chars, i + k) for k in range(size)]))


def _mentions(texts: DataFrame, names: DataFrame) -> DataFrame:
    """Distinct ``texts(_text)`` and ``names(_name)`` (both lower case) to the pairs for which the text is LIKE
    ``%name%``: in a name, ``_`` stands for any one character and ``%`` for any number.

    An inverted index: a text is found under each of its distinct stretches of at most three characters that a name has
    between its wildcards, and a name is looked up by the one of its stretches that the fewest texts have. Only
    those pairs are compared. A name without any other character is looked up under the empty stretch.
    """
    texts = stored(texts.select("_text", F.monotonically_increasing_id().alias("_id")), "runlog-texts")
    pieces = names.select("_name", F.explode(F.split("_name", "[_%]")).alias("_piece")).withColumn("_n", F.least(F.length("_piece"), F.lit(3)))
    longest = Window.partitionBy("_name")
    pieces = pieces.withColumn("_most", F.max("_n").over(longest)).filter("_n = _most").withColumn("_c", F.split("_piece", ""))
    of_size = F.when(F.col("_n") == 3, _grams(F.col("_c"), 3)).when(F.col("_n") == 2, _grams(F.col("_c"), 2)).otherwise(F.array("_piece"))
    wanted = stored(pieces.select("_name", F.explode(of_size).alias("_gram")).distinct(), "runlog-grams")
    chars = F.split("_text", "")
    every = F.array_distinct(F.concat(F.array(F.lit("")), F.array_distinct(chars), F.array_distinct(_grams(chars, 2)), _grams(chars, 3)))
    found = texts.select("_id", F.explode(every).alias("_gram")).join(wanted.select("_gram").distinct(), "_gram", "left_semi")
    found = stored(found, "runlog-found")
    held = wanted.join(found.groupBy("_gram").agg(F.count(F.lit(1)).alias("_texts")), "_gram", "left")
    rarest = held.groupBy("_name").agg(F.min_by("_gram", F.struct(F.coalesce("_texts", F.lit(0)), F.col("_gram"))).alias("_gram"))
    like = F.concat(F.lit("%"), F.replace(F.col("_name"), F.lit("\\"), F.lit("\\\\")), F.lit("%"))
    return found.join(rarest, "_gram").join(texts, "_id").filter(F.call_function("like", F.col("_text"), like)).select("_text", "_name")


def rows_written(task_events: DataFrame, history: DataFrame) -> DataFrame:
    """Rows written per successful task, from the query history.

    A query counts for a task when it ended inside [start - 10 s, end + 10 s]
    (bounds truncated to whole seconds), succeeded, is a write, and its text
    mentions the model name (ILIKE ``%name%``). The value is SUM(inserted + updated), NULL when
    nothing matched, the task failed or one of its times is missing.

    The window is a difference of range sums, not a join. Bounds are whole seconds, so a query counts at its second
    or between two seconds: time ``2 s`` or ``2 s + 1``. History is summed per (name, time), and running
    sums within a minute (at most 240 times), over a day's minutes and over days give the rows up to any bound:
    no window holds more than that, however hot a model or a minute is.
    """
    ev = with_model(task_events)
    pad = F.expr(f"INTERVAL {WINDOW_PAD_SECONDS} SECONDS")
    second = lambda c: F.unix_seconds(F.date_trunc("second", c).cast("timestamp"))
    ok = ev.filter((F.col("status") == "success") & F.col("start_date").isNotNull() & F.col("end_date").isNotNull()).select(
        "event_id", F.lower("model_name").alias("_name"),
        (2 * second(F.col("start_date") - pad) - 1).alias("_before"), (2 * second(F.col("end_date") + pad)).alias("_until"))
    ok = stored(ok, "runlog-windows")
    micros = F.unix_micros(F.col("end_time").cast("timestamp"))
    at = 2 * F.floor(micros / 1_000_000) + F.when(F.pmod(micros, F.lit(1_000_000)) > 0, 1).otherwise(0)
    span = ok.agg(F.min("_before").alias("low"), F.max("_until").alias("high")).first()
    queries = history.filter((F.col("execution_status") == "SUCCESS") & F.col("query_type").isin(*WRITE_QUERY_TYPES)).select(
        at.cast("bigint").alias("_t"), F.lower("query_text").alias("_text"),
        (F.coalesce("rows_inserted", F.lit(0)) + F.coalesce("rows_updated", F.lit(0))).cast("bigint").alias("_rows"),
    ).filter(F.col("_t").between(span["low"] or 0, span["high"] or 0)).groupBy("_text", "_t").agg(F.sum("_rows").alias("_s"), F.count(F.lit(1)).alias("_c"))
    pairs = _mentions(queries.select("_text").distinct(), ok.select("_name").distinct())
    points = queries.join(pairs, "_text").select("_name", "_t", "_s", "_c")
    none = [F.lit(0).cast("bigint").alias("_s"), F.lit(0).cast("bigint").alias("_c")]
    ends = F.array(F.struct(F.col("_before").alias("_t"), F.lit(-1).alias("_k")), F.struct(F.col("_until").alias("_t"), F.lit(1).alias("_k")))
    marks = ok.select("event_id", "_name", F.inline(ends))
    times = points.union(marks.select("_name", "_t", *none)).groupBy("_name", "_t").agg(F.sum("_s").alias("_s"), F.sum("_c").alias("_c"))
    times = stored(times.withColumn("_m", F.floor(F.col("_t") / 120)).withColumn("_d", F.floor(F.col("_t") / 172_800)), "runlog-times")

    def running(df: DataFrame, by: list[str], order: str, upto: int, s: str, c: str) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, upto)
        return df.withColumns({s: F.coalesce(F.sum("_s").over(w), F.lit(0)), c: F.coalesce(F.sum("_c").over(w), F.lit(0))})

    total = lambda df, *by: df.groupBy(*by).agg(F.sum("_s").alias("_s"), F.sum("_c").alias("_c"))
    minutes = total(times, "_name", "_d", "_m")
    days = running(total(minutes, "_name", "_d"), ["_name"], "_d", -1, "_s3", "_c3").drop("_s", "_c")
    minutes = running(minutes, ["_name", "_d"], "_m", -1, "_s2", "_c2").drop("_s", "_c")
    times = running(times, ["_name", "_m"], "_t", 0, "_s1", "_c1").join(minutes, ["_name", "_d", "_m"]).join(days, ["_name", "_d"])
    upto = times.select("_name", "_t", (F.col("_s1") + F.col("_s2") + F.col("_s3")).alias("_sum"), (F.col("_c1") + F.col("_c2") + F.col("_c3")).alias("_n"))
    rows = marks.join(upto, ["_name", "_t"]).groupBy("event_id").agg(F.sum(F.col("_k") * F.col("_sum")).alias("_sum"), F.sum(F.col("_k") * F.col("_n")).alias("_n"))
    rows = rows.select("event_id", F.when(F.col("_n") > 0, F.col("_sum")).cast("bigint").alias("rows_affected"))
    return ev.select("event_id", "model_name").join(rows, "event_id", "left")


def cycle_state(task_events: DataFrame, key: str = "model_name") -> DataFrame:
    """Current state per (dag, key) from insert-only task events: the latest
    event (by end time, then id) wins; SUCCESS or FAILED."""
    ev = with_model(task_events)
    order = F.struct("end_date", "event_id")
    latest = ev.groupBy("dag_id", key).agg(
        F.max_by(F.struct("layer", "status", "end_date"), order).alias("_l")
    )
    return latest.select(
        "dag_id", key, F.col("_l.layer").alias("layer"),
        F.when(F.col("_l.status") == "success", "SUCCESS").otherwise("FAILED").alias("status"),
        F.col("_l.end_date").alias("updated_at"),
    )


def pending(manifest: DataFrame, state: DataFrame, key: str = "task_id") -> DataFrame:
    """Nodes of the manifest without a SUCCESS state this cycle."""
    done = state.filter(F.col("status") == "SUCCESS").select("dag_id", key)
    return manifest.select("dag_id", key).distinct().join(done, ["dag_id", key], "left_anti")


def clear_dag(state: DataFrame, dag_id: str) -> DataFrame:
    """State table after a DAG's cycle reset."""
    return state.filter(F.col("dag_id") != F.lit(dag_id))
