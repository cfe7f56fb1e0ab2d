import datetime as dt

from pyspark.sql import functions as F

from tierforge.operators import quality as Q
from tierforge.operators import runlog as L


def test_quality_checks_fail_and_pass(spark):
    bad = spark.createDataFrame([(1, "A"), (1, "B"), (None, "Z"), (None, "A")], "k int, s string")
    good = spark.createDataFrame([(1, "A"), (2, "B")], "k int, s string")
    assert Q.unique(bad, "k").count() == 1 and Q.unique(good, "k").count() == 0  # NULLs ignored
    assert Q.not_null(bad, "k").count() == 2 and Q.not_null(good, "k").count() == 0
    assert [tuple(r) for r in Q.accepted_values(bad.unionByName(bad), "s", ["A", "B"]).collect()] == [("Z", 2)] and Q.accepted_values(good, "s", ["A", "B"]).count() == 0
    parent = spark.createDataFrame([(1,)], "p int")
    assert Q.relationships(bad, "k", parent, "p").count() == 0  # NULL child keys ignored
    assert Q.relationships(good, "k", parent, "p").count() == 1
    assert Q.unique_combination(bad, ["k", "s"]).count() == 0
    assert Q.unique_combination(bad.unionByName(bad), ["k", "s"]).count() == 4
    assert Q.null_counts(bad, ["k", "s"]).first().asDict() == {"k": 2, "s": 0}


def test_suite_summary(spark):
    t = {"m": spark.createDataFrame([(1,), (1,), (None,)], "k int")}
    checks = [Q.Check("m", "unique", "k"), Q.Check("m", "not_null", "k")]
    got = {r.test_name: (r.failures, r.status) for r in Q.run_suite(checks, t).collect()}
    assert got == {"unique_m_k": (1, "fail"), "not_null_m_k": (1, "fail")}


def test_model_name_and_layer(spark):
    ids = ["stg_tpch__orders.run", "snap_tpch_customer_snapshot", "tpch_silver_x_run_test", "tpch_date", "other_run"]
    df = spark.createDataFrame([(i,) for i in ids], "task_id string")
    got = [(r.m, r.l) for r in df.select(L.base_model_name(F.col("task_id")).alias("m")).select(
        "m", L.infer_layer(F.col("m")).alias("l")).collect()]
    assert got == [("stg_tpch__orders", "bronze"), ("snap_tpch_customer", "snapshot"), ("tpch_silver_x_run", "silver"),
                   ("tpch_date", "gold"), ("other", "unknown")]


def test_flatten_and_rollup(spark):
    rows = [
        (1, 10, "gold", "model.p.tpch_fact_a", "success", 1.0, None, 5, dt.datetime(2024, 1, 1)),
        (2, 10, "gold", "model.p.tpch_fact_b", "error", 2.0, "x" * 5000, None, dt.datetime(2024, 1, 1)),
        (3, 10, "gold", "test.p.t1", "pass", 0.5, "ignored", None, dt.datetime(2024, 1, 1)),
        (4, 11, "gold", "", "error", 0.1, "", None, dt.datetime(2024, 1, 2)),
    ]
    res = spark.createDataFrame(rows, "result_id long, run_id long, layer string, unique_id string, status string, "
                                      "execution_time double, message string, rows_affected int, started_at timestamp_ntz")
    flat = {r.result_id: r for r in L.flatten_results(L.results_documents(res, ["result_id", "run_id", "layer"])).collect()}
    assert flat[1].model_name == "tpch_fact_a" and flat[1].resource_type == "model" and flat[1].rows_affected == 5
    assert len(flat[2].error_message) == 4000
    assert flat[3].error_message is None
    assert flat[4].resource_type == "unknown" and flat[4].error_message is None
    roll = {r.run_id: r for r in L.rollup(res).collect()}
    assert (roll[10].models_total, roll[10].models_success, roll[10].models_error, roll[10].status) == (3, 1, 1, "FAILED")
    state = {r.layer: r.state for r in L.last_attempt_state(spark, res).collect()}
    assert state == {"gold": "FAILED", "bronze": "NONE", "silver": "NONE", "snapshot": "NONE"}


def test_rows_written_window_and_null(spark):
    T = dt.datetime
    ev = spark.createDataFrame([
        (1, "d", "stg_tpch__a_run", "success", T(2024, 1, 1, 0, 0, 30), T(2024, 1, 1, 0, 1, 30)),
        (2, "d", "stg_tpch__b_run", "success", T(2024, 1, 1, 0, 0, 30), T(2024, 1, 1, 0, 1, 30)),
        (3, "d", "stg_tpch__a_run", "error", T(2024, 1, 1, 0, 0, 30), T(2024, 1, 1, 0, 1, 30)),
    ], "event_id long, dag_id string, task_id string, status string, start_date timestamp_ntz, end_date timestamp_ntz")
    hist = spark.createDataFrame([
        (1, T(2024, 1, 1, 0, 0, 20), "merge into STG_TPCH__A x", "SUCCESS", "MERGE", 5, None),   # on the lower bound
        (2, T(2024, 1, 1, 0, 1, 40), "insert STG_TPCH__A", "SUCCESS", "INSERT", None, 2),         # on the upper bound
        (3, T(2024, 1, 1, 0, 1, 41), "insert STG_TPCH__A", "SUCCESS", "INSERT", 100, None),       # outside
        (4, T(2024, 1, 1, 0, 1, 0), "select STG_TPCH__A", "SUCCESS", "SELECT", 100, None),        # not a write
        (5, T(2024, 1, 1, 0, 1, 0), "insert STG_TPCH__A", "FAIL", "INSERT", 100, None),           # failed
    ], "query_id long, end_time timestamp_ntz, query_text string, execution_status string, query_type string, "
       "rows_inserted long, rows_updated long")
    got = {r.event_id: r.rows_affected for r in L.rows_written(ev, hist).collect()}
    assert got == {1: 7, 2: None, 3: None}


def test_cycle_state_pending_clear(spark):
    T = dt.datetime
    ev = spark.createDataFrame([
        (1, "d1", "m_run", "error", T(2024, 1, 1), T(2024, 1, 1, 0, 1)),
        (2, "d1", "m_run", "success", T(2024, 1, 2), T(2024, 1, 2, 0, 1)),
        (3, "d1", "m_test", "error", T(2024, 1, 2), T(2024, 1, 2, 0, 2)),
        (4, "d2", "x_run", "error", T(2024, 1, 2), T(2024, 1, 2, 0, 2)),
    ], "event_id long, dag_id string, task_id string, status string, start_date timestamp_ntz, end_date timestamp_ntz")
    st = {(r.dag_id, r.model_name): r.status for r in L.cycle_state(ev).collect()}
    assert st == {("d1", "m"): "FAILED", ("d2", "x"): "FAILED"}  # _run and _test share one base name
    pend = {(r.dag_id, r.task_id) for r in L.pending(ev, L.cycle_state(ev, key="task_id")).collect()}
    assert pend == {("d1", "m_test"), ("d2", "x_run")}
    assert L.clear_dag(L.cycle_state(ev), "d1").count() == 1
    d = {r.event_id: r.duration_seconds for r in L.durations(ev).collect()}
    assert d[1] == 60.0 and d[3] == 120.0


def test_read_run_results_files(spark, tmp_path):
    import json

    from tierforge.sources.runlog_files import read_run_results
    docs = {
        "silver": {"results": [{"unique_id": "model.p.tpch_silver_a", "status": "success", "execution_time": 1.5,
                                "adapter_response": {"rows_affected": 10}},
                               {"unique_id": "model.p.tpch_silver_b", "status": "skipped", "execution_time": 0}]},
        "gold": {"results": []},
    }
    for layer, doc in docs.items():
        d = tmp_path / layer
        d.mkdir()
        (d / "run_results.json").write_text(json.dumps(doc, indent=2))
    raw = read_run_results(spark, str(tmp_path / "*" / "run_results.json")).withColumn(
        "layer", F.regexp_extract("source_file", r"/(\w+)/run_results\.json$", 1))
    flat = L.flatten_results(raw)
    got = {r.model_name: (r.layer, r.status, r.rows_affected) for r in flat.collect()}
    assert got == {"tpch_silver_a": ("silver", "success", 10), "tpch_silver_b": ("silver", "skipped", None)}
    roll = {r.layer: r.status for r in L.rollup(flat, keys=("layer",)).collect()}
    assert roll == {"silver": "FAILED"}  # the empty document has no node rows
    st = {r.layer: r.state for r in L.last_attempt_state_docs(spark, raw, "source_file").collect()}
    assert st == {"silver": "FAILED", "gold": "SUCCESS", "bronze": "NONE", "snapshot": "NONE"}
    acts = {r.layer: r.next_action for r in L.last_attempt_state_docs(spark, raw, "source_file").collect()}
    assert acts == {"silver": "RETRY", "gold": "SKIP", "bronze": "BUILD", "snapshot": "BUILD"}


def test_declared_tests_pass_on_the_pipeline_and_fail_on_dirty_copies(spark):
    from conftest import SF_SMALL
    from tierforge.plans import ops

    clean = Q.run_suite(Q.DECLARED_TESTS, ops.clean_tables(spark, SF_SMALL)).collect()
    assert len(clean) == 30 and {r.status for r in clean} == {"pass"}
    dirty = Q.run_suite(Q.DECLARED_TESTS, ops._tables(spark, SF_SMALL)).collect()
    failing = {r.test_name for r in dirty if r.status == "fail"}
    assert {"unique_stg_orders_order_id", "accepted_values_stg_orders_order_status", "relationships_fact_lineitem_part_key",
            "unique_combination_fact_lineitem_order_key__line_number", "not_null_dim_part_part_key"} <= failing


def test_documents_hold_several_results(spark):
    from conftest import SF_SMALL
    from tierforge.sources import fixtures as fx

    res = fx.fixture(spark, SF_SMALL, "fx_run_results")
    docs = L.results_documents(res, ["run_id", "layer"])
    flat = L.flatten_results(docs)
    assert docs.count() < res.count() == flat.count()
    assert sorted(L.rollup(flat).collect()) == sorted(L.rollup(res).collect())


def test_mentions_by_wildcards_in_long_texts(spark):
    """Against a regular expression for each pair: wildcards in names, short and empty names, 10,000-character texts."""
    import random
    import re

    rnd = random.Random(11)
    names = ["stg_a", "x", "_", "", "%", "a%b", "st%_z", "tpch__silver", "é_x", "back\\slash", "no match here", "a.b", "zz%zz%zz", "__", "1%", "%%_"]
    alphabet = "abstgx_z .é%\\1\n"
    texts = ["", "x", "tpch--silver", "stg-a", "back\\slash", "st 123 zz", "a\nb", "é x", "axb", "a.b"]
    texts += ["".join(rnd.choices(alphabet, k=rnd.randrange(40))) for _ in range(150)]
    texts += ["".join(rnd.choices("qwertyuiop ", k=10_000)) + tail for tail in ("stg_a", "tpch_1silver", "zz q zz q zz", "")]
    texts = sorted(set(texts))
    found = L._mentions(spark.createDataFrame([(t,) for t in texts], "_text string"), spark.createDataFrame([(n,) for n in [*names, None]], "_name string"))
    got = sorted((r._text, r._name) for r in found.collect())

    def like(text, name):
        return re.search("".join("." if c == "_" else ".*" if c == "%" else re.escape(c) for c in name), text, re.S)

    assert got == sorted((t, n) for t in texts for n in names if like(t, n))
    assert L._mentions(found.select("_text").limit(0), found.select("_name")).count() == 0
