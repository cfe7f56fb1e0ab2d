"""The table store's state on disk, partition-scoped merges, and streams that continue."""

import datetime as dt
import json
import os
import subprocess
import sys
import time
from glob import glob

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tierforge.operators.incremental import append_new, high_water, merge_upsert
from tierforge.operators.scd2 import scd2_apply
from tierforge.plans import tpch
from tierforge.plans.runner import Run, needed
from tierforge.session import SHUFFLE_CLEANUP
from tierforge.sources import fixtures as fx
from tierforge.sources import tables
from tierforge.sources.tables import TableStore
from tierforge.streaming.microbatch import run_available


def files(store, name):
    """Data files of a table."""
    return set(glob(f"{store.root}/{name}/data-*/_p=*/*.parquet"))


def rows(df):
    return sorted(map(str, df.collect()))


def test_reopened_store_appends_and_merges(spark, tmp_path):
    root = str(tmp_path / "s")
    a = TableStore(spark, root, buckets=4)
    a.write("t", spark.range(10).selectExpr("id as k", "id as v"), keys=["k"])
    a.append("t", spark.range(10, 15).selectExpr("id as k", "id as v"))
    b = TableStore(spark, root, buckets=99)  # the layout of the first write stays
    assert b.exists("t") and b.read("t").count() == 15
    b.append("t", append_new(spark.range(12, 16).selectExpr("id as k", "id as v"), b.read("t"), ["k"]))
    assert b.read("t").count() == 16
    c = TableStore(spark, root)
    c.write("t", merge_upsert(c.read("t"), spark.range(3).selectExpr("id as k", "-1L as v"), ["k"]))
    d = TableStore(spark, root).read("t")
    assert d.count() == 16 and d.filter("v = -1").count() == 3


def test_reopened_history(spark, tmp_path):
    root = str(tmp_path / "s")
    schema = "k int, a string"
    a = TableStore(spark, root, buckets=4)
    one = spark.createDataFrame([(i, "x") for i in range(20)], schema)
    two = spark.createDataFrame([(i, "y" if i == 3 else "x") for i in range(20)], schema)
    a.write("h", scd2_apply(None, one, "k", ["a"], "2024-01-01 00:00:00"), keys=["k"], open_until="valid_to")
    b = TableStore(spark, root)
    before = files(b, "h")
    b.write("h", scd2_apply(b.read("h"), two, "k", ["a"], "2024-01-02 00:00:00"))
    got = TableStore(spark, root).read("h")
    assert got.count() == 21 and got.filter("k = 3").count() == 2 and b.rows_written["h"] == 2
    # the three buckets without a change keep their files
    assert len(files(b, "h") & before) == len(before) - 1


def test_closed_versions_stay_as_they_are(spark, tmp_path):
    """Runs with changes, a hard delete of a bucket's only key and a return: no closed row is rewritten, none is lost."""
    store = TableStore(spark, str(tmp_path / "s"), buckets=3)
    load = lambda v, keys: spark.createDataFrame([(k, v.get(k, "x")) for k in keys], "k int, a string")
    loads = [load({}, range(6)), load({1: "y"}, range(6)), load({1: "z"}, [0, 1, 2, 4, 5]), load({1: "z"}, [1]), load({1: "z", 3: "back"}, [1, 3])]
    whole, closed = None, set()
    for day, rows_ in enumerate(loads, 1):
        at = f"2024-01-0{day} 00:00:00"
        whole = scd2_apply(whole, rows_, "k", ["a"], at, hard_deletes=True)
        store.write("h", scd2_apply(store.read("h"), rows_, "k", ["a"], at, hard_deletes=True), keys=["k"], open_until="valid_to")
        now = {f: os.path.getmtime(f) for f in files(store, "h") if "_p=closed" in f}
        assert closed <= set(now.items())
        closed = set(now.items())
        assert rows(store.read("h")) == rows(whole)
        assert store.read("h", still_open=True).filter("valid_to is not null").count() == 0
    assert len({f.split("_p=")[1].split("/")[0] for f, _ in closed}) == 3  # one partition a run that closed any


def test_second_process_continues(tmp_path):
    """Day 1 and day 2 of one table in two processes."""
    code = """
import sys
from pyspark.sql import SparkSession
from tierforge.session import prepare
from tierforge.sources.tables import TableStore
from tierforge.operators.incremental import append_new
spark = prepare(SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate())
store = TableStore(spark, sys.argv[1])
src = spark.range(int(sys.argv[2])).selectExpr("id as k", "cast('2024-01-0" + sys.argv[3] + "' as timestamp_ntz) as _loaded_at")
store.append("bronze", append_new(src, store.read("bronze"), ["k"]), keys=["k"])
print("ROWS", store.read("bronze").count(), store.read("bronze").filter("_loaded_at = timestamp_ntz'2024-01-01'").count())
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = [subprocess.run([sys.executable, "-c", code, str(tmp_path / "w"), n, day], cwd=root, capture_output=True, text=True, timeout=300).stdout for n, day in (("10", "1"), ("25", "2"))]
    assert "ROWS 10 10" in out[0] and "ROWS 25 10" in out[1]


def test_replacement_goes_to_a_new_folder(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"))
    for n in range(1, 5):
        store.write("t", spark.range(n))
    assert sorted(x for x in os.listdir(tmp_path / "s" / "t") if x.startswith("data")) == ["data-4"]
    assert store.read("t").count() == 4 and spark.table(store.view("t")).count() == 4
    spark.range(100).write.parquet(str(tmp_path / "s" / "t" / "data-5" / "_p=0"))  # a write that died before its marker
    again = TableStore(spark, store.root)
    assert again.read("t").count() == 4
    again.write("t", again.read("t").filter("id > 0"))
    assert again.read("t").count() == 3


def test_merge_overwrites_touched_buckets_only(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"), buckets=16)
    store.write("t", spark.range(5000).selectExpr("id as k", "id * 2 as v").repartition(8), keys=["k"])
    before = files(store, "t")
    assert len(before) <= 16
    store.write("t", merge_upsert(store.read("t"), spark.createDataFrame([(7, -1), (9999, -1)], "k int, v long"), ["k"]))
    after = files(store, "t")
    assert len(before & after) >= 14 and len(after) <= 16 and store.rows_written["t"] == 2
    got = store.read("t")
    assert got.count() == 5001 and got.filter("v = -1").count() == 2


def test_merge_that_died_is_repeated(spark, tmp_path):
    """The marker of a merge is lost after its files were moved: the batch, given again, leaves the same rows."""
    store = TableStore(spark, str(tmp_path / "s"), buckets=4)
    store.write("t", spark.range(100).selectExpr("id as k", "id as v"), keys=["k"])
    marker = glob(f"{store.root}/t/runs/1.json")[0]
    text = open(marker).read()
    batch = spark.createDataFrame([(7, -1), (500, -1)], "k long, v long")
    store.write("t", merge_upsert(store.read("t"), batch, ["k"]))
    want = rows(store.read("t"))
    os.remove(f"{store.root}/t/runs/2.json")
    with open(marker, "w") as f:
        f.write(text)
    for crc in glob(f"{store.root}/t/runs/.*.crc"):
        os.remove(crc)
    store.write("t", merge_upsert(store.read("t"), batch, ["k"]))
    assert rows(store.read("t")) == want


def test_appends_stay_few_files(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"), buckets=2)
    for n in range(50):
        source = spark.range(10 * n + 10).selectExpr("id as k", f"{n} as v").coalesce(1)
        store.append("t", append_new(source, store.read("t"), ["k"]), keys=["k"])
        assert store.rows_written["t"] == 10
    per = {p: len(glob(f"{p}/*.parquet")) for p in glob(f"{store.root}/t/data-*/_p=*")}
    assert len(per) == 2 and max(per.values()) <= tables.SMALL_FILES
    got = store.read("t")
    assert got.count() == 500 and got.select("k").distinct().count() == 500 and got.filter("v <> floor(k / 10)").count() == 0


def test_null_keys_are_spread(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"), buckets=8)
    store.write("t", spark.range(4000).selectExpr("cast(null as bigint) as k", "id as v"), keys=["k"])
    per = [spark.read.parquet(f).count() for f in files(store, "t")]
    assert len(per) == 8 and sum(per) == 4000 and max(per) < 1000


def test_schema_sync_reaches_untouched_buckets(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"), buckets=8)
    store.write("t", spark.range(100).selectExpr("id as k", "id as v"), keys=["k"])
    upd = spark.createDataFrame([(1, "n")], "k long, w string")
    store.write("t", merge_upsert(store.read("t"), upd, ["k"], sync_schema=True))
    got = store.read("t")
    assert got.columns == ["k", "w"] and got.count() == 100 and got.filter("w is not null").count() == 1


def test_month_layout_lasts(spark, tmp_path):
    """After three merges, also of rows that move to another month, a file holds one month."""
    store = TableStore(spark, str(tmp_path / "s"))
    base = spark.range(2000).selectExpr("id as k", "date_add(date'2024-01-15', cast(id % 300 as int)) as d", "0 as v")
    store.write("t", base, month_of="d", keys=["k"])
    for n in range(1, 4):
        upd = spark.range(0, 2000, 97 * n).selectExpr("id as k", f"date_add(date'2024-02-01', cast(id % 290 as int)) as d", f"{n} as v")
        store.write("t", merge_upsert(store.read("t"), upd, ["k"]))
    got = store.read("t")
    assert got.count() == 2000 and got.select("k").distinct().count() == 2000
    months = got.groupBy(F.input_file_name().alias("f")).agg(F.count_distinct(F.date_format("d", "yyyy-MM")).alias("n"))
    assert months.filter("n > 1").count() == 0
    of_day = got.filter("d = date'2024-05-05'").select(F.input_file_name()).distinct().count()
    assert of_day <= len([f for f in files(store, "t") if "_p=2024-05" in f])


def test_merge_into_months_opens_touched_months_only(spark, tmp_path):
    """The files of other months, and other buckets of the keys' months, are unreadable: the merge does not notice."""
    store = TableStore(spark, str(tmp_path / "s"), buckets=32)
    base = spark.range(300).selectExpr("id as k", "add_months(date'2024-01-15', cast(id % 6 as int)) as d", "0 as v")
    store.write("t", base, month_of="d", keys=["k"])
    upd = spark.createDataFrame([(1, dt.date(2024, 2, 20), 1), (7, dt.date(2024, 4, 2), 1), (900, dt.date(2024, 4, 3), 1)], "k long, d date, v int")
    part = store._part(upd, store.state("t/months")["layout"], 0)
    mine = {r[0] for r in upd.select(part).collect()}
    broken = {f for f in files(store, "t") if f.split("_p=")[1][:7] not in ("2024-02", "2024-04")}
    broken |= {f for f in files(store, "t/months") if f.split("_p=")[1].split("/")[0] not in mine}
    saved = {f: open(f, "rb").read() for f in broken}
    for f in broken:
        with open(f, "wb") as out:
            out.write(b"broken")
    store.write("t", merge_upsert(store.read("t"), upd, ["k"]))
    for f, data in saved.items():
        with open(f, "wb") as out:
            out.write(data)
        crc = os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    got = {r["k"]: r["d"] for r in store.read("t").filter("k in (1, 7, 900)").collect()}
    assert got == {1: dt.date(2024, 2, 20), 7: dt.date(2024, 4, 2), 900: dt.date(2024, 4, 3)} and store.read("t").count() == 301
    held = {r["k"]: r["month"] for r in store.read("t/months").collect()}
    assert len(held) == 301 and held[7] == held[900] == "2024-04" and held[1] == "2024-02" and held[2] == "2024-03"


def test_month_that_loses_its_last_row_goes(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"))
    store.write("t", spark.sql("select 1L as k, date'2024-01-05' as d union all select 2L, date'2024-02-05'"), month_of="d", keys=["k"])
    store.write("t", merge_upsert(store.read("t"), spark.sql("select 1L as k, date'2024-02-07' as d"), ["k"]))
    assert rows(store.read("t")) == ["Row(k=1, d=datetime.date(2024, 2, 7))", "Row(k=2, d=datetime.date(2024, 2, 5))"]


def test_row_counts_and_typed_marks(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"))
    store.write("t", spark.range(50_000).selectExpr("id as k", "id as _loaded_at", "date_add(date'2024-01-01', cast(id % 99 as int)) as d"), month_of="d", keys=["k"])
    assert store.rows_written["t"] == store.read("t").count() == 50_000
    store.write("n", spark.createDataFrame([(1, 9), (2, 10)], "k long, _loaded_at long"), keys=["k"])
    store.append("n", spark.createDataFrame([(3, 8)], "k long, _loaded_at long"))
    assert spark.range(1).select(high_water(store.read("n"), "_loaded_at")).first()[0] == 10


def test_empty_tables(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"))
    store.write("t", spark.range(0).selectExpr("id as k", "id as v"), keys=["k"])
    assert store.exists("t") and store.read("t").count() == 0 and store.read("none") is None
    store.write("t", merge_upsert(store.read("t"), spark.range(2).selectExpr("id as k", "id as v"), ["k"]))
    assert store.read("t").count() == 2
    none = spark.range(0).selectExpr("id as k", "id as v")
    store.write("t", merge_upsert(store.read("t"), none, ["k"]))
    store.append("t", none)
    assert store.read("t").count() == 2 and store.rows_written["t"] == 0
    dated = spark.range(3).selectExpr("id as k", "date'2024-01-05' as d")
    store.write("m", dated, month_of="d", keys=["k"])
    store.write("m", merge_upsert(store.read("m"), dated.filter("k > 9"), ["k"]))
    history = scd2_apply(None, dated, "k", ["d"], "2024-01-01 00:00:00")
    store.write("h", history, keys=["k"], open_until="valid_to")
    store.write("h", scd2_apply(store.read("h"), dated, "k", ["d"], "2024-01-02 00:00:00"))
    assert store.read("m").count() == store.read("h").count() == 3 and store.rows_written["m"] == store.rows_written["h"] == 0


def landing(spark, tmp_path):
    li = fx.fixture(spark, SF_SMALL, "fx_lineitem")
    src = str(tmp_path / "landing")
    fx.day_slice(li, 1).write.parquet(f"{src}/day=1")
    return li, src, spark.read.parquet(f"{src}/day=1").schema


def test_restarted_stream_continues(spark, tmp_path):
    li, src, schema = landing(spark, tmp_path)
    root, ckpt = str(tmp_path / "store"), str(tmp_path / "ckpt")
    run_available(spark, f"{src}/*", schema, tpch.silver_lineitem, TableStore(spark, root), "silver_lineitem", checkpoint_location=ckpt)
    li.filter("_loaded_at > timestamp_ntz'2024-01-01 00:00:00'").write.parquet(f"{src}/day=2")
    again = TableStore(spark, root)  # a new process has a new store on the same root
    run_available(spark, f"{src}/*", schema, tpch.silver_lineitem, again, "silver_lineitem", checkpoint_location=ckpt)

    batch = tpch.silver_lineitem(fx.day_slice(li, 2), tpch.silver_lineitem(fx.day_slice(li, 1), None))
    got = again.read("silver_lineitem")
    assert got.count() == batch.count() == 4272
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0


def test_replayed_batch_is_skipped(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"))
    batch = spark.createDataFrame([(1, "a"), (None, "n")], "k long, v string")
    for _ in range(2):  # NULL keys match nothing, so a plain second append would insert them again
        store.append("t", append_new(batch, store.read("t"), ["k"]), keys=["k"], batch="stream#0")
    assert store.read("t").count() == 2
    store.append("t", append_new(batch, store.read("t"), ["k"]), batch="stream#1")
    assert store.read("t").count() == 3


def test_slow_stream_among_fast_ones(spark, tmp_path):
    """A batch of one stream stays known however many batches other streams bring."""
    store = TableStore(spark, str(tmp_path / "s"))
    one = spark.createDataFrame([(None, "n")], "k long, v string")
    store.append("t", one, keys=["k"], batch="slow#0")
    state = store.state("t")
    path = glob(f"{store.root}/t/runs/*.json")[0]
    state["streams"].update({f"fast{i}": 10_000 for i in range(200)})
    for crc in glob(f"{store.root}/t/runs/.*.crc"):
        os.remove(crc)
    with open(path, "w") as f:
        json.dump(state, f)
    store.append("t", one, batch="slow#0")
    assert store.read("t").count() == 1 and store.rows_written["t"] == 0
    store.append("t", one, batch="slow#1")
    assert store.read("t").count() == 2


def test_runner_logs_each_model_attempt(spark):
    from tierforge.operators import runlog as L
    from tierforge.plans.runner import built

    run = built(spark, SF_SMALL, "tpch")
    seen = {(x.run_id, x.model_name): x for x in run.run_log().collect()}
    assert seen[(1, "silver_lineitem")].status == "success"
    # day 2 puts in the update rows, not the merged table
    assert 0 < seen[(2, "silver_lineitem")].rows_affected < run.store.read("silver_lineitem").count()
    assert seen[(1, "fact_lineitem")].rows_affected == seen[(1, "silver_lineitem")].rows_affected
    roll = {(x.run_id, x.layer): x.status for x in L.rollup(run.run_log()).collect()}
    assert set(roll.values()) == {"SUCCESS"} and {layer for _, layer in roll} == {"bronze", "silver", "snapshot", "gold"}


def test_changed_input_is_not_served_from_memory(spark, tmp_path):
    import shutil

    from tierforge.plans.runner import input_state

    shutil.copytree(SF_SMALL, tmp_path / "in")
    first = input_state(spark, str(tmp_path / "in"))
    p = tmp_path / "in" / "region.parquet"
    os.chmod(p, 0o644)
    t = dt.datetime.now().timestamp() + 60
    os.utime(p, (t, t))
    assert input_state(spark, str(tmp_path / "in")) != first


def test_merge_shuffles_stored_rows_once(spark, tmp_path, monkeypatch):
    """Stored rows that stay are written from where they met the keys of the batch: by partition, with no other shuffle."""
    plans, plain = [], TableStore._save

    def noted(self, df, folder, layout, run, mode="overwrite", kept=None):
        if kept is not None:
            plans.append(kept._jdf.queryExecution().executedPlan().toString())
        return plain(self, df, folder, layout, run, mode, kept)

    monkeypatch.setattr(TableStore, "_save", noted)
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        store = TableStore(spark, str(tmp_path / "s"))
        base = spark.range(300).selectExpr("id as k", "id % 3 as l", "add_months(date'2024-01-15', cast(id % 6 as int)) as d", "0 as v")
        upd = spark.range(200, 400).selectExpr("if(id % 50 = 0, null, id) as k", "id % 3 as l", "add_months(date'2024-01-15', cast(id % 5 as int)) as d", "1 as v")
        for name, layout in (("b", {}), ("m", {"month_of": "d"})):
            store.write(name, base, keys=["k", "l"], **layout)
            store.write(name, merge_upsert(store.read(name), upd, ["k", "l"]))
            got = sorted((r["k"] or -1, r["d"], r["v"]) for r in store.read(name).collect())
            kept = base.filter("k < 200 or k % 50 = 0").unionByName(upd)  # a NULL key replaces nothing
            assert got == sorted((r["k"] or -1, r["d"], r["v"]) for r in kept.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert len(plans) == 3  # the buckets; the lookup of months and the months
    for plan in plans:
        assert plan.count("Exchange hashpartitioning(_p#") == plan.count("Exchange") == 2 and plan.count(", REBALANCE_PARTITIONS_BY_COL") == 2
        assert all("_p#" in x and "," not in x.split("hashpartitioning(")[1].split(", 8)")[0] for x in plan.splitlines() if "Exchange" in x)


def test_run_leaves_no_shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    shuffled = lambda: {f for d in dirs for f in glob(f"{d}/*/shuffle_*.data")}
    before, set_to = shuffled(), spark.conf.get(SHUFFLE_CLEANUP, None)
    Run(spark, SF_SMALL).run(domains=("tpch",), only=needed(["silver_part"]))
    late = time.time() + 10
    while shuffled() - before and time.time() < late:
        time.sleep(0.1)
    assert not shuffled() - before and spark.conf.get(SHUFFLE_CLEANUP, None) == set_to


def test_tables_and_batches_are_compressed_by_zstd(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"))
    store.write("t", spark.range(10).selectExpr("id as k"), keys=["k"])
    batch = merge_upsert(store.read("t"), spark.range(5, 15).selectExpr("id as k"), ["k"])
    staged = glob(f"{getattr(batch, tables.MERGE_ATTR)[1].stored_at.removeprefix('file:')}/*.parquet")
    assert staged and files(store, "t") and all(".zstd." in f for f in [*staged, *files(store, "t")])
