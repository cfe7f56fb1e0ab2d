"""The two-day scenario: day 1 is the first run of every model, day 2 an incremental run over the stored tables.

``layers`` lists the models of one day in order; each is computed from the sources and the stored tables, written
and read back. Models within a layer are independent of each other and are submitted together.
"""

from __future__ import annotations

import datetime
import threading
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_root, early_cleanup, prepare
from ..sources import fixtures as fx
from ..sources.tables import TableStore
from . import retail, tpch

DAY_TS = {1: fx.DAY1_TS, 2: fx.DAY2_TS}
DAY_DATE = {1: fx.DAY1_DATE, 2: fx.DAY2_DATE}
TPCH_TABLES = ("customer", "lineitem", "nation", "orders", "part", "partsupp", "region", "supplier")
AT_ONCE = 4  # models of a layer that are submitted together

# Layout of each stored table: buckets of its merge key, or months of a date; histories keep closed versions apart. The
# others are small or replaced whole.
LAYOUT: dict[str, dict] = {
    "bronze_customer": {"keys": ["customer_key"]}, "bronze_lineitem": {"keys": ["order_key", "line_number"]},
    "bronze_orders": {"keys": ["order_key"]}, "bronze_part": {"keys": ["part_key"]},
    "bronze_partsupp": {"keys": ["part_key", "supplier_key"]}, "bronze_supplier": {"keys": ["supplier_key"]},
    "silver_customer": {"keys": ["customer_key"]}, "silver_lineitem": {"month_of": "ship_date", "keys": ["order_key", "line_number"]},
    "silver_orders": {"keys": ["order_key"]}, "silver_part": {"keys": ["part_key"]},
    "silver_partsupp": {"keys": ["part_key", "supplier_key"]}, "silver_supplier": {"keys": ["supplier_key"]},
    "snap_customer": {"keys": ["customer_key"], "open_until": "valid_to"}, "snap_supplier": {"keys": ["supplier_key"], "open_until": "valid_to"},
    "dim_part": {"keys": ["part_key"]}, "fact_lineitem": {"month_of": "ship_date", "keys": ["order_key", "line_number"]}, "fact_orders": {"keys": ["order_key"]},
    "stg_customers": {"keys": ["customer_id"]}, "stg_order_items": {"keys": ["order_id", "order_item_id"]},
    "stg_orders": {"keys": ["order_id"]}, "stg_payments": {"keys": ["order_id", "payment_sequential"]},
    "stg_products": {"keys": ["product_id"]}, "fct_orders": {"keys": ["order_id"]}, "scd_fct_orders": {"keys": ["order_id"], "open_until": "valid_to"},
}

Model = tuple[str, Callable[[], DataFrame]]


def tpch_layers(day: int, source: Callable[[str], DataFrame], stored: Callable[[str], DataFrame | None]) -> dict[str, list[Model]]:
    ts, run_date = DAY_TS[day], DAY_DATE[day]

    def bronze(t: str) -> DataFrame:
        src = source(f"src_{t}")
        return tpch.bronze(t, src.filter("in_day1") if day == 1 else src, stored(f"bronze_{t}"), ts)

    def rows(t: str) -> DataFrame:
        """The stored bronze table; on day 2 changed rows have come into it too (append alone never lets them in)."""
        held = stored(f"bronze_{t}")
        return held.unionByName(source(f"fx_{t}_v2"), allowMissingColumns=True) if day == 2 else held

    def silver(t: str, model, *more) -> Model:
        return f"silver_{t}", lambda: model(rows(t), stored(f"silver_{t}"), *more)

    return {
        "bronze": [(f"bronze_{t}", lambda t=t: bronze(t)) for t in TPCH_TABLES],
        "silver": [
            silver("customer", tpch.silver_customer), silver("lineitem", tpch.silver_lineitem),
            silver("orders", tpch.silver_orders, run_date), silver("part", tpch.silver_part),
            silver("partsupp", tpch.silver_partsupp), silver("supplier", tpch.silver_supplier),
            ("silver_nation_region", lambda: tpch.silver_nation_region(stored("bronze_nation"), stored("bronze_region"), stored("silver_nation_region"))),
        ],
        "snapshot": [
            ("snap_customer", lambda: tpch.snapshot_customer(stored("snap_customer"), stored("silver_customer"), ts)),
            ("snap_supplier", lambda: tpch.snapshot_supplier(stored("snap_supplier"), stored("silver_supplier"), ts)),
        ],
        "gold": [
            ("dim_customer", lambda: tpch.dim_customer(stored("snap_customer"), stored("silver_nation_region"))),
            ("dim_supplier", lambda: tpch.dim_supplier(stored("snap_supplier"), stored("silver_nation_region"))),
            ("dim_part", lambda: tpch.dim_part(stored("silver_part"), stored("silver_partsupp"), stored("dim_part"))),
            ("dim_date", lambda: tpch.dim_date(SparkSession.active())),
            ("fact_lineitem", lambda: tpch.fact_lineitem(stored("silver_lineitem"), stored("silver_orders"), stored("fact_lineitem"))),
        ],
        "mart": [
            ("fact_orders", lambda: tpch.fact_orders(stored("fact_lineitem"), stored("fact_orders"))),
            ("mart_sales_summary", lambda: tpch.mart_sales_summary(stored("fact_lineitem"), stored("dim_customer"), stored("dim_date"))),
            ("mart_supplier_performance", lambda: tpch.mart_supplier_performance(stored("fact_lineitem"), stored("dim_supplier"))),
        ],
        "mart of marts": [("mart_customer_segment", lambda: tpch.mart_customer_segment(stored("fact_orders"), stored("dim_customer")))],
    }


def retail_layers(day: int, source: Callable[[str], DataFrame], stored: Callable[[str], DataFrame | None]) -> dict[str, list[Model]]:
    def raw(n: str) -> DataFrame:
        held = fx.day_slice(source(f"fx_raw_{n}"), day)
        return held.unionByName(source(f"fx_raw_{n}_v2")) if day == 2 else held

    def staged(n: str, model) -> Model:
        return f"stg_{n}", lambda: model(raw(n), stored(f"stg_{n}"))

    return {
        "silver": [staged("customers", retail.stg_customers), staged("order_items", retail.stg_order_items),
                   staged("orders", retail.stg_orders), staged("payments", retail.stg_payments), staged("products", retail.stg_products)],
        "gold": [
            ("dim_customer_retail", lambda: retail.dim_customer(stored("stg_customers"))),
            ("dim_product", lambda: retail.dim_product(stored("stg_products"))),
            ("dim_date_retail", lambda: retail.dim_date(SparkSession.active())),
            ("fct_orders", lambda: retail.fct_orders(stored("stg_orders"), stored("stg_order_items"), stored("stg_payments"), stored("fct_orders"))),
        ],
        "snapshot": [("scd_fct_orders", lambda: retail.snapshot_orders(stored("scd_fct_orders"), stored("fct_orders"), DAY_TS[day]))],
        "mart": [("mart_revenue_kpis", lambda: retail.mart_revenue_kpis(
            stored("fct_orders"), stored("dim_customer_retail"), stored("stg_order_items"), stored("dim_product"), stored("dim_date_retail")))],
    }


FAMILIES = {"tpch": tpch_layers, "retail": retail_layers}

# The stored tables that each model reads, its own aside.
READS: dict[str, tuple[str, ...]] = {
    **{f"silver_{t}": (f"bronze_{t}",) for t in ("customer", "lineitem", "orders", "part", "partsupp", "supplier")},
    "silver_nation_region": ("bronze_nation", "bronze_region"),
    "snap_customer": ("silver_customer",), "snap_supplier": ("silver_supplier",),
    "dim_customer": ("snap_customer", "silver_nation_region"), "dim_supplier": ("snap_supplier", "silver_nation_region"),
    "dim_part": ("silver_part", "silver_partsupp"), "fact_lineitem": ("silver_lineitem", "silver_orders"),
    "fact_orders": ("fact_lineitem",), "mart_sales_summary": ("fact_lineitem", "dim_customer", "dim_date"),
    "mart_supplier_performance": ("fact_lineitem", "dim_supplier"), "mart_customer_segment": ("fact_orders", "dim_customer"),
    "dim_customer_retail": ("stg_customers",), "dim_product": ("stg_products",),
    "fct_orders": ("stg_orders", "stg_order_items", "stg_payments"), "scd_fct_orders": ("fct_orders",),
    "mart_revenue_kpis": ("fct_orders", "dim_customer_retail", "stg_order_items", "dim_product", "dim_date_retail"),
}


def needed(tables: Iterable[str]) -> frozenset[str]:
    """``tables`` and all that they are made from."""
    out: set[str] = set()
    left = list(tables)
    while left:
        name = left.pop()
        if name not in out:
            out.add(name)
            left += READS.get(name, ())
    return frozenset(out)


class Run:
    """The tables of one warehouse, and a log row for each model attempt."""

    def __init__(self, spark: SparkSession, sf_dir: str, store: TableStore | None = None):
        self.spark, self.sf_dir = prepare(spark), sf_dir
        self.store = store or TableStore(spark)
        self.log: list[tuple] = []

    def get(self, name: str) -> DataFrame:
        df = self.store.read(name)
        if df is None:
            raise KeyError(name)
        return df

    def put(self, day: int, layer: str, name: str, build: Callable[[], DataFrame]) -> None:
        """Compute a model (including its scalar jobs), write it and log the attempt."""
        now = lambda: datetime.datetime.now(datetime.UTC).replace(tzinfo=None)
        start, status, error = now(), "error", None
        try:
            df, layout = build(), LAYOUT.get(name, {})
            if layer == "bronze":
                self.store.append(name, df, **layout)
            else:
                self.store.write(name, df, **layout)
            status = "success"
        except Exception as e:
            error = str(e)[:4000]
            raise
        finally:
            rows = self.store.rows_written.get(name) if status == "success" else None
            self.log.append((day, "gold" if layer.startswith("mart") else layer, name, status, start, now(), rows, error))

    def run(self, domains: tuple[str, ...] = ("tpch", "retail"), days: tuple[int, ...] = (1, 2), at_once: int = AT_ONCE,
            only: frozenset[str] | None = None) -> Run:
        """All models of the domains, or those that make the tables ``only``."""
        source = lambda n: fx.fixture(self.spark, self.sf_dir, n)
        with early_cleanup(self.spark), ThreadPoolExecutor(at_once) as pool:
            for day in days:
                for domain in domains:
                    for layer, models in FAMILIES[domain](day, source, self.store.read).items():
                        for done in [pool.submit(self.put, day, layer, n, f) for n, f in models if only is None or n in only]:
                            done.result()
        return self

    def run_log(self) -> DataFrame:
        """This run's model log, shaped like the run-log inputs of ``operators.runlog`` (``run_id`` = day)."""
        return self.spark.createDataFrame(
            self.log,
            "run_id int, layer string, model_name string, status string, started_at timestamp_ntz, "
            "ended_at timestamp_ntz, rows_affected long, message string",
        )


_BUILT: dict[tuple, list[tuple[frozenset[str] | None, Run]]] = {}
_LOCK = threading.Lock()
_LOCKS: dict[tuple, threading.Lock] = {}


def input_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and times of the input files."""
    root = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    out = []
    for s in fs.listStatus(root):
        files = fs.listStatus(s.getPath()) if s.isDirectory() else [s]
        out += [(str(f.getPath()), f.getLen(), f.getModificationTime()) for f in files]
    return tuple(sorted(out))


def built(spark: SparkSession, sf_dir: str, domain: str, *tables: str) -> Run:
    """The two-day run of one domain, or of ``tables`` and what they are made from. It is kept for the session as long as the
    input files stay as they are, and serves all later calls whose tables it has."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), domain, input_state(spark, sf_dir))
    only = needed(tables) if tables else None
    with _LOCK:
        checkpoint_root(prepare(spark))
        lock = _LOCKS.setdefault(key, threading.Lock())
    with lock:  # other domains can run meanwhile
        runs = _BUILT.setdefault(key, [])
        for made, run in runs:
            if made is None or (only is not None and only <= made):
                return run
        run = Run(spark, sf_dir).run(domains=(domain,), only=only)
        runs.append((only, run))
        return run
