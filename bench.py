"""Benchmark: the two-day pipeline plus the operator queries.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS] and prints one JSON line. The
pipeline is timed as a whole (``pipeline_sec``, models of a layer submitted together) and once more with one model at a
time: per model, ``queries`` holds the sum over both days of computing and writing its table alone. ``value`` is
the pipeline's wall time plus the operator queries', each timed to completion with a no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from pyspark.sql import SparkSession

    from tierforge.plans import catalog, ops
    from tierforge.plans.runner import _BUILT, Run, input_state
    from tierforge.session import prepare

    scratch = tempfile.mkdtemp(prefix="tierforge-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tierforge-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(int(cpus) * 2)))
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{scratch}/ckpt")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)

    t0 = time.perf_counter()
    run = Run(spark, sf_dir).run()
    pipeline = time.perf_counter() - t0
    for domain in ("tpch", "retail"):
        _BUILT[(spark.sparkContext.applicationId, sf_dir, domain, input_state(spark, sf_dir))] = run
    alone: dict[str, float] = {}
    for _, _, name, _, start, end, _, _ in Run(spark, sf_dir).run(at_once=1).log:
        alone[name] = alone.get(name, 0.0) + (end - start).total_seconds()

    timings = {query: round(alone.get(table, 0.0), 3) for query, (_, table, _) in catalog.MODELS.items()}
    qs, operators = catalog.queries(), 0.0
    for name in ops.OPS:
        t = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t, 3)
        operators += timings[name]
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "two_day_pipeline_plus_operator_queries",
        "value": round(pipeline + operators, 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "pipeline_sec": round(pipeline, 3),
        "operators_sec": round(operators, 3),
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
