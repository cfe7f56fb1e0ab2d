"""Session helpers.

Nothing here hard-codes cluster settings: a cluster session keeps its own
configuration. Defaults are only filled in where a key is unset, which in
practice means tests and local runs.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the models rely on for correct results (not tuning knobs).
REQUIRED_CONF = {
    # All literals and comparisons are wall-clock; UTC keeps Spark and the
    # SQL oracle on the same clock.
    "spark.sql.session.timeZone": "UTC",
}

# Tuning defaults applied only when the key is unset.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tierforge") -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TIERFORGE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply required settings and fill unset tuning defaults."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    for k, v in DEFAULT_CONF.items():
        if spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for materialised tables: ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment (shared storage). Only a
    local-mode session without one gets a fresh folder under the system temp
    directory, as in tests.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if d:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return d.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage "
            "(the table store and checkpoints live there)"
        )
    d = tempfile.mkdtemp(prefix="tierforge-ckpt-")
    spark.conf.set("spark.checkpoint.dir", d)
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir().rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unique folder below the checkpoint root."""
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_HELD: dict[tuple[str, str], list] = {}  # (application, setting) to how many blocks hold it and its value before
_LOCK = threading.Lock()


@contextmanager
def held(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting for the time of a block; blocks of several threads may overlap."""
    at = (spark.sparkContext.applicationId, key)
    with _LOCK:
        _HELD.setdefault(at, [0, spark.conf.get(key, None)])[0] += 1
        spark.conf.set(key, value)
    try:
        yield
    finally:
        with _LOCK:
            _HELD[at][0] -= 1
            if not _HELD[at][0]:
                before = _HELD.pop(at)[1]
                spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def early_cleanup(spark: SparkSession):
    """Shuffle files go when the job that wrote them ends, not when the driver collects its garbage."""
    return held(spark, SHUFFLE_CLEANUP, "true")


def stored(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """``df`` written once below the checkpoint root and read back: later uses don't compute it again, and a
    lost executor costs no more than the running stage. ``stored_at`` of the result is its folder."""
    path = scratch_dir(df.sparkSession, label)
    # nobody else reads it: no marker
    df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path, compression=compression)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.stored_at = path
    return back


def discard(df: DataFrame) -> None:
    """Delete a ``stored`` table that nothing reads any more."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_at)
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
