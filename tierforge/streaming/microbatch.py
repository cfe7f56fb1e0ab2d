"""Incremental models driven by Structured Streaming.

The daily incremental run is a micro-batch: new files land in a source
folder, each trigger applies one model to the new rows and writes the next
version of its table. ``availableNow`` processes everything that has
landed and stops, which is the streaming form of a scheduled run; the
stream checkpoint records which files were consumed, so a restarted run
resumes where the last one stopped.

The number of the stream's last batch is in the table's marker, so a batch that
is replayed after its run was finished is skipped, NULL keys included.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..session import scratch_dir
from ..sources.tables import TableStore

# model(batch, previous table or None) -> next table
Model = Callable[[DataFrame, DataFrame | None], DataFrame]


def run_available(
    spark: SparkSession,
    source_dir: str,
    schema: StructType,
    model: Model,
    store: TableStore,
    table: str,
    checkpoint_location: str | None = None,
    append: bool = False,
    keys: list[str] | None = None,
) -> str:
    """Apply ``model`` to every not-yet-consumed file of ``source_dir``.

    Returns the stream checkpoint location (pass it again on the next run).
    """
    ckpt = checkpoint_location or scratch_dir(spark, f"stream-{table}")
    stream = spark.readStream.schema(schema).parquet(source_dir)

    def apply(batch: DataFrame, epoch_id: int) -> None:
        name = f"{ckpt}#{epoch_id}"
        if store.has(table, name):
            return
        out = model(batch, store.read(table))
        if append:
            store.append(table, out, keys=keys, batch=name)
        else:
            store.write(table, out, keys=keys, batch=name)

    q = (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", ckpt)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return ckpt
