"""Helpers that several operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session
from ..session import SHUFFLE_CLEANUP

__all__ = ["SHUFFLE_CLEANUP", "bucketed", "connected_components", "discard", "in_fold", "read", "set_aside", "stored"]


def stored(df: DataFrame, label: str) -> DataFrame:
    """``session.stored``, whose shuffle files go when the table is written."""
    with session.early_cleanup(df.sparkSession):
        return session.stored(df, label)


def bucketed(df: DataFrame, label: str, *by: str) -> DataFrame:
    """``stored``, in as many buckets as a shuffle has partitions: grouping or joining by the same columns does not shuffle it again."""
    spark = df.sparkSession
    path = session.scratch_dir(spark, label)
    name = "tierforge_" + uuid.uuid4().hex
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with session.early_cleanup(spark):
        df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").option("path", path).bucketBy(buckets, *by).saveAsTable(name, format="parquet")
    back = spark.table(name)
    back.stored_at, back.stored_as = path, name
    return back


def discard(df: DataFrame) -> None:
    """Delete a ``stored`` or ``bucketed`` table that nothing reads any more."""
    if "stored_as" in vars(df):
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {df.stored_as}")
    session.discard(df)


def set_aside(df: DataFrame, *keep: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` whose columns but ``keep`` have names that no operator uses, and how a frame of these columns gets them back."""
    names, seen = df.columns, set()
    inner = []
    for i, c in enumerate(names):
        inner.append(c if c in keep and c not in seen else f"_aside_{i}")
        seen.add(c)
    return df.toDF(*inner), lambda out: out.toDF(*names)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def in_fold(column: str, folds: int) -> "F.Column":
    """crc32 of the id as text, modulo ``folds`` (a null id: fold 0 of its empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` (bigint) to ``(node, root)``: every node of an edge with the smallest node it reaches.

    Each round maps a node to the smallest of itself and its neighbours, twice over, and contracts the
    edges by that map; at least half of the nodes that still have edges vanish, so rounds grow with the
    logarithm of the longest chain. Only aggregates and joins by node: a hub is pre-aggregated before the
    shuffle and its join side can be split. Nothing but the number of edges left reaches the driver.
    """
    pairs = edges.filter("a <> b")
    both = stored(pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc-edges")
    nodes = both.select(F.col("a").alias("node")).distinct().withColumn("root", F.col("node"))
    while not both.isEmpty():
        parent = stored(both.groupBy("a").agg(F.least("a", F.min("b")).alias("p")), "cc-parents")
        up = parent.select(F.col("a").alias("p"), F.col("p").alias("pp"))
        jump = stored(parent.join(up, "p").select("a", F.col("pp").alias("to")), "cc-jump")
        mapped = stored(
            nodes.join(jump.withColumnRenamed("a", "root"), "root", "left").select("node", F.coalesce("to", "root").alias("root")),
            "cc-nodes",
        )
        left = stored(
            both.join(jump.withColumnRenamed("to", "ra"), "a")
            .join(jump.select(F.col("a").alias("b"), F.col("to").alias("rb")), "b")
            .filter("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(),
            "cc-edges",
        )
        for old in (parent, jump, both, nodes):
            if "stored_at" in vars(old):
                discard(old)
        nodes, both = mapped, left
    return nodes
