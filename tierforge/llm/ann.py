"""Approximate nearest neighbours by cross-polytope hashing.

A table turns unit vectors by a pseudo-rotation (three rounds of random signs and a fast Hadamard transform) and
puts each into the bucket of its nearest signed axis, ``hashes`` such axes in a row for finer buckets. A query looks into
the buckets of its ``probes`` nearest axes (best sums for several in a row) of each of ``tables`` tables; all it meets
there is ranked by the exact cosine. Equal vectors are one entry with the smallest ids that a result can need, so
a large group of copies is one candidate. Buckets are cut into chunks of ``CHUNK`` vectors and ``CHUNK`` queries, so
a task never holds more than a chunk of either, whatever the largest bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored

TABLES = 8
PROBES = 16
HASHES = 1
CHUNK = 4096


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row (a power of two wide), scaled to keep lengths."""
    n, d = x.shape
    half = 1
    while half < d:
        x = x.reshape(n, d // (2 * half), 2, half)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2)
        half *= 2
    return x.reshape(n, d) / np.sqrt(d)


def turned(unit: np.ndarray, table: int, part: int) -> np.ndarray:
    """Vectors (a power of two wide) turned by the pseudo-rotation of one hash."""
    rng = np.random.default_rng([97, table, part])
    for _ in range(3):
        unit = hadamard(unit * rng.choice((-1.0, 1.0), unit.shape[1]))
    return unit


def _padded(flat: np.ndarray, dim: int) -> np.ndarray:
    x = flat.reshape(-1, dim)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    return np.pad(x, ((0, 0), (0, (1 << max(0, dim - 1).bit_length()) - dim)))


def _axes(x: np.ndarray) -> np.ndarray:
    """Signed coordinates: first the axes, then their opposites."""
    return np.concatenate((x, -x), axis=1)


def _buckets(unit: np.ndarray, tables: int, hashes: int) -> np.ndarray:
    """Bucket of each vector in each table."""
    out = np.zeros((len(unit), tables), np.int64)
    for t in range(tables):
        for h in range(hashes):
            out[:, t] = out[:, t] * 2 * unit.shape[1] + _axes(turned(unit, t, h)).argmax(axis=1)
    return out


def _probes(unit: np.ndarray, tables: int, hashes: int, probes: int) -> np.ndarray:
    """The most likely buckets of each vector in each table."""
    n, width = len(unit), 2 * unit.shape[1]
    out = np.zeros((n, tables, min(probes, width**hashes)), np.int64)
    rows = np.arange(n)[:, None]
    for t in range(tables):
        best, value = np.zeros((n, 1), np.int64), np.zeros((n, 1))
        for h in range(hashes):
            axes = _axes(turned(unit, t, h))
            near = np.argsort(-axes, axis=1, kind="stable")[:, :probes]
            total = (value[:, :, None] + axes[rows, near][:, None, :]).reshape(n, -1)
            names = (best[:, :, None] * width + near[:, None, :]).reshape(n, -1)
            order = np.argsort(-total, axis=1, kind="stable")[:, :probes]
            best, value = names[rows, order], total[rows, order]
        out[:, t] = best
    return out


def _flat(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)


def _placed(dim: int, tables: int, hashes: int, probes: int):
    """(entry, vector) to (entry, table, bucket): one row a table, or one a probe."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 2048):
                part = batch.slice(lo, 2048)
                unit = _padded(_flat(part.column(1)), dim)
                found = _probes(unit, tables, hashes, probes) if probes else _buckets(unit, tables, hashes)[:, :, None]
                n, _, m = found.shape
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(np.repeat(np.arange(n), tables * m))),
                    pa.array(np.tile(np.repeat(np.arange(tables, dtype=np.int32), m), n)), pa.array(found.reshape(-1)),
                ], ["entry", "table", "bucket"])

    return work


def _meet(dim: int, most: int):
    """A chunk's candidates (query 0) and queries (query 1): each query's ``most`` nearest by exact cosine."""

    def work(rows: pa.Table) -> pa.Table:
        query = rows["query"].to_numpy().astype(bool)
        entry, vector = rows["entry"].to_numpy(), _flat(rows["vector"].combine_chunks()).reshape(-1, dim)
        length = np.linalg.norm(vector, axis=1)
        ids, cand, size = entry[~query], vector[~query], length[~query]
        order = np.argsort(ids)
        ids, cand, size = ids[order], cand[order], size[order]
        out: list[tuple] = []
        if len(ids) and query.any():
            asking, ask, own = entry[query], vector[query], length[query]
            for lo in range(0, len(asking), 256):
                score = (ask[lo:lo + 256] @ cand.T) / (own[lo:lo + 256, None] * size[None, :])
                best = np.argsort(-score, axis=1, kind="stable")[:, :most]  # equal scores: the smaller id
                out.append((np.repeat(asking[lo:lo + 256], best.shape[1]), ids[best].reshape(-1), np.take_along_axis(score, best, 1).reshape(-1)))
        q, c, s = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        return pa.table([pa.array(q), pa.array(c), pa.array(s)], ["asking", "entry", "score"])

    return work


def neighbours(vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", tables: int = TABLES,
               probes: int = PROBES, hashes: int = HASHES, chunk: int = CHUNK) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found for each row that ``is_query`` marks.

    Vectors that are null, zero or hold null or non-finite components take no part, nor do rows without an id or of
    another dimension than most. Of repeated rows (same id and vector) one counts. Ties go to the smaller id. A query
    whose buckets hold fewer than ``k`` others is compared with all vectors, in blocks. A table of fewer than ``k`` other vectors
    gives what there is; an empty one gives no row.
    """
    cast = F.col(vector).cast("array<double>")
    fit = F.forall(cast, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(cast, lambda x: x != 0)
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), cast.alias("vector"), is_query.alias("query"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.coalesce(F.when(F.col("vector").isNotNull(), fit), F.lit(False)))
    common = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    dim = common["dim"] if common else 1
    rows = rows.filter(F.size("vector") == dim)
    # One entry a vector, named by its smallest id, with the k + 1 smallest ids that share it.
    unique = rows.select("vec_id", "vector").groupBy("vec_id", "vector").agg(F.lit(1).alias("one")).drop("one")
    first = W.partitionBy("vector").orderBy("vec_id")
    entries = stored(
        unique.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= k + 1)
        .groupBy("vector").agg(F.min("vec_id").alias("entry"), F.sort_array(F.collect_list("vec_id")).alias("ids")).select("entry", "ids", "vector"),
        "ann-entries",
    )
    queries = rows.filter("query").select(F.col("vec_id").alias("query_id"), "vector").distinct()
    queries = stored(queries.join(entries.select("entry", "vector"), "vector").select("query_id", "entry"), "ann-queries")
    asking = queries.select("entry").distinct().join(entries, "entry").select("entry", "vector")
    place = "entry bigint, table int, bucket bigint"
    index = stored(entries.select("entry", "vector").mapInArrow(_placed(dim, tables, hashes, 0), place), "ann-index")
    probe = stored(asking.mapInArrow(_placed(dim, tables, hashes, probes), place), "ann-probes")
    cut = lambda df, name: df.groupBy("table", "bucket").agg(F.ceil(F.count(F.lit(1)) / F.lit(chunk)).cast("int").alias(name))
    sizes = stored(cut(index, "parts").join(cut(probe, "groups"), ["table", "bucket"]), "ann-sizes")
    every = lambda name: F.explode(F.sequence(F.lit(0), F.col(name) - 1))
    mine = lambda name: F.pmod(F.xxhash64("entry"), F.col(name)).cast("int")
    keys = ["table", "bucket", "part", "group"]
    left = index.join(sizes, ["table", "bucket"]).withColumn("part", mine("parts")).withColumn("group", every("groups"))
    right = probe.join(sizes, ["table", "bucket"]).withColumn("group", mine("groups")).withColumn("part", every("parts"))
    slim = entries.select("entry", "vector")
    both = (left.join(slim, "entry").select(*keys, "entry", "vector", F.lit(0).alias("query"))
            .union(right.join(slim, "entry").select(*keys, "entry", "vector", F.lit(1).alias("query"))))
    found = stored(_nearest(both.groupBy(*keys), dim, entries, queries, k), "ann-found")
    enough = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= k)
    short = stored(queries.join(enough, "query_id", "left_anti"), "ann-short")
    if short.isEmpty():
        return found
    blocks = lambda df: -(-df.count() // chunk) or 1
    ask = short.select("entry").distinct().join(slim, "entry")
    parts, groups = F.lit(blocks(entries)), F.lit(blocks(ask))
    mine = lambda n: F.pmod(F.xxhash64("entry"), n).cast("int")
    left = slim.withColumn("part", mine(parts)).withColumn("group", F.explode(F.sequence(F.lit(0), groups - 1)))
    right = ask.withColumn("group", mine(groups)).withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    both = left.select("part", "group", "entry", "vector", F.lit(0).alias("query")).union(right.select("part", "group", "entry", "vector", F.lit(1).alias("query")))
    rest = _nearest(both.groupBy("part", "group"), dim, entries, short, k)
    return found.join(short, "query_id", "left_anti").union(rest)


def _nearest(met: GroupedData, dim: int, entries: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score of ``queries``, from chunks in which they meet entries."""
    met = met.applyInArrow(_meet(dim, k + 1), "asking bigint, entry bigint, score double")
    met = met.groupBy("asking", "entry").agg(F.max("score").alias("score"))
    near = W.partitionBy("asking").orderBy(F.desc("score"), "entry")
    met = met.withColumn("place", F.row_number().over(near)).filter(F.col("place") <= k + 1).drop("place")
    found = met.join(entries.select("entry", "ids"), "entry").select("asking", "score", F.explode("ids").alias("vec_id"))
    found = found.join(queries.withColumnRenamed("entry", "asking"), "asking").filter("vec_id <> query_id")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
