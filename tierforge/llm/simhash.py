"""SimHash near-dedup: pigeonhole blocks, verified Hamming distances, components.

A document's fingerprint takes, bit by bit, the majority of the XXH64 hashes (seed 42, UTF-8) of its word
shingles. Fingerprints at most ``distance`` bits apart are linked. Equal fingerprints are one from the
start, so a group of copies costs one row. The 64 bits are cut into ``distance + 2`` blocks; close pairs agree in
two blocks at least, so rows meet in one bucket for each pair of blocks and are verified there. A bucket of
more than ``BUCKET`` fingerprints is cut again by the same rule over its free bits; three rounds leave 8 free
bits or fewer (for a distance of 2), so no bucket exceeds 256 fingerprints however skewed the data are.
A bucket yields the edges of a spanning star for each linked cluster, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import connected_components, set_aside, stored
from .text import unsigned

SHINGLE = 3
DISTANCE = 2
BUCKET = 256
SEED = 42
_ROWS = 1 << 14


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Unsigned fingerprint of one text; 0 without words."""
    words = text.lower().split()  # bytes: A-Z only, and exactly the six separators
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    set_bits = np.zeros(64, np.int64)
    firsts, lasts = starts[:n].tolist(), ends[min(shingle, len(words)) - 1:].tolist()
    for lo in range(0, n, _ROWS):
        hashes = [digest(line[s:e], SEED) for s, e in zip(firsts[lo:lo + _ROWS], lasts[lo:lo + _ROWS])]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, shingle: int = SHINGLE, text: str = "text", column: str = "fp") -> DataFrame:
    """All columns of ``docs`` and ``column`` (bigint, the bits of the fingerprint)."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.names.index(text)
            fps = [0 if not t.is_valid else fingerprint(t.as_buffer().to_pybytes(), shingle) for t in batch.column(at)]
            fps = pa.array(np.array(fps, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, fps], [*batch.schema.names, column])

    return docs.mapInArrow(add, StructType([*docs.schema.fields, StructField(column, LongType())]))


def _cut(free: list[int], distance: int) -> list[int]:
    """Masks of the bits to agree on: two of ``distance + 2`` blocks of the free bits."""
    blocks = [list(map(int, b)) for b in np.array_split(np.array(free), distance + 2)]
    return [sum(1 << bit for b in pair for bit in b) for pair in combinations(blocks, 2)]


def _long(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _stars(distance: int):
    """Rows (mask, key, fp) sorted by bucket, to a spanning star of each linked cluster of a bucket."""

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None
        for batch in batches:
            cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)]
            if rest is not None:
                cols = [np.concatenate(x) for x in zip(rest, cols)]
            last = np.flatnonzero((cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            rest = [c[cut:] for c in cols]
            yield link([c[:cut] for c in cols])
        if rest is not None:
            yield link(rest)

    def link(cols: list[np.ndarray]) -> pa.RecordBatch:
        n = len(cols[2])
        fp, index = unsigned(cols[2]), np.arange(n)
        bucket = np.zeros(n, np.int64)
        if n > 1:
            bucket[1:] = np.cumsum((cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1]))
        left, right, at, far = [], [], index, 1
        while len(at):
            at = at[at + far < n]
            at = at[bucket[at] == bucket[at + far]]
            near = at[np.bitwise_count(fp[at] ^ fp[at + far]) <= distance]
            left.append(near)
            right.append(near + far)
            far += 1
        i, j = np.concatenate(left or [index[:0]]), np.concatenate(right or [index[:0]])
        label = index.copy()
        while len(i):
            low = np.minimum(label[i], label[j])
            before = label.copy()
            np.minimum.at(label, i, low)
            np.minimum.at(label, j, low)
            label = label[label]
            if (label == before).all():
                break
        own = np.flatnonzero(label != index)
        return pa.RecordBatch.from_arrays([pa.array(cols[2][own]), pa.array(cols[2][label[own]])], ["a", "b"])

    return buckets


def near_edges(fps: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """Distinct ``fps(fp)`` to edges (a, b) that connect exactly what links of ``distance`` bits connect."""
    free = {0: list(range(64))}
    rows = fps.select(F.lit(0).cast("bigint").alias("mask"), "fp")
    edges: DataFrame | None = None
    while True:
        cuts = {m: [m | c for c in _cut(bits, distance)] for m, bits in free.items()}
        children = F.create_map(*[x for m, kids in cuts.items() for x in (F.lit(_long(m)), F.array(*[F.lit(_long(k)) for k in kids]))])
        rows = rows.select(F.explode(children[F.col("mask")]).alias("mask"), "fp").withColumn("key", F.col("mask").bitwiseAND(F.col("fp")))
        sizes = rows.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        met = stored(rows.join(sizes, ["mask", "key"]).select("mask", "key", "fp", "n"), "simhash-buckets")
        free = {k: [b for b in range(64) if not k >> b & 1] for kids in cuts.values() for k in kids}
        final = any(len(bits) < 2 * (distance + 2) for bits in free.values())
        cold = met if final else met.filter(F.col("n") <= bucket)
        found = (
            cold.select("mask", "key", "fp").repartition("mask", "key").sortWithinPartitions("mask", "key", "fp")
            .mapInArrow(_stars(distance), "a bigint, b bigint")
        )
        edges = found if edges is None else edges.union(found)
        rows = met.filter(F.col("n") > bucket).select("mask", "fp")
        if final or rows.isEmpty():
            return edges


def near_components(marked: DataFrame, doc_id: str = "doc_id", distance: int = DISTANCE, column: str = "fp") -> DataFrame:
    """``marked`` (rows with a fingerprint) to (fp, root, component_id): the smallest fingerprint and the smallest
    doc_id of the component. One row for each distinct fingerprint."""
    own = stored(marked.groupBy(F.col(column).alias("fp")).agg(F.min(doc_id).alias("low")), "simhash-fps")
    roots = connected_components(near_edges(own.select("fp"), distance)).withColumnRenamed("node", "fp")
    own = stored(own.join(roots, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root")), "simhash-roots")
    least = own.groupBy("root").agg(F.min("low").alias("component_id"))
    return own.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id.

    Null and empty texts have fingerprint zero and link like any other; repeated rows stay, one output row
    each; a null doc_id keeps its row and never becomes a component's id unless no other is there.
    """
    marked = stored(with_fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), shingle).drop("text"), "simhash-docs")
    found = near_components(marked, distance=distance)
    return marked.join(found, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_per_component(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the smallest doc_id, one row even if
    that row is repeated; columns as they were, whatever their names. Null and empty texts are alike, a null id
    stays only where a component has no other; an empty table gives an empty table."""
    plain, restored = set_aside(docs, doc_id, text)
    body = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    slim = plain.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), body.alias("body"))
    ids = stored(with_fingerprints(slim, shingle).drop("text"), "simhash-docs")
    # of a component's rows with the smallest id the one of the smallest text hash; those that are repeated are made one
    found = near_components(ids, distance=distance)
    first = ids.join(found, "fp").filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root", "doc_id").agg(F.min("body").alias("body"))
    n = ids.groupBy("doc_id", "body").agg(F.count(F.lit(1)).alias("n")).toDF("_id", "_body", "_n")
    stay = first.join(n, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("body") == F.col("_body"))).select("_id", "_body", "_n")
    stay = stored(stay, "simhash-stay")
    same = F.col(doc_id).eqNullSafe(F.col("_id")) & (body == F.col("_body"))
    kept = stored(plain.join(stay.hint("merge"), same), "simhash-kept")  # both sides grow with the documents
    return restored(kept.filter("_n = 1").union(kept.filter("_n > 1").dropDuplicates(["_id", "_body"])).select(*plain.columns))
