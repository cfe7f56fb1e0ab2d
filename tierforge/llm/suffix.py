"""Repeated byte strings: suffix buckets refined by bucket pointers, over blocks of documents.

Every position is in the bucket of its 50-byte q-gram. A bucket with one position is final. The others are
refined by the bucket of a later offset: the pair of the buckets at p and p + 50 gives the bucket of 100 bytes,
and those refined buckets, at p and p + 100, give the one of 200 bytes. Bucket pointers are hashes of their
content, so all executors agree on them; sorting pointers, within blocks and then in the shards of the hash
range, finds the buckets of more than one position.

Not every position has to be sorted at depth 50. Each 200-byte string contains 151 q-grams; the one of the
smallest pointer (the leftmost of equals) is its anchor, the same wherever the string stands. Sorting anchors alone
(one position in 76) settles all strings of an anchor that occurs once. The strings that share one anchor
lie side by side; if all occurrences of an anchor have the same stretch around them, all its strings
repeat. Only the other anchors' strings are refined to 200 bytes and sorted. A block sends each pointer once, with
a mark if it has it twice, so a passage in a third of all documents costs one entry per block.
Pointers have 64 bits; a match asks for 128 bits at anchors, 96 bits at strings.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import ROW, batch_of, cuts, gather, pack, pack_keys, row, unpack, unpack_keys
from .common import discard, stored
from .text import Spans, mix, utf8

LENGTH = 200  # bytes; four q-grams
BLOCK = 4 << 20  # bytes of text
_PIECE = 1 << 18  # string starts that one vectorised step holds
_PLACE = np.uint64(21)  # bits for a position in a piece
_U = np.uint64


def refined(pointers: np.ndarray, later: int) -> np.ndarray:
    """Buckets of twice the depth from the buckets here and at the offset ``later``."""
    return mix(pointers[:-later] * _U(3) + mix(pointers[later:]))


def _windows_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours."""
    n, span = len(x) - width + 1, 1
    while 2 * span <= width:
        x = np.minimum(x[:len(x) - span], x[span:])
        span *= 2
    return np.minimum(x[:n], x[width - span:width - span + n])


class Piece:
    """String starts [low, high) of a block's text, with the bytes that they reach."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, low: int, high: int, length: int):
        self.low, q = low, length // 4
        text = data[low:min(high + length - 1, len(data))]
        self.spans = Spans(text)
        self.pointers = self.spans.windows(q)
        starts = np.arange(min(high - low, len(text) - length + 1))
        doc = np.searchsorted(offs, starts + low, "right") - 1
        self.starts = starts[starts + low + length <= offs[doc + 1]]

    def anchors(self, length: int):
        """Per anchor: its pointer, the stretch's hash, and the first and last of its string starts in the block."""
        q = length // 4
        ranked = (self.pointers >> _PLACE << _PLACE) | np.arange(len(self.pointers), dtype=_U)
        anchor = (_windows_min(ranked, length - q + 1)[self.starts] & ((_U(1) << _PLACE) - _U(1))).astype(np.int64)
        begin = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (self.starts[1:] != self.starts[:-1] + 1))))
        first = self.starts[begin]
        last = self.starts[np.append(begin[1:], len(anchor)) - 1]
        at = anchor[begin]
        stretch = mix(self.spans.of(first, last + length) + (at - first).astype(_U))
        return self.pointers[at], stretch, first + self.low, last + self.low

    def strings(self, where: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Bucket pointers of depth ``length`` at starts of the block, and 32 bits of another hash."""
        q = length // 4
        twice = refined(self.pointers, q)
        whole = refined(twice, 2 * q)
        at = where - self.low
        other = mix(self.spans.of(at, at + length) ^ mix(self.spans.of(at + 1, at + length)))
        return whole[at], (other >> _U(32)).astype(np.uint32)


def pieces(data: np.ndarray, offs: np.ndarray, length: int) -> Iterator[Piece]:
    for low in range(0, len(data) - length + 1, _PIECE):
        piece = Piece(data, offs, low, min(low + _PIECE, len(data)), length)
        if len(piece.starts):
            yield piece


def _joined(parts: list[tuple], kinds: tuple) -> list[np.ndarray]:
    return [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, k) for k in kinds]


def _spread(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All numbers of the ranges first..last."""
    size = last - first + 1
    return np.repeat(first - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())


class Texts:
    """The documents of a block: ids, text and offsets."""

    def __init__(self, ids: pa.Array, data: np.ndarray, offs: np.ndarray):
        self.ids, self.data, self.offs = ids, data, offs

    def dumped(self) -> tuple:
        return pa.record_batch([self.ids], ["doc_id"]).serialize().to_pybytes(), self.ids.type, zstandard.ZstdCompressor(level=1).compress(self.data.tobytes()), pack(self.offs)

    @classmethod
    def loaded(cls, ids: bytes, kind: pa.DataType, text: bytes, offs: bytes) -> Texts:
        ids = pa.ipc.read_record_batch(ids, pa.schema([("doc_id", kind)])).column(0)
        return cls(ids, np.frombuffer(zstandard.ZstdDecompressor().decompress(text), np.uint8), unpack(offs, np.int64))

    def anchors(self, length: int) -> list[np.ndarray]:
        return _joined([p.anchors(length) for p in pieces(self.data, self.offs, length)], (_U, _U, np.int64, np.int64))

    def part(self, docs: np.ndarray) -> tuple[Texts, np.ndarray]:
        """The documents ``docs`` alone, and how far each moved to the front."""
        size = np.diff(self.offs)[docs]
        offs = np.concatenate(([0], np.cumsum(size)))
        return Texts(self.ids.take(pa.array(docs)), self.data[_spread(self.offs[docs], self.offs[docs + 1] - 1)], offs), self.offs[docs] - offs[:-1]

    def results(self, docs: np.ndarray, first: np.ndarray, last: np.ndarray, length: int) -> pa.Table:
        """The rows of ``docs`` when the bytes of the strings that start in first..last go."""
        step = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(step, first, 1)
        np.add.at(step, last + length, -1)
        gone = np.cumsum(step[:-1]) > 0
        removed, spans, digest = [], [], []
        for d in docs.tolist():
            text, cut = self.data[self.offs[d]:self.offs[d + 1]], gone[self.offs[d]:self.offs[d + 1]]
            n = int(np.count_nonzero(cut))
            removed.append(n)
            spans.append(int(cut[0]) + int(np.count_nonzero(cut[1:] & ~cut[:-1])) if n else 0)
            digest.append(hashlib.sha256(text[~cut].tobytes() if n else text.tobytes()).hexdigest())
        return pa.table([self.ids.take(pa.array(docs)), pa.array(np.diff(self.offs)[docs]), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest, pa.string())],
                        ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _pack_documents(docs: DataFrame, block: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        held: list[tuple] = []
        size = 0
        for batch in batches:
            data, offs = utf8(batch.column(1))
            lo = 0
            while lo < len(batch):
                hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + block - size, "right")) - 1)
                hi = min(hi, len(batch))
                held.append((batch.column(0).slice(lo, hi - lo), data[offs[lo]:offs[hi]], np.diff(offs[lo:hi + 1])))
                size += int(offs[hi] - offs[lo])
                lo = hi
                if size >= block or lo < len(batch):
                    yield batch_of([row(number, 0, 0, packed(held))])
                    number, held, size = number + 1, [], 0
        if held:
            yield batch_of([row(number, 0, 0, packed(held))])

    def packed(held: list[tuple]) -> bytes:
        ids = pa.chunked_array([h[0] for h in held]).combine_chunks()
        offs = np.concatenate(([0], np.cumsum(np.concatenate([h[2] for h in held]))))
        return pickle.dumps(Texts(ids, np.concatenate([h[1] for h in held]), offs).dumped())

    return docs.mapInArrow(work, ROW)


def _sorted_anchors(pointers: np.ndarray, stretch: np.ndarray):
    """Distinct pointers in order, each one's places, whether it stands twice, and its least and greatest stretch."""
    keys, place, n = np.unique(pointers, return_inverse=True, return_counts=True)
    order = np.argsort(place, kind="stable")
    begin = np.cumsum(n) - n
    by = stretch[order]
    low = np.minimum.reduceat(by, begin) if len(keys) else by
    high = np.maximum.reduceat(by, begin) if len(keys) else by
    return keys, place, n > 1, low, high


def _send(bits: int, length: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, data in zip(batch.column(0).to_pylist(), batch.column(3)):
                texts = Texts.loaded(*pickle.loads(data.as_py()))
                pointers, stretch, _, _ = texts.anchors(length)
                keys, _, twice, low, high = _sorted_anchors(pointers, stretch)
                cut = cuts(keys, bits)
                yield batch_of([row(number, 1, s, pickle.dumps((pack_keys(keys[a:b]), pack(twice[a:b]), pack(low[a:b]), pack(low[a:b] ^ high[a:b]))))
                                for s, (a, b) in enumerate(zip(cut[:-1], cut[1:])) if b > a])
    return work


def _returned(table: pa.Table, kind: int, order: np.ndarray, sizes: list[int], values: np.ndarray) -> pa.Table:
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    shard, blocks = table["shard"][0].as_py(), table["block"].to_numpy()[order]
    return pa.Table.from_batches([batch_of([row(int(b), kind, shard, pack(values[lo:hi])) for b, lo, hi in zip(blocks, bounds[:-1], bounds[1:])])])


def _judge_anchors(table: pa.Table) -> pa.Table:
    """Of each anchor sent: 0, it stands once; 1, in one and the same stretch everywhere; 2, in several."""
    order = np.arange(table.num_rows)
    parts = [pickle.loads(d.as_py()) for d in table["data"]]
    keys = [unpack_keys(p[0]) for p in parts]
    twice, low, differ = (np.concatenate([unpack(p[i], k) for p in parts]) for i, k in ((1, bool), (2, _U), (3, _U)))
    unique, place, n = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    by, begin = np.argsort(place, kind="stable"), np.cumsum(n) - n
    more = (n > 1) | np.logical_or.reduceat(twice[by], begin)
    same = np.minimum.reduceat(low[by], begin) == np.maximum.reduceat((low ^ differ)[by], begin)
    return _returned(table, 2, order, [len(k) for k in keys], np.where(more, np.where(same, 1, 2), 0).astype(np.uint8)[place])


def _judge_strings(table: pa.Table) -> pa.Table:
    """Of each string sent: whether it stands anywhere else."""
    parts = [pickle.loads(d.as_py()) for d in table["data"]]
    keys = [unpack_keys(p[0]) for p in parts]
    twice, other = (np.concatenate([unpack(p[i], k) for p in parts]) for i, k in ((1, bool), (2, np.uint32)))
    key = np.concatenate(keys)
    _, n, group = _grouped(key, other)
    n = n + np.bincount(group, twice, len(n))
    return _returned(table, 4, np.arange(table.num_rows), [len(k) for k in keys], n[group] > 1)


def _payload(rows: pa.Table, kind: int) -> tuple:
    return pickle.loads(next(d for k, d in zip(rows["kind"].to_pylist(), rows["data"]) if k == kind).as_py())


def _strings(texts: Texts, first: np.ndarray, last: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts first..last with their pointers and second hashes."""
    where = _spread(first, last)
    out = []
    for piece in pieces(texts.data, texts.offs, length):
        mine = where[(where >= piece.low) & (where < piece.low + _PIECE)]
        if len(mine):
            out.append((mine, *piece.strings(mine, length)))
    return tuple(_joined(out, (np.int64, _U, np.uint32)))


def _refine(length: int):
    """A block with its anchors judged: finished rows of documents without open strings; the others with what is
    known and the strings to sort."""

    def work(rows: pa.Table) -> pa.Table:
        number = rows["block"][0].as_py()
        texts = Texts.loaded(*_payload(rows, 0))
        pointers, stretch, first, last = texts.anchors(length)
        _, place, _, _, _ = _sorted_anchors(pointers, stretch)
        verdict = gather(rows, 2, np.uint8)
        verdict = verdict[place] if len(place) else np.zeros(0, np.uint8)
        doc = np.searchsorted(texts.offs, first, "right") - 1
        unsettled = np.zeros(len(texts.ids), bool)
        unsettled[doc[verdict == 2]] = True
        sure = verdict == 1
        done = texts.results(np.flatnonzero(~unsettled), first[sure & ~unsettled[doc]], last[sure & ~unsettled[doc]], length)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, done.schema) as writer:
            writer.write_table(done)
        out = [row(number, 5, -1, sink.getvalue().to_pybytes())]
        if unsettled.any():
            docs = np.flatnonzero(unsettled)
            rest, moved = texts.part(docs)
            shift = np.zeros(len(texts.ids), np.int64)
            shift[docs] = moved
            known, open_ = sure & unsettled[doc], verdict == 2
            first, last = first - shift[doc], last - shift[doc]
            out.append(row(number, 6, -1, pickle.dumps((rest.dumped(), *[pack(x) for x in (first[known], last[known], first[open_], last[open_])]))))
        return pa.Table.from_batches([batch_of(out)])

    return work


def _grouped(keys: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal strings, by both hashes: a place of each in order, how many there are, and the group of each place."""
    order = np.lexsort((other, keys))
    new = np.ones(len(keys), bool)
    new[1:] = (keys[order][1:] != keys[order][:-1]) | (other[order][1:] != other[order][:-1])
    group = np.empty(len(keys), np.int64)
    group[order] = np.cumsum(new) - 1
    return order[new], np.bincount(group, minlength=int(new.sum())), group


def _send_strings(bits: int, length: int):
    """The open strings of each block's unsettled documents."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, data in zip(batch.column(0).to_pylist(), batch.column(3)):
                dumped, _, _, first, last = pickle.loads(data.as_py())
                _, keys, other = _strings(Texts.loaded(*dumped), unpack(first, np.int64), unpack(last, np.int64), length)
                at, n, _ = _grouped(keys, other)
                unique = keys[at]
                cut = cuts(unique, bits)
                yield batch_of([row(number, 3, s, pickle.dumps((pack_keys(unique[a:b]), pack(n[a:b] > 1), pack(other[at[a:b]]))))
                                for s, (a, b) in enumerate(zip(cut[:-1], cut[1:])) if b > a])

    return work


def _finish(length: int):
    def work(rows: pa.Table) -> pa.Table:
        dumped, *packed = _payload(rows, 6)
        texts = Texts.loaded(*dumped)
        known_first, known_last, first, last = (unpack(x, np.int64) for x in packed)
        where, keys, other = _strings(texts, first, last, length)
        again = gather(rows, 4, bool)[_grouped(keys, other)[2]]
        where = where[again]
        return texts.results(np.arange(len(texts.ids)), np.concatenate((known_first, where)), np.concatenate((known_last, where)), length)

    return work


def _unwrap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column(0):
            yield from pa.ipc.open_stream(data.as_buffer())


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, block: int = BLOCK) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: one row for each row of ``docs``, without each byte that a
    string of ``length`` bytes covers that also starts anywhere else.

    ``length`` is a multiple of 4, 8 at least. Texts shorter than it, empty and null ones lose nothing; repeated
    rows repeat each other; an empty table gives an empty table.
    """
    if length % 4 or length < 8:
        raise ValueError("length must be a multiple of 4, 8 at least")
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    bits = max(4, (2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())
    packed = stored(_pack_documents(slim, block), "suffix-blocks")
    judged = packed.mapInArrow(_send(bits, length), ROW).groupBy("shard").applyInArrow(_judge_anchors, ROW)
    refined_ = stored(packed.union(judged).groupBy("block").applyInArrow(_refine(length), ROW), "suffix-refined")
    discard(packed)
    schema = f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    done = refined_.filter("kind = 5").select("data").mapInArrow(_unwrap, schema)
    unsettled = refined_.filter("kind = 6")
    judged = unsettled.mapInArrow(_send_strings(bits, length), ROW).groupBy("shard").applyInArrow(_judge_strings, ROW)
    rest = unsettled.union(judged).groupBy("block").applyInArrow(_finish(length), schema)
    return done.union(rest)
