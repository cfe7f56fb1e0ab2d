"""Katz backoff language model: Good-Turing discounted n-grams, exactly normalised backoff weights.

    p(w | h) = d(c(hw)) c(hw) / c(h)        if hw was seen
             = alpha(h) p(w | h')           otherwise, h' being h without its first word;  p(w) = d(c(w)) c(w) / N, unseen
                                            words sharing the rest

``alpha(h)`` makes the probabilities after ``h`` sum to one over the vocabulary and one unknown word; a history that was
never seen has weight one. ``d`` is Katz's discount for counts up to 5 (or the largest bound that the counts of counts
allow). For n-grams of two words and more with larger counts it is the Good-Turing ratio of counts of counts that fall as a
power of the count, so that every context leaves something to what was never seen after it.

Documents are packed into blocks of about ``BLOCK`` tokens. A block sends its distinct n-grams of each order
(sorted 64-bit hashes, delta-coded) with their training counts to the partitioned count tables, one part for
each shard of the hash range, and gets the corpus counts back in the order it sent the keys. So a frequent word
or n-gram costs a row per block and is summed in one shard without skew. From three words on, an n-gram goes out only if
its first and its last n - 1 words both stand in training documents of other blocks too, or both in held-out documents of
other blocks; the others' counts are the block's own. In a last exchange blocks send what they own
of the discounted and backed-off mass of each context that some held-out document has (tokens of training documents never
back off, so no other weight is asked for), and get the backoff weights they need; then each token is evaluated from
the longest n-gram that was seen down, one weight for each shorter step. Work and shuffle follow the distinct n-grams
of all documents.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .blocks import ROW, batch_of, cuts, gather, pack, pack_keys, row, unpack, unpack_keys
from .common import discard, stored
from .text import Spans, Words, distinct, lower, mix, steps, utf8

BLOCK = 1 << 19  # tokens
BOUND = 5  # counts above it are not discounted
_U = np.uint64
_END, _START = _U(1), _U(2)  # keys of the end token and of the history of a first token
ORDER = 3  # words of the longest n-grams
PARTS = 2  # of the blocks, which get their counts one part after the other: only one part's shuffle is on disk at a time
_COUNTS, _RESULT, _MASSES, _WEIGHTS = 0, 10, 20, 30  # kinds of rows: with the order of the n-grams or the length of the contexts added


def _longer(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Keys of n-grams from those of their contexts and last words."""
    return mix(mix(context) * _U(3) + word)


def _start_keys(order: int) -> list[np.ndarray]:
    """Keys of the histories of a first token, by their length."""
    out = [np.array([_START])]
    while len(out) < order:
        out.append(_longer(out[-1], out[0]))
    return out


def _pack_documents(docs: DataFrame, block: int) -> DataFrame:
    """doc_id, text, held_out to one row for each block: ids, training flags, vocabulary and token numbers."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        held: list[tuple] = []
        size = 0
        for batch in batches:
            data, offs = utf8(batch.column(1))
            for lo, hi in steps(offs):
                part, at = lower(data[offs[lo]:offs[hi]]), offs[lo:hi + 1] - offs[lo]
                words = Words(part, at)
                keys = np.insert(Spans(part).of(words.starts, words.ends), words.first[1:], _END)
                held.append((batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), words.counts + 1, keys))
                size += len(keys)
                if size >= block:
                    yield batch_of([row(number, 0, 0, packed(held))])
                    number, held, size = number + 1, [], 0
        if held:
            yield batch_of([row(number, 0, 0, packed(held))])

    def packed(held: list[tuple]) -> bytes:
        ids = pa.chunked_array([h[0] for h in held]).combine_chunks()
        out = np.concatenate([h[1].to_numpy(zero_copy_only=False) for h in held]).astype(bool)
        counts = np.concatenate([h[2] for h in held])
        vocabulary, _, tokens = distinct(np.concatenate([h[3] for h in held]))
        return pickle.dumps((pa.record_batch([ids], ["doc_id"]).serialize().to_pybytes(), ids.type, pack(out), pack(counts), pack_keys(vocabulary), pack(tokens.astype(np.uint32))))

    return docs.mapInArrow(work, ROW)


class Block:
    """A packed block: its documents, and for each order the sorted distinct n-grams, each token's place among them, the
    place of its context one order below, and a token of each n-gram. Histories of first tokens are among the contexts."""

    def __init__(self, data: bytes, order: int, upto: int | None = None):
        ids, kind, out, counts, vocabulary, tokens = pickle.loads(data)
        self.ids = pa.ipc.read_record_batch(ids, pa.schema([("doc_id", kind)])).column(0)
        self.held_out, self.counts = unpack(out, bool), unpack(counts, np.int64)
        words = unpack_keys(vocabulary)[unpack(tokens, np.uint32)]
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)
        self.training = ~self.held_out[self.doc]
        first = np.cumsum(self.counts) - self.counts
        self.keys, self.place, self.some, self.context, self.start = [], [], [], [np.zeros(len(words), np.int64)], []
        grams = words
        for n, start in enumerate(_start_keys(order)[:upto], 1):
            keys, some, place = distinct(grams)
            if n < order:  # contexts of the next order
                at = int(np.searchsorted(keys, start[0]))
                keys, some = np.insert(keys, at, start), np.insert(some, at, 0)
                place = place + (place >= at)
                before = np.empty_like(place)
                before[1:] = place[:-1]
                before[first] = at
                self.context.append(before)
                self.start.append(at)
                if n < (upto or order):
                    grams = _longer(keys[before], words)
            self.keys.append(keys)
            self.place.append(place)
            self.some.append(some)

    def counted(self, n: int) -> np.ndarray:
        """How often training documents have each n-gram (a first history: how often it is one)."""
        out = np.bincount(self.place[n - 1][self.training], minlength=len(self.keys[n - 1]))
        if n <= len(self.start):
            out[self.start[n - 1]] = int((~self.held_out).sum())
        return out

    def asked(self, n: int) -> np.ndarray:
        """Which n-grams held-out documents have (a first history: whether there is such a document)."""
        out = np.bincount(self.place[n - 1][~self.training], minlength=len(self.keys[n - 1])) > 0
        if n <= len(self.start):
            out[self.start[n - 1]] = self.held_out.any()
        return out

    def shared(self, n: int, marked: np.ndarray) -> np.ndarray:
        """Which n-grams other blocks may count or ask for too, given the marked corpus counts of the order below: those whose
        first and last n - 1 words do stand in others' training documents, and of its training documents' n-grams those where
        they stand in others' held-out documents. The block's own counts are the corpus counts of the rest."""
        some = self.some[n - 1]
        both = lambda elsewhere: elsewhere[self.place[n - 2][some]] & elsewhere[self.context[n - 1][some]]
        out = both(marked >> 2 > self.counted(n - 1)) | both((marked & 2) > 0) & (self.counted(n) > 0)
        if n <= len(self.start):
            out[self.start[n - 1]] = True
        return out


def _messages(number: int, kind: int, keys: np.ndarray, counts: np.ndarray, asked: np.ndarray, bits: int) -> pa.RecordBatch:
    cut = cuts(keys, bits)
    return batch_of([row(number, kind, s, pickle.dumps((pack_keys(keys[a:b]), pack(counts[a:b].astype(np.uint32)), np.packbits(asked[a:b]).tobytes())))
                     for s, (a, b) in enumerate(zip(cut[:-1], cut[1:])) if b > a])


def _send(bits: int, order: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, data in zip(batch.column(0).to_pylist(), batch.column(3)):
                block = Block(data.as_py(), order, 2)
                for n in (1, 2):
                    yield _messages(number, _COUNTS + n, block.keys[n - 1], block.counted(n), block.asked(n), bits)
    return work


def _send_more(bits: int, order: int, n: int):
    """The n-grams of a block that others may have, and the counts of counts of the rest (block -1)."""

    def work(rows: pa.Table) -> pa.Table:
        number = rows["block"][0].as_py()
        block = Block(_data(rows), order, n)
        own = block.counted(n)
        shared = block.shared(n, _marked(rows, block, n - 1)[-1])
        alone = own[~shared]
        counts = [int(alone.sum()), int((alone > 0).sum()), *[int((alone == c).sum()) for c in range(1, BOUND + 2)]]
        return pa.Table.from_batches([_messages(number, _COUNTS + n, block.keys[n - 1][shared], own[shared], block.asked(n)[shared], bits),
                                      batch_of([row(-1, _COUNTS + n, -1, pickle.dumps(counts))])])

    return work


def _data(rows: pa.Table) -> bytes:
    return next(d for k, d in zip(rows["kind"].to_pylist(), rows["data"]) if k == 0).as_py()


def _whole(shared: np.ndarray, own: np.ndarray, back: np.ndarray) -> np.ndarray:
    """Counts with their marks, those that came back put among the block's own."""
    out = 4 * own + (own > 0)
    out[shared] = back
    return out


def _marked(rows: pa.Table, block: Block, upto: int) -> list[np.ndarray]:
    """By order the corpus counts that came back: four times the count, plus two where held-out documents of other blocks have
    the n-gram, and from two words on plus one where the block answers for it."""
    out = [gather(rows, _COUNTS + 1, np.int64)]
    for n in range(2, upto + 1):
        back = gather(rows, _COUNTS + n, np.int64)
        out.append(back if n == 2 else _whole(block.shared(n, out[-1]), block.counted(n), back))
    return out


def _count(order: int):
    starts = _start_keys(order)

    def work(table: pa.Table) -> pa.Table:
        """All parts of one shard: the corpus counts back to each block, and counts of counts (block -1).

        A count comes with a flag for what held-out documents of other blocks have; one of two words and more with a flag for
        the one block that answers for it."""
        kind, shard = table["kind"][0].as_py(), table["shard"][0].as_py()
        by = np.argsort(table["block"].to_numpy())
        blocks = table["block"].to_numpy()[by]
        parts = [pickle.loads(table["data"][int(i)].as_py()) for i in by]
        keys = [unpack_keys(k) for k, *_ in parts]
        own = np.concatenate([unpack(c, np.uint32) for _, c, _ in parts]).astype(np.int64)
        asked = np.concatenate([np.unpackbits(np.frombuffer(a, np.uint8), count=len(k)) for k, (*_, a) in zip(keys, parts)])
        bounds = np.concatenate(([0], np.cumsum([len(k) for k in keys])))
        unique, _, place = distinct(np.concatenate(keys))
        total = np.bincount(place, own, len(unique)).astype(np.int64)  # exact: below 2^53
        askers = np.bincount(place, asked, len(unique)).astype(np.int64)  # blocks
        back = 4 * total[place] + 2 * (askers[place] > asked)
        if kind > _COUNTS + 1:
            has = np.flatnonzero(own > 0)
            first = np.full(len(unique), len(own), np.int64)
            np.minimum.at(first, place[has], has)
            back += first[place] == np.arange(len(own))
        counted = total[unique != starts[kind - _COUNTS - 1]] if kind < _COUNTS + order else total
        of_counts = [int((counted == c).sum()) for c in range(1, BOUND + 2)]
        rows = [row(int(b), kind, shard, pack(back[lo:hi])) for b, lo, hi in zip(blocks, bounds[:-1], bounds[1:])]
        rows.append(row(-1, kind, shard, pickle.dumps([int(counted.sum()), int((counted > 0).sum()), *of_counts])))
        return pa.Table.from_batches([batch_of(rows)])

    return work


def discounts(of_counts: list[int]) -> list[float]:
    """d(1), d(2), ... of Katz for the largest bound up to ``BOUND`` for which all lie strictly between 0 and 1."""
    n = [0, *of_counts]
    for k in range(min(BOUND, len(of_counts) - 1), 0, -1):
        if all(n[r] > 0 for r in range(1, k + 2)):
            a = (k + 1) * n[k + 1] / n[1]
            d = [((r + 1) * n[r + 1] / (n[r] * r) - a) / (1 - a) for r in range(1, k + 1)] if a < 1 else [1.0]
            if all(0 < x < 1 for x in d):
                return d
    return []


def fall(of_counts: list[int]) -> float:
    """The power by which counts of counts fall, from 1.2 to 3; 1.5 where there are too few to tell."""
    have = [(np.log(r), np.log(n)) for r, n in enumerate(of_counts, 1) if n > 0]
    return float(np.clip(-np.polyfit(*zip(*have), 1)[0], 1.2, 3.0)) if len(have) > 2 else 1.5


class Model:
    """What all blocks share: totals, discounts and the unknown word. ``counts`` has for each order the tokens, types and
    counts of counts."""

    def __init__(self, *counts: list[int]):
        self.tokens, self.types = counts[0][0], counts[0][1]
        self.one, self.more = discounts(counts[0][2:]), [(discounts(c[2:]), fall(c[2:])) for c in counts[1:]]
        lost = sum((1 - d) * r * counts[0][1 + r] for r, d in enumerate(self.one, 1))
        # without discounts one more token stands for all unknown words
        self.total = self.tokens if lost > 0 else self.tokens + 1
        self.unknown = (lost if lost > 0 else 1) / self.total

    def word(self, counts: np.ndarray) -> np.ndarray:
        by = np.concatenate(([1.0], self.one, [1.0]))
        return np.where(counts > 0, counts * by[np.minimum(counts, len(self.one) + 1)] / self.total, self.unknown)

    def seen(self, counts: np.ndarray, n: int = 2) -> np.ndarray:
        """Discounted counts of n-grams of two words and more; 0 for 0."""
        low, power = self.more[n - 2]
        tail = (1 + 1 / np.maximum(counts, 1)) ** (1 - power)
        by = np.concatenate(([1.0], low, [1.0]))
        return counts * np.where(counts > len(low), tail, by[np.minimum(counts, len(low) + 1)])


def _answer(model: Model, bits: int, order: int):
    """A block with its counts: what it can score by itself, and its part of the contexts' masses."""

    def work(rows: pa.Table) -> pa.Table:
        number = rows["block"][0].as_py()
        block = Block(_data(rows), order)
        docs = len(block.counts)
        marked = _marked(rows, block, order)
        known, owned = [k >> 2 for k in marked], [(k & 1) > 0 for k in marked]
        asked = [block.asked(n) | ((k & 2) > 0) for n, k in enumerate(marked, 1)]
        of_words = known[0][block.place[0]]
        base = np.bincount(block.doc, np.log10((of_words + 1) / (model.tokens + model.types + 1)), docs)
        # by order: the probability of each n-gram that was seen, and each token's value from the longest one of its own
        p = model.word(known[0])
        value = np.log10(p)[block.place[0]]
        longest = np.ones(len(value), np.int64)
        masses = []
        for n in range(2, order + 1):
            context, some, count = block.context[n - 1][block.some[n - 1]], block.some[n - 1], known[n - 1]
            shorter, size = p[block.place[n - 2][some]], len(known[n - 2])
            mine = owned[n - 1]
            if n < order:
                mine[block.start[n - 1]] = False  # a history, no n-gram
            masses.append((np.bincount(context[mine], model.seen(count[mine], n), size), np.bincount(context[mine], shorter[mine], size)))
            p = np.where(count > 0, model.seen(count, n) / np.maximum(known[n - 2][context], 1), 0)
            here = count[block.place[n - 1]] > 0
            value[here] = np.log10(p[block.place[n - 1][here]])
            longest[here] = n
        out, waits = [], []
        for m in range(1, order):  # tokens that back off wait for the weights of their contexts of m words
            size = len(known[m - 1])
            at = np.flatnonzero((longest <= m) & (known[m - 1][block.context[m]] > 0))
            waiting, times = np.unique(block.doc[at] * size + block.context[m][at], return_counts=True)
            wanted = np.zeros(size, bool)
            wanted[waiting % size] = True
            waits.append(tuple(pack(x.astype(np.uint32)) for x in (np.diff(waiting // size, prepend=0), (np.cumsum(wanted) - 1)[waiting % size], times)))
            mass, behind = masses[m - 1]
            given = (mass > 0) & asked[m - 1] | wanted
            keys, *columns = (x[given] for x in (block.keys[m - 1], mass, behind, wanted, known[m - 1]))
            cut = cuts(keys, bits)
            for s, (a, b) in enumerate(zip(cut[:-1], cut[1:])):
                if b > a:
                    seen, less, want, count = (x[a:b] for x in columns)
                    out.append(row(number, _MASSES + m, s, pickle.dumps((pack_keys(keys[a:b]), pack(seen), pack(less), pack(want), pack(count[want])))))
        result = (pa.record_batch([block.ids], ["doc_id"]).serialize().to_pybytes(), block.held_out, block.counts,
                  np.bincount(block.doc, of_words > 0, docs).astype(np.int64), base, np.bincount(block.doc, value, docs), waits)
        out.append(row(number, _RESULT, -1, pickle.dumps(result)))
        return pa.Table.from_batches([batch_of(out)])

    return work


def _weigh(table: pa.Table) -> pa.Table:
    """All parts of one shard of contexts: the backoff weights that each block waits for, in its order."""
    kind, shard = table["kind"][0].as_py(), table["shard"][0].as_py()
    parts = [pickle.loads(d.as_py()) for d in table["data"]]
    keys, mass, behind, wanted, count = (
        [f(p[i]) for p in parts] for i, f in enumerate(
            (unpack_keys, *[lambda x, t=t: unpack(x, t) for t in (np.float64, np.float64, bool, np.int64)])))
    unique, place = np.unique(np.concatenate(keys), return_inverse=True)
    seen = np.bincount(place, np.concatenate(mass), len(unique))
    less = np.bincount(place, np.concatenate(behind), len(unique))
    bounds = np.concatenate(([0], np.cumsum([len(k) for k in keys])))
    rows = []
    for b, lo, hi, w, n in zip(table["block"].to_pylist(), bounds[:-1], bounds[1:], wanted, count):
        if w.any():
            at = place[lo:hi][w]
            rows.append(row(b, kind - _MASSES + _WEIGHTS, shard, pack((1 - seen[at] / np.maximum(n, 1)) / (1 - less[at]))))
    return pa.Table.from_batches([batch_of(rows)])


def _finish(tokens: int, id_type: pa.DataType):
    def work(rows: pa.Table) -> pa.Table:
        result = next(d for k, d in zip(rows["kind"].to_pylist(), rows["data"]) if k == _RESULT)
        ids, held_out, counts, known, base, score, waits = pickle.loads(result.as_py())
        for m, wait in enumerate(waits, 1):
            step, context, times = (unpack(x, np.uint32) for x in wait)
            doc = np.cumsum(step, dtype=np.int64)
            if len(doc):
                score = score + np.bincount(doc, times * np.log10(gather(rows, _WEIGHTS + m, np.float64)[context]), len(counts))
        ids = pa.ipc.read_record_batch(ids, pa.schema([("doc_id", id_type)])).column(0)
        columns = [ids, *map(pa.array, (held_out, counts, known, np.full(len(counts), tokens), base, score))]
        return pa.table(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return work


def scores(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text", order: int = ORDER, block: int = BLOCK) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row for each row of ``docs``.

    The model, of n-grams up to ``order`` words (2 at least), learns from the documents that ``held_out`` does not hold
    out. A null or empty text is its end token alone; repeated rows count and score each; without training documents every
    probability is 1; an empty table gives an empty table. A document lies in one block whatever its length.
    """
    if order < 2:
        raise ValueError("order must be 2 at least")
    spark = docs.sparkSession
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), held_out.alias("held_out"))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = max(4, (2 * width - 1).bit_length())
    packed = stored(_pack_documents(slim, block), "katz-blocks")
    counted = [stored(packed.mapInArrow(_send(bits, order), ROW).groupBy("kind", "shard").applyInArrow(_count(order), ROW), "katz-counts")]

    def returned(work, label: str) -> list[DataFrame]:
        rows = reduce(DataFrame.union, [packed, *[c.filter("block >= 0") for c in counted]])
        part = F.pmod(F.col("block") + F.shiftright("block", 33), F.lit(PARTS))  # blocks of a task in turn
        return [stored(rows.filter(part == i).groupBy("block").applyInArrow(work, ROW), label) for i in range(PARTS)]

    for n in range(3, order + 1):
        parts = returned(_send_more(bits, order, n), "katz-sent")
        sent = reduce(DataFrame.union, parts)
        more = sent.filter("block >= 0").groupBy("kind", "shard").applyInArrow(_count(order), ROW)
        counted.append(stored(more.union(sent.filter("block = -1")), "katz-counts"))
        for done in parts:
            discard(done)
    totals = reduce(DataFrame.union, counted).filter("block = -1").select("kind", "data").mapInArrow(_sums, "kind int, place int, n bigint")
    sums = {(r["kind"], r["place"]): r["n"] for r in totals.groupBy("kind", "place").agg(F.sum("n").alias("n")).collect()}
    model = Model(*[[sums.get((_COUNTS + n, i), 0) for i in range(BOUND + 3)] for n in range(1, order + 1)])
    answers = reduce(DataFrame.union, returned(_answer(model, bits, order), "katz-answers"))
    for done in (packed, *counted):
        discard(done)
    weights = answers.filter(F.col("kind").between(_MASSES, _WEIGHTS - 1)).groupBy("kind", "shard").applyInArrow(_weigh, ROW)
    id_type = to_arrow_type(slim.schema["doc_id"].dataType)
    schema = f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return answers.filter(F.col("kind") == _RESULT).union(weights).groupBy("block").applyInArrow(_finish(model.tokens, id_type), schema)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for kind, data in zip(batch.column(0).to_pylist(), batch.column(1)):
            n = pickle.loads(data.as_py())
            yield pa.RecordBatch.from_arrays([pa.array([kind] * len(n), pa.int32()), pa.array(range(len(n)), pa.int32()), pa.array(n, pa.int64())], ["kind", "place", "n"])
