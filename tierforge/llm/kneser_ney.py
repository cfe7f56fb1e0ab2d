"""Quality by perplexity: an interpolated modified Kneser-Ney trigram model of all trusted text.

All training documents are learned from, whole, so the model grows with them and stays a table. Documents are packed into
blocks of about ``BLOCK`` tokens. Training blocks send their distinct trigrams with counts to the shards of a hash range; a
shard adds them up and says which one block answers for a trigram. These blocks send what their trigrams give the bigrams: the
continuation counts of the last two words, and for the first two, the context, its sum and its numbers of followers seen
once, twice and at all. The bigrams' sums give those of the words likewise. So the model is three tables of counts, bucketed
by shard, with discounts (one for each of the counts 1, 2 and 3 or more, from counts of counts); no probability is stored:

    p(c | a b) = own(a b c) + weight(a b) * (own(b c) + weight(b) * p(c)),  own = (n - discount) / sum of the context

is made at each token from the counts of its n-grams and contexts, which the blocks of the documents ask of the shards
(see ``blocks``), part of the documents by part: only one part's blocks and messages are on disk at a time, and the
bucketed tables are not shuffled. A document is kept if its perplexity is at most its language's threshold:
the ``QUANTILE`` quantile of all trusted documents that the model has not seen, times ``SLACK``.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blocks import ROW, batch_of, cuts, pack, pack_keys, row, unpack, unpack_keys
from .common import bucketed, discard, stored
from .katz import Block, _data, _pack_documents, _sums
from .text import Spans, Words, distinct, lower, mix

TRUSTED_DOCS = 4_000  # bounds of ``training_sample``, which ``judged`` does not use
TRUSTED_CHARS = 50_000
TRUSTED_TOTAL = 16_000_000
BLOCK = 1 << 19  # tokens
SHARD = 1 << 25  # bytes of text for each shard of the hash range: what blocks send and ask follows the text, not the partitions
PARTS = 6  # of the documents, which ask one part after the other: only one part's blocks and messages are on disk at a time
QUANTILE = 0.99
SLACK = 1.2
FEWEST = 30  # trusted documents that a language's own quantile needs; with fewer, that of all languages holds
_U = np.uint64
_START, _END = _U(2), _U(1)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(mix(a) * _U(3) + b)


def _histories(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The word before each token and the one before that."""
    first = np.cumsum(counts) - counts
    one, two = np.empty_like(keys), np.empty_like(keys)
    one[1:], two[2:] = keys[:-1], keys[:-2]
    one[first] = _START
    two[first] = _START
    second = first[counts > 1] + 1
    two[second] = _START
    return one, two


def _tokens(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes with an end after each document, the two words before each, and each token's document."""
    data = lower(data)
    words = Words(data, offs)
    keys = np.insert(Spans(data).of(words.starts, words.ends), words.first[1:], _END)
    counts = words.counts + 1
    return keys, *_histories(keys, counts), np.repeat(np.arange(len(counts)), counts)


def _discounts(of_counts: list[int]) -> list[float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more; 0.5, 0.75, 0.9 where counts of counts don't give them."""
    n = of_counts
    if all(n):
        y = n[0] / (n[0] + 2 * n[1])
        d = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
        if all(0 < d[k] < k + 1 for k in range(3)):
            return d
    return [0.5, 0.75, 0.9]


class Rates:
    """What all documents share: the discounts and the unknown word. ``counts`` has by the length of the n-grams the sum of
    their counts, how many there are, and how many have the counts 1 to 4."""

    def __init__(self, counts: dict[int, list[int]]):
        self.d = {n: _discounts(c[2:]) for n, c in counts.items()}
        total, types, ones, twos = counts[1][:4]
        lost = self._lost(types, ones, twos, 1)
        self.total = total or 1
        self.unknown = (lost or 1.0) / self.total / (types + 1)  # the words' lost mass is shared by all words and the unknown one

    def _lost(self, types, ones, twos, n: int):
        d = self.d[n]
        return ones * d[0] + twos * d[1] + (types - ones - twos) * d[2]

    def _own(self, count: np.ndarray, total, n: int) -> np.ndarray:
        """The part of an n-gram's probability that is its own; 0 for one that was not seen."""
        return np.where(count > 0, (count - np.array([0, *self.d[n]])[np.minimum(count, 3)]) / np.maximum(total, 1), 0)

    def _weight(self, sums: list[np.ndarray], n: int) -> np.ndarray:
        """The share of a context that backs off; 1 for one that was not seen."""
        total, ones, twos, types = sums
        return np.where(total > 0, self._lost(types, ones, twos, n) / np.maximum(total, 1), 1)

    def log10(self, three: list[np.ndarray], two: list[np.ndarray], before: list[np.ndarray], one: list[np.ndarray], word: list[np.ndarray]) -> np.ndarray:
        """Of tokens c after a b: the counts of a b c, b c and c, and the sums of the contexts a b (``before``) and b (``word``)."""
        weights = self._weight(before, 3), self._weight(word, 2)
        p1 = self._own(one[0], self.total, 1) + self.unknown
        p2 = self._own(two[0], word[0], 2) + weights[1] * p1
        log = lambda x: np.log10(x).astype(np.float32)
        out = log(self._own(three[0], before[0], 3) + weights[0] * p2)
        left = np.flatnonzero(three[0] == 0)
        shorter, rest = log(p2[left]), np.flatnonzero(two[0][left] == 0)
        shorter[rest] = log(p1[left[rest]]) + log(weights[1][left[rest]])
        out[left] = shorter + log(weights[0][left])
        return out


def _width(n: int) -> int:
    """Columns of the n-grams of n words: their count, and as contexts of longer ones the sum and the followers seen once, twice, at all."""
    return 1 if n == 3 else 5


def _found(known: np.ndarray, columns: list[np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Which keys are among the sorted keys ``known``, and these ones' columns."""
    if not len(known):
        return np.zeros(len(keys), bool), columns
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    hit = known[at] == keys
    return hit, [c[at[hit]] for c in columns]


def _spread(hit: np.ndarray, columns: list[np.ndarray]) -> list[np.ndarray]:
    """Columns at all keys, 0 where there is none."""
    out = [np.zeros(len(hit), np.int64) for _ in columns]
    for x, c in zip(out, columns):
        x[hit] = c
    return out


class Model:
    """The count tables of a small corpus in memory: by the length of the n-grams their sorted keys and columns."""

    def __init__(self, tables: dict[int, tuple[np.ndarray, list[np.ndarray]]], rates: Rates):
        self.tables, self.rates = tables, rates

    def scores(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and log10 probability of each document."""
        c, b, a, doc = _tokens(data, offs)
        n = len(offs) - 1
        ab = _pair(a, b)
        get = lambda n, keys: _spread(*_found(*self.tables[n], keys))
        p = self.rates.log10(get(3, _pair(ab, c)), get(2, _pair(b, c))[:1], get(2, ab)[1:], get(1, c)[:1], get(1, b)[1:])
        return np.bincount(doc, minlength=n), np.bincount(doc, p, n)


def _narrow(column: np.ndarray) -> tuple[str, bytes]:
    """Counts, packed in as few bytes as the largest needs."""
    kind = np.min_scalar_type(int(column.max(initial=0)))
    return kind.str, pack(column.astype(kind))


def _wide(kind: str, data: bytes) -> np.ndarray:
    return unpack(data, np.dtype(kind)).astype(np.int64)


def _columns_of(data: bytes) -> tuple[np.ndarray, list[np.ndarray]]:
    keys, columns = pickle.loads(data)
    return unpack_keys(keys), [_wide(*c) for c in columns]


def _packed(keys: np.ndarray, columns: list[np.ndarray]) -> bytes:
    return pickle.dumps((pack_keys(keys), [_narrow(c) for c in columns]))


def _messages(number: int, n: int, keys: np.ndarray, columns: list[np.ndarray], bits: int) -> pa.RecordBatch:
    cut = cuts(keys, bits)
    return batch_of([row(number, n, s, _packed(keys[a:b], [c[a:b] for c in columns])) for s, (a, b) in enumerate(zip(cut[:-1], cut[1:])) if b > a])


def _send(bits: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, data in zip(batch.column(0).to_pylist(), batch.column(3)):
                block = Block(data.as_py(), 3)
                yield _messages(number, 3, block.keys[2], [block.counted(3)], bits)
    return work


def _add(table: pa.Table) -> pa.Table:
    """All parts of one shard of the n-grams of one length: the sums (block -1), what they sum up to and their counts of counts
    (block -2), and back to each block twice its n-grams' counts, plus one where it is the block that answers for one."""
    n, shard = table["kind"][0].as_py(), table["shard"][0].as_py()
    parts = [_columns_of(d.as_py()) for d in table["data"]]
    keys = [k for k, _ in parts]
    columns = [np.concatenate(c) for c in zip(*(c for _, c in parts))]
    bounds = np.concatenate(([0], np.cumsum([len(k) for k in keys])))
    unique, _, place = distinct(np.concatenate(keys))
    sums = [np.bincount(place, c, len(unique)).astype(np.int64) for c in columns]  # exact: below 2^53
    seen = sums[0][sums[0] > 0]
    out = [row(-1, n, shard, _packed(unique, sums)), row(-2, n, shard, pickle.dumps([int(seen.sum()), len(seen), *[int((seen == i).sum()) for i in (1, 2, 3, 4)]]))]
    if n > 1:
        has = np.flatnonzero(columns[0] > 0)[::-1]
        first = np.full(len(unique), -1, np.int64)
        first[place[has]] = has
        back = 2 * sums[0][place] + (first[place] == np.arange(len(place)))
        out += [row(b, n, shard, pickle.dumps(_narrow(back[lo:hi]))) for b, lo, hi in zip(table["block"].to_pylist(), bounds[:-1], bounds[1:])]
    return pa.Table.from_batches([batch_of(out)])


def _given(block: Block, n: int, count: np.ndarray, mine: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """What the n-grams that a block answers for give those one word shorter: which of these get any, and their columns."""
    some, count = block.some[n - 1][mine], count[mine]
    context, last, size = block.context[n - 1][some], block.place[n - 2][some], len(block.keys[n - 2])
    columns = [np.bincount(x, minlength=size) for x in (last, context[count == 1], context[count == 2], context)]
    columns.insert(1, np.bincount(context, count, size).astype(np.int64))
    some = (columns[0] > 0) | (columns[4] > 0)
    return some, [c[some] for c in columns]


def _by_shard(rows: pa.Table, n: int) -> list:
    """What came back for a block's n-grams of n words, in the order of the shards, which is that of the keys."""
    mine = [(s, d) for k, s, d in zip(rows["kind"].to_pylist(), rows["shard"].to_pylist(), rows["data"]) if k == n]
    return [pickle.loads(d.as_py()) for _, d in sorted(mine, key=lambda x: x[0])]


def _send_shorter(bits: int, n: int):
    def work(rows: pa.Table) -> pa.Table:
        """What a block gives the n-grams of n words, from the sums of the longer ones."""
        block = Block(_data(rows), 3)
        whole = lambda n: np.concatenate([_wide(*x) for x in _by_shard(rows, n)] or [np.zeros(0, np.int64)])
        back = whole(3)
        some, columns = _given(block, 3, back >> 1, (back & 1) > 0)
        if n == 1:
            back = np.zeros(len(some), np.int64)
            back[some] = whole(2)
            some, columns = _given(block, 2, back >> 1, (back & 1) > 0)
        return pa.Table.from_batches([_messages(rows["block"][0].as_py(), n, block.keys[n - 1][some], columns, bits)])

    return work


def _size(docs: DataFrame, text: str) -> int:
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0


class Counts:
    """The model: by the length of the n-grams a table of ``blocks`` rows bucketed by shard, of which ``sums`` are the model's."""

    def __init__(self, tables: dict[int, DataFrame], rates: Rates, bits: int):
        self.tables, self.rates, self.bits = tables, rates, bits

    def sums(self, n: int) -> DataFrame:
        return self.tables[n].filter("block = -1")

    def discard(self) -> None:
        for table in self.tables.values():
            discard(table)


def _blocks(docs: DataFrame, size: int, block: int, label: str) -> DataFrame:
    """Blocks of all rows of doc_id, text, held_out: of about ``size`` bytes, so that small tables in many partitions make few blocks."""
    most = max(docs.sparkSession.sparkContext.defaultParallelism, 1 + size // (4 * block))  # a token and its space take some 6 bytes
    return stored(_pack_documents(docs.coalesce(most), block), label)


def counts(trusted: DataFrame, text: str = "text", block: int = BLOCK, size: int | None = None) -> Counts:
    """The model of all rows of ``trusted``. ``size``, the bytes of text of the rows to be scored, is what the number of shards follows."""
    size = _size(trusted, text) if size is None else size
    bits = max(4, (size // SHARD).bit_length())
    packed = _blocks(trusted.select(F.lit(0).alias("doc_id"), F.col(text).alias("text"), F.lit(False).alias("held_out")), size, block, "kn-learned")
    added = lambda sent, label: bucketed(sent.groupBy("shard").applyInArrow(_add, ROW), label, "shard")
    tables = {3: added(packed.mapInArrow(_send(bits), ROW), "kn-three")}
    for n, label in ((2, "kn-two"), (1, "kn-one")):
        back = [t.filter("block >= 0") for t in tables.values()]
        tables[n] = added(reduce(DataFrame.union, back, packed).groupBy("block").applyInArrow(_send_shorter(bits, n), ROW), label)
    discard(packed)
    totals = reduce(DataFrame.union, tables.values()).filter("block = -2").select("kind", "data").mapInArrow(_sums, "kind int, place int, n bigint")
    sums = {(r["kind"], r["place"]): r["n"] for r in totals.groupBy("kind", "place").agg(F.sum("n").alias("n")).collect()}
    return Counts(tables, Rates({n: [sums.get((n, i), 0) for i in range(6)] for n in (1, 2, 3)}), bits)


def trained(trusted: DataFrame, text: str = "text") -> Model:
    """The model of all rows of ``trusted``, a small table, in memory."""
    model, tables = counts(trusted, text), {}
    for n in model.tables:
        parts = [_columns_of(r["data"]) for r in sorted(model.sums(n).collect(), key=lambda r: r["shard"])]
        keys = np.concatenate([k for k, _ in parts]) if parts else np.zeros(0, _U)
        tables[n] = keys, [np.concatenate(c) for c in zip(*(c for _, c in parts))] or [np.zeros(0, np.int64)] * _width(n)
    model.discard()
    return Model(tables, model.rates)


def _ask(bits: int, n: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The distinct n-grams of n words of each block, with the histories of first tokens, by shard."""
        for batch in batches:
            for number, data in zip(batch.column(0).to_pylist(), batch.column(3)):
                _, _, _, sizes, vocabulary, tokens = pickle.loads(data.as_py())
                words = unpack_keys(vocabulary)[unpack(tokens, np.uint32)]
                one, two = _histories(words, unpack(sizes, np.int64))
                start = np.array([_START])
                grams = np.append(words, start) if n == 1 else np.append(_pair(one, words), _pair(start, start)) if n == 2 else _pair(_pair(two, one), words)
                grams = np.sort(grams)  # np.unique hashes, which is far slower
                keys = grams[np.insert(grams[1:] != grams[:-1], 0, True)]
                cut = cuts(keys, bits)
                yield batch_of([row(number, n, s, pack_keys(keys[a:b])) for s, (a, b) in enumerate(zip(cut[:-1], cut[1:])) if b > a])
    return work


def _reply(n: int):
    def work(asked: pa.Table, model: pa.Table) -> pa.Table:
        """All that the blocks ask of one shard: its columns at their n-grams."""
        known, columns = _columns_of(model["data"][0].as_py()) if len(model) else (np.zeros(0, _U), [np.zeros(0, np.int64)] * _width(n))
        out = []
        for number, shard, data in zip(*(asked[c] for c in ("block", "shard", "data"))):
            hit, found = _found(known, columns, unpack_keys(data.as_py()))
            out.append(row(number.as_py(), n, shard.as_py(), pickle.dumps((len(hit), pack(np.packbits(hit)), [_narrow(x) for x in found]))))
        return pa.Table.from_batches([batch_of(out)])
    return work


def _back(rows: pa.Table, n: int) -> list[np.ndarray]:
    """The columns of a block's n-grams of n words, 0 where there is none."""
    parts = [(np.unpackbits(unpack(hit, np.uint8), count=size), [_wide(*c) for c in columns]) for size, hit, columns in _by_shard(rows, n)]
    return _spread(np.concatenate([h for h, _ in parts]) > 0, [np.concatenate(c) for c in zip(*(c for _, c in parts))])


def _judge(rates: Rates):
    def work(rows: pa.Table) -> pa.Table:
        """Tokens and perplexity of a block's documents."""
        block = Block(_data(rows), 3)
        one, two, three = (_back(rows, n) for n in (1, 2, 3))
        at = lambda columns, place: [c[place] for c in columns]
        p = rates.log10(at(three, block.place[2]), at(two[:1], block.place[1]), at(two[1:], block.context[2]), at(one[:1], block.place[0]), at(one[1:], block.context[1]))
        score = np.bincount(block.doc, p, len(block.counts))
        doc_id, lang = block.ids.flatten()
        return pa.table([doc_id, lang, pa.array(block.counts.astype(np.int64)), pa.array(10 ** (-score / block.counts))], ["doc_id", "lang", "n_tokens", "perplexity"])

    return work


def perplexities(docs: DataFrame, model: Counts, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", block: int = BLOCK, parts: int = PARTS, size: int | None = None) -> DataFrame:
    """doc_id, lang, n_tokens, perplexity of every row under the model (see ``counts``), stored; a text without
    words has n_tokens 1 (its end)."""
    slim = docs.select(F.struct(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang")).alias("id"), F.col(text).alias("text"), F.lit(False).alias("held_out"))
    kinds = {f.name: f.dataType.simpleString() for f in slim.schema["id"].dataType.fields}
    schema = f"doc_id {kinds['doc_id']}, lang {kinds['lang']}, n_tokens bigint, perplexity double"
    part = F.pmod(F.xxhash64("id.doc_id", "text"), F.lit(parts))
    size = _size(slim, "text") if size is None else size
    out = []
    for i in range(parts):
        packed = _blocks(slim.filter(part == i), size // parts, block, "kn-blocks")
        back = []
        for n in model.tables:
            asked = packed.mapInArrow(_ask(model.bits, n), ROW).groupBy("shard")
            back.append(stored(asked.cogroup(model.sums(n).groupBy("shard")).applyInArrow(_reply(n), ROW), "kn-replies"))
        out.append(stored(reduce(DataFrame.union, back, packed).groupBy("block").applyInArrow(_judge(model.rates), schema), "kn-perplexities"))
        for done in (packed, *back):
            discard(done)
    return reduce(DataFrame.union, out)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids with quality 1 and without toxic 1, once each, and whether the model may learn from them (four fifths)."""
    ids = labels.filter("quality = 1 and coalesce(toxic, 0) <> 1 and doc_id is not null").select("doc_id").distinct()
    return ids.withColumn("training", F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(5)) != 0)


def training_sample(docs: DataFrame, ids: DataFrame, most: int = TRUSTED_DOCS, chars: int = TRUSTED_CHARS, total: int = TRUSTED_TOTAL) -> DataFrame:
    """At most ``most`` different training documents of at most ``chars`` characters that ``docs`` has, ``total``
    characters in all: those of the smallest hashes of their ids, as far as their running sum of sizes goes.
    A row that is repeated counts once. For trials with ``trained``: ``judged`` learns from all training documents."""
    short = docs.select("doc_id", "text").filter(F.length("text") <= chars)
    print_of = F.xxhash64("text").alias("print")
    order = [F.xxhash64(F.lit(17), "doc_id"), "doc_id", "print"]
    there = short.select("doc_id", print_of, F.length("text").alias("size")).distinct()
    first = there.join(ids.filter("training").select("doc_id"), "doc_id", "left_semi").orderBy(*order).limit(most)  # a top-k: each task sends k rows at most
    running = F.sum("size").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))  # over those k rows
    chosen = first.withColumn("running", running).filter(F.col("running") <= total).select("doc_id", "print")
    some = short.withColumn("print", F.xxhash64("text")).join(F.broadcast(chosen), ["doc_id", "print"]).select("doc_id", "text").distinct()
    return stored(some, "kn-trusted")


def judged(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, slack: float = SLACK, fewest: int = FEWEST) -> DataFrame:
    """doc_id, lang, n_tokens, perplexity, threshold, kept: one row for each row of ``docs`` (doc_id, text, lang).

    A null or empty text is not kept. A null lang is a language of its own. Labels of ids that no document has are
    ignored; a doc_id labelled twice is trusted if any of its labels trusts it. Without trusted documents there is no threshold (null) and every text with words is kept.
    """
    ids = trusted_ids(labels)
    learned = docs.select("doc_id", "text").filter("text is not null").join(ids.filter("training").select("doc_id"), "doc_id", "left_semi")
    size = _size(docs, "text")
    model = counts(learned.distinct(), size=size)  # a row that is repeated counts once
    rows = perplexities(docs, model, size=size)
    model.discard()
    seen = rows.join(ids, "doc_id", "left_semi").join(learned.select("doc_id").distinct(), "doc_id", "left_anti").withColumn("log", F.log("perplexity"))
    cut = F.percentile_approx("log", F.lit(quantile), F.lit(10_000)).alias("cut")
    every = seen.agg(cut.alias("every"))
    own = seen.groupBy("lang").agg(cut.alias("own"), F.count(F.lit(1)).alias("size")).filter(F.col("size") >= fewest)
    own = own.select(F.col("lang").alias("__lang"), "own")
    rows = rows.join(own, F.col("lang").eqNullSafe(F.col("__lang")), "left").crossJoin(F.broadcast(every))  # one row
    threshold = F.exp(F.coalesce("own", "every")) * slack
    kept = (F.col("n_tokens") > 1) & F.coalesce(F.col("perplexity") <= threshold, F.lit(True))
    return rows.select("doc_id", "lang", "n_tokens", "perplexity", threshold.alias("threshold"), kept.alias("kept"))
