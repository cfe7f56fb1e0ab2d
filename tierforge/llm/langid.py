"""Language ID by multilingual mixtures.

Each language has a multinomial over hashed letter 4-grams (bytes), learned from all documents given for
learning. A document is a mixture: expectation-maximisation finds the languages' proportions from its
4-grams' likelihoods. The languages are then put in the order of their proportions, and of the sets of the
first one, two, ... the one with the largest likelihood less a penalty per language is taken and fitted again.
Sets grow, up to all languages, until the penalty outweighs all that any further language could still add.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import STEP_BYTES, steps, utf8

GRAM_BITS = 16  # hash buckets of the 4-grams
WIDE = 64  # languages beyond which a step holds fewer texts, by so much more
ROUNDS = 10
PENALTY = 4.0  # times half the logarithm of the number of 4-grams, per further language
SMOOTH = 0.5
UNKNOWN = "und"

_LETTER = np.full(256, 32, np.uint8)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)
_ANY_LETTER = regex.compile(r"\p{L}")


def grams(data: np.ndarray, offs: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of each 4-gram whose second byte is in a word; texts are padded with blanks."""
    n = len(offs) - 1
    doc = np.repeat(np.arange(n, dtype=np.uint32), np.diff(offs))
    line = np.full(len(data) + 3 * n + 3, 32, np.uint32)
    line[np.arange(len(data)) + 3 * doc.astype(np.int64) + 1] = _LETTER[data]
    at = np.flatnonzero(line != 32) - 1
    code = line[at] | line[at + 1] << np.uint32(8) | line[at + 2] << np.uint32(16) | line[at + 3] << np.uint32(24)
    code ^= code >> np.uint32(15)
    code *= np.uint32(0x2C1B3C6D)
    code ^= code >> np.uint32(12)
    code *= np.uint32(0x297A2D39)
    return doc[_LETTER[data] != 32], code >> np.uint32(32 - bits)


def _counted(bits: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), object)
            data, offs = utf8(batch.column(0))
            for lo, hi in steps(offs):
                doc, bucket = grams(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], bits)
                for lang in set(langs[lo:hi].tolist()):
                    mine = (langs[lo:hi] == lang)[doc]
                    counts[lang] = counts.get(lang, 0) + np.bincount(bucket[mine], minlength=1 << bits)
        for lang, n in counts.items():
            at = np.flatnonzero(n)
            if not len(at):  # the language is known, if by nothing else
                at = np.zeros(1, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(n[at], pa.int64())], ["lang", "bucket", "n"])

    return work


class Model:
    """Languages and the chances of 4-gram buckets: what a bucket that a language never showed has, and what the counted ones
    have beyond that, by bucket."""

    def __init__(self, langs: list[str], lang: np.ndarray, bucket: np.ndarray, n: np.ndarray, bits: int = GRAM_BITS):
        self.langs, self.bits = langs, bits
        total = np.bincount(lang, n, len(langs)) + SMOOTH * (1 << bits)
        order = np.argsort(bucket, kind="stable")
        self.unseen = (SMOOTH / total).astype(np.float32)
        self.lang, self.chance = lang[order], (n[order] / total[lang[order]]).astype(np.float32)
        self.begin = np.searchsorted(bucket[order], np.arange((1 << bits) + 1))

    def chances(self, bucket: np.ndarray) -> np.ndarray:
        """A row for each bucket, a column for each language."""
        out = np.tile(self.unseen, (len(bucket), 1))
        size = self.begin[bucket + 1] - self.begin[bucket]
        at = np.repeat(self.begin[bucket] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        out[np.repeat(np.arange(len(bucket)), size), self.lang[at]] += self.chance[at]
        return out

    def mixtures(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Proportions of the chosen languages (rows of zeros: no 4-gram)."""
        n, k = len(offs) - 1, len(self.langs)
        doc, bucket = grams(data, offs, self.bits)
        out = np.zeros((n, k))
        if not len(doc) or not k:
            return out
        cell, times = np.unique(doc.astype(np.uint64) << np.uint64(self.bits) | bucket, return_counts=True)
        doc = (cell >> np.uint64(self.bits)).astype(np.int64)
        chance = self.chances((cell & np.uint64((1 << self.bits) - 1)).astype(np.int64))
        begin = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
        size = np.diff(np.append(begin, len(doc)))
        times = times.astype(np.float32)
        total = np.add.reduceat(times, begin).astype(np.float64)

        def fit(share: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
            for _ in range(rounds):
                part = chance * np.repeat(share.astype(np.float32), size, axis=0)
                part *= (times / part.sum(axis=1))[:, None]
                share = np.add.reduceat(part, begin, axis=0) / total[:, None]
            likely = np.log(np.einsum("ij,ij->i", chance, np.repeat(share.astype(np.float32), size, axis=0)))
            return share, np.add.reduceat(times * likely, begin).astype(np.float64)

        every, likely = fit(np.full((len(begin), k), 1 / k), ROUNDS)
        # no set's likelihood is larger: the mixtures' likelihood is concave, and this is the most that its slope allows
        part = chance * (times / np.einsum("ij,ij->i", chance, np.repeat(every.astype(np.float32), size, axis=0)))[:, None]
        most = likely + total * np.log((np.add.reduceat(part, begin, axis=0) / total[:, None]).max(axis=1))
        penalty = PENALTY * 0.5 * np.log(np.maximum(total, 2))
        rank = np.argsort(np.argsort(-every, axis=1, kind="stable"), axis=1)
        best, value = np.zeros((len(begin), k)), np.full(len(begin), -np.inf)
        where, places = doc[begin], np.arange(len(begin))
        for m in range(1, k + 1):
            left = most - (m - 1) * penalty > value[places]
            if not left.any():
                break
            if not left.all():  # the others are settled
                cells = np.repeat(left, size)
                chance, times, every, rank, total, most, penalty, places, size = (
                    chance[cells], times[cells], every[left], rank[left], total[left], most[left], penalty[left], places[left], size[left])
                begin = np.cumsum(size) - size
            start = np.where(rank < m, np.maximum(every, 1e-6), 0.0)
            share, likely = fit(start / start.sum(axis=1, keepdims=True), 0 if m == 1 else 3)
            likely = likely - (m - 1) * penalty
            more = likely > value[places]
            best[places[more]], value[places[more]] = share[more], likely[more]
        out[where] = best
        return out


def learned(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """The model of all rows of ``docs`` whose lang is not null."""
    known = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter("lang is not null")
    rows = known.mapInArrow(_counted(GRAM_BITS), "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs, lang = np.unique(np.array(rows["lang"].to_pylist(), str), return_inverse=True)
    return Model(langs.tolist(), lang, rows["bucket"].to_numpy(), rows["n"].to_numpy().astype(np.float64))


def predicted(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (its proportion), langs (all chosen ones with proportions); one row for each row of ``docs``.

    A text that is null or without any letter is ``und`` with score 0, as is every text when nothing was learned;
    of equal proportions the smaller name wins; a text of letters but no known 4-gram gets the model's best guess.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            data, offs = utf8(batch.column(1))
            for lo, hi in steps(offs, STEP_BYTES * WIDE // max(WIDE, len(model.langs))):
                part, at = data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
                shares = model.mixtures(part, at)
                names, scores, sets = [], [], []
                for d, share in enumerate(shares):
                    top = int(share.argmax()) if share.any() else -1
                    if top >= 0 and not _ANY_LETTER.search(part[at[d]:at[d + 1]].tobytes().decode()):
                        top = -1
                    names.append(model.langs[top] if top >= 0 else UNKNOWN)
                    scores.append(float(min(1.0, share[top])) if top >= 0 else 0.0)
                    chosen = sorted(np.flatnonzero(share > 0), key=lambda i: (-share[i], i)) if top >= 0 else []  # noqa: B023
                    sets.append(",".join(f"{model.langs[i]}:{share[i]:.3f}" for i in chosen))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(sets, pa.string())],
                    ["doc_id", "lang_pred", "score", "langs"])

    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return slim.mapInArrow(work, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, langs string")


def identified(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Learn from the rows that ``held_out`` does not hold out, predict all: doc_id, held_out, lang_pred, score, langs."""
    model = learned(docs.filter(~held_out), text, lang)
    return predicted(docs, model, doc_id, text).withColumn("held_out", held_out).select("doc_id", "held_out", "lang_pred", "score", "langs")
