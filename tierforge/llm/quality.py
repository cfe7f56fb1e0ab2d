"""Quality rules as a short-circuit cascade.

Each rule needs some statistics of a text and says which texts it rejects. A bounded sample gives each
statistic's cost (measured seconds a byte) and each rule's rejections; rules are ordered greedily by the
rejections they add per second they add, given the rules before them. Per step of about 1 MB of text, a rule
is then run over the texts that no earlier rule rejected, and only for those its statistics are computed.
The verdict is the conjunction of all rules, so the order (and the sample) changes the cost, never the result.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from .text import Spans, Words, mix, per_row, steps, utf8

SAMPLE_ROWS = 1000  # bound of the sample that orders the rules

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True


class Step:
    """The statistics of some documents, each computed once when first asked for."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        self.data, self.offs, self.n = data, offs, len(offs) - 1
        self._made: dict = {}

    def __getattr__(self, name: str):
        if name.startswith("_") or name not in STATISTICS:
            raise AttributeError(name)
        if name not in self._made:
            self._made[name] = STATISTICS[name](self)
        return self._made[name]

    def part(self, rows: np.ndarray) -> Step:
        """The same for the documents ``rows``."""
        size = np.diff(self.offs)[rows]
        offs = np.concatenate(([0], np.cumsum(size)))
        take = np.repeat(self.offs[rows] - offs[:-1], size) + np.arange(offs[-1])
        return Step(self.data[take], offs)


def _later(key: np.ndarray) -> np.ndarray:
    """True where an equal key stands earlier."""
    first = np.zeros(len(key), bool)
    first[np.unique(key, return_index=True)[1]] = True
    return ~first


def _dup_lines(s: Step) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and those equal to an earlier one, per document."""
    breaks = np.union1d(np.flatnonzero(s.data == 10) + 1, s.offs[:-1][np.diff(s.offs) > 0])
    ends = np.append(breaks[1:], s.offs[-1])
    ends = ends - (s.data[ends - 1] == 10) if len(breaks) else ends[:0]
    worded = np.searchsorted(s.words.starts, breaks) < np.searchsorted(s.words.starts, ends)
    begins, ends = breaks[worded], ends[worded]
    doc = np.searchsorted(s.offs, begins, "right") - 1
    again = _later(s.spans.of(begins, ends) ^ mix(doc.astype(np.uint64) + np.uint64(1)))
    return np.bincount(doc, minlength=s.n), np.bincount(doc[again], minlength=s.n)


def _repeat_words(s: Step) -> np.ndarray:
    h, doc = s.word_hash, s.words.doc
    if len(h) < 3:
        return np.zeros(s.n, np.int64)
    key = mix(h[:-2]) + mix(h[1:-1] ^ np.uint64(0x5BD1E995)) * np.uint64(3) + mix(h[2:] ^ np.uint64(0x27D4EB2F)) * np.uint64(5)
    key = mix(key ^ mix(doc[:-2].astype(np.uint64) + np.uint64(1)))
    at = np.flatnonzero(doc[:-2] == doc[2:])
    order = at[np.argsort(key[at])]
    same = key[order[1:]] == key[order[:-1]]
    twice = np.union1d(order[1:][same], order[:-1][same])
    hit = np.zeros(len(h), bool)
    for k in range(3):
        hit[twice + k] = True
    return np.bincount(doc[hit], minlength=s.n)


def _top_words(s: Step) -> np.ndarray:
    """Occurrences of each document's most frequent word."""
    key = np.sort(mix(s.word_hash ^ mix(s.words.doc.astype(np.uint64) + np.uint64(1))))
    order = np.argsort(mix(s.word_hash ^ mix(s.words.doc.astype(np.uint64) + np.uint64(1))), kind="stable")
    begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    top = np.zeros(s.n, np.int64)
    np.maximum.at(top, s.words.doc[order[begin]], np.diff(np.append(begin, len(key))))
    return top


STATISTICS: dict[str, Callable[[Step], object]] = {
    "words": lambda s: Words(s.data, s.offs),
    "spans": lambda s: Spans(s.data),
    "word_hash": lambda s: s.spans.of(s.words.starts, s.words.ends),
    "n_words": lambda s: s.words.counts,
    "word_chars": lambda s: per_row(s.words.inside & ((s.data & 0xC0) != 0x80), s.offs),
    "n_symbols": lambda s: per_row(_SYMBOL[s.data], s.offs),
    "n_upper": lambda s: per_row(_UPPER[s.data], s.offs),
    "n_exclaims": lambda s: per_row(s.data == 33, s.offs),
    "lines": _dup_lines,
    "n_lines": lambda s: s.lines[0],
    "n_dup_lines": lambda s: s.lines[1],
    "n_repeat_words": _repeat_words,
    "n_top_word": _top_words,
}


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Step], np.ndarray]


BASE_RULES = (
    Rule("few_words", lambda s: s.n_words < 50),
    Rule("repeated_words", lambda s: 100 * s.n_repeat_words > 50 * s.n_words),
)
RULES = (
    Rule("symbols", lambda s: 10 * s.n_symbols > s.n_words),
    Rule("duplicate_lines", lambda s: 2 * s.n_dup_lines > s.n_lines),
    Rule("word_length", lambda s: (s.word_chars < 2 * s.n_words) | (s.word_chars > 12 * s.n_words)),
    Rule("one_word", lambda s: 10 * s.n_top_word > 3 * s.n_words),
    Rule("upper_case", lambda s: 10 * s.n_upper > 4 * s.word_chars),
    Rule("exclamations", lambda s: 2 * s.n_exclaims > s.n_words),
)
BASE_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def order_rules(rules: Sequence[Rule], data: np.ndarray, offs: np.ndarray) -> list[Rule]:
    """Greedy order by (new rejections + 1/2) per (seconds of what is not computed yet) on a sample."""
    rejected, cost = {}, {}
    for rule in rules:
        began = time.perf_counter()
        rejected[rule.name] = np.asarray(rule.rejects(Step(data, offs)), bool)
        cost[rule.name] = time.perf_counter() - began + 1e-9
    left, out, alive = list(rules), [], np.ones(len(offs) - 1, bool)
    while left:
        best = max(left, key=lambda r: ((rejected[r.name] & alive).sum() + 0.5) / cost[r.name])
        alive &= ~rejected[best.name]
        out.append(best)
        left.remove(best)
    return out


def sample_order(docs: DataFrame, rules: Sequence[Rule], text: str = "text", rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The order of ``rules`` measured on at most ``rows`` sampled documents of bounded length. They come from as many
    partitions as it takes to find them, one after the other; no task gathers a share of every partition."""
    taken = docs.select(F.substring(F.col(text), 1, 20_000).alias("t")).sample(0.2, seed=11).take(rows)
    data, offs = utf8(pa.array([r["t"] for r in taken], pa.large_string()))
    return order_rules(rules, data, offs)


def _rejected(step: Step, rules: Sequence[Rule]) -> np.ndarray:
    out = np.zeros(step.n, bool)
    rows = np.arange(step.n)
    for rule in rules:
        if not len(rows):
            break
        bad = np.asarray(rule.rejects(step), bool)
        out[rows[bad]] = True
        if bad.any():
            rows, step = rows[~bad], step.part(np.flatnonzero(~bad))
    return out


def judged(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = BASE_RULES + RULES, column: str = "kept",
           sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """All columns of ``docs`` and ``column``: no rule rejects the text. A null text has no words; an empty
    table gives an empty table; other columns, whatever their names, pass through."""
    ordered = sample_order(docs, rules, text, sample_rows)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = utf8(batch.column(batch.schema.names.index(text)))
            kept = [~_rejected(Step(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]), ordered) for lo, hi in steps(offs)]
            kept = pa.array(np.concatenate(kept) if kept else np.zeros(0, bool))
            yield pa.RecordBatch.from_arrays([*batch.columns, kept], [*batch.schema.names, column])

    return docs.mapInArrow(add, StructType([*docs.schema.fields, StructField(column, BooleanType())]))


def statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: Sequence[Rule] = RULES,
               sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, the five counts of every text, base_failed and kept. The cascade runs over the texts that pass the base.

    A null text has no words, so it fails the base; repeated rows each give a row, null ids stay null; an empty table gives an
    empty table. A text of any length is one step of vectorised work, about 60 bytes of memory a byte of it.
    """
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    ordered = sample_order(slim, rules, "text", sample_rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = utf8(batch.column(1))
            for lo, hi in steps(offs):
                step = Step(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
                failed = np.zeros(step.n, bool)
                for rule in BASE_RULES:
                    failed |= rule.rejects(step)
                kept = ~failed
                if kept.any():
                    rest = step if kept.all() else step.part(np.flatnonzero(kept))
                    kept[kept] = ~_rejected(rest, ordered)
                counts = [pa.array(getattr(step, c).astype(np.int64)) for c in BASE_COUNTS]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), *counts, pa.array(failed), pa.array(kept)],
                    ["doc_id", *BASE_COUNTS, "base_failed", "kept"],
                )

    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(count, f"doc_id {kind}, " + ", ".join(f"{c} bigint" for c in BASE_COUNTS) + ", base_failed boolean, kept boolean")
