"""Span hashes: equal for equal bytes wherever they stand, different for texts that defeat sums modulo a power of two."""

import numpy as np
import pytest

from tierforge.llm import katz, quality, suffix
from tierforge.llm.text import Spans, Words

from .brute import quality as plain_quality
from .brute import repeats


def thue_morse(n, letters="ab"):
    """The first ``n`` letters of the sequence."""
    return "".join(letters[i.bit_count() & 1] for i in range(n))


@pytest.mark.parametrize("size", [1, 2, 63, 1024, 4096, 65536])
def test_thue_morse_strings_differ(size):
    a, b = thue_morse(size), thue_morse(size, "ba")
    data = np.frombuffer((a + b + a).encode(), np.uint8)
    at = np.array([0, size, 2 * size])
    h = Spans(data).of(at, at + size)
    assert h[0] == h[2] != h[1]


def test_equal_spans_have_equal_hashes():
    rng = np.random.default_rng(2)
    data = rng.integers(0, 3, 5000).astype(np.uint8)
    spans = Spans(data)
    starts = rng.integers(0, 4900, 4000)
    ends = starts + rng.integers(0, 12, 4000)
    h = spans.of(starts, ends)
    by_hash, by_bytes = {}, {}
    for x, a, b in zip(h.tolist(), starts, ends):
        by_hash.setdefault(x, set()).add(data[a:b].tobytes())
        by_bytes.setdefault(data[a:b].tobytes(), set()).add(x)
    assert all(len(v) == 1 for v in by_hash.values()) and all(len(v) == 1 for v in by_bytes.values())
    assert (Spans(np.concatenate(([7, 7, 7], data)).astype(np.uint8)).of(starts + 3, ends + 3) == h).all()


def test_windows_are_spans():
    data = np.random.default_rng(4).integers(0, 256, 500).astype(np.uint8)
    for width in (1, 7, 50, 500):
        at = np.arange(500 - width + 1)
        assert (Spans(data).windows(width) == Spans(data).of(at, at + width)).all()


def lines(shipped):
    a, b = thue_morse(4096), thue_morse(4096, "ba")
    texts = [f"{a}\n{b}\n{a}\nx", f"{a}\n{b}", f"{a} {b} x {b} {a} x {a} {b} x", thue_morse(4096, ("a ", "b ")) + "\n" + thue_morse(4096, ("b ", "a "))]
    return shipped.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), texts


def test_long_lines_and_words_of_quality_rules(shipped):
    table, texts = lines(shipped)
    got = {r["doc_id"]: tuple(r[1:6]) for r in quality.statistics(table).collect()}
    assert [got[i] for i in range(len(texts))] == [plain_quality(t) for t in texts]


def test_repeated_strings(shipped):
    a, b = thue_morse(1024), thue_morse(1024, "ba")
    texts = [a, b, "x" + a[:300], b[100:900]]
    table = shipped.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for length in (8, 200, 1024):
        got = {r["doc_id"]: tuple(r[1:]) for r in suffix.repeats(table, length=length).collect()}
        assert [got[i] for i in range(len(texts))] == repeats(texts, length)


def test_equal_first_hashes_are_told_apart_by_the_second():
    keys, other = np.array([5, 5, 3, 5, 3], np.uint64), np.array([1, 2, 1, 1, 1], np.uint32)
    at, n, group = suffix._grouped(keys, other)
    assert n.tolist() == [2, 2, 1] and group.tolist() == [1, 2, 0, 1, 0] and keys[at].tolist() == [3, 5, 5] and other[at].tolist() == [1, 1, 2]
    assert [len(x) for x in suffix._grouped(keys[:0], other[:0])] == [0, 0, 0]


def test_long_words_are_words_of_their_own(shipped):
    """Counted words of language models: two words, each twice."""
    table, _ = lines(shipped)
    from pyspark.sql import functions as F

    row = katz.scores(table.filter("doc_id = 1"), F.lit(False)).first()
    a, b = thue_morse(4096), thue_morse(4096, "ba")
    data = np.frombuffer(f"{a} {b} {a}".encode(), np.uint8)
    words = Words(data, np.array([0, len(data)]))
    assert len(np.unique(Spans(data).of(words.starts, words.ends))) == 2
    # three tokens of three kinds: each count 1 of 3
    assert row["n_known"] == row["n_tokens"] == 3 and row["base_score"] == pytest.approx(3 * np.log10(2 / 7))
