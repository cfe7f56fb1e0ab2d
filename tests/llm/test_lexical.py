"""Ranked search against a plain scorer, and SQL; NRA against full sums."""

import collections
import math
import random
import re

import duckdb
import numpy as np
import pytest

from tierforge.llm import lexical as L
from tierforge.llm.oracles import OP12_LEXICAL_SEARCH

from .brute import lower


def split(t):
    return re.findall(L.TERM, lower(t))


def plain(docs, items, k=10):
    """(item, rank, doc_id, score) of all rows, every document scored for every item."""
    bags = [collections.Counter(split(t)) for _, t in docs]
    n_all, n_terms = sum(bool(b) for b in bags), sum(sum(b.values()) for b in bags)
    df = collections.Counter(t for b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for (i, _), b in zip(docs, bags):
            score = 0
            for t in set(split(text)):
                if b[t]:
                    m = 100 - 90 + (90 * sum(b.values()) * n_all) // n_terms
                    score += math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * ((1000000000 * b[t]) // (1000 * b[t] + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i))
        out += [(str(item), rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=str)


def result(table, items, **more):
    return sorted(((str(r["item_id"]), r["rank"], r["doc_id"], r["score"]) for r in L.ranked(table, items, **more).collect()), key=str)


def pairs(df, *names):
    return [tuple(r[n] for n in names) for r in df.collect()]


@pytest.fixture
def bench(shipped):
    return shipped.read.parquet("/root/testdata/sf0.001/benchmark.parquet")


def test_nra_equals_full_sums():
    rng = np.random.default_rng(5)
    for trial in range(200):
        n, k = int(rng.integers(1, 60)), int(rng.integers(1, 8))
        lists, full = [], np.zeros(n, np.int64)
        for _ in range(int(rng.integers(1, 7))):
            docs = rng.permutation(n)[: int(rng.integers(0, n + 1))]
            impacts = np.sort(rng.integers(0, (3, 1000)[trial % 2], len(docs)))[::-1].astype(np.int64)
            lists.append((docs, impacts))
            full[docs] += impacts
        low, kth = L.nra(lists, n, k, depth=2)
        best = np.flatnonzero(low >= kth)
        want = max(1, np.sort(full)[::-1][k - 1] if n > k else 1)
        assert set(best) == set(np.flatnonzero(full >= want)) and (low[best] == full[best]).all()


def test_nra_stops_early():
    """One document is far ahead in every list: the tails stay unread."""
    n = 100_000
    rest = np.arange(1, n)
    lists = [(np.concatenate(([0], np.roll(rest, 7 * j))), np.concatenate(([10_000], np.full(n - 1, 1)))) for j in range(5)]
    low, kth = L.nra(lists, n, 1)
    assert kth == 50_000 and (low > 0).sum() < 2000


def test_documents_against_plain_form(shipped, docs, bench):
    assert result(docs, bench) == plain(pairs(docs, "doc_id", "text"), pairs(bench, "item_id", "text"))


def test_many_shards_and_blocks(docs, bench, monkeypatch):
    whole = result(docs, bench)
    monkeypatch.setattr(L, "SHARD", 500)
    monkeypatch.setattr(L, "BLOCK", 100)
    assert result(docs, bench) == whole


def test_awkward_rows(shipped, awkward):
    items = [(1, "same text"), (2, None), (3, ""), (4, "no such-terms_here"), (None, "a null id, TEXT"), (6, "漢字 ÉMILE émile 🙂"), (7, "same text"), (7, "same text"),
             (9, "word " * 5000 + "long"), (10, "a b c 1 2 3 4"), (11, "\x00nul")]
    table = shipped.createDataFrame([(i, t, 5, "x", 1) for i, t in items], "item_id long, text string, item long, term string, score long")
    assert result(awkward, table) == plain(pairs(awkward, "doc_id", "text"), items)
    assert result(awkward.filter("false"), table) == [] and result(awkward, table.filter("false")) == []


def test_copies_and_ties(shipped):
    random.seed(1)
    rows = [(i, "the same passage again") for i in range(400)] + [(1000 + i, f"the other text {random.randrange(5)}") for i in range(100)] + [(None, "the same passage again")] * 3
    table = shipped.createDataFrame(rows, "doc_id long, text string").repartition(5)
    items = [(1, "same passage"), (2, "other"), (3, "the"), (4, "text 3 passage")]
    assert result(table, shipped.createDataFrame(items, "item_id long, text string")) == plain(rows, items)


def test_against_sql(shipped, docs, bench):
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    con.register("benchmark", bench.toPandas())
    want = sorted(((str(i), *r) for i, *r in con.execute(OP12_LEXICAL_SEARCH).fetchall()), key=str)
    assert result(docs, bench) == want
