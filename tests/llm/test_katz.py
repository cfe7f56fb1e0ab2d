import collections
import functools
import math
import pickle
import zlib

import numpy as np
import pytest
from .brute import AWKWARD, lower, words
from pyspark.sql import functions as F

from tierforge.llm import katz as K
from tierforge.llm.blocks import unpack_keys
from tierforge.llm.common import in_fold


def reference(pairs, order):
    """(score, base, known) of each pair by the formulas, recursively, and p(w | history)."""
    tokens = [(i, [*words(lower(t)), None]) for i, t in pairs]
    train = [w for i, w in tokens if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    grams, after = [], []  # by length of the context: n-grams, and how often a context is one
    for m in range(order):
        found = [(tuple(([0] * m + w)[i:i + m]), x) for w in train for i, x in enumerate(w)]
        grams.append(collections.Counter(found))
        after.append(collections.Counter(h for h, _ in found))
    one = collections.Counter({x: c for (_, x), c in grams[0].items()})
    n, v = sum(one.values()), len(one)
    counts = lambda c: [sum(x == r for x in c.values()) for r in range(1, K.BOUND + 2)]
    model = K.Model([n, v, *counts(one)], *[[0, 0, *counts(g)] for g in grams[1:]])
    d = functools.cache(lambda c, m: float(model.seen(np.array([c]), m + 1)[0]))
    word = functools.cache(lambda c: float(model.word(np.array([c]))[0]))
    mass, behind = collections.Counter(), collections.Counter()

    def p(h, w):
        m = len(h)
        if not m:
            return word(one.get(w, 0))
        if not after[m].get(h):
            return p(h[1:], w)
        c = grams[m].get((h, w), 0)
        return d(c, m) / after[m][h] if c else (1 - mass[h] / after[m][h]) / (1 - behind[h]) * p(h[1:], w)

    for m in range(1, order):
        for (h, w), c in grams[m].items():
            mass[h] += d(c, m)
            behind[h] += p(h[1:], w)
    history = lambda w, i: tuple(([0] * (order - 1) + w)[i:i + order - 1])
    rows = [(str(i), len(w), sum(x in one for x in w), n, sum(math.log10((one.get(x, 0) + 1) / (n + v + 1)) for x in w),
             sum(math.log10(p(history(w, k), x)) for k, x in enumerate(w))) for i, w in tokens]
    return rows, p, one, grams


def held(rows):
    return sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in rows)


@pytest.mark.parametrize("name,order", [("docs", 3), ("awkward", 3), ("awkward", 2), ("docs", 4)])
def test_scores(request, name, order):
    table = request.getfixturevalue(name)
    pairs = [(r["doc_id"], r["text"]) for r in table.collect()]
    got = K.scores(table, in_fold("doc_id", 7) == 2, order=order, block=5000).collect()
    want = sorted(reference(pairs, order)[0])
    assert len(got) == len(want)
    for a, b in zip(held(got), want):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], rel=1e-9, abs=1e-9)
    assert all(r["held_out"] == (zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 7 == 2) for r in got)


def test_normalised_and_better_than_base(docs):
    pairs = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rows, p, one, grams = reference(pairs, 3)
    seen = list(grams[2])[:4]
    for h in [(0, 0), *[h for h, _ in seen], *[(x, "never seen") for x in list(one)[:2]], ("never seen", list(one)[3]), (list(one)[0],), ()]:
        assert sum(p(h, w) for w in one) + p(h, "@unknown") == pytest.approx(1)
    held_out = in_fold("doc_id", 7) == 2
    two, three = ([r for r in K.scores(docs, held_out, order=n).collect() if r["held_out"]] for n in (2, 3))
    assert sum(r["score"] for r in two) > sum(r["base_score"] for r in two)
    assert sum(r["score"] for r in three) != sum(r["score"] for r in two)


def test_no_training_documents(awkward):
    rows = K.scores(awkward, F.lit(True)).collect()
    assert len(rows) == len(AWKWARD) and all(r["score"] == 0 and r["n_known"] == 0 and r["train_tokens"] == 0 for r in rows)


def test_empty_table(awkward):
    assert K.scores(awkward.filter("false"), F.lit(False)).collect() == []


def test_discounts():
    assert K.discounts([100, 40, 20, 12, 8, 6]) and all(0 < d < 1 for d in K.discounts([100, 40, 20, 12, 8, 6]))
    assert K.discounts([0, 0, 0, 0, 0, 0]) == [] and K.fall([0] * 6) == 1.5


def test_weights_are_exchanged_for_contexts_of_held_out_documents_only(shipped, monkeypatch):
    contexts = []

    def noted(df, label, plain=K.stored):
        out = plain(df, label)
        if label == "katz-answers":
            contexts.extend(len(unpack_keys(pickle.loads(r["data"])[0])) for r in out.filter(F.col("kind") >= K._MASSES).collect())
        return out

    monkeypatch.setattr(K, "stored", noted)
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(40)), False) for i in range(20)] + [(20, "w1x1 w1x2 w3x3", True)]
    scored = K.scores(shipped.createDataFrame(rows, "doc_id long, text string, held boolean"), F.col("held"), block=100).collect()
    assert len(scored) == 21 and 0 < sum(contexts) < 100  # the training documents have 1,600


@pytest.mark.parametrize("order", [3, 4])
def test_blocks_count_what_only_held_out_documents_of_others_have(shipped, order):
    texts = ["p q r s t z q w z r u", "a b c d", "x p q r s t y", "a b d", "p z p q", "q r s t w"]
    ids = [next(i for i in range(1000 * k, 9999) if (zlib.crc32(str(i).encode()) % 7 == 2) == (k in (2, 5))) for k in range(len(texts))]
    pairs = list(zip(ids, texts))
    apart = shipped.createDataFrame(shipped.sparkContext.parallelize(pairs, len(pairs)), "doc_id long, text string")  # a block each
    for a, b in zip(held(K.scores(apart, in_fold("doc_id", 7) == 2, order=order).collect()), sorted(reference(pairs, order)[0])):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], rel=1e-9, abs=1e-9)
