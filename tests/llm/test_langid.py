import collections
import itertools
import math
import zlib

import numpy as np
import pytest
from .brute import AWKWARD
from pyspark.sql import functions as F

from tierforge.llm import langid as L
from tierforge.llm.common import in_fold


@pytest.fixture(scope="module")
def model(shipped):
    return L.learned(shipped.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_held_out_accuracy(shipped):
    docs = shipped.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = {r["doc_id"]: r["lang"] for r in docs.collect()}
    rows = L.identified(docs, in_fold("doc_id", 5) == 0).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in rows)
    out = [r for r in rows if r["held_out"]]
    assert len(rows) == len(lang) and sum(r["lang_pred"] == lang[r["doc_id"]] for r in out) >= 0.98 * len(out)


def test_mixtures(shipped, model):
    docs = shipped.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("length(text) > 2000").orderBy("doc_id").collect()
    en, fr = (next(r["text"] for r in docs if r["lang"] == x) for x in ("en", "fr"))
    table = shipped.createDataFrame([(1, en[:600] + " " + fr[:600]), (2, en[:900] + " " + fr[:300]), (3, en[:1200])], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in L.predicted(table, model).collect()}
    assert {x.split(":")[0] for x in rows[1]["langs"].split(",")} == {"en", "fr"} and rows[1]["score"] < 0.7
    assert rows[2]["lang_pred"] == "en" and 0.6 < rows[2]["score"] < 0.95
    assert rows[3]["langs"] == "en:1.000" and rows[3]["score"] == pytest.approx(1.0)


def test_awkward_rows(awkward, model, shipped):
    rows = L.predicted(awkward, model).collect()
    assert len(rows) == len(AWKWARD)
    und = {r["doc_id"] for r in rows if r["lang_pred"] == "und"}
    assert und == {1, 2, 3, 18} and all(r["score"] == 0 for r in rows if r["doc_id"] in und)
    odd = shipped.createDataFrame([(1, "12 €€"), (2, "漢"), (3, "a")], "doc_id long, text string")
    assert [r["lang_pred"] == "und" for r in sorted(L.predicted(odd, model).collect())] == [True, False, False]


def test_nothing_learned(awkward):
    model = L.learned(awkward.withColumn("lang", F.lit(None).cast("string")))
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in L.predicted(awkward, model).collect())


def test_empty_table(awkward, model):
    assert L.predicted(awkward.filter("false"), model).collect() == []
    assert L.identified(awkward.filter("false"), in_fold("doc_id", 5) == 0).collect() == []


def test_sets_of_all_languages(shipped, model):
    docs = shipped.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("length(text) > 2000").orderBy("doc_id").collect()
    assert len(model.langs) == 4
    parts = [next(r["text"] for r in docs if r["lang"] == x)[:600] for x in model.langs]
    table = shipped.createDataFrame([(1, " ".join(parts)), (2, " ".join(parts[:3])), (3, parts[0])], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in L.predicted(table, model).collect()}
    found = {i: {x.split(":")[0] for x in r["langs"].split(",")} for i, r in rows.items()}
    assert found == {1: set(model.langs), 2: set(model.langs[:3]), 3: {model.langs[0]}} and rows[1]["score"] < 0.4


def plain_mixture(text, counts):
    """The set of languages, of all sets, with the largest likelihood less the penalty, by plain EM over its 4-grams; and its shares."""
    data = np.frombuffer(text.encode(), np.uint8)
    _, bucket = L.grams(data, np.array([0, len(data)]), L.GRAM_BITS)
    times = collections.Counter(bucket.tolist())
    n = sum(times.values())
    chance = {x: {g: (c.get(g, 0) + L.SMOOTH) / (sum(c.values()) + L.SMOOTH * 2**L.GRAM_BITS) for g in times} for x, c in counts.items()}
    best = (-math.inf, None, None)
    for size in range(1, len(counts) + 1):
        for langs in itertools.combinations(sorted(counts), size):
            share = dict.fromkeys(langs, 1 / size)
            for _ in range(60):
                new = dict.fromkeys(langs, 0.0)
                for g, t in times.items():
                    whole = sum(share[x] * chance[x][g] for x in langs)
                    for x in langs:
                        new[x] += t * share[x] * chance[x][g] / whole / n
                share = new
            likely = sum(t * math.log(sum(share[x] * chance[x][g] for x in langs)) for g, t in times.items())
            value = likely - (size - 1) * L.PENALTY * 0.5 * math.log(max(n, 2))
            if value > best[0]:
                best = (value, langs, share)
    return best[1], best[2]


def test_against_every_set_of_languages(shipped):
    """Chosen sets and proportions against plain EM over all sets: pure texts, mixtures of two to four, short and repeated ones."""
    docs = shipped.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = L.learned(docs)
    counts = collections.defaultdict(collections.Counter)
    for r in docs.filter("lang is not null").collect():
        data = np.frombuffer((r["text"] or "").encode(), np.uint8)
        counts[r["lang"]].update(L.grams(data, np.array([0, len(data)]), L.GRAM_BITS)[1].tolist())
    long = docs.filter("length(text) > 2000").orderBy("doc_id").collect()
    part = {x: next(r["text"] for r in long if r["lang"] == x) for x in model.langs}
    texts = [part[x][:k] for x in model.langs for k in (40, 300, 900)]
    texts += [part[a][:500] + " " + part[b][:250] for a, b in itertools.permutations(model.langs, 2)]
    texts += [" ".join(part[x][:400] for x in model.langs[:3]), " ".join(part[x][:400] for x in model.langs), "the the the the"]
    rows = {r["doc_id"]: r for r in L.predicted(shipped.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()}
    for i, t in enumerate(texts):
        langs, share = plain_mixture(t, counts)
        assert {x.split(":")[0] for x in rows[i]["langs"].split(",")} == set(langs), (i, rows[i]["langs"], share)
        assert rows[i]["lang_pred"] == max(langs, key=lambda x: share[x]) and abs(rows[i]["score"] - max(share.values())) < 0.03


def test_many_languages_leave_predictions_as_they_are(shipped, model):
    """200 more languages of other letters: the same hash width, the same answers."""
    docs = shipped.read.parquet("/root/testdata/sf0.001/documents.parquet")
    more = [(f"zz{i:03}", " ".join(chr(0x3400 + 20 * i + (7 * j) % 19) * 3 for j in range(60))) for i in range(200)]
    learned = shipped.read.parquet("/root/testdata/sf0.01/documents.parquet").select("lang", "text")
    wide = L.learned(learned.union(shipped.createDataFrame(more, "lang string, text string")))
    assert len(wide.langs) == 204
    few = docs.limit(40)
    a, b = ({r["doc_id"]: r["lang_pred"] for r in L.predicted(few, m).collect()} for m in (model, wide))
    assert a == b
