import collections
import math
import pathlib

import numpy as np
import pyarrow as pa
from .brute import AWKWARD, lower, words

from tierforge.llm import kneser_ney as K
from tierforge.llm.text import utf8


def reference(texts):
    """Interpolated modified Kneser-Ney by its formulas."""
    grams = collections.Counter()
    for t in texts:
        w = ["<s>", "<s>", *words(lower(t)), "</s>"]
        grams.update(zip(w, w[1:], w[2:]))
    two = collections.Counter((b, c) for _, b, c in grams)
    one = collections.Counter(c for _, c in two)

    def discounts(counts):
        n = [sum(v == i for v in counts.values()) for i in (1, 2, 3, 4)]
        if all(n):
            y = n[0] / (n[0] + 2 * n[1])
            d = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
            if all(0 < d[k] < k + 1 for k in range(3)):
                return d
        return [0.5, 0.75, 0.9]

    d3, d2, d1 = map(discounts, (grams, two, one))
    take = lambda d, n: d[min(n, 3) - 1]

    def tail(counts, d):
        total, lost = collections.Counter(), collections.Counter()
        for g, n in counts.items():
            total[g[:-1]] += n
            lost[g[:-1]] += take(d, n)
        return total, lost

    t3, l3 = tail(grams, d3)
    t2, l2 = tail(two, d2)
    total1 = sum(one.values())
    unknown = sum(take(d1, n) for n in one.values()) / total1 / (len(one) + 1)

    def p(a, b, c):
        p1 = ((one[c] - take(d1, one[c])) / total1 if one[c] else 0) + unknown
        p2 = p1
        if t2[(b,)]:
            p2 = ((two[b, c] - take(d2, two[b, c])) if two[b, c] else 0) / t2[(b,)] + l2[(b,)] / t2[(b,)] * p1
        if t3[a, b]:
            return ((grams[a, b, c] - take(d3, grams[a, b, c])) if grams[a, b, c] else 0) / t3[a, b] + l3[a, b] / t3[a, b] * p2
        return p2

    return p, set(one)


def test_probabilities(docs, shipped):
    texts = [r["text"] for r in docs.orderBy("doc_id").limit(60).collect()]
    table = shipped.createDataFrame([(t,) for t in texts[:40]], "text string").repartition(3)
    model = K.trained(table)
    p, vocabulary = reference(texts[:40])
    n, scores = model.scores(*utf8(pa.array(texts)))
    for t, m, s in zip(texts, n, scores):
        w = ["<s>", "<s>", *words(lower(t)), "</s>"]
        want = sum(math.log10(p(*g)) for g in zip(w, w[1:], w[2:]))
        assert m == len(w) - 2 and abs(s - want) < 1e-3 * abs(want) + 1e-3
    w = words(lower(texts[0]))
    for a, b in (("<s>", "<s>"), (w[0], w[1]), ("never", "seen")):
        assert abs(sum(p(a, b, c) for c in vocabulary) + p(a, b, "unheard") - 1) < 1e-9


def test_clean_kept_junk_rejected(shipped):
    read = lambda t: shipped.read.parquet(f"/root/testdata/sf0.01/{t}.parquet")
    rows = K.judged(read("documents"), read("labels")).join(read("labels"), "doc_id").toPandas()
    assert rows[rows.quality == 1].kept.mean() > 0.97 and rows[rows.quality == 0].kept.mean() < 0.2


def test_awkward_rows(awkward, shipped):
    labels = shipped.createDataFrame([(11, 1, 0, "x"), (11, 1, 0, "x"), (12, 1, None, "x"), (5, 0, 0, "x"), (None, 1, 0, "x"), (999, 1, 0, "x")],
                                     "doc_id long, quality int, toxic int, text string")
    rows = K.judged(awkward, labels).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(i) for i, _ in AWKWARD)
    assert all(np.isfinite(r["perplexity"]) for r in rows) and not any(r["kept"] for r in rows if r["doc_id"] in (1, 2, 3))


def test_no_labels_and_no_documents(awkward, shipped):
    none = shipped.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = K.judged(awkward, none).collect()
    assert all(r["threshold"] is None and r["kept"] == (r["n_tokens"] > 1) for r in rows) and len(rows) == len(AWKWARD)
    assert K.judged(awkward.filter("false"), none).collect() == []


def test_sample_is_bounded(docs, shipped):
    ids = docs.select("doc_id").withColumn("training", K.F.lit(True))
    assert K.training_sample(docs, ids, most=20).count() <= 20
    some = K.training_sample(docs, ids, most=50, chars=5000, total=20_000)
    assert some.select(K.F.sum(K.F.length("text"))).first()[0] <= 20_000 * 1.3


def test_bound_takes_four_thousand_documents(shipped):
    table = shipped.range(4500).selectExpr("id as doc_id", "concat('document number ', id) as text")
    ids = table.select("doc_id").withColumn("training", K.F.lit(True))
    assert K.training_sample(table, ids).count() == 4000 and K.TRUSTED_TOTAL == 16_000_000


def test_sample_of_skewed_and_partial_tables(shipped):
    rows = shipped.range(100).selectExpr("id as doc_id", "concat('document number ', id) as text")
    copies = shipped.range(20_000).selectExpr("7L as doc_id", "'the hot text' as text")
    long = shipped.range(100, 200).selectExpr("id as doc_id", "repeat('x', 60000) as text")
    table = rows.unionByName(copies).unionByName(long).repartition(4)
    ids = shipped.range(10_000).selectExpr("id as doc_id", "true as training")  # most of them in no row
    got = [tuple(r) for r in K.training_sample(table, ids, most=200).collect()]
    assert len(got) == len(set(got)) == 101 and (7, "the hot text") in got
    assert K.training_sample(table, ids, most=60).count() == 60
    assert K.training_sample(table, ids, most=200, total=300).selectExpr("sum(length(text))").first()[0] <= 300


def test_all_training_documents_are_learned(shipped):
    """More training documents, and longer ones, than ``training_sample`` would take: every word of theirs is known to the model."""
    table = shipped.range(4_600).selectExpr("id as doc_id", "concat('document number w', id) as text", "'en' as lang")
    long = shipped.range(5_000, 5_002).selectExpr("id as doc_id", "concat(repeat('word ', 12000), 'z', id) as text", "'en' as lang")
    docs = table.unionByName(long).repartition(3)
    labels = docs.selectExpr("doc_id", "1 as quality", "0 as toxic")
    ids = {r["doc_id"] for r in K.trusted_ids(labels).filter("training").collect()}
    copies = docs.unionByName(docs.filter("doc_id < 50"))
    learned = copies.select("doc_id", "text").filter(K.F.col("doc_id").isin(*ids)).distinct()
    rows = {r["doc_id"]: r for r in K.judged(copies, labels).collect()}
    n, scores = K.trained(learned).scores(*utf8(pa.array([r["text"] for r in docs.orderBy("doc_id").collect()])))
    for i, m, s in zip(sorted(rows), n, scores):
        assert rows[i]["n_tokens"] == m and abs(math.log10(rows[i]["perplexity"]) + s / m) < 1e-4
    known = [rows[i]["perplexity"] for i in rows if i < 4_600 and i in ids]
    unknown = [rows[i]["perplexity"] for i in rows if i < 4_600 and i not in ids]
    assert len(known) > 3_600 and max(known) < min(unknown)


def own_rows(shipped, n=300):
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.3, 200) % 50_000) for _ in range(n)]
    docs = shipped.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    return docs, sum(len(t) for t in texts)


def test_stored_tables_stay_small(shipped, monkeypatch):
    """What is stored at one time, model, blocks and replies, is below three times the text when all is learned from and all is asked."""
    docs, size = own_rows(shipped, 1500)
    live, peak = {}, [0]
    under = lambda path: sum(f.stat().st_size for f in pathlib.Path(path.removeprefix("file:")).rglob("*.parquet"))

    def watched(write):
        def work(df, *args):
            out = write(df, *args)
            live[out.stored_at] = under(out.stored_at)
            peak[0] = max(peak[0], sum(live.values()))
            return out
        return work

    def discard(df, real=K.discard):
        live.pop(df.stored_at, None)
        real(df)

    for name in ("stored", "bucketed"):
        monkeypatch.setattr(K, name, watched(getattr(K, name, None)), raising=False)
    monkeypatch.setattr(K, "discard", discard)
    labels = docs.selectExpr("doc_id", "1 as quality", "0 as toxic")
    assert K.judged(docs, labels).count() == 1500
    assert peak[0] < 3 * size, peak[0] / size
    assert len(live) <= K.PARTS  # what is returned


def test_model_is_not_shuffled_to_answer(shipped):
    docs, size = own_rows(shipped, 40)
    model = K.counts(docs)
    asked = K._blocks(docs.selectExpr("doc_id", "text", "false as held_out"), size, K.BLOCK, "t").mapInArrow(K._ask(model.bits, 3), K.ROW)
    back = asked.groupBy("shard").cogroup(model.sums(3).groupBy("shard")).applyInArrow(K._reply(3), K.ROW)
    plan = back._jdf.queryExecution().executedPlan().toString()
    model.discard()
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan


def test_messages_follow_the_text_not_the_partitions(shipped):
    docs, size = own_rows(shipped)
    slim = docs.selectExpr("doc_id", "text", "false as held_out").repartition(200)
    assert K._blocks(slim, size, K.BLOCK, "t").count() <= shipped.sparkContext.defaultParallelism
    before = shipped.conf.get("spark.sql.shuffle.partitions")
    try:
        shipped.conf.set("spark.sql.shuffle.partitions", "300")
        model = K.counts(docs.limit(20))
        assert 1 << model.bits == 16
        model.discard()
    finally:
        shipped.conf.set("spark.sql.shuffle.partitions", before)


def test_counts_beyond_a_byte_and_first_tokens(shipped):
    """Sums that need more than a byte, a text that is one word, and blocks that share all their n-grams."""
    texts = ["the cat sat on the mat", "the", ""] * 300 + ["the dog sat down"] * 5
    table = shipped.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    p, _ = reference(texts)
    n, scores = K.trained(table).scores(*utf8(pa.array(texts[-3:] + ["the", "cat the sat", "unheard of"])))
    for t, m, s in zip(texts[-3:] + ["the", "cat the sat", "unheard of"], n, scores):
        w = ["<s>", "<s>", *words(lower(t)), "</s>"]
        assert m == len(w) - 2 and abs(s - sum(math.log10(p(*g)) for g in zip(w, w[1:], w[2:]))) < 1e-5
