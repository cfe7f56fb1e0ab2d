import hashlib

import duckdb

from tierforge.llm import pii as P
from tierforge.llm.oracles import OP2_PII

from .brute import AWKWARD, pii


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def test_base_spans_match_brute_force(awkward, docs):
    for table in (awkward, docs):
        texts = sorted((str(r["doc_id"]), sha(pii(r["text"]))) for r in table.collect())
        assert sorted((str(r["doc_id"]), r["base_sha256"]) for r in P.report(table).collect()) == texts


def test_patterns_in_odd_strings(shipped):
    import random

    random.seed(4)
    parts = ["a", "b.", "@", "1", "2.", "255", "0", "-", " ", "+", "(", "9", "_", "é", "🙂", "a@b.c", "1.2.3.4", "+1 234", "4111 1111 1111 1111", "."]
    texts = ["".join(random.choices(parts, k=random.randrange(30))) for _ in range(600)] + ["1." * 3000, "a@" * 3000, "1 " * 5000, "+1" + "(" * 5000, "a." * 5000]
    table = shipped.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["base_sha256"] for r in P.report(table).collect()}
    assert [i for i, t in enumerate(texts) if got[i] != sha(pii(t))] == []


def test_no_terms_without_evidence(docs):
    assert all(r["n_term"] == 0 or r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"] for r in P.report(docs).collect())


def revealing(spark):
    """One address whose every mention stands by the same rare name, among many other texts."""
    rows = [(i, f"entry {'abc'[i % 3]}{i} Zebulonius writes from zeb@mail.org about matters number {i}") for i in range(6)]
    rows += [(100 + i, f"entry {i} somebody writes from other{i}@mail.org about matters") for i in range(60)]
    rows += [(300 + i, f"plain text about matters and writes from nobody {i}") for i in range(200)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_revealing_term_is_found_and_removed(shipped):
    table = revealing(shipped)
    rows = {r["doc_id"]: r for r in P.report(table).collect()}
    at = rows[0]["spans"].split(",")
    start = "entry a0 Zebulonius".index("Zebulonius")
    assert f"term:{start}:{start + 10}" in at and all(rows[100 + i]["n_term"] == 0 for i in range(60))
    text = {r["doc_id"]: r["text"] for r in P.sanitised(table).collect()}
    assert "Zebulonius" not in text[0] and "[EMAIL]" in text[0] and text[300] == "plain text about matters and writes from nobody 0"
    softer = {r["doc_id"]: r["text"] for r in P.sanitised(table, remove=2.0).collect()}
    assert "[TERM] writes from [EMAIL]" in softer[0]


def test_copies_are_no_evidence(shipped):
    rows = [(i, "a Zebulonius writes from zeb@mail.org here") for i in range(50)] + [(100 + i, f"other text {i}") for i in range(200)]
    out = P.report(shipped.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r["n_term"] == 0 for r in out)


def test_sanitised_keeps_rows_and_columns(awkward):
    out = P.sanitised(awkward)
    assert out.columns == awkward.columns and out.count() == len(AWKWARD)
    text = {r["doc_id"]: r["text"] for r in out.collect()}
    assert text[14] == "[IP] [EMAIL]; [PHONE]; [CARD]" and text[1] is None and text[2] == ""


def test_native_plan(docs):
    plan = P.report(docs)._jdf.queryExecution().executedPlan().toString() + P.sanitised(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_empty_table(awkward):
    assert P.report(awkward.filter("false")).collect() == [] and P.sanitised(awkward.filter("false")).count() == 0


def test_against_sql(shipped, awkward, docs):
    for table in (docs, awkward, revealing(shipped), far(shipped)):
        documents = table.select("doc_id", "text").toPandas()  # noqa: F841 (DuckDB reads it)
        want = duckdb.connect().execute(OP2_PII).fetchall()
        got = P.report(table).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_term").collect()
        assert sorted(str((int(w[0]) if w[0] == w[0] and w[0] is not None else None, *w[1:])) for w in want) == sorted(str(tuple(r)) for r in got)


def far(spark):
    """The name stands far from the address, and again in a document where both are apart; a short name too."""
    fill = " ".join(f"filler{'abcdefgh'[i % 8]} words about matters" for i in range(20))
    rows = [(i, f"Zebulonius heads entry {i}. {fill} {i} mail zeb@mail.org now {i}. {fill} Signed Zebulonius") for i in range(6)]
    rows += [(50 + i, f"Bo {'xyz'[i % 3]}{i} wrote. {fill} call +1 555 123 45{i % 2}0 now") for i in range(6)]
    rows += [(100 + i, f"entry {i} {fill} mail other{i}@mail.org") for i in range(60)] + [(300 + i, f"plain {fill} {i}") for i in range(200)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_far_terms_are_found_and_removed(shipped):
    table = far(shipped)
    rows = sorted(map(tuple, table.collect()))
    got = {r["doc_id"]: r for r in P.report(table).collect()}
    second = rows[0][1].rindex("Zebulonius")
    assert got[0]["n_term"] >= 2 and {"term:0:10", f"term:{second}:{second + 10}"} <= set(got[0]["spans"].split(","))
    assert all(got[100 + i]["n_term"] == 0 for i in range(60))
    assert all("Zebulonius" not in r["text"] for r in P.sanitised(table).collect())


def test_many_mentions_in_one_text(shipped):
    """160,000 addresses, many of them repeated, in one text: linear work."""
    import time

    text = " ".join(f"mail user{i % 90000}@host{i % 7}.org é🙂" for i in range(160_000))
    table = shipped.createDataFrame([(1, text), (2, "x")], "doc_id long, text string")
    began = time.time()
    row = P.report(table).filter("doc_id = 1").first()
    assert row["n_email"] == 160_000 and row["base_sha256"] == sha(pii(text))
    clean = {r["doc_id"]: r["text"] for r in P.sanitised(table).collect()}
    assert clean[1].count("[EMAIL]") == 160_000 and "@" not in clean[1] and clean[1].count("é🙂") == 160_000
    assert time.time() - began < 120


def test_running_results_over_groups(shipped, monkeypatch):
    """Groups of three: sums and maxima equal the plain ones, and a text cut in pieces of four equals the whole."""
    import itertools

    from pyspark.sql import functions as F

    monkeypatch.setattr(P, "_GROUP", 3)
    monkeypatch.setattr(P, "_CHUNK", 4)
    values = [[], [5], [3, 1, 2], [1, 9, 2, 8, 3, 7, 4, 0], list(range(20)), [4] * 7]
    table = shipped.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v array<long>")
    for r in table.select("i", P._running(F.col("v"), P._add).alias("s"), P._running(F.col("v"), F.greatest).alias("m")).collect():
        assert r["s"] == list(itertools.accumulate(values[r["i"]])) and r["m"] == list(itertools.accumulate(values[r["i"]], max))
    texts = ["", "a", "abcdefgh", "é🙂漢字 mail a@b.co and 1.2.3.4 end", "a@b.co"]
    cuts = shipped.createDataFrame([(t,) for t in texts], "t string")
    for r in cuts.select("t", *[P._cut(P._chunks(F.col("t")), F.lit(s).cast("bigint"), F.lit(n)).alias(f"c{s}_{n}") for s in (0, 3, 4, 9) for n in (0, 1, 4, 11)]).collect():
        assert all(r[f"c{s}_{n}"] == r["t"][s:s + n] for s in (0, 3, 4, 9) for n in (0, 1, 4, 11))
    rows = shipped.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"]: r["base_sha256"] for r in P.report(rows).collect()} == {i: sha(pii(t)) for i, t in enumerate(texts)}
    assert [r["text"] for r in P.sanitised(rows).orderBy("doc_id").collect()] == ["", "a", "abcdefgh", "é🙂漢字 mail [EMAIL] and [IP] end", "[EMAIL]"]


def test_clashing_columns(docs):
    names = ("__id", "__hash", "__edits", "__clean", "row", "id", "hash", "edits", "spans", "terms", "TEXT", "found_id")
    wide = docs.selectExpr("*", *[f"'x' as `{c}`" for c in names])
    out = P.sanitised(wide)
    assert out.columns == wide.columns
    got = sorted((r[0], r[1]) for r in out.collect())
    assert got == sorted((r["doc_id"], r["text"]) for r in P.sanitised(docs).collect())
