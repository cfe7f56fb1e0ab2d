"""Filter interaction audit against SQL and a plain per-document loop."""

import itertools

import duckdb

from tierforge.llm import audit
from tierforge.llm.oracles import OP13_FILTER_AUDIT

from .brute import words

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def plain(rows, labels):
    """Every document through every order, one filter at a time."""
    labels = [x for x in labels if x[0] is not None]
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1}
    lows = {}
    for i, t, _ in rows:
        if i is not None:
            lows[t or ""] = min(lows.get(t or "", i), i)
    out, shapley = {}, {}
    for i, t, part in rows:
        t, part, w = t or "", part or "", words(t)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t),
                 "D": any(c in "#$%&*|" for c in t), "E": i is not None and lows[t] < i}
        for order in map("".join, itertools.permutations("ABCDE")):
            gone = False
            for step, f in enumerate(order, 1):
                n = out.setdefault((part, order, step), [0] * 6)
                hit = fails[f]
                removed = hit and not gone
                shapley[part, f] = shapley.get((part, f), 0) + removed
                for k, v in enumerate((not hit and not gone, removed, hit and gone, hit and sum(fails.values()) == 1, removed and i in good, removed and i in toxic)):
                    n[k] += bool(v)
                gone |= hit
    return sorted((p, o, s, *n, shapley[p, o[s - 1]]) for (p, o, s), n in out.items())


def result(table, labels):
    return sorted(tuple(r) for r in audit.audited(table, labels).select(COLUMNS).collect())


def marks(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string, part string, row int")


def test_against_plain_loop(shipped, awkward):
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in awkward.collect()]
    labels = [(1, 1, 0), (1, 1, 1), (2, None, 1), (16, 1, None), (16, 0, 0), (999, 1, 1), (None, 1, 1), (12, 1, 1)]
    assert result(awkward, marks(shipped, [(*x, "t", "p", 1) for x in labels])) == plain(rows, labels)


def test_group_of_copies(shipped):
    prose = " ".join(f"w{i}" for i in range(120))
    rows = [(i, prose, "en") for i in range(500)] + [(700, prose, "de"), (0, prose, "de"), (None, prose, None), (800, prose + "!", "en")]
    table = shipped.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    assert result(table, marks(shipped, [])) == plain(rows, [])


def test_against_sql(shipped, docs):
    labels = shipped.read.parquet("/root/testdata/sf0.001/labels.parquet")
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    con.register("labels", labels.toPandas())
    want = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({OP13_FILTER_AUDIT})").fetchall()
    got = result(docs, labels)
    assert got == sorted(want) and len(got) == 600 * docs.select("lang").distinct().count()


def test_empty_tables(shipped, awkward):
    assert audit.audited(awkward.filter("false"), marks(shipped, [])).collect() == []


def test_clashing_columns(shipped, docs):
    """Columns named like those that the operator makes."""
    labels = shipped.read.parquet("/root/testdata/sf0.001/labels.parquet")
    names = ("id", "part", "body", "bits", "row", "hash", "low", "failed", "good", "step", "n")
    assert result(docs.selectExpr("*", *[f"'x' as {c}" for c in names]), labels.selectExpr("*", *[f"'x' as {c}" for c in names])) == result(docs, labels)
