import collections

import pytest
from .brute import AWKWARD, targets, words

from tierforge.llm import mixing as M


def check(table, block=128):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in table.collect()]
    out = M.mixed(table, block=block).collect()
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len(words(t))
    want = targets(sizes)
    assert sorted((str(r["doc_id"]), str(r["source"]), r["size"]) for r in out) == sorted((str(i), str(s), len(words(t))) for i, t, s in rows)
    taken, longest = collections.Counter(), collections.Counter()
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
        taken[r["source"]] += r["taken"]
        longest[r["source"]] = max(longest[r["source"]], r["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= longest[s] + 1e-6
    return out


@pytest.mark.parametrize("block", [4, 128])
def test_documents(docs, block):
    first = check(docs, block)
    again = M.mixed(docs.repartition(7), block=block).collect()
    assert sorted(map(str, first)) == sorted(map(str, again))


def test_awkward(awkward):
    check(awkward)
    check(awkward, 2)


def test_caps_spread_the_excess(shipped):
    rows = [(i, "w " * n, s) for i, (n, s) in enumerate([(10, "a"), (500, "b"), (30, "c"), (400, "d"), (5, None), (7, "e"), (0, "f")])]
    check(shipped.createDataFrame(rows, "doc_id long, text string, source string"))


def test_repeated_rows(shipped):
    rows = [(1, "one two three", "a")] * 50 + [(2, "x y", "a")] * 10 + [(3, "word " * 90, "b")]
    out = check(shipped.createDataFrame(rows, "doc_id long, text string, source string").repartition(3))
    assert len(out) == 61


def test_repeated_follows_the_plan(docs, awkward):
    for table in (docs, awkward):
        plan = collections.Counter()
        for r in M.mixed(table).collect():
            plan[str(r["doc_id"])] += r["copies"]
        rows = M.repeated(table)
        assert rows.columns == table.columns
        got = collections.Counter(str(r["doc_id"]) for r in rows.collect())
        assert got == +plan


def test_expectation_does_not_depend_on_size(shipped):
    """Short and long documents of a source are taken equally often on average."""
    sizes = shipped.createDataFrame([(i, "ab"[i % 2], 3 + 40 * (i % 4 // 2)) for i in range(400)], "doc_id long, source string, size long")
    taken, rate, n = collections.Counter(), {}, 6
    for seed in range(n):
        for r in M.mixed_sizes(sizes, block=16, seed=1000 + seed).collect():
            taken[r["source"], r["size"]] += r["copies"]
            rate[r["source"]] = r["target"] / r["source_size"]
    assert all(abs(c / (100 * n) - rate[s]) < 0.1 for (s, _), c in taken.items())


def test_native_plan(docs):
    plan = M.mixed(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(awkward):
    assert M.mixed(awkward.filter("false")).collect() == [] and M.repeated(awkward.filter("false")).count() == 0
