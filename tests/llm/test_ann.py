import numpy as np
from pyspark.sql import functions as F

from tierforge.llm import ann as A

SCHEMA = "vec_id long, embedding array<float>, score string, rank int"


def run(table, **options):
    rows = A.neighbours(table, F.col("vec_id") % 50 == 0, **options).collect()
    out = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def exact(ids, x, k=5):
    unit = np.linalg.norm(x, axis=1)
    out = {}
    for i in np.flatnonzero(ids % 50 == 0):
        s = x @ x[i] / (unit * unit[i])
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]][:k]
        out[ids[i]] = [(ids[j], s[j]) for j in order]
    return out


def test_recall_and_scores(shipped):
    rows = shipped.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    pdf = rows.toPandas()
    want = exact(pdf.vec_id.to_numpy(), np.array(pdf.embedding.tolist(), np.float64))
    got = run(rows)
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in w}) for q, w in want.items())
    assert hits >= 0.9 * sum(map(len, want.values()))
    for q, found in got.items():
        assert len(found) == 5 and [s for _, s in found] == sorted((s for _, s in found), reverse=True) and q not in dict(found)


def test_copies_ties_and_bad_vectors(shipped):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 12)).astype(np.float32)
    rows = [(i, [float(v) for v in x[i]], "s", 1) for i in range(60)]
    rows += [(1000 + i, [float(v) for v in x[7]], "s", 1) for i in range(130)]  # copies; some are queries
    good = list(rows)
    rows += [(2000, None, "s", 1), (2050, [0.0] * 12, "s", 1), (2100, [float("nan")] * 12, "s", 1), (2150, [None] * 12, "s", 1), (2200, [1.0] * 5, "s", 1),
             (None, [1.0] * 12, "s", 1), (2250, [], "s", 1), rows[0]]
    got = run(shipped.createDataFrame(rows, SCHEMA).repartition(3), tables=16, probes=24, chunk=20)
    want = exact(np.array([r[0] for r in good]), np.array([r[1] for r in good], np.float64))
    assert got.keys() == want.keys()
    for q in want:
        assert [v for v, _ in got[q]] == [v for v, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], atol=1e-12)


def test_several_hashes_in_a_row(shipped):
    rng = np.random.default_rng(8)
    rows = [(i, [float(v) for v in rng.normal(size=4)], "s", 1) for i in range(100)]
    got = run(shipped.createDataFrame(rows, SCHEMA), hashes=2, tables=4, probes=64)
    assert [v for v, _ in got[50]] == [v for v, _ in exact(np.arange(100), np.array([r[1] for r in rows], np.float32).astype(np.float64))[50]]


def test_rotation_keeps_lengths_and_angles():
    x = np.random.default_rng(1).normal(size=(5, 16))
    y = A.turned(x, 2, 0)
    assert np.allclose(x @ x.T, y @ y.T)


def test_few_and_none(shipped):
    rows = [(0, [1.0, 0.0], "s", 1), (1, [1.0, 1.0], "s", 1)]
    assert run(shipped.createDataFrame(rows, SCHEMA))[0] == [(1, 1 / np.sqrt(2))] or abs(run(shipped.createDataFrame(rows, SCHEMA))[0][0][1] - 2**-0.5) < 1e-12
    assert run(shipped.createDataFrame(rows[:1], SCHEMA)) == {} and run(shipped.createDataFrame([], SCHEMA)) == {}


def test_five_neighbours_wherever_there_are_five(shipped):
    """Few vectors and wide ones, with the defaults: buckets that hold too little are made up for, exactly."""
    rng = np.random.default_rng(8)
    for n, dim, step in ((6, 64, 50), (6, 1024, 50), (40, 1024, 1), (4, 64, 50), (120, 300, 7)):
        ids, x = np.arange(n) * step, rng.normal(size=(n, dim))
        table = shipped.createDataFrame([(int(i), [float(v) for v in row], "s", 1) for i, row in zip(ids, x)], "vec_id long, embedding array<double>, score string, rank int")
        got, want = run(table), exact(ids, x)
        assert set(got) == set(want)
        for q, w in want.items():
            assert len(got[q]) == len(w) == min(5, n - 1)
            if n <= 40:
                assert [v for v, _ in got[q]] == [v for v, _ in w]


def test_short_queries_meet_blocks(shipped):
    """The search for short queries in blocks of a few vectors equals the whole."""
    rng = np.random.default_rng(9)
    ids, x = np.arange(30) * 10, rng.normal(size=(30, 512))
    table = shipped.createDataFrame([(int(i), [float(v) for v in row], "s", 1) for i, row in zip(ids, x)], "vec_id long, embedding array<double>, score string, rank int")
    assert {q: [v for v, _ in w] for q, w in run(table, tables=1, probes=1, chunk=4).items()} == {q: [v for v, _ in w] for q, w in exact(ids, x).items()}
