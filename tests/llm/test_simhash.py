import random

from .brute import AWKWARD, components, fingerprint
from pyspark.sql import functions as F

from tierforge.llm import simhash as S
from tierforge.llm.common import connected_components


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints(awkward, docs):
    for table in (awkward, docs):
        texts = sorted((str(r["doc_id"]), f"{fingerprint(r['text']):016x}") for r in table.collect())
        assert sorted((str(r["doc_id"]), r["fingerprint"]) for r in S.near_duplicates(table).collect()) == texts


def test_components_of_documents(docs):
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    root = components([fingerprint(t) for _, t in rows], 2)
    low = {}
    for (i, _), r in zip(rows, root):
        low[r] = min(low.get(r, i), i)
    got = {r["doc_id"]: r["component_id"] for r in S.near_duplicates(docs).collect()}
    assert got == {i: low[r] for (i, _), r in zip(rows, root)}


def test_links_of_planted_fingerprints(shipped):
    """Clusters, chains and one dense cluster that forces the blocks to be cut again."""
    random.seed(7)
    fps = {random.getrandbits(64) for _ in range(300)}
    for f in list(fps)[:60]:
        for _ in range(random.randrange(4)):
            f ^= 1 << random.randrange(64) | 1 << random.randrange(64)
            fps.add(f)
    centre = random.getrandbits(64)
    fps |= {centre ^ (1 << a) ^ (1 << b) ^ (1 << c) for a in range(0, 20) for b in range(a) for c in range(b)}
    fps |= {0, (1 << 64) - 1, 3, 1 << 63}
    fps = sorted(fps)
    table = shipped.createDataFrame([(signed(f),) for f in fps], "fp long").repartition(5)
    edges = S.near_edges(table, 2, bucket=16)
    roots = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    got = {}
    for i, f in enumerate(fps):
        got.setdefault(roots.get(signed(f), signed(f)), set()).add(i)
    want = {}
    for i, r in enumerate(components(fps, 2)):
        want.setdefault(r, set()).add(i)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
    assert edges.count() <= 6**3 * len(fps)  # a star in each bucket that a fingerprint is in, not all pairs


def test_long_chain_of_edges(shipped):
    n = 300
    order = list(range(n))
    random.seed(1)
    random.shuffle(order)
    edges = shipped.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)] + [(1000, 1001), (7, 7)], "a long, b long")
    roots = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    assert roots == {**{i: 0 for i in range(n)}, 1000: 1000, 1001: 1000}


def test_one_per_component(docs, awkward):
    keep = {r["component_id"] for r in S.near_duplicates(docs).collect()}
    out = S.one_per_component(docs)
    assert out.columns == docs.columns and sorted(r["doc_id"] for r in out.collect()) == sorted(keep)
    out = S.one_per_component(awkward)
    assert out.columns == awkward.columns
    ids = [r["doc_id"] for r in out.collect()]
    assert ids.count(16) == 1 and 12 not in ids and 11 in ids and None in ids and 1 in ids and 2 not in ids


def test_empty_table(awkward):
    assert S.near_duplicates(awkward.filter("false")).collect() == [] and S.one_per_component(awkward.filter(F.lit(False))).count() == 0
    assert len(AWKWARD) == S.near_duplicates(awkward).count()
