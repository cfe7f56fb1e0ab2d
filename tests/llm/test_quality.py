import duckdb
import numpy as np
import pyarrow as pa
from .brute import AWKWARD, quality

from tierforge.llm import quality as Q
from tierforge.llm.oracles import OP1_QUALITY_RULES
from tierforge.llm.text import utf8


def test_counts_match_brute_force(awkward):
    rows = Q.statistics(awkward).collect()
    assert sorted((str(r["doc_id"]), *r[1:6]) for r in rows) == sorted((str(i), *quality(t)) for i, t in AWKWARD)
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_documents_against_sql(docs):
    con = duckdb.connect()
    con.execute("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    assert {tuple(x) for x in con.execute(OP1_QUALITY_RULES).fetchall()} == {tuple(x) for x in Q.statistics(docs).collect()}


def test_judged_keeps_columns_and_agrees_with_statistics(docs, awkward):
    kept = {r["doc_id"] for r in Q.statistics(docs).collect() if r["kept"]}
    assert {r["doc_id"] for r in Q.judged(docs).filter("kept").collect()} == kept
    out = Q.judged(awkward, column="__verdict")
    assert out.columns == [*awkward.columns, "__verdict"] and out.count() == len(AWKWARD)


def test_order_changes_no_verdict(docs):
    a = Q.judged(docs, rules=Q.BASE_RULES + Q.RULES).filter("kept").select("doc_id").collect()
    b = Q.judged(docs, rules=tuple(reversed(Q.BASE_RULES + Q.RULES))).filter("kept").select("doc_id").collect()
    assert sorted(a) == sorted(b)


def test_order_prefers_rejections_per_cost():
    import time

    data, offs = utf8(pa.array([f"{k} word" for k in range(100)]))

    def slow(s):
        time.sleep(0.05)
        return np.arange(s.n) < 50

    dear = Q.Rule("dear", slow)
    cheap = Q.Rule("cheap", lambda s: np.arange(s.n) < 40)
    useless = Q.Rule("useless", lambda s: (time.sleep(0.02), np.zeros(s.n, bool))[1])
    assert [r.name for r in Q.order_rules([useless, dear, cheap], data, offs)] == ["cheap", "dear", "useless"]


def test_empty_table(awkward):
    none = awkward.filter("false")
    assert Q.statistics(none).collect() == [] and Q.judged(none).count() == 0
