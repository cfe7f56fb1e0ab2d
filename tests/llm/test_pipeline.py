"""The pipeline's stages against the operators' plain forms, and the registry."""

import collections

import __spark_entry__ as E
import corpus_pipeline
import numpy as np
import public_tokenizers
from .brute import components, fingerprint

from tierforge.llm import bpe, mixing, pii, quality
from tierforge.llm.common import stored

SF = "/root/testdata/sf0.001"


def test_stage_by_stage(shipped, docs):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "SimHash near-dedup", "PII", "mixing sources to target weights", "byte-level BPE encoding and decoding"]
    tables, table = [docs], docs
    for name, stage in corpus_pipeline.STAGES:
        table = stored(stage(shipped, table, SF), "test-stage")
        tables.append(table)
        if name != names[-1]:
            assert table.dtypes == docs.dtypes
    first, good, single, clean, mix, final = tables
    kept = {r["doc_id"] for r in quality.statistics(first).collect() if r["kept"]}
    assert {r["doc_id"] for r in good.collect()} == kept
    rows = sorted((r["doc_id"], r["text"]) for r in good.collect())
    low = {}
    for (i, _), root in zip(rows, components([fingerprint(t) for _, t in rows], 2)):
        low[root] = min(low.get(root, i), i)
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(low.values())
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(low.values())
    assert all(r["n_email"] + r["n_card"] + r["n_ip"] + r["n_phone"] == 0 for r in pii.report(clean).collect())
    copies = {r["doc_id"]: r["copies"] for r in mixing.mixed(clean).collect()}
    assert collections.Counter(r["doc_id"] for r in mix.collect()) == +collections.Counter(copies)
    codec = bpe.Codec(bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    text = {r["doc_id"]: r["text"] for r in mix.collect()}
    for r in final.collect():
        assert r["round_trip"] and codec.decode(bytes(r["token_ids"])).decode() == text[r["doc_id"]] and len(np.frombuffer(r["token_ids"], "<u4"))


def test_run_equals_stages(shipped):
    a, b = corpus_pipeline.run(shipped, SF).collect(), corpus_pipeline.run(shipped, SF).collect()
    assert sorted(map(str, a)) == sorted(map(str, b)) and a


def test_registry(shipped):
    names = [n for n in E.queries() if n.startswith("op")]
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)] and "pipeline" in E.queries()


def test_awkward_documents(shipped, awkward):
    table = awkward.selectExpr("doc_id", "text", "lang", "source", "length(text) as n_chars")
    for name, stage in corpus_pipeline.STAGES:
        table = stored(stage(shipped, table, SF), "test-stage")
    assert table.columns == ["doc_id", "token_ids", "round_trip"]
    empty = awkward.filter("false").selectExpr("doc_id", "text", "lang", "source", "cast(length(text) as bigint) as n_chars")
    for name, stage in corpus_pipeline.STAGES:
        empty = stored(stage(shipped, empty, SF), "test-stage")
    assert empty.count() == 0


def test_clashing_columns(shipped, docs):
    """Extra columns named like those that the stages make: each stage keeps them and gives the same rows."""
    names = ("__kept", "_kept", "__fp", "__root", "__id", "__hash", "__edits", "__n", "__times", "_id", "_body", "_n", "fp", "row", "size", "TEXT", "_aside_0")
    wide = docs.selectExpr("*", *[f"'{i}' as `{c}`" for i, c in enumerate(names)])
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(shipped, wide, SF)
        assert out.columns == wide.columns, name
        got = out.collect()
        assert all(tuple(r)[5:] == tuple(map(str, range(len(names)))) for r in got)
        assert sorted(str(tuple(r)[:5]) for r in got) == sorted(str(tuple(r)) for r in stage(shipped, docs, SF).collect()), name


def test_repeated_rows_and_ids(shipped):
    """Of equal rows one stays; of one id with two texts the smaller hash; a null id gives way."""
    long = " ".join(f"word{i}" for i in range(60))
    rows = [(1, long), (1, long), (2, long), (None, long), (3, "other " + long[::-1]), (3, "other " + long[::-1]), (None, "a lone one"), (5, None), (6, ""), (6, None)]
    table = shipped.createDataFrame(rows, "doc_id long, text string").repartition(4)
    from tierforge.llm import simhash

    out = [r["doc_id"] for r in simhash.one_per_component(table).collect()]
    assert sorted(map(str, out)) == ["1", "3", "5", "None"]


def test_inputs_in_a_store_that_only_spark_reads(shipped, tmp_path):
    text = "the quick brown fox and a lazy dog that have been to the river with all of their friends of the old town , " * 4
    docs = shipped.createDataFrame([(i, f"{text} number {i}", "en", "s", 1) for i in range(6)], "doc_id long, text string, lang string, source string, n_chars int")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    shipped._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.tests.link./in", tmp_path.as_uri())
    far, near = (corpus_pipeline.run(shipped, at).collect() for at in ("viewfs://tests/in", str(tmp_path)))
    assert sorted(map(str, far)) == sorted(map(str, near))
