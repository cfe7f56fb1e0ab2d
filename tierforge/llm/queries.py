"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, audit, bpe, katz, kneser_ney, langid, lexical, mixing, pii, quality, secret_scan, simhash, suffix
from .common import in_fold, read

Query = Callable[[SparkSession, str], DataFrame]
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Hand this package to the executors' Python, once per application."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        _SHIPPED.add(app)
        top = Path(__file__).resolve().parents[1]
        packed = os.path.join(tempfile.mkdtemp(prefix="tierforge-"), "tierforge_src.zip")
        with zipfile.ZipFile(packed, "w") as out:
            for file in sorted(top.rglob("*.py")):
                out.write(file, file.relative_to(top.parent))
        spark.sparkContext.addPyFile(packed)
    return spark


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.statistics(read(ship(spark), sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(read(ship(spark), sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.repeats(read(ship(spark), sf_dir, "documents"), length=200)


def op4_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(read(ship(spark), sf_dir, "embeddings"), is_query=F.col("vec_id") % 50 == 0, k=5)


def op5_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.judged(read(ship(spark), sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mixed(read(ship(spark), sf_dir, "documents"), weights=(1, 2, 3), share=1.0, most=3)
    return rows.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digests(read(ship(spark), sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identified(read(ship(spark), sf_dir, "documents"), held_out=in_fold("doc_id", 5) == 0)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(ship(spark), sf_dir, "documents"), shingle=3, distance=2)


def op10_katz_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.scores(read(ship(spark), sf_dir, "documents"), held_out=in_fold("doc_id", 7) == 2)


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(read(ship(spark), sf_dir, "documents"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(read(ship(spark), sf_dir, "documents"), read(spark, sf_dir, "benchmark"), k=10)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audited(read(ship(spark), sf_dir, "documents"), read(spark, sf_dir, "labels"))


QUERIES: dict[str, Query] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_pii": op2_pii,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_cross_polytope": op4_cross_polytope,
    "op5_kneser_ney": op5_kneser_ney,
    "op6_mixing": op6_mixing,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_language_id": op8_language_id,
    "op9_simhash": op9_simhash,
    "op10_katz_scoring": op10_katz_scoring,
    "op11_secret_scan": op11_secret_scan,
    "op12_lexical_search": op12_lexical_search,
    "op13_filter_audit": op13_filter_audit,
}
