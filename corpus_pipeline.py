"""From raw documents to an encoded mix: the stages, each over all that the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierforge.llm import bpe, mixing, pii, quality, simhash
from tierforge.llm.common import discard, read, set_aside, stored
from tierforge.llm.queries import ship


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects, columns as they were. A null text is rejected; repeated rows stay."""
    ship(spark)
    plain, restored = set_aside(docs, "text")
    return restored(quality.judged(plain, column="_kept").filter("_kept").drop("_kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of the smallest id; null texts are one group with empty ones."""
    ship(spark)
    return simhash.one_per_component(docs, shingle=3, distance=2)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked; n_chars follows the text. Null texts stay null, rows and ids as they are."""
    plain, restored = set_aside(pii.sanitised(docs), "text", "n_chars")
    return restored(plain.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as its source's target takes it, as that many rows; those taken no time go. Texts
    without words come once, a null source is a source, repeated rows share what they take."""
    return mixing.repeated(docs, weights=(1, 2, 3), share=1.0, most=3)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row of the mix, and whether they decode to its text; a null text has none."""
    ship(spark)
    return bpe.encoded(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("PII", personal_data),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode),
]

ORACLE_SQL = None  # fingerprints, rounding and BPE have no SQL form; tests/llm holds the run against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = read(ship(spark), sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
        if "stored_at" in vars(before):
            discard(before)
    return docs
