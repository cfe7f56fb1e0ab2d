"""Filter interaction audit: what each filter of a cascade removes, misses and shares with the others, in every order.

Five filters judge a document on its own text (A to D) or against the table (E: an equal text with a smaller id).
E is an existential self-join: a left-semi join of the documents on hash, exact text and smaller id with the smallest
id of each text that occurs more than once. Its marks are unioned with the failures of the other filters and aggregated
by row to bit combinations. All counts of all orders follow from the (at most 32) combinations of a part.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

FILTERS = "ABCDE"
_WORD_GAP = r"[\x20\x09-\x0D]+"


def _bit(name: str) -> int:
    return 1 << FILTERS.index(name)


def own_failures(text: Column) -> dict[str, Column]:
    """Filters A to D for a text that is not null, by their letters."""
    words = F.filter(F.split(text, _WORD_GAP, -1), lambda w: w != "")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * capitals > 10 * F.length(text),
        "D": F.rlike(text, F.lit(r"[#$%&*|]")),
    }


def duplicates(docs: DataFrame, doc_id: str, text: str, row: str) -> DataFrame:
    """``row`` of each document whose text a smaller id holds too.

    Only texts whose hash occurs twice or more are compared. The smallest id of a text stands for all smaller ones:
    partial aggregates make it one row a text and task before the shuffle, so that a group of copies of any size
    meets a single row, and the join may split the copies.
    """
    keyed = docs.select(row, F.col(doc_id).alias("id"), F.xxhash64(text).alias("hash"), F.col(text).alias("body"))
    twice = keyed.groupBy("hash").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low < high").select("hash")
    # both joins are steps of their own, without aggregates, so that they can split a hot hash
    again = stored(keyed.join(stored(twice, "audit-hashes"), "hash", "left_semi"), "audit-again")
    first = stored(again.groupBy("hash", "body").agg(F.min("id").alias("low")), "audit-first")
    a, b = again.alias("a"), first.alias("b")
    smaller = (F.col("b.hash") == F.col("a.hash")) & (F.col("b.body") == F.col("a.body")) & (F.col("b.low") < F.col("a.id"))
    return a.join(b, smaller, "left_semi").select(row)


def combinations(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """part, failed (bits of the filters that a document fails), and how many documents, good ones and toxic ones."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), body.alias("body"))
    own = own_failures(F.col("body"))
    bits = sum((F.when(failed, _bit(name)).otherwise(0) for name, failed in own.items()), F.lit(0))
    rows = stored(rows.select("id", "part", "body", bits.alias("bits")).withColumn("row", F.monotonically_increasing_id()), "audit-rows")
    again = stored(duplicates(rows, "id", "body", "row"), "audit-duplicates")
    marks = labels.filter(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    failing = rows.filter("bits > 0").select("row", "bits").union(again.select("row", F.lit(_bit("E")).alias("bits")))
    failed = failing.groupBy("row").agg(F.bit_or("bits").alias("failed"))
    told = rows.select("row", "id", "part").join(failed, "row", "left").join(marks, "id", "left")
    flag = lambda c: F.sum(F.coalesce(c, F.lit(0)).cast("bigint"))
    return told.groupBy("part", F.coalesce("failed", F.lit(0)).alias("failed")).agg(
        F.count(F.lit(1)).alias("n"), flag("good").alias("good"), flag("toxic").alias("toxic"))


def audited(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley: each step of
    each order of the filters in each part of ``docs``.

    A null text is empty, a null part the part of the empty string. A null id has no smaller one and is none; repeated
    rows (same id) are documents of their own and not smaller than each other. A document is good (toxic) if any row
    of ``labels`` with its id says so; labels of other ids and null marks count for nothing. An empty table has no part
    and gives no row. A text of any length is scanned by linear expressions, within the memory of one row.
    """
    found = combinations(docs, labels, doc_id, text, part)
    steps = found.withColumn("filter_order", F.explode(F.lit(["".join(p) for p in permutations(FILTERS)])))
    steps = steps.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    at = lambda name: F.instr("filter_order", name)
    steps = steps.withColumn("bit", sum((F.when(at(f) == F.col("step"), _bit(f)).otherwise(0) for f in FILTERS), F.lit(0)))
    steps = steps.withColumn("before", sum((F.when(at(f) < F.col("step"), _bit(f)).otherwise(0) for f in FILTERS), F.lit(0)))
    fails = F.col("failed").bitwiseAND(F.col("bit")) > 0
    gone = F.col("failed").bitwiseAND(F.col("before")) > 0
    total = lambda when, what="n": F.sum(F.when(when, F.col(what)).otherwise(0))
    counts = steps.groupBy("part", "filter_order", "step", "bit").agg(
        total(~fails & ~gone).alias("kept"), total(fails & ~gone).alias("removed"), total(fails & gone).alias("redundant"),
        total(F.col("failed") == F.col("bit")).alias("unique_fails"),
        total(fails & ~gone, "good").alias("good_lost"), total(fails & ~gone, "toxic").alias("toxic_lost"))
    shapley = F.sum("removed").over(Window.partitionBy("part", "bit"))
    return counts.withColumn("shapley", shapley).drop("bit")
