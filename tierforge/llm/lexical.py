"""Ranked lexical search by NRA (no random access).

Documents are dealt to shards; a shard holds for each query term the list of its documents by descending impact. For
one query the lists are read in step, each read four times as deep as the one before. A document's score lies between the
impacts read for it and these plus, for each list that has not shown it, the next impact there. Reading ends when no
document that could reach the ``k``-th lower bound, or tie with it, has an open interval: membership, ties and scores are
then final. The best of the shards are ranked by a window over at most ``k`` rows a shard and query.

Weights, document counts and lengths are those of all documents, so a document scores the same in any shard. The number of
shards follows the number of postings and the number of query blocks that of query terms, so that a task holds a bounded part
of either (a query's terms stay together); queries meet shards block by block, and no table is broadcast by this module.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SHARD = 250_000  # postings of a shard
BLOCK = 100_000  # query terms of a block
DEPTH = 64  # postings of the first read of a list
_A_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def terms(text: Column) -> Column:
    """All terms of a text in order, A-Z lower-cased; none of a null text."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), _A_Z, _A_Z.lower()), F.lit(TERM), F.lit(0))


def nra(lists: list[tuple[np.ndarray, np.ndarray]], n_docs: int, k: int, depth: int = DEPTH) -> tuple[np.ndarray, int]:
    """Lower bounds of all documents when the ``k`` best are final, and the score from which they are exact.

    ``lists`` holds for each term its documents (each once) and their impacts (descending, 0 at least).
    """
    low = np.zeros(n_docs, np.int64)
    at, size = np.zeros(len(lists), np.int64), np.array([len(d) for d, _ in lists], np.int64)
    while True:
        upto = np.minimum(at + depth, size)
        for (docs, impacts), lo, hi in zip(lists, at, upto):
            low[docs[lo:hi]] += impacts[lo:hi]
        at, depth = upto, 4 * depth
        kth = max(1, int(np.partition(low, n_docs - k)[n_docs - k]) if n_docs > k else 1)
        ahead = np.array([impacts[p] if p < len(impacts) else 0 for (_, impacts), p in zip(lists, at)], np.int64)
        more = np.full(n_docs, ahead.sum())  # what the lists that have not shown a document can still add
        for (docs, _), p, a in zip(lists, at, ahead):
            if a:
                more[docs[:p]] -= a
        if not ((more > 0) & (low + more >= kth)).any():
            return low, kth


def _searched(n_all: int, n_terms: int, k: int):
    """A shard's postings and a block's queries: the ``k`` best documents of each query."""

    def work(postings: pa.Table, queries: pa.Table) -> pa.Table:
        term, tf, size = (postings[c].to_numpy().astype(np.int64) for c in ("t", "tf", "n"))
        rows, first, doc = np.unique(postings["row"].to_numpy(), return_index=True, return_inverse=True)
        ids = postings["doc_id"].combine_chunks().take(pa.array(first))
        unknown, ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
        longer = 100 - 90 + (90 * size * n_all) // n_terms
        impact = (1_000_000_000 * tf) // (1000 * tf + 8 * longer)
        order = np.lexsort((-impact, term))
        term, doc, impact = term[order], doc[order], impact[order]
        known, begin = np.unique(term, return_index=True)
        end = np.append(begin[1:], len(term))
        item, asked, weight = (queries[c].to_numpy() for c in ("item", "t", "w"))
        place = np.searchsorted(known, asked)
        here = np.append(known, -1)[place] == asked
        item, place, weight = item[here], place[here], weight[here]
        by_item = np.argsort(item, kind="stable")
        item, place, weight = item[by_item], place[by_item], weight[by_item]
        out: list[tuple] = []
        starts = np.unique(item, return_index=True)[1]
        for lo, hi in zip(starts, np.append(starts[1:], len(item))):
            low, kth = nra([(doc[begin[p]:end[p]], w * impact[begin[p]:end[p]]) for p, w in zip(place[lo:hi], weight[lo:hi])], len(rows), k)
            best = np.flatnonzero(low >= kth)
            best = best[np.lexsort((rows[best], ids[best], unknown[best], -low[best]))[:k]]
            out.append((np.full(len(best), item[lo]), rows[best], best, low[best]))
        got, row, best, score = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 4
        found = pa.array(ids[best], mask=unknown[best], type=pa.int64())
        return pa.table([pa.array(got), pa.array(row), found, pa.array(score)], ["item", "row", "doc_id", "score"])

    return work


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents with a score above 0 for each row of ``items``.

    A null text has no terms, so it finds and is found by nothing. Each row of ``items`` is a query and each row of
    ``docs`` a document of its own, also with a null or repeated id; equal scores go by id (a bigint, null last), then by
    the order of the rows. Empty tables give an empty table. Other columns, whatever their names, play no part. A very
    long text is one list of terms in one row, counted in place; its postings lie in one shard.
    """
    queries = items.select(F.monotonically_increasing_id().alias("item"), F.col(item_id).alias("item_id"), F.array_distinct(terms(F.col(item_text))).alias("words"))
    queries = stored(queries.select("item", "item_id", F.explode("words").alias("term")), "lexical-queries")
    vocabulary = stored(queries.select("term").distinct().select("term", F.monotonically_increasing_id().alias("t")), "lexical-vocabulary")
    # one more row a document, without a term: its length, for the counts over all documents
    known = vocabulary.union(docs.sparkSession.range(1).select(F.lit(""), F.lit(-1).cast("bigint")))
    found = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("bigint").alias("doc_id"), terms(F.col(text)).alias("words"))
    found = found.select("row", "doc_id", F.size("words").cast("bigint").alias("n"), F.explode(F.concat("words", F.array(F.lit("")))).alias("term"))
    hits = stored(found.join(known, "term").groupBy("row", "doc_id", "n", "t").agg(F.count(F.lit(1)).alias("tf")), "lexical-postings")
    total = hits.agg(F.count_if((F.col("t") < 0) & (F.col("n") > 0)).alias("docs"), F.sum(F.when(F.col("t") < 0, F.col("n"))).alias("terms"),
                     F.count_if(F.col("t") >= 0).alias("postings")).first()
    n_all, n_terms = total["docs"] or 0, total["terms"] or 1
    hits = hits.filter("t >= 0")
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_all + 2) / (2.0 * F.col("df") + 1))).cast("bigint")
    weights = hits.groupBy("t").agg(F.count(F.lit(1)).alias("df")).select("t", weight.alias("w")).filter("w > 0")
    asked = stored(queries.join(vocabulary, "term").join(weights, "t").select("item", "t", "w"), "lexical-asked")
    blocks, shards = max(1, ceil(asked.count() / BLOCK)), max(1, ceil(total["postings"] / SHARD))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int"))
    of_block = asked.select("t", F.col("block").alias("block")).distinct()
    left = hits.join(of_block, "t").withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    right = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    keys = ["shard", "block"]
    best = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_searched(n_all, n_terms, k), "item bigint, row bigint, doc_id bigint, score bigint")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row")
    best = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.join(queries.select("item", "item_id").distinct(), "item").select("item_id", "rank", "doc_id", "score")
