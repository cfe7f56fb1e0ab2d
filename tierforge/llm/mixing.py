"""Mixing sources to target weights by pivotal dependent rounding; DataFrame functions only.

A source with words ``S`` and target ``t`` takes each document ``t / S`` times on average: the whole part
always, the rest by a fractional copy probability. Rounding that fraction keeps the source's words: two
documents meet, and words of probability move from one to the other (at random, in the proportion that keeps
both expectations) until one probability is 0 or 1; the other document carries what is left to the next
meeting. Documents meet in hashed blocks of about ``BLOCK``; the one residual of a block goes on to the next
level of a tree, until a source has one. Long documents meet first: then the shorter ones that follow settle them,
and the last residual is seldom long. Only that last one is rounded on its own, so a source's words miss the target by
one document at most. All draws are hashes of the documents that meet, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import set_aside, stored

BLOCK = 128
RANGES = 64  # range partitions of the table of sources
WORD = r"[^\x20\x09-\x0D]+"
_CHUNK = 4096  # repeated rows that are written out at a time


def _running(table: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """``table`` with running sums over its whole order (this row included): sums inside range partitions,
    plus the totals of the partitions before, of which there are ``RANGES`` at most."""
    dealt = stored(table.repartitionByRange(RANGES, *order).withColumn("__p", F.spark_partition_id()), "mix-ranges")
    totals = dealt.groupBy("__p").agg(*[F.sum(c).alias(f"__{n}") for n, c in sums.items()])
    before = W.orderBy("__p").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select("__p", *[F.coalesce(F.sum(f"__{n}").over(before), F.lit(0)).alias(f"__{n}") for n in sums])
    inside = W.partitionBy("__p").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return (
        dealt.withColumns({n: F.sum(c).over(inside) for n, c in sums.items()}).join(F.broadcast(totals), "__p")
        .withColumns({n: F.col(n) + F.col(f"__{n}") for n in sums}).drop("__p", *[f"__{n}" for n in sums])
    )


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0, most: int = 3) -> DataFrame:
    """Per source: source_size, n_docs and target. Sources by code point, null last, weigh ``weights`` in turn;
    a target stops at ``most`` times its source, the excess going to the others by weight until none is above."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    per = _running(per, [F.col("source").asc_nulls_last()], {"place": F.lit(1)})
    turn = F.pmod(F.col("place") - 1, F.lit(len(weights)))
    per = per.withColumns({
        "weight": F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int")).cast("decimal(38,0)"),
        "cap": (F.col("source_size") * most).cast("decimal(38,0)"),
    })
    # A source is full if the others' common level can rise to its own: caps below it plus its level times all weight from it on.
    level = F.col("cap").cast("double") / F.col("weight").cast("double")
    per = _running(per.withColumn("level", level), [F.col("level"), F.col("source").asc_nulls_last()],
                   {"caps": F.col("cap"), "full_weight": F.col("weight")})
    whole = per.agg(F.sum("weight").alias("all_weight"), (F.sum("source_size") * F.lit(share)).alias("all_words"))
    per = per.crossJoin(F.broadcast(whole))  # one row
    filled = F.col("caps").cast("double") + F.col("level") * (F.col("all_weight") - F.col("full_weight")).cast("double")
    per = stored(per.withColumn("full", filled <= F.col("all_words")), "mix-levels")
    left = per.agg(
        F.first("all_words").alias("words"), F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).alias("taken"),
        F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0)).alias("open"),
    ).select((F.col("words") - F.col("taken").cast("double")).alias("__words"), F.col("open").cast("double").alias("__open"))
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("weight").cast("double") * F.col("__words") / F.col("__open"))
    return per.crossJoin(F.broadcast(left)).select("source", "source_size", "n_docs", target.alias("target"))


def _draw(seed: int, *columns: Column) -> Column:
    """Uniform in [0, 1) from what the columns hold."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11).cast("double") / F.lit(float(1 << 53))


_ITEM = "struct<size:bigint,doc_id:{id},n:bigint,sure:bigint,p:double>"


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _meet(state: Column, item: Column, seed: int) -> Column:
    """One meeting: of the residual and the next document, one is settled, the other is the residual."""
    mine, other = state["cur"], item
    done = lambda settled, p, kept, q: F.struct(
        F.concat(state["done"], F.array(settled.withField("p", p))).alias("done"), kept.withField("p", q).alias("cur"))
    whole = lambda x: (x["p"] <= 0) | (x["p"] >= 1)
    up = F.struct(  # words that can move to mine, and to the other
        F.least((1 - mine["p"]) * mine["size"], other["p"] * other["size"]).alias("here"),
        F.least(mine["p"] * mine["size"], (1 - other["p"]) * other["size"]).alias("there"),
        _draw(seed, mine["doc_id"], mine["size"], other["doc_id"], other["size"]).alias("u"),
    )

    def move(m: Column) -> Column:
        gain, lose = (1 - mine["p"]) * mine["size"], (1 - other["p"]) * other["size"]
        to_mine = (F.when(gain <= other["p"] * other["size"], done(mine, F.lit(1.0), other, other["p"] - m["here"] / other["size"]))
                   .otherwise(done(other, F.lit(0.0), mine, mine["p"] + m["here"] / mine["size"])))
        to_other = (F.when(lose <= mine["p"] * mine["size"], done(other, F.lit(1.0), mine, mine["p"] - m["there"] / mine["size"]))
                    .otherwise(done(mine, F.lit(0.0), other, other["p"] + m["there"] / other["size"])))
        return F.when(m["u"] * (m["here"] + m["there"]) < m["there"], to_mine).otherwise(to_other)

    return (F.when(whole(mine), done(mine, mine["p"], other, other["p"]))
            .when(whole(other), done(other, other["p"], mine, mine["p"]))
            .otherwise(_let(up, move)))


def _settle(blocks: DataFrame, seed: int, item: str) -> DataFrame:
    """(source..., block, items) to done and the residual cur of each block."""
    start = F.struct(F.array().cast(f"array<{item}>").alias("done"), F.element_at("items", 1).alias("cur"))
    folded = F.aggregate(F.slice("items", 2, F.greatest(F.size("items") - 1, F.lit(1))), start, lambda s, x: _meet(s, x, seed))
    folded = F.when(F.size("items") == 1, start).otherwise(folded)
    return blocks.withColumn("f", folded).drop("items").withColumns({"done": F.col("f.done"), "cur": F.col("f.cur")}).drop("f")


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = (1, 2, 3),
          share: float = 1.0, most: int = 3, block: int = BLOCK, seed: int = 7) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken: one row for each row of ``docs``.

    Null and empty texts have size 0 and are taken once, at no words; a null source is one, the last. Repeated rows
    are counted first and rounded as one document of that many copies; an empty table gives an empty table.
    """
    sizes = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
        F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("bigint").alias("size"),
    )
    return mixed_sizes(stored(sizes, "mix-sizes"), weights, share, most, block, seed)


def mixed_sizes(sizes: DataFrame, weights=(1, 2, 3), share=1.0, most=3, block=BLOCK, seed=7) -> DataFrame:
    """``mixed`` for documents given as doc_id, source, size."""
    per = stored(targets(sizes, weights, share, most), "mix-targets")
    item = _ITEM.format(id=sizes.schema["doc_id"].dataType.simpleString())
    keys = ["source", "source_size", "target", "times"]
    each = sizes.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("n"))
    rate = F.col("target") / F.col("source_size")
    plan = per.select(
        F.col("source").alias("__source"), "source_size", "target", "n_docs",
        F.when(F.col("source_size") > 0, F.floor(rate)).otherwise(1).cast("bigint").alias("times"),
        F.when(F.col("source_size") > 0, rate - F.floor(rate)).otherwise(0.0).alias("part"),
    )
    each = each.join(plan, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    mass = F.col("n") * F.when(F.col("size") > 0, F.col("part")).otherwise(0.0)
    each = each.select(
        *keys, F.pmod(F.xxhash64(F.lit(seed), "doc_id", "size"), F.ceil(F.col("n_docs") / F.lit(block))).alias("block"), "n_docs",
        F.struct("size", "doc_id", "n", F.floor(mass).cast("bigint").alias("sure"), (mass - F.floor(mass)).alias("p")).cast(item).alias("item"),
    )
    most_docs = per.agg(F.max("n_docs")).first()[0] or 0
    tree, level, blocks = [], 0, -(-most_docs // block)
    while True:
        gathered = each.groupBy(*keys, "block").agg(F.sort_array(F.collect_list("item"), asc=False).alias("items"))
        settled = stored(_settle(gathered, seed + level, item), f"mix-level{level}")
        tree.append(settled.select(*keys, F.explode("done").alias("item")))
        each = settled.select(*keys, F.floor(F.col("block") / F.lit(block)).cast("bigint").alias("block"), F.col("cur").alias("item"))
        level += 1
        if blocks <= 1:
            break
        blocks = -(-blocks // block)
    lone = F.col("item.p")
    one = F.when(_draw(seed - 1, F.col("item.doc_id"), F.col("item.size")) < lone, 1.0).otherwise(0.0)
    rows = each.select(*keys, F.col("item").withField("p", F.when((lone <= 0) | (lone >= 1), lone).otherwise(one)).alias("item"))
    for part in tree:
        rows = rows.union(part)
    # The n equal rows of an item: as many as it took get one copy more.
    rows = rows.select(*keys, "item", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("item.n") - 1) / _CHUNK).cast("bigint"))).alias("__c"))
    last = F.least(F.col("item.n"), (F.col("__c") + 1) * _CHUNK)
    rows = rows.select(*keys, "item", F.explode(F.sequence(F.col("__c") * _CHUNK + 1, last)).alias("__k"))
    copies = F.col("times") + F.when(F.col("__k") <= F.col("item.sure") + F.col("item.p").cast("bigint"), 1).otherwise(0)
    return rows.select(
        F.col("item.doc_id").alias("doc_id"), "source", F.col("item.size").alias("size"), "source_size", "target",
        copies.cast("bigint").alias("copies"), (copies * F.col("item.size")).cast("bigint").alias("taken"),
    )


def repeated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """``docs`` with the same columns, each row as often as the mix takes it.

    Equal documents (same id, source and size) share what they take: each row of theirs comes ``copies / rows`` times, the
    first ones once more; a text of no words comes once.
    """
    plain, restored = set_aside(docs, doc_id, text, source)
    size = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("bigint")
    taken = mixed(plain, doc_id, text, source, **options)
    plan = taken.groupBy("doc_id", "source", "size").agg(F.sum("copies").alias("__copies"), F.count(F.lit(1)).alias("__n"))
    plan = plan.select(F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__size"), "__copies", "__n")
    one, many = plan.filter("__n = 1 and __copies > 0"), plan.filter("__n > 1")
    same = F.col(doc_id).eqNullSafe(F.col("__id")) & F.col(source).eqNullSafe(F.col("__source")) & (F.col("__rowsize") == F.col("__size"))
    # both sides grow with the documents; the rows are used twice
    rows = stored(plain.withColumn("__rowsize", size).join(one.union(many).hint("merge"), same), "mix-rows")
    single = rows.filter("__n = 1").select(*plain.columns, F.col("__copies").alias("__times"))
    # Equal rows are one with a count (combined before the shuffle); the rest of the division goes to the first rows.
    group = [*plain.columns, "__id", "__source", "__size", "__copies", "__n"]
    shared = rows.filter("__n > 1").groupBy(*group).agg(F.count(F.lit(1)).alias("__m"))
    order = W.partitionBy("__id", "__source", "__size").orderBy(F.xxhash64(text)).rowsBetween(W.unboundedPreceding, 0)
    last = F.sum("__m").over(order)
    rest = F.pmod(F.col("__copies"), F.col("__n"))
    extra = F.least(last, rest) - F.least(last - F.col("__m"), rest)
    shared = shared.withColumn("__times", F.col("__m") * F.floor(F.col("__copies") / F.col("__n")) + extra).select(*plain.columns, "__times")
    out = single.union(shared).filter("__times > 0").withColumn("__c", F.explode(F.sequence(F.lit(1), F.col("__times").cast("int")))).select(*plain.columns)
    return restored(out)
