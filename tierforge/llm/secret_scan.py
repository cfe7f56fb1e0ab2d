"""Secrets: known forms, and strings that a battery of randomness tests tells from text; DataFrame functions only.

A candidate is a maximal run of ``LEAST`` or more letters, digits and ``+/_-``, with its padding. Its encoding is the
smallest of ``ENCODINGS`` that holds all its symbols. Over that alphabet it must look drawn evenly and independently: a
chi-squared test of the symbol counts, a runs test of the lower against the upper half of the alphabet, and the lag-1
serial correlation of the symbols' places, each at ``ALPHA / 3``. What such a string could be by chance is then judged
against text: symbols of ordinary text (their frequencies in all documents) coincide more often than even ones, and the
p-value is the chance that a text of this length has as few equal pairs. Short strings have little power and get no small
p-value. Over the distinct candidates of each length class (powers of two) the procedure of Benjamini and Hochberg keeps
the share of false discoveries at ``FDR``, from a histogram of the p-values in hundredths of a decade, rounded up: no
task sorts a class.

Positions are code points, the running sums of the lengths of matches and of what lies between them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

KINDS = ("assign", "access", "hex")
RANDOM = "random"
# fixed values: the forms of the base kinds
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}+"  # shorter ones fail; none of them hides a longer one
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}+"

LEAST = 16
CANDIDATE = rf"[A-Za-z0-9+/_-]{{{LEAST},}}+={{0,2}}"
FDR = 0.01
ALPHA = 0.001  # a truly random string fails the battery with this chance

_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
_UPPER = _LOWER.upper()
# by size; of two that fit, the first
ENCODINGS = {
    "decimal": _DIGITS, "hex": _DIGITS + "abcdef", "HEX": _DIGITS + "ABCDEF", "lower": _LOWER, "upper": _UPPER, "base32": _UPPER + "234567",
    "base36": _DIGITS + _LOWER, "BASE36": _DIGITS + _UPPER, "letters": _UPPER + _LOWER, "base62": _DIGITS + _UPPER + _LOWER,
    "base64": _UPPER + _LOWER + _DIGITS + "+/", "base64url": _UPPER + _LOWER + _DIGITS + "-_", "mixed": _UPPER + _LOWER + _DIGITS + "+/-_",
}
FINEST = 30_000  # hundredths of a decade; smaller p-values count as this one


def _cut(text: Column, pattern: str) -> Column:
    """All matches in order, each with the number of code points between it and the one before."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.transform(F.split(text, pattern, -1), F.length), F.lit(1), F.size(found))
    return F.zip_with(gaps, found, lambda g, m: F.struct(g.alias("gap"), m.alias("value")))


def _found(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """row, doc_id and the matches of each kind, one stored row for each row of ``docs``."""
    body = F.coalesce(F.col(text), F.lit(""))
    none = F.array().cast("array<struct<gap:int,value:string>>")
    kinds = {
        "assign": F.when(F.rlike(body, F.lit(r"(?i:word|passwd|secret|token|key)[\"']?\x20*[:=]")), _cut(body, ASSIGN)),
        "access": F.when(F.contains(body, F.lit("AKIA")), _cut(body, ACCESS)),
        "hex": F.when(F.rlike(body, F.lit(HEX)), _cut(body, HEX)),
        RANDOM: F.when(F.rlike(body, F.lit(CANDIDATE)), _cut(body, CANDIDATE)),
    }
    rows = docs.select(F.col(doc_id).alias("doc_id"), *[F.coalesce(m, none).alias(k) for k, m in kinds.items()])
    return stored(rows.withColumn("row", F.monotonically_increasing_id()), "secret-matches")


def _placed(found: DataFrame) -> DataFrame:
    """(row, kind, start, end, value) of every match."""
    of_kind = lambda no: lambda m, i: F.struct(F.lit(no).alias("kind"), i.alias("i"), m["gap"].alias("gap"), m["value"].alias("value"))
    every = F.concat(*[F.transform(k, of_kind(no)) for no, k in enumerate((*KINDS, RANDOM))])
    each = found.select("row", F.explode(every).alias("m")).select("row", "m.*")
    size = F.length("value")
    end = F.sum((F.col("gap") + size).cast("bigint")).over(Window.partitionBy("row", "kind").orderBy("i"))
    return each.select("row", "kind", "value", (end - size).alias("start"), end.alias("end"))


def symbol_moments(docs: DataFrame, text: str) -> dict[str, tuple[float, float]]:
    """For each encoding the chance that two (three) symbols of ordinary text, of those that it has, are equal. For
    alphabets of one case the text counts as written in that case: a text that has capitals only in its secrets would
    else pass them as text."""
    pieces = docs.select(F.explode(F.regexp_extract_all(F.col(text), F.lit(r"(?s).{1,4096}"), F.lit(0))).alias("piece"))
    symbols = stored(pieces.select(F.explode(F.split("piece", "")).alias("c")).filter(F.col("c").isin(list(ENCODINGS["mixed"]))).groupBy("c").count(), "secret-symbols")
    out: dict[str, tuple[float, float]] = {}
    for folded in (False, True):
        counts = symbols.groupBy(F.lower("c").alias("c")).agg(F.sum("count").alias("count")) if folded else symbols
        mine = {e: list(a.lower()) if folded else list(a) for e, a in ENCODINGS.items() if folded == (a in (a.lower(), a.upper()))}
        power = lambda e, k: F.sum(F.when(F.col("c").isin(mine[e]), F.pow(F.col("count").cast("double"), F.lit(k))))  # noqa: B023, E731
        got = counts.agg(*[F.coalesce(power(e, k), F.lit(0.0)).alias(f"{e}:{k}") for e in mine for k in (1, 2, 3)]).first()
        out |= {e: (got[f"{e}:2"] / got[f"{e}:1"] ** 2, got[f"{e}:3"] / got[f"{e}:1"] ** 3) if got[f"{e}:1"] else (1.0, 1.0) for e in mine}
    return out


def _above(z: Column) -> Column:
    """The chance of a standard normal value above ``z`` (relative error below 1.2e-7)."""
    x = F.abs(z) / F.lit(math.sqrt(2.0))
    t = 1 / (1 + 0.5 * x)
    poly = F.lit(0.17087277)
    # fixed values: Chebyshev fit of the complementary error function
    for c in (-0.82215223, 1.48851587, -1.13520398, 0.27886807, -0.18628806, 0.09678418, 0.37409196, 1.00002368, -1.26551223):
        poly = F.lit(c) + t * poly
    half = 0.5 * t * F.exp(poly - x * x)
    return F.when(z >= 0, half).otherwise(1 - half)


def _of(encoding: Column, values: dict[str, object]) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), encoding)


def _statistics(tokens: DataFrame) -> DataFrame:
    """``tokens(value)`` with encoding, its size k, and what the tests count: the length n, the squares of the symbols' counts,
    turns and ones of the runs, the sums of the symbols' places, of their squares and of the products of neighbours."""
    kind = F.lit(None)
    for e, symbols in reversed(ENCODINGS.items()):
        kind = F.when(F.call_function("translate", F.col("s"), F.lit(symbols), F.lit("")) == "", F.lit(e)).otherwise(kind)
    t = tokens.select("value", F.regexp_replace("value", "=+$", "").alias("s"))
    t = t.select("*", F.length("s").alias("n"), kind.alias("encoding"))
    t = t.select("*", _of(F.col("encoding"), ENCODINGS).alias("symbols"), _of(F.col("encoding"), {e: len(x) for e, x in ENCODINGS.items()}).alias("k"))
    low = F.floor(F.col("k") / 2).cast("int")
    halves = F.concat(F.repeat(F.lit("0"), low), F.repeat(F.lit("1"), F.col("k") - low))
    t = t.select("*", F.call_function("translate", F.col("s"), F.col("symbols"), halves).alias("side"),
                 F.transform(F.split("s", ""), lambda c: F.call_function("instr", F.col("symbols"), c).cast("bigint")).alias("v"))
    without = lambda text, part: F.length(F.replace(text, part, F.lit("")))
    times = F.transform(F.split("symbols", ""), lambda c: (F.col("n") - without(F.col("s"), c)).cast("bigint"))
    turns = sum((F.col("n") - without(F.col("side"), F.lit(pair))) / 2 for pair in ("01", "10"))
    add = lambda a: F.aggregate(a, F.lit(0).cast("bigint"), lambda x, y: x + y).cast("double")
    turned = F.concat(F.slice("v", F.lit(2), F.size("v")), F.slice("v", 1, 1))
    return t.select(
        "value", "encoding", F.col("k").cast("double").alias("k"), F.col("n").cast("double").alias("n"),
        add(F.transform(times, lambda x: x * x)).alias("squares"), turns.alias("turns"), without(F.col("side"), F.lit("0")).cast("double").alias("ones"),
        add(F.col("v")).alias("total"), add(F.transform("v", lambda x: x * x)).alias("own"), add(F.zip_with("v", turned, lambda x, y: x * y)).alias("next"))


def battery(tokens: DataFrame, moments: dict[str, tuple[float, float]]) -> DataFrame:
    """``tokens(value)``: value, encoding, n, the p-values of the three tests of randomness, and of text having as few equal pairs."""
    t = stored(_statistics(tokens), "secret-statistics")
    n, k = F.col("n"), F.col("k")
    # chi-squared of the counts, its cube root taken as normal (Wilson and Hilferty)
    df = k - 1
    spread = 2 / (9 * df)
    z_even = (F.pow((k * F.col("squares") / n - n) / df, F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread)
    # runs of the lower and upper half of the alphabet
    runs = 2 * F.col("ones") * (n - F.col("ones")) / n + 1
    varied = (runs - 1) * (runs - 2) / (n - 1)
    z_runs = F.when(varied > 0, F.abs(1 + F.col("turns") - runs) / F.sqrt(varied))
    # circular serial correlation of the symbols' places
    square = F.col("total") * F.col("total")
    size = n * F.col("own") - square
    z_serial = F.when(size > 0, F.abs((n * F.col("next") - square) / size + 1 / (n - 1)) / F.sqrt(n * n / ((n - 1) * (n - 1) * (n - 2))))
    # equal pairs: their number in text of this length has this mean and variance
    two, three = (_of(F.col("encoding"), {e: float(m[i]) for e, m in moments.items()}) for i in (0, 1))
    pairs = n * (n - 1) / 2
    spread_pairs = pairs * (two - two * two) + n * (n - 1) * (n - 2) * (three - two * two)
    z_text = F.when(spread_pairs > 0, ((F.col("squares") - n) / 2 - pairs * two) / F.sqrt(spread_pairs))
    z = t.select("value", "encoding", "n", z_even.alias("even"), z_runs.alias("runs"), z_serial.alias("serial"), z_text.alias("text"))
    twice = lambda name: F.coalesce(2 * _above(F.col(name)), F.lit(0.0))
    return z.select("value", "encoding", "n", _above(F.col("even")).alias("p_even"), twice("runs").alias("p_runs"), twice("serial").alias("p_serial"),
                    F.coalesce(_above(-F.col("text")), F.lit(1.0)).alias("p_text"))


def discoveries(tokens: DataFrame, moments: dict[str, tuple[float, float]], fdr: float = FDR, alpha: float = ALPHA) -> DataFrame:
    """The distinct ``tokens(value)`` that pass as random strings: value, encoding and p (rounded up)."""
    tested = battery(tokens, moments)
    even = (F.col("p_even") >= alpha / 3) & (F.col("p_runs") >= alpha / 3) & (F.col("p_serial") >= alpha / 3)
    place = F.least(F.floor(-100 * F.log10(F.greatest(F.when(even, F.col("p_text")).otherwise(1.0), F.lit(1e-300)))), F.lit(FINEST)).cast("int")
    tested = stored(tested.select("value", "encoding", F.length(F.bin(F.col("n").cast("bigint"))).alias("class"), place.alias("place")), "secret-tested")
    histogram = tested.groupBy("class", "place").count()
    whole = Window.partitionBy("class")
    as_small = F.sum("count").over(whole.orderBy(F.desc("place")))
    p = F.pow(F.lit(10.0), -F.col("place") / 100)
    cuts = histogram.select("class", "place", p.alias("p"), as_small.alias("as_small"), F.sum("count").over(whole).alias("m"))
    cuts = cuts.filter(F.col("p") <= F.lit(fdr) * F.col("as_small") / F.col("m")).groupBy("class").agg(F.min("place").alias("cut"))
    return tested.join(cuts, "class").filter("place >= cut").select("value", "encoding", p.alias("p"))


def _spans(found: DataFrame, docs: DataFrame, text: str, fdr: float, alpha: float) -> DataFrame:
    """(row, kind, start, end, value, encoding, p) of all findings; encoding and p are null for the base kinds."""
    placed = stored(_placed(found), "secret-places")
    group = F.when(F.col("kind") == 0, F.length(F.regexp_extract("value", ASSIGN, 1))).otherwise(LEAST)
    base = placed.filter(F.col("kind") < len(KINDS)).filter(group >= 8)
    candidates = placed.filter(F.col("kind") == len(KINDS))
    strange = discoveries(candidates.select("value").distinct(), symbol_moments(docs, text), fdr, alpha)
    return base.withColumn("encoding", F.lit(None).cast("string")).withColumn("p", F.lit(None).cast("double")).unionByName(candidates.join(strange, "value"))


def findings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", fdr: float = FDR, alpha: float = ALPHA) -> DataFrame:
    """doc_id, kind, start, end, value, encoding, p: one row for each secret found, p and encoding for the kind ``random``."""
    found = _found(docs, doc_id, text)
    names = F.array(*[F.lit(k) for k in (*KINDS, RANDOM)])
    spans = _spans(found, docs, text, fdr, alpha).withColumn("kind", F.element_at(names, F.col("kind") + 1))
    return spans.join(found.select("row", "doc_id"), "row").select("doc_id", "kind", "start", "end", "value", "encoding", "p")


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", fdr: float = FDR, alpha: float = ALPHA) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans; one row for each row of ``docs``.

    A null text is empty; repeated rows each give a row, and their strings count once in the control of false
    discoveries; null ids stay null; other columns, whatever their names, play no part; an empty table gives an empty
    table. Work is linear in a text, whatever its length and the number of its matches; its matches are held in one row.
    """
    found = _found(docs, doc_id, text)
    spans = _spans(found, docs, text, fdr, alpha)
    name = F.array(*[F.lit(k) for k in (*KINDS, RANDOM)])
    written = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", F.element_at(name, x["kind"] + 1), x["start"], x["end"])), ",")
    per = spans.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"),
        *[F.count_if(F.col("kind") == no).alias(f"n_{k}") for no, k in enumerate((*KINDS, RANDOM))])
    per = per.select("row", *[f"n_{k}" for k in (*KINDS, RANDOM)], written(F.filter("spans", lambda s: s["kind"] < len(KINDS))).alias("base"),
                     written(F.col("spans")).alias("spans"))
    out = found.select("row", "doc_id").join(per, "row", "left")
    return out.select("doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("bigint").alias(f"n_{k}") for k in (*KINDS, RANDOM)],
                      F.sha2(F.coalesce("base", F.lit("")).cast("binary"), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))
