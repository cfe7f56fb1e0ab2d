"""Personal data: patterns, and the terms that would give it away; DataFrame functions only.

Emails, IP addresses, card and phone numbers are protected entities. A term (a run of ``TERM_LETTERS`` letters
or more) discloses an entity as far as knowing the term removes the uncertainty about it: the pointwise mutual
information of entity and term, estimated from their document frequencies over the whole corpus, against the
entity's own information content ``log2(D / df(entity))``. Both stand in the same document, however far apart.
In every document that holds the entity, every occurrence of a term whose share reaches ``GENERALISE`` is
generalised, of one that reaches ``REMOVE`` removed. A pair counts only with ``SUPPORT`` different contexts of the
mentions, ``WINDOW`` characters on either side (copies of one passage are one observation).

The patterns are possessive forms of the plain ones: the classes next to each other are disjoint, so nothing that
the plain pattern matches is lost, and a scan stays linear in the text. Positions are code points: running sums of the
lengths of what lies between the matches, and of the matches. A text is cut up once, so that work is linear in its
length and in the number of its mentions; both are held in one row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import set_aside, stored

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_OCTETS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}"

TERM_LETTERS = 2
WINDOW = 100  # characters on either side of a mention
SUPPORT = 3  # different contexts
GENERALISE = 0.9
REMOVE = 0.97
_LETTERS = rf"\p{{L}}{{{TERM_LETTERS},}}"
_MASK = "\ufdd0"  # stands for a letter of a span; no character
_FREE = rf"(?<![\p{{L}}{_MASK}])\p{{L}}{{{TERM_LETTERS},}}+(?!{_MASK})"  # a term that reaches into no span

SPAN = "struct<start:bigint,kind:int,end:bigint>"
MATCH = "struct<start:bigint,end:bigint,value:string>"
_GROUP = 512  # elements that one running result copies
_CHUNK = 256  # characters of a piece of text


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(values: Column, step: Callable[[Column, Column], Column]) -> Column:
    """The results of ``step`` (a sum, a maximum) over the bigints up to and with each place. Only groups of ``_GROUP`` grow
    element by element, so work follows the length of ``values``."""
    none = F.array().cast("array<bigint>")
    start = F.struct(F.lit(0).cast("bigint").alias("last"), none.alias("out"))

    def grow(state: Column, x: Column) -> Column:
        return _let(step(state["last"], x), lambda now: F.struct(now.alias("last"), F.concat(state["out"], F.array(now)).alias("out")))

    def whole(v: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / _GROUP).cast("int"))
        groups = F.transform(numbers, lambda g: F.aggregate(F.slice(v, g * _GROUP + 1, F.lit(_GROUP)), start, grow))
        return _let(groups, lambda gs: _let(
            F.concat(F.array(F.lit(0).cast("bigint")), F.aggregate(F.transform(gs, lambda g: g["last"]), start, grow)["out"]),
            lambda before: F.flatten(F.zip_with(gs, F.slice(before, F.lit(1), F.size(gs)), lambda g, base: F.transform(g["out"], lambda x: step(base, x))))))

    return _let(values, lambda v: F.when(F.size(v) > 0, whole(v)).otherwise(none))


def _add(a: Column, b: Column) -> Column:
    return a + b


def _cut(chunks: Column, start: Column, length: Column) -> Column:
    """``length`` characters of a text in pieces of ``_CHUNK``, from place ``start`` (0 the first) on."""
    inside = (start % _CHUNK).cast("int")
    first = F.floor(start / _CHUNK).cast("int") + 1
    held = F.transform(F.sequence(first, first + F.floor((inside + length) / _CHUNK).cast("int")), lambda i: F.try_element_at(chunks, i))
    return F.substring(F.array_join(held, ""), inside + 1, length.cast("int"))


def _chunks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{_CHUNK}}}"), F.lit(0))


def _matches(text: Column, pattern: str) -> Column:
    """All matches of ``pattern`` with their code point positions."""

    def placed(found: Column) -> Column:
        gaps = F.slice(F.transform(F.split(text, pattern, -1), F.length), F.lit(1), F.size(found))
        sizes = F.zip_with(gaps, found, lambda g, m: (g + F.length(m)).cast("bigint"))
        return F.zip_with(_running(sizes, _add), found, lambda e, m: F.struct((e - F.length(m)).alias("start"), e.alias("end"), m.alias("value")))

    none = F.array().cast(f"array<{MATCH}>")
    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda f: F.when(F.size(f) > 0, placed(f).cast(f"array<{MATCH}>")).otherwise(none))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = _digits(value)

    def add(total: Column, place: Column) -> Column:
        digit = F.substring(digits, F.length(digits) + 1 - place, F.lit(1)).cast("int")
        twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when(place % 2 == 0, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def base_matches(text: Column) -> dict[str, Column]:
    """Matches of each kind that pass its check, for a text that is not null."""
    none = F.array().cast(f"array<{MATCH}>")
    count = lambda m: F.length(_digits(m["value"]))
    return {
        "email": F.when(F.contains(text, F.lit("@")), _matches(text, EMAIL)).otherwise(none),
        "ip": F.when(F.rlike(text, F.lit(r"[0-9]\.[0-9]")), F.filter(_matches(text, IP), lambda m: F.rlike(m["value"], F.lit(_OCTETS)))).otherwise(none),
        "card": F.when(F.rlike(text, F.lit(r"[0-9](?:[\x20-]?[0-9]){13}")),
                       F.filter(_matches(text, CARD), lambda m: F.when(count(m).between(14, 19), _luhn(m["value"])).otherwise(False))).otherwise(none),
        "phone": F.when(F.rlike(text, F.lit(r"\+[0-9]")), F.filter(_matches(text, PHONE), lambda m: count(m).between(10, 15))).otherwise(none),
    }


def _entity(kind: str, value: Column) -> Column:
    same = F.lower(value) if kind == "email" else value if kind == "ip" else _digits(value)
    return F.concat(F.lit(kind + ":"), same)


def _written(spans: Column) -> Column:
    """kind:start:end by start, then kind, comma-joined."""
    name = F.array(*[F.lit(k) for k in (*KINDS, TERM)])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(name, s["kind"] + 1), s["start"], s["end"])), ",")


def _pieced(text: Column, edits: Column, put: Callable[[Column, Column], Column]) -> Column:
    """``text`` with each of the sorted ``edits`` (start, end, ...) replaced by ``put`` of the text in pieces and the edit; the
    edit's ``start`` is where the edits before it end, if that is later. An edit that lies in them gives nothing."""

    def whole(chunks: Column, es: Column) -> Column:
        ends = _running(F.transform(es, lambda e: e["end"]), F.greatest)
        return _let(ends, lambda upto: F.concat(
            F.array_join(F.zip_with(
                F.concat(F.array(F.lit(0).cast("bigint")), F.slice(upto, F.lit(1), F.size(es) - 1)), es,
                lambda free, e: F.when(e["end"] > free, F.concat(
                    _cut(chunks, free, F.greatest(e["start"] - free, F.lit(0))), put(chunks, e.withField("start", F.greatest(e["start"], free))))).otherwise("")), ""),
            _let(F.element_at(upto, -1), lambda last: F.array_join(F.concat(
                F.array(_cut(chunks, last, F.lit(_CHUNK) - last % _CHUNK)), F.slice(chunks, F.floor(last / _CHUNK).cast("int") + 2, F.size(chunks) + 1)), ""))))

    return _let(_chunks(text), lambda chunks: _let(edits, lambda es: whole(chunks, es)))


def _plain(text: Column, spans: Column) -> Column:
    """The text at its length, spans blanked; their letters are masked, so that a run that goes on into one is known."""

    def blank(chunks: Column, s: Column) -> Column:
        inside = _cut(chunks, s["start"], s["end"] - s["start"])
        return F.regexp_replace(F.regexp_replace(inside, r"\p{L}", _MASK), f"(?s)[^{_MASK}]", " ")

    return _pieced(text, spans, blank)


def found_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One stored row for each row of ``docs``: a row number, doc_id, the text's hash, the base spans, the
    mentions with what stands around them and, if there are any, the text without its spans."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", *[m.alias(k) for k, m in base_matches(F.col("text")).items()])
    of_kind = lambda i: lambda m: F.struct(m["start"].alias("start"), F.lit(i).alias("kind"), m["end"].alias("end"))
    spans = F.concat(*[F.transform(k, of_kind(i)) for i, k in enumerate(KINDS)])

    def around(kind: str, chunks: Column):
        def make(m: Column) -> Column:
            low = F.greatest(m["start"] - WINDOW, F.lit(0))
            left = _cut(chunks, low, m["start"] - low)
            beyond = _cut(chunks, m["end"], F.lit(WINDOW + 1))
            right = F.substring(beyond, 1, WINDOW)
            # a run of letters that the window cuts is no term
            cut = F.when(low > 0, F.length(F.regexp_extract(left, r"^\p{L}+", 0))).otherwise(0)
            left = F.substring(left, (cut + 1).cast("int"), F.lit(WINDOW))
            right = F.when(F.length(beyond) > WINDOW, F.regexp_replace(right, r"\p{L}++$", "")).otherwise(right)
            return F.struct(_entity(kind, m["value"]).alias("entity"), F.xxhash64(left, right).alias("context"))
        return make

    any_span = F.greatest(*[F.size(k) for k in KINDS]) > 0
    mentions = F.when(any_span, _let(_chunks(F.col("text")), lambda chunks: F.concat(*[F.transform(k, around(k, chunks)) for k in KINDS])))
    mentions = F.coalesce(mentions, F.array().cast("array<struct<entity:string,context:bigint>>"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), F.array_sort(spans).cast(f"array<{SPAN}>").alias("spans"), mentions.alias("mentions"), "text",
                       *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS])
    plain = F.when(F.size("spans") > 0, _plain(F.col("text"), F.col("spans")))
    return stored(rows.withColumn("plain", plain).drop("text").withColumn("row", F.monotonically_increasing_id()), "pii-spans")


def disclosing_spans(found: DataFrame, docs: DataFrame, text: str = "text", support: int = SUPPORT, generalise: float = GENERALISE,
                     remove: float = REMOVE) -> DataFrame:
    """(row, start, end, share) of all occurrences of the terms that disclose an entity of their row."""
    rows = found.count()
    n = F.lit(float(max(1, rows)))
    mention = found.select("row", F.explode("mentions").alias("m")).select("row", "m.entity", "m.context")
    # one row for each entity of a document, with as many of its contexts as can matter
    held = mention.groupBy("row", "entity").agg(F.slice(F.sort_array(F.collect_set("context")), 1, support).alias("contexts"))
    held = stored(held, "pii-mentions")
    contexts = lambda df, *by: df.select(*by, F.explode("contexts").alias("context")).distinct().groupBy(*by).count().filter(F.col("count") >= support).drop("count")
    # an entity with too few contexts has no pair with enough
    entities = held.groupBy("entity").agg(F.count(F.lit(1)).alias("df_entity")).filter(F.col("df_entity") < n)
    entities = stored(entities.join(contexts(held, "entity"), "entity"), "pii-entities")
    held = stored(held.join(entities.select("entity"), "entity"), "pii-held")
    words = found.join(held.select("row").distinct(), "row", "left_semi")
    words = words.select("row", F.explode(F.array_distinct(F.transform(F.regexp_extract_all("plain", F.lit(_FREE), F.lit(0)), F.lower))).alias("term"))
    met = held.join(words, "row")
    often = met.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("df_both"))
    pair = stored(often.join(contexts(met, "entity", "term"), ["entity", "term"]), "pii-pairs")
    wanted = stored(pair.select("term").distinct(), "pii-terms")
    every = docs.select(F.explode(F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(_LETTERS), F.lit(0)), F.lower))).alias("term"))
    terms = every.join(wanted, "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("df_term"))
    strong = (
        pair.join(entities, "entity").join(terms, "term")
        .withColumn("pmi", F.log2(F.col("df_both") * n / (F.col("df_entity") * F.col("df_term"))))
        .withColumn("share", F.col("pmi") / F.log2(n / F.col("df_entity")))
        .filter(F.col("share") >= generalise).select("entity", "term", "share")
    )
    hit = held.select("row", "entity").join(strong, "entity").groupBy("row", "term").agg(F.max("share").alias("share"))
    hit = stored(hit, "pii-hits")
    gaps = F.transform(F.split("plain", _FREE, -1), F.length)
    placed = found.join(hit.select("row").distinct(), "row", "left_semi").select(
        "row", F.posexplode(F.arrays_zip(gaps.alias("gap"), F.regexp_extract_all("plain", F.lit(_FREE), F.lit(0)).alias("m"))).alias("i", "t"))
    end = F.sum(F.col("t.gap") + F.length("t.m")).over(Window.partitionBy("row").orderBy("i"))
    placed = placed.filter("t.m is not null").select("row", F.lower("t.m").alias("term"), (end - F.length("t.m")).alias("start"), end.alias("end"))
    return placed.join(hit, ["row", "term"]).select("row", "start", "end", "share")


def all_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **thresholds) -> DataFrame:
    """One row for each row of ``docs``: doc_id, text_hash, the base spans, the terms' (start, end, share) and the base counts."""
    found = found_spans(docs, doc_id, text)
    terms = disclosing_spans(found, docs, text, **thresholds).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end", "share"))).alias("terms"))
    return found.drop("mentions", "plain").join(terms, "row", "left").withColumn("terms", F.coalesce("terms", F.array().cast("array<struct<start:bigint,end:bigint,share:double>>")))


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **thresholds) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, n_term, base_sha256, spans; one row for each row of ``docs``.

    A null text is empty; repeated rows each give a row; an empty table gives an empty table.
    """
    rows = all_spans(set_aside(docs, doc_id, text)[0], doc_id, text, **thresholds)
    terms = F.transform("terms", lambda t: F.struct(t["start"].alias("start"), F.lit(len(KINDS)).alias("kind"), t["end"].alias("end")))
    return rows.select(
        "doc_id", *[f"n_{k}" for k in KINDS], F.sha2(_written(F.col("spans")).cast("binary"), 256).alias("base_sha256"),
        _written(F.array_sort(F.concat("spans", terms.cast(f"array<{SPAN}>")))).alias("spans"), F.size("terms").cast("bigint").alias("n_term"),
    )


def sanitised(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", remove: float = REMOVE, **thresholds) -> DataFrame:
    """``docs`` with the same columns and rows; in the text each protected entity is its kind in brackets, each
    generalised term ``[TERM]``, and removed terms are gone. Texts without any stay as they are, null stays null."""
    plain, restored = set_aside(docs, doc_id, text)
    rows = all_spans(plain, doc_id, text, remove=remove, **thresholds)
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    edits = F.concat(
        F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.element_at(names, s["kind"] + 1).alias("put"))),
        F.transform("terms", lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), F.when(t["share"] >= remove, "").otherwise("[TERM]").alias("put"))),
    )
    edits = rows.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), F.array_sort(edits).alias("edits")).filter(F.size("edits") > 0)
    edits = edits.dropDuplicates(["id", "hash"])
    text_col = F.col(text)
    clean = F.when(F.col("edits").isNull(), text_col).otherwise(_pieced(text_col, F.col("edits"), lambda _, e: e["put"]))
    joined = plain.join(edits.toDF("found_id", "found_hash", "edits"), F.col(doc_id).eqNullSafe(F.col("found_id")) & (F.xxhash64(F.coalesce(text_col, F.lit(""))) == F.col("found_hash")), "left")
    return restored(joined.select(*[clean.alias(c) if c == text else F.col(c) for c in plain.columns]))
