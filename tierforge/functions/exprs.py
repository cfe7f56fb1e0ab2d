"""Column expressions shared by the models. All are built-in Spark
functions (JVM side, code-generated); nothing here runs Python per row."""

from __future__ import annotations

from functools import reduce

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ------------------------------------------------------------
# Token the surrogate-key macro substitutes for NULL inputs.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
# Word delimiters of the warehouse INITCAP: whitespace plus these characters.
INITCAP_DELIMITERS = "!?@\"^#$&~_,.:;+-*%/|\\[](){}<>"
# Brazilian state code -> region (retail customers).
STATE_REGION = {
    "SP": "Southeast", "RJ": "Southeast", "MG": "Southeast", "ES": "Southeast",
    "PR": "South", "SC": "South", "RS": "South",
    "MT": "Centre-West", "MS": "Centre-West", "GO": "Centre-West", "DF": "Centre-West",
    "BA": "Northeast", "CE": "Northeast", "MA": "Northeast", "PB": "Northeast", "PE": "Northeast",
    "PI": "Northeast", "RN": "Northeast", "SE": "Northeast", "AL": "Northeast",
    "AM": "North", "PA": "North", "RO": "North", "RR": "North", "AC": "North", "AP": "North", "TO": "North",
}
# TPC-H order status code -> label.
ORDER_STATUS_LABEL = {"O": "Open", "F": "Fulfilled", "P": "Partially Filled"}


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_number(c: str | Column, precision: int = 38, scale: int = 0) -> Column:
    """TRY_TO_NUMBER: text -> decimal, NULL on bad text. Scale 0 rounds half up
    ('12.7' -> 13); overflow of the precision gives NULL."""
    return F.try_cast(col_(c), f"decimal({precision},{scale})") if hasattr(F, "try_cast") else col_(c).try_cast(f"decimal({precision},{scale})")


def try_timestamp_ntz(c: str | Column) -> Column:
    """TRY_TO_TIMESTAMP_NTZ: text -> zone-less timestamp, NULL on bad text."""
    return col_(c).try_cast("timestamp_ntz")


def day_diff(start: str | Column, end: str | Column) -> Column:
    """DATEDIFF('day', start, end): number of midnight boundaries crossed,
    i.e. the difference of the calendar dates (not of elapsed 24h spans)."""
    return F.datediff(F.to_date(col_(end)), F.to_date(col_(start)))


def initcap_words(c: str | Column) -> Column:
    """INITCAP with the warehouse's delimiters: lower-case everything, then
    upper-case the first character and every character after a delimiter
    (whitespace or punctuation). Spark's own initcap splits on spaces only."""
    words = F.split(F.lower(col_(c)), "(?<=[" + re.escape(INITCAP_DELIMITERS) + r"\s])", -1)
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, F.lit(2), F.length(w)))), "")


def map_lookup(c: str | Column, mapping: dict[str, str], default: str) -> Column:
    """Simple CASE over literal values (a literal map lookup)."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.element_at(m, col_(c)), F.lit(default))


def flag(cond: Column) -> Column:
    """CASE WHEN cond THEN TRUE ELSE FALSE: NULL comparisons give FALSE."""
    return F.coalesce(cond, F.lit(False))


def timestamp_text(c: str | Column) -> Column:
    """Timestamp rendered as the warehouse renders it in string casts."""
    return F.date_format(col_(c), "yyyy-MM-dd HH:mm:ss.SSS")


def surrogate_key(*cols: str | Column) -> Column:
    """md5 over '-'-joined text of the inputs, NULL replaced by a token."""
    parts = []
    for c in cols:
        cc = col_(c)
        parts.append(F.coalesce(cc.cast("string"), F.lit(SURROGATE_NULL)))
    return F.md5(F.concat_ws("-", *parts))


def surrogate_key_ts(key: str | Column, ts: str | Column) -> Column:
    """Surrogate key of (key, timestamp) with millisecond timestamp text."""
    return F.md5(
        F.concat_ws(
            "-",
            F.coalesce(col_(key).cast("string"), F.lit(SURROGATE_NULL)),
            F.coalesce(timestamp_text(ts), F.lit(SURROGATE_NULL)),
        )
    )


def dow_sunday0(c: str | Column) -> Column:
    """DATE_PART('dayofweek'): 0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(col_(c)) - 1


def pct_half_up(numer: str | Column, denom: str | Column, scale_to_int: int = 1) -> Column:
    """ROUND(numer / denom * 100, 2) computed exactly, as a double.

    ``numer`` and ``denom`` are non-negative and become integers after
    multiplying by ``scale_to_int`` (1 for counts, 100 for money with two
    decimals). Half-up rounding is done in integer arithmetic so that the
    result does not depend on binary floating point; denom 0 gives NULL.
    """
    n = (col_(numer) * scale_to_int).cast("decimal(38,0)")
    d = (col_(denom) * scale_to_int).cast("decimal(38,0)")
    q = F.floor((n * 20000 + d) / (d * 2))
    return F.when(d == 0, F.lit(None).cast("double")).otherwise(q.cast("double") / F.lit(100.0).cast("double"))


def avg_exact(c: str | Column) -> Column:
    """AVG as a double: exact (decimal / integer) sum divided by the count."""
    cc = col_(c)
    return F.sum(cc).cast("double") / F.nullif(F.count(cc), F.lit(0)).cast("double")


def all_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)
