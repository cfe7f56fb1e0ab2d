"""Secrets against the plain patterns, a plain battery in Python, and SQL."""

import collections
import hashlib
import math
import random
import re

import duckdb
import pytest

from tierforge.llm import secret_scan as S
from tierforge.llm.oracles import OP11_SECRET_SCAN

BASE = (
    ("assign", r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
     lambda m: len(m[2]) >= 8),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16), ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 32),
)


def base(t):
    out = [(m.start(), k, f"{name}:{m.start()}:{m.end()}") for k, (name, pattern, ok) in enumerate(BASE) for m in re.finditer(pattern, t or "") if ok(m)]
    return ",".join(x for *_, x in sorted(out))


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def above(z):
    return math.erfc(z / math.sqrt(2)) / 2


def plain_battery(token, texts):
    """Encoding and the four p-values, one symbol at a time."""
    s = token.rstrip("=")
    encoding = next(e for e, symbols in S.ENCODINGS.items() if set(s) <= set(symbols))
    symbols = S.ENCODINGS[encoding]
    n, k, seen = len(s), len(symbols), collections.Counter(s)
    chi = sum((seen[c] - n / k) ** 2 for c in symbols) * k / n
    p_even = above(((chi / (k - 1)) ** (1 / 3) - (1 - 2 / (9 * (k - 1)))) / math.sqrt(2 / (9 * (k - 1))))
    v = [symbols.index(c) + 1 for c in s]
    side = [x > k // 2 for x in v]
    ones = sum(side)
    mean = 2 * ones * (n - ones) / n + 1
    var = (mean - 1) * (mean - 2) / (n - 1)
    p_runs = 2 * above(abs(1 + sum(a != b for a, b in zip(side, side[1:])) - mean) / math.sqrt(var)) if var > 0 else 0
    size = n * sum(x * x for x in v) - sum(v) ** 2
    corr = (n * sum(a * b for a, b in zip(v, v[1:] + v[:1])) - sum(v) ** 2) / size if size else 0
    p_serial = 2 * above(abs(corr + 1 / (n - 1)) / math.sqrt(n * n / ((n - 1) ** 2 * (n - 2)))) if size else 0
    one_case = symbols in (symbols.lower(), symbols.upper())
    mine = symbols.lower() if one_case else symbols
    all_symbols = collections.Counter(c for t in texts for c in ((t or "").lower() if one_case else t or "") if c in mine)
    total = sum(all_symbols.values())
    two, three = (sum((m / total) ** i for m in all_symbols.values()) for i in (2, 3))
    equal = sum(m * (m - 1) / 2 for m in seen.values())
    pairs = n * (n - 1) / 2
    var = pairs * (two - two**2) + n * (n - 1) * (n - 2) * (three - two**2)
    return encoding, p_even, p_runs, p_serial, 1 - above((equal - pairs * two) / math.sqrt(var)) if var > 0 else 1


def test_base_spans_match_plain_patterns(awkward, docs):
    for table in (awkward, docs):
        want = sorted((str(r["doc_id"]), sha(base(r["text"]))) for r in table.collect())
        assert sorted((str(r["doc_id"]), r["base_sha256"]) for r in S.report(table).collect()) == want


def odd(spark):
    random.seed(7)
    parts = ["token", "secret", "PassWord", "api_key", "apikey", "passwd", "=", ":", " ", '"', "'", "abcdef12", "x", "AKIA", "ABCDEFGH", "0123456789abcdef", "é", "🙂", "\n", ".", "K", "ſ"]
    texts = ["".join(random.choices(parts, k=random.randrange(25))) for _ in range(500)]
    texts += ["token=" * 3000, "token: " * 3000, "AKIA" * 5000, "f" * 50000, "token" + " " * 50000, "0123456789abcdef0123456789abcdef " * 5000]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)


def test_odd_strings(shipped):
    table = odd(shipped)
    got = {r["doc_id"]: r["base_sha256"] for r in S.report(table).collect()}
    assert [r["doc_id"] for r in table.collect() if got[r["doc_id"]] != sha(base(r["text"]))] == []


def mixture(spark):
    """Random strings of several encodings among ordinary words, paths and patterned strings."""
    rng = random.Random(3)
    words = [("".join(rng.choices("eeetaoinshrdlu", k=rng.randrange(2, 9)))) for _ in range(400)]
    secrets = ["".join(rng.choices(S.ENCODINGS[e], k=n)) for e in ("hex", "base62", "base64", "base32", "HEX") for n in (32, 40, 64, 120) for _ in range(6)]
    plain = ["/".join(rng.choices(words, k=8)) for _ in range(60)] + ["a" * 40, "0123456789" * 5, "abcdefghijklmnopqrstuvwxyz" * 2, "ab" * 30]
    rows = [(i, " ".join(rng.choices(words, k=60)) + " " + x + " " + " ".join(rng.choices(words, k=20))) for i, x in enumerate(secrets + plain)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3), secrets, plain


def test_random_strings_are_found_and_words_are_not(shipped):
    table, secrets, plain = mixture(shipped)
    found = {r["value"] for r in S.findings(table).filter("kind = 'random'").collect()}
    assert len(found & set(secrets)) >= 0.9 * len(secrets)
    assert len(found - set(secrets)) <= 0.05 * len(found)
    assert not found & set(plain[60:])


def test_battery_against_plain_form(shipped):
    table, secrets, plain = mixture(shipped)
    tokens = secrets + plain + ["A" * 20 + "==", "0123456789abcdef" * 2]
    texts = [r["text"] for r in table.collect()]
    moments = S.symbol_moments(table, "text")
    got = {r["value"]: r for r in S.battery(shipped.createDataFrame([(t,) for t in tokens], "value string"), moments).collect()}
    for t in tokens:
        encoding, *p = plain_battery(t, texts)
        r = got[t]
        assert r["encoding"] == encoding
        assert [r["p_even"], r["p_runs"], r["p_serial"], r["p_text"]] == pytest.approx(p, rel=1e-5, abs=1e-12)


def test_false_discovery_control(shipped):
    """The step-up rule on a class's p-values rounded up to hundredths of a decade, and copies count once."""
    table, _, _ = mixture(shipped)
    texts = [r["text"] for r in table.collect()]
    tokens = sorted({m[0] for t in texts for m in re.finditer(S.CANDIDATE, t)})
    classes = collections.defaultdict(list)
    for t in tokens:
        _, *battery, p = plain_battery(t, texts)
        p = p if min(battery) >= S.ALPHA / 3 else 1.0
        classes[len(t.rstrip("=")).bit_length()].append((10 ** (-math.floor(-100 * math.log10(max(p, 1e-300))) / 100), t))
    want = set()
    for many in classes.values():
        many.sort()
        cut = max((p for i, (p, _) in enumerate(many, 1) if p <= S.FDR * sum(q <= p for q, _ in many) / len(many)), default=-1)
        want |= {t for p, t in many if p <= cut}
    twice = table.union(table)
    assert {r["value"] for r in S.findings(twice).filter("kind = 'random'").collect()} == want


def test_against_sql(shipped, awkward, docs):
    for table in (docs, awkward, mixture(shipped)[0], odd(shipped).filter("length(text) < 1000")):
        documents = table.select("doc_id", "text").toPandas()  # noqa: F841 (DuckDB reads it)
        want = duckdb.connect().execute(OP11_SECRET_SCAN).fetchall()
        got = S.report(table).select("doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans").collect()
        assert sorted(str((int(w[0]) if w[0] == w[0] and w[0] is not None else None, *w[1:])) for w in want) == sorted(str(tuple(r)) for r in got)


def test_native_plan(docs):
    plan = S.report(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_empty_table(awkward):
    assert S.report(awkward.filter("false")).collect() == [] and S.findings(awkward.filter("false")).collect() == []


def test_clashing_columns(docs):
    names = ("row", "kind", "value", "start", "end", "p", "n", "k", "c", "piece", "assign", "random", "count")
    wide = docs.selectExpr("*", *[f"'x' as {c}" for c in names])
    assert sorted(map(str, S.report(wide).collect())) == sorted(map(str, S.report(docs).collect()))
