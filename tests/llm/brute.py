"""Plain Python forms of the operators' definitions, for small tables."""

import collections
import hashlib
import re

WORD = r"[^\x20\x09-\x0D]+"
AWKWARD = [
    (1, None), (2, ""), (3, " \t\n\r\x0b\x0c "), (4, "one"), (5, "Two words"), (6, "a b c a b c a b c"), (7, "line\nline\n\nline\n"),
    (8, "Émile É 漢字 🙂 d'été"), (9, "x" * 300), (10, "ab " * 2000), (11, "same text here and there"), (12, "same text here and there"),
    (13, "no break and   other spaces"), (14, "1.2.3.4 a@b.co; +1 (555) 123-4567; 4111 1111 1111 1111"), (None, "an id that is null"),
    (16, "\x00 nul \x00"), (16, "\x00 nul \x00"), (17, "long " + "word " * 30000), (18, "#*$%&|<>" * 20), (19, "UPPER CASE! " * 40),
]


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def words(t):
    return re.findall(WORD, t or "")


def quality(t):
    w = words(t)
    grams = list(zip(w, w[1:], w[2:]))
    seen = collections.Counter(grams)
    hit = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(3)}
    lines = [x for x in (t or "").split("\n") if words(x)]
    symbols = len(re.findall(r"[#*$%&|<>]", t or ""))
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(hit)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c)
        total += (v * 2 - 9 if v > 4 else v * 2) if i % 2 else v
    return total % 10 == 0


def pii(t):
    t, out = t or "", []
    out += [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub("[ -]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return ",".join(f"{('email', 'ip', 'card', 'phone')[k]}:{s}:{e}" for s, k, e in sorted(out))


def repeats(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[s:s + length] for b in raw for s in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s:s + length]] > 1:
                gone[s:s + length] = b"\1" * length
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return out


def fingerprint(t, shingle=3):
    import xxhash

    w = words(lower(t))
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i:i + shingle]).encode(), 42) for i in range(max(1, len(w) - shingle + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps, distance):
    """Index of each item's component root."""
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= distance:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def targets(sizes):
    """Source -> target for Counter sizes (weights 1, 2, 3 in turn, at most 3 times the source)."""
    order = sorted(s for s in sizes if s is not None) + ([None] if None in sizes else [])
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    out, open_, left = {}, set(order), float(sum(sizes.values()))
    while open_:
        total = sum(weight[s] for s in open_)
        full = [s for s in open_ if left * weight[s] / total > 3 * sizes[s]]
        if not full:
            break
        for s in full:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
            open_.discard(s)
    total = sum(weight[s] for s in open_) or 1
    return out | {s: left * weight[s] / total for s in open_}
