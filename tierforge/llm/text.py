"""Vectorised views of text columns inside Arrow batches.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]`` (in UTF-8 these
bytes never occur inside a longer character, so byte and code point words are
the same). Strings are compared by 62-bit hashes of byte spans, computed from
running sums, so any span costs the same however long it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

STEP_BYTES = 1 << 20  # bytes of text that one vectorised step holds (a longer document is a step of its own)

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PRIME = _U((1 << 31) - 1)
_RANDOM = np.random.default_rng(20240229)
# two hashes modulo the prime: the values of the bytes, and the base
_FIELDS = [(_RANDOM.integers(1, int(_PRIME), 256, dtype=np.uint64), int(_RANDOM.integers(1 << 20, int(_PRIME)))) for _ in range(2)]
_POWERS: dict[int, np.ndarray] = {}


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the n + 1 offsets of its rows (a null row is empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def steps(offs: np.ndarray, limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each (one row at least)."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (SplitMix64's finaliser)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _folded(x: np.ndarray) -> np.ndarray:
    """Remainders by the prime of numbers below 2^62."""
    for _ in range(2):
        high = x >> _U(31)
        x = x & _PRIME
        x += high
    return np.minimum(x, x - _PRIME)  # below the prime the difference wraps


def _powers(base: int, n: int) -> np.ndarray:
    """At least the first ``n`` powers of ``base``."""
    have = _POWERS.get(base, np.ones(1, np.uint32))
    while len(have) < n:
        have = np.concatenate((have, _folded(have * _U(pow(base, len(have), int(_PRIME)))).astype(np.uint32)))
    _POWERS[base] = have
    return have


class Spans:
    """Hashes of byte spans of one buffer: two polynomials modulo a prime, 62 bits, whose bases know no bad texts."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self._sums, self._down = [], []
        for values, base in _FIELDS:
            terms = values[data] * _powers(base, n + 1)[:n]
            high = terms >> _U(31)
            terms &= _PRIME
            terms += high
            total = np.zeros(n + 1, _U)
            np.cumsum(terms, out=total[1:])
            self._sums.append(_folded(total).astype(np.uint32))
            self._down.append(_powers(pow(base, -1, int(_PRIME)), n + 1))

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = mix((ends - starts).astype(_U))
        for sums, down, up in zip(self._sums, self._down, (_U(32), _U(0))):
            x = _folded(sums[ends] + _PRIME - sums[starts])
            x *= down[starts]
            out ^= _folded(x) << up
        return mix(out)

    def windows(self, width: int) -> np.ndarray:
        """The hashes of all spans of ``width`` bytes, from the first on; the same as ``of`` gives."""
        n = len(self._sums[0]) - width
        out = mix(np.full(1, width, _U))
        for sums, down, up in zip(self._sums, self._down, (_U(32), _U(0))):
            x = _folded(sums[width:] + _PRIME - sums[:n])
            x *= down[:n]
            out = (_folded(x) << up) ^ out
        return mix(out)


class Words:
    """Words of a run of documents: byte starts and ends, and ``first[d]``, the index of document d's first word."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        inside = ~_SPACE[data]
        n = len(data)
        edge = np.zeros(n + 1, bool)
        edge[offs] = True
        begins, ends = inside.copy(), inside.copy()
        if n:
            begins[1:] &= ~inside[:-1] | edge[1:n]
            ends[:-1] &= ~inside[1:] | edge[1:n]
        self.inside = inside
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.starts, offs)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        """The document index of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, where one of each stands, and each key's place among them."""
    by = np.argsort(keys)
    ordered = keys[by]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    place = np.empty(len(keys), np.int64)
    place[by] = np.cumsum(new) - 1
    return ordered[new], by[new], place


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, all other bytes as they are."""
    return _LOWER[data]


def per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` in each of the ranges that ``bounds`` separate."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[bounds])


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, dtype=_U).view(np.int64)


def unsigned(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, dtype=np.int64).view(_U)
