"""Byte-level BPE encoding and decoding.

Texts are cut into pieces by a pattern; each piece is encoded on its own, exactly as merging byte pairs by
rank would. Bytes become Latin-1 characters, so an Aho-Corasick automaton over strings finds every vocabulary
entry in a piece. It is then encoded from its longest matches: a token is accepted if it
is compatible with the token before it (merging the two tokens' bytes gives just these two, memoised);
otherwise the next shorter prefix is tried, and when none is left the token before is shortened. A position
found to lead nowhere is not entered again, so the work is linear in the piece. A sequence whose neighbours are all
compatible is the one that the merges give. Encoded pieces are kept in a bounded table per worker.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from struct import pack

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import steps, utf8

KEPT_PIECES = 400_000  # encoded pieces a worker keeps
KEPT_PAIRS = 1_000_000  # judged token pairs a worker keeps
KEPT_CHARS = 64  # longer pieces are not kept


def load_ranks(path: str) -> list[bytes]:
    """Token bytes by rank from a file of ``base64 rank`` lines."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens: list[bytes] = [b""] * (1 + max(int(r) for _, r in pairs))
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


class _Pieces(dict):
    """Encoded pieces, filled when first asked for."""

    def __init__(self, codec: Codec):
        self.codec = codec

    def __missing__(self, piece: str) -> bytes:
        ids = self.codec.piece(piece)
        if len(piece) <= KEPT_CHARS:
            if len(self) >= KEPT_PIECES:
                self.clear()
            self[piece] = ids
        return ids


class Codec:
    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens = tokens
        self.pattern = regex.compile(pattern)
        self.rank = {t: i for i, t in enumerate(tokens) if t}
        self._pieces = _Pieces(self)
        self._pairs: dict[int, bool] = {}
        self._shorter: dict[int, int] = {}
        # A few entries may be out of the merges' reach; they count only as whole pieces.
        self._reached = {i for t, i in self.rank.items() if len(t) < 2 or self.merged(t) == [i]}
        self._find = ahocorasick.Automaton()
        for i in self._reached:
            self._find.add_word(tokens[i].decode("latin-1"), (len(tokens[i]) - 1, i))
        self._find.make_automaton()

    def merged(self, piece: bytes) -> list[int]:
        """Ids by merging, always the pair of lowest rank (the leftmost of equals)."""
        rank, parts = self.rank, [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = rank.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [rank[p] for p in parts]

    def _fits(self, left: int, right: int) -> bool:
        key = left << 32 | right
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= KEPT_PAIRS:
                self._pairs.clear()
            known = self._pairs[key] = self.merged(self.tokens[left] + self.tokens[right]) == [left, right]
        return known

    def _prefix(self, token: int) -> int:
        """The longest token that is a proper prefix; -1: none."""
        found = self._shorter.get(token)
        if found is None:
            whole, found = self.tokens[token], -1
            for n in range(len(whole) - 1, 0, -1):
                r = self.rank.get(whole[:n], -1)
                if r in self._reached:
                    found = r
                    break
            self._shorter[token] = found
        return found

    def _walk(self, longest: list[int], size: int) -> list[int]:
        """Ids of a piece; longest[p]: the longest token that starts at byte p."""
        out: list[int] = []
        dead: set[int] = set()
        tokens, pos, token = self.tokens, 0, longest[0]
        while True:
            while token >= 0:
                end = pos + len(tokens[token])
                if end not in dead and (not out or self._fits(out[-1], token)):
                    break
                token = self._prefix(token)
            if token < 0:
                dead.add(pos)
                token = out.pop()
                pos -= len(tokens[token])
                continue
            out.append(token)
            if end == size:
                return out
            pos, token = end, longest[end]

    def piece(self, piece: str) -> bytes:
        """Little-endian 32-bit ids of one piece."""
        raw = piece.encode()
        whole = self.rank.get(raw)
        if whole is not None:
            return whole.to_bytes(4, "little")
        longest = [-1] * len(raw)
        for end, (back, token) in self._find.iter(raw.decode("latin-1")):  # by end, so a longer match of a start comes later
            longest[end - back] = token
        ids = self._walk(longest, len(raw))
        return pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids of a text."""
        return b"".join(map(self._pieces.__getitem__, self.pattern.findall(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_CODECS: dict[bytes, Codec] = {}


def _codec(tokens: list[bytes], pattern: str) -> Codec:
    key = hashlib.sha256(pattern.encode() + b"\0".join(base64.b64encode(t) for t in tokens)).digest()
    if key not in _CODECS:
        _CODECS[key] = Codec(tokens, pattern)
    return _CODECS[key]


def encoded(docs: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, token_ids (binary, little-endian 32-bit) and the decoded bytes' equality with the text.

    Null and empty texts have no ids; every row gives one row. The vocabulary (bounded by its file) is read on the
    driver and broadcast.
    """
    return _mapped(docs, ranks_path, pattern, doc_id, text, "token_ids binary, round_trip boolean",
                   lambda codec, texts, ids: [pa.array(ids, pa.binary()), pa.array([codec.decode(x) == t.encode() for x, t in zip(ids, texts)], pa.bool_())])


def digests(docs: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text."""
    sha = lambda xs: pa.array([hashlib.sha256(x).hexdigest() for x in xs], pa.string())
    return _mapped(docs, ranks_path, pattern, doc_id, text, "n_tokens bigint, ids_sha256 string, decoded_sha256 string",
                   lambda codec, _, ids: [pa.array([len(x) // 4 for x in ids], pa.int64()), sha(ids), sha(map(codec.decode, ids))])


def decoded(encodings: DataFrame, ranks_path: str, doc_id: str = "doc_id", ids: str = "token_ids") -> DataFrame:
    """doc_id and text of token ids; null ids give a null text, and bytes that are no UTF-8 are replaced."""
    shared = encodings.sparkSession.sparkContext.broadcast(load_ranks(ranks_path))

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = shared.value
        for batch in batches:
            texts = [None if not x.is_valid else b"".join(map(tokens.__getitem__, np.frombuffer(x.as_py(), "<u4").tolist())).decode("utf-8", "replace") for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    slim = encodings.select(F.col(doc_id).alias("doc_id"), F.col(ids).alias("ids"))
    return slim.mapInArrow(turn, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, text string")


def _mapped(docs, ranks_path, pattern, doc_id, text, schema, columns) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(load_ranks(ranks_path))
    names = ["doc_id", *(c.split()[0] for c in schema.split(", "))]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value, pattern)
        for batch in batches:
            for lo, hi in steps(utf8(batch.column(1))[1], 4 << 20):
                texts = [x or "" for x in batch.column(1).slice(lo, hi - lo).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *columns(codec, texts, [codec.encode(t) for t in texts])], names)

    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return slim.mapInArrow(work, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, {schema}")
