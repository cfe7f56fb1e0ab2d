"""Exchange between packed blocks of documents and shards of a hash range.

A row is (block, kind, shard, data). A block sends the sorted distinct 64-bit keys of each shard, delta-coded
and compressed; what comes back for a shard stands in the order of the keys sent, so it needs no keys.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard

ROW = "block bigint, kind int, shard int, data binary"
_U = np.uint64


def pack(x: np.ndarray) -> bytes:
    """Numbers as byte planes, compressed."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes() if len(x) else b""
    return zstandard.ZstdCompressor(level=1).compress(planes)


def unpack(data: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(kind).reshape(-1)


def pack_keys(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=_U(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, _U), dtype=_U)


def row(block: int, kind: int, shard: int, data: bytes) -> tuple:
    return block, kind, shard, data


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * 4
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["block", "kind", "shard", "data"])


def cuts(keys: np.ndarray, bits: int) -> np.ndarray:
    """Bounds of the shards (top ``bits`` of the key) in sorted keys."""
    return np.searchsorted(keys >> _U(64 - bits), np.arange((1 << bits) + 1, dtype=_U))


def gather(rows: pa.Table, kind: int, dtype) -> np.ndarray:
    """What came back for a block, in the order of its keys."""
    mine = [(s, d) for k, s, d in zip(rows["kind"].to_pylist(), rows["shard"].to_pylist(), rows["data"]) if k == kind]
    parts = [unpack(d.as_py(), dtype) for _, d in sorted(mine, key=lambda x: x[0])]
    return np.concatenate(parts) if parts else np.zeros(0, dtype)
