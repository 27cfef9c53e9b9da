"""Columns of 64-bit numbers as one compressed binary, for shuffles of many small rows."""

from __future__ import annotations

import numpy as np
import zstandard


def pack(columns: list[np.ndarray] | np.ndarray) -> bytes:
    """Byte planes of 64-bit columns, compressed; planes of small numbers are nearly free."""
    planes = [np.ascontiguousarray(c.view(np.uint8).reshape(-1, 8).T) for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(np.concatenate(planes).tobytes())


def unpack(blob: bytes, n: int) -> np.ndarray:
    """The 64-bit columns, one per row of the result."""
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(planes.reshape(-1, 8, n).transpose(0, 2, 1)).view(np.int64)[:, :, 0]


def buckets_of(keys: np.ndarray, n: int) -> np.ndarray:
    return ((keys.view(np.uint64) >> np.uint64(20)) % np.uint64(n)).astype(np.int64)
