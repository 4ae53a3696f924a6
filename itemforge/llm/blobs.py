"""Arrays as compressed binary values, so that a shuffle carries one row for thousands of numbers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def pack(values: np.ndarray) -> bytes:
    """Numbers as planes of their bytes, compressed: the planes that hardly vary cost next to nothing."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T if len(values) else np.zeros(0, np.uint8)
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes, kind: type, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    if not n:
        return np.zeros(0, kind)
    raw = np.frombuffer(pa.decompress(data, decompressed_size=n * size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, n).T).view(kind).reshape(n)


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending uint64 as differences."""
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64, n), dtype=np.uint64)


def part_bounds(ordered: np.ndarray, log_parts: int) -> np.ndarray:
    """Where each of 2**log_parts ranges of uint64 begins in an ascending array, and its end."""
    edges = (np.arange(1, 1 << log_parts, dtype=np.uint64)) << np.uint64(64 - log_parts) if log_parts else np.zeros(0, np.uint64)
    return np.concatenate(([0], np.searchsorted(ordered, edges), [len(ordered)]))


def log_parts(total: int, each: int, least: int = 4) -> int:
    """For `total` numbers in ranges of about `each`: the power of two of ranges."""
    return max(least, int(np.ceil(np.log2(max(1, total / each)))))
