"""Arrays of numbers as compressed bytes, for rows that hold many numbers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def packed(values: np.ndarray) -> bytes:
    """Numbers as compressed planes of their bytes: leading zeros take no room."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(blob: bytes, kind: type) -> np.ndarray:
    n, size = size_of(blob), np.dtype(kind).itemsize
    held = pa.decompress(blob[8:], decompressed_size=n * size, codec="zstd", asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(held, dtype=np.uint8).reshape(size, n).T).reshape(-1).view(kind)


def size_of(blob: bytes) -> int:
    """How many numbers a blob holds."""
    return int.from_bytes(blob[:8], "little")


def packed_sorted(values: np.ndarray) -> bytes:
    return packed(np.diff(values, prepend=np.uint64(0)))


def unpacked_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpacked(blob, np.uint64), dtype=np.uint64)
