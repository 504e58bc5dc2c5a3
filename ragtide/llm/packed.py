"""Arrays of small integers, or of strings, as compressed bytes (numpy, zstd)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def pack(values: np.ndarray) -> bytes:
    """Byte planes of unsigned 64-bit integers: the high ones are mostly zero."""
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def unpack(packed: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, 8 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view("<u8").ravel()


def pack_texts(texts: list[str]) -> tuple[bytes, bytes]:
    """Byte lengths and bytes of strings."""
    data = [t.encode() for t in texts]
    lengths = np.fromiter(map(len, data), np.int64, len(data))
    return pack(lengths), pa.compress(b"".join(data), codec="zstd", asbytes=True)


def unpack_texts(lengths: bytes, texts: bytes, n: int) -> pa.Array:
    ends = np.cumsum(unpack(lengths, n)).astype(np.int64)
    offsets = np.concatenate(([0], ends)).astype(np.int64)
    data = pa.decompress(texts, int(offsets[-1]), codec="zstd")
    return pa.LargeStringArray.from_buffers(n, pa.py_buffer(offsets), data).cast(pa.string())
