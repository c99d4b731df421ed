"""Compressed columns of numbers and words, for lists that travel as one cell of a row."""

from __future__ import annotations

import numpy as np
import zstandard


def pack(values: np.ndarray, level: int = 3) -> bytes:
    """Byte planes of fixed-width numbers, compressed."""
    raw = np.ascontiguousarray(values)
    return zstandard.compress(raw.view(np.uint8).reshape(-1, raw.itemsize).T.tobytes(), level)


def unpack(packed: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def pack_rising(values: np.ndarray, level: int = 3) -> bytes:
    """Sorted unsigned numbers as differences."""
    return pack(np.diff(values, prepend=values.dtype.type(0)), level)


def unpack_rising(packed: bytes, dtype) -> np.ndarray:
    return np.cumsum(unpack(packed, dtype), dtype=dtype)


def pack_words(words: list[bytes]) -> bytes:
    """Word lengths, and the bytes, compressed."""
    sizes = pack(np.array([len(w) for w in words], np.uint32))
    return len(sizes).to_bytes(4, "little") + sizes + zstandard.compress(b"".join(words), 3)


def unpack_words(packed: bytes) -> list[bytes]:
    n = int.from_bytes(packed[:4], "little")
    ends = np.cumsum(unpack(packed[4:4 + n], np.uint32)).tolist()
    raw = zstandard.decompress(packed[4 + n:])
    return [raw[a:b] for a, b in zip([0, *ends], ends)]


def spread(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches flat[start:start + size], one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - ends + sizes, sizes) + np.arange(total)]
