"""Exact integer vectors of any finite size: floors, compact bytes, products, sortable scores.

Values lie in 16, 32 or 64 bit arrays while they fit and in arrays of Python integers
beyond that. Products run in double precision while every sum stays below 2**53, where
they are exact, and in Python integers otherwise, so that no finite component is refused.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXACT = 1 << 53
LONG = (-(1 << 63), (1 << 63) - 1)


def finite(vectors: DataFrame, column: str = "embedding") -> Column:
    """True where a vector is known and all its components are finite numbers."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    x = F.transform(column, lambda v: v.cast("double"))
    return F.col(column).isNotNull() & ~F.coalesce(F.exists(x, bad), F.lit(False))


def _floor(x: float, scale: int) -> int:
    return int(x) * scale if abs(x) >= EXACT else math.floor(x * scale)


def floors(lists: pa.Array, width: int, scale: int) -> np.ndarray:
    """floor(scale * x) of the components of lists of one width, one row each."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(flat) and np.abs(flat).max() * scale >= EXACT:
        return np.array([_floor(float(x), scale) for x in flat], object).reshape(len(lists), width)
    return np.floor(flat * scale).astype(np.int64).reshape(len(lists), width)


def largest(*arrays: np.ndarray) -> int:
    """The greatest absolute value; 0 of nothing."""
    return max([0, *(int(max(a.max(), -a.min())) for a in arrays if a.size)])


def dump(values: np.ndarray) -> bytes:
    """Integers as bytes: the narrowest signed width that holds all, or decimal text."""
    most = largest(values)
    for kind, bits in (("<i2", 15), ("<i4", 31), ("<i8", 63)):
        if most < 1 << bits:
            return kind[1:].encode() + np.ascontiguousarray(values, kind).tobytes()
    return b"tx" + ",".join(map(str, values.reshape(-1))).encode()


def load(data: bytes, width: int) -> np.ndarray:
    """What ``dump`` wrote, as rows of ``width``."""
    kind, body = bytes(data[:2]), bytes(data[2:])
    if kind == b"tx":
        flat = np.array([int(x) for x in body.split(b",")], object)
    else:
        flat = np.frombuffer(body, "<" + kind.decode()).astype(np.int64)
    return flat.reshape(-1, width) if width else np.zeros((0, 0), np.int64)


def approximate(values: np.ndarray) -> np.ndarray:
    """Doubles near the integers; those beyond the range of doubles become its border."""
    if values.dtype != object:
        return values.astype(np.float64)
    border = 1 << 1000
    flat = [float(max(-border, min(border, x))) if abs(x) != np.inf else x for x in values.reshape(-1)]
    return np.array(flat, np.float64).reshape(values.shape)


def working(*arrays: np.ndarray, factor: int = 1) -> list[np.ndarray]:
    """The arrays in one kind in which sums of ``factor`` products over a row are exact."""
    width = max(1, arrays[0].shape[-1])
    exact = factor * width * max(1, largest(*arrays)) ** 2 < EXACT
    return [a.astype(np.float64 if exact else object) for a in arrays]


def clamp(value) -> int:
    """The value, or the nearest 64-bit one where it lies beyond."""
    return max(LONG[0], min(LONG[1], int(value)))


def sortable(value: int) -> bytes:
    """Bytes that sort like the integers: count of bytes first, complemented below 0."""
    value = int(value)
    body = abs(value).to_bytes((abs(value).bit_length() + 7) // 8, "big")
    if value < 0:
        return (0x8000 - len(body)).to_bytes(2, "big") + bytes(255 - x for x in body)
    return (0x8000 + len(body)).to_bytes(2, "big") + body


def unsorted(data: bytes) -> int:
    """The integer of ``sortable`` bytes."""
    head, body = int.from_bytes(data[:2], "big"), data[2:]
    return -int.from_bytes(bytes(255 - x for x in body), "big") if head < 0x8000 else int.from_bytes(body, "big")


def limbs(value: int) -> list[int]:
    """Summands of a sum that may pass 64 bits: one if small, else 32 bits each; the last has the sign."""
    value = int(value)
    if abs(value) < 1 << 40:
        return [value]
    out = []
    while not -(1 << 31) <= value < 1 << 31:
        out.append(value & 0xFFFFFFFF)
        value >>= 32
    return [*out, value]
