"""Numeric expressions: binning, rounding, scaling, sigmoid, id hashing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cut(c, bins: Sequence[float], labels: Sequence | None = None) -> Column:
    """Right-closed bins ``(b_i, b_{i+1}]``; label ``i+1`` or ``labels[i]``; outside → null."""
    c = _c(c)
    labels = list(labels) if labels is not None else list(range(1, len(bins)))
    expr = None
    for i in range(len(bins) - 1):
        cond = (c > F.lit(float(bins[i]))) & (c <= F.lit(float(bins[i + 1])))
        expr = F.when(cond, F.lit(labels[i])) if expr is None else expr.when(cond, F.lit(labels[i]))
    return expr


def ceil_cap(c, width: float, cap: float) -> Column:
    """``min(ceil(x / width), cap)`` as double."""
    return F.least(F.ceil(_c(c) / F.lit(float(width))).cast("double"), F.lit(float(cap)))


def round_or_raw(c, digits: int) -> Column:
    """Score rounded half to even to ``digits`` as text; ``-1`` disables rounding."""
    c = _c(c).cast("double")
    return (c if digits == -1 else F.bround(c, digits)).cast("string")


def minmax(c, lo: Column, hi: Column) -> Column:
    """``(x − lo) / (hi − lo)``; a zero range is replaced by 1 (constant column → 0)."""
    rng = F.when(hi > lo, hi - lo).otherwise(F.lit(1.0))
    return (_c(c) - lo) / rng


def sigmoid(c) -> Column:
    """``1 / (1 + e^−x)``."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(c)))


def id_le_bytes(c) -> Column:
    """The 8-byte little-endian encoding of a 64-bit integer id, as binary."""
    hx = F.lpad(F.hex(_c(c).cast("long")), 16, "0")
    rev = F.concat(*[F.substring(hx, 15 - 2 * i, 2) for i in range(8)])
    return F.unhex(rev)


def in_test_crc(c, ratio: float) -> Column:
    """``crc32(id as int64 little-endian) < ratio · 2³²`` – stable test membership."""
    return F.crc32(id_le_bytes(c)) < F.lit(float(ratio) * 2 ** 32)


def in_test_md5(c, ratio: float) -> Column:
    """Last byte of ``md5(id as int64 little-endian)`` ``< 256 · ratio``."""
    last = F.conv(F.substring(F.md5(id_le_bytes(c)), 31, 2), 16, 10).cast("int")
    return last < F.lit(256 * float(ratio))


def composite_id(a, b, factor: int = 1000) -> Column:
    """``a·factor + b`` truncated to a 64-bit integer."""
    return (_c(a) * F.lit(factor) + _c(b)).cast("long")
