"""Arithmetic whose NULL and rounding rules the results depend on."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F

_UNIT = 2 ** 53


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def row_sum(columns) -> Column:
    """Left-to-right sum; NULL as soon as one term is NULL."""
    return reduce(add, [_col(c) for c in columns])


def safe_divide(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient, or NULL for a zero or NULL denominator."""
    return F.try_divide(_col(numerator), _col(denominator))


def clamp_at_zero(value: Column | str) -> Column:
    """0 for negative values. NULL stays NULL, which ``greatest(x, 0)`` would not do."""
    value = _col(value)
    return F.when(value < 0, F.lit(0)).when(value >= 0, value)


def round_int(value: Column | str) -> Column:
    """Nearest integer, halves away from zero (a bare cast would truncate)."""
    return F.round(_col(value)).cast("bigint")


def hash_uniform(*keys: Column | str, seed: int = 0) -> Column:
    """A number in [0, 1) per key. The same row gives the same number after a
    retry or under another partitioning, unlike ``rand``."""
    hashed = F.xxhash64(F.lit(seed), *[_col(k) for k in keys])
    return F.pmod(hashed, F.lit(_UNIT)) / F.lit(float(_UNIT))
