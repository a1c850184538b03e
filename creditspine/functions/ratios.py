"""Ratio, log and change expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(num: Column | str, den: Column | str, den_offset: float = 0.0, num_offset: float = 0.0) -> Column:
    """``(num + num_offset) / (den + den_offset)``, null on a zero denominator."""
    n = _col(num).cast("double")
    d = _col(den).cast("double")
    return F.try_divide(n + F.lit(float(num_offset)), d + F.lit(float(den_offset)))


def log1p(c: Column | str) -> Column:
    return F.log1p(_col(c))


def change_flag(c: Column | str, null_as_zero: bool = False) -> Column:
    """1 when the value differs from zero. Null stays null unless asked."""
    c = _col(c)
    return F.when(c != 0, 1).otherwise(0) if null_as_zero else (c != 0).cast("int")


def decrease_flag(c: Column | str) -> Column:
    return F.when(_col(c) < 0, 1).otherwise(0)


def presence_flag(present: Column) -> Column:
    """Boolean condition as 0/1, null stays null."""
    return present.cast("int")
