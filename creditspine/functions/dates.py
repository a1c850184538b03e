"""Month arithmetic on first-of-month snapshot dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def shift_months(c: Column | str, months: int | Column) -> Column:
    """Date moved by whole months; the result is a DATE, clamped at month ends."""
    return F.add_months(_col(c).cast("date"), months)


def month_floor(c: Column | str) -> Column:
    return F.trunc(_col(c).cast("date"), "MM")
