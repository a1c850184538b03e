"""Imputation, quantile capping and the null gate.

``fit_*`` functions run one job and return a small dict (one entry per column);
``fill``/``cap`` apply it as literals, so later months reuse the fitted values
and the application is a narrow projection.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditspine.functions import cleaning as C
from creditspine.operators.profile import null_counts
from creditspine.operators.ranks import approx_quantiles, exact_quantiles


def fit_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], exact: bool = True) -> dict[str, dict[float, float]]:
    """``{column: {prob: value}}``; all-null columns are left out."""
    q = exact_quantiles(df, columns, probs) if exact else approx_quantiles(df, columns, probs)
    out: dict[str, dict[float, float]] = {}
    for r in q.collect():  # len(columns) * len(probs) rows
        out.setdefault(r["feature"], {})[r["prob"]] = r["quantile"]
    return out


def fit_medians(df: DataFrame, columns: Sequence[str], exact: bool = True) -> dict[str, float]:
    return {c: q[0.5] for c, q in fit_quantiles(df, columns, [0.5], exact).items()}


def fit_means(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    row = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
    return {c: row[c] for c in columns if row[c] is not None}


def fill(df: DataFrame, values: Mapping[str, object], as_double: bool = True) -> DataFrame:
    """Replace nulls by one constant per column. Numeric columns become double
    unless ``as_double`` is off, so that a fractional median is not truncated."""
    types = dict(df.dtypes)

    def filled(name: str):
        value = values[name]
        c = F.col(name)
        if isinstance(value, float) and as_double and types[name] != "double":
            c = c.cast("double")
        return F.coalesce(c, F.lit(value))

    return df.withColumns({c: filled(c) for c in values if c in types})


def fit_caps(df: DataFrame, columns: Sequence[str], low: float | None, high: float, exact: bool = True) -> dict[str, tuple]:
    """Quantile bounds per column, ``(low value or None, high value)``."""
    probs = [high] if low is None else [low, high]
    q = fit_quantiles(df, columns, probs, exact)
    return {c: (None if low is None else v[low], v[high]) for c, v in q.items()}


def cap(df: DataFrame, caps: Mapping[str, tuple]) -> DataFrame:
    """Clip each column to its bounds; nulls stay null."""
    return df.withColumns({
        c: C.cap_constant(F.col(c).cast("double"), high, low) for c, (low, high) in caps.items()
    })


def trimmed_median(df: DataFrame, column: str, upper: float = 0.99) -> DataFrame:
    """Median of the values strictly below their own upper quantile (one row)."""
    limit = exact_quantiles(df, [column], [upper]).select("quantile").scalar()
    kept = df.where(F.col(column).cast("double") < limit)
    return exact_quantiles(kept, [column], [0.5]).select("feature", F.col("quantile").alias("median"))


class NullValuesError(AssertionError):
    """Raised by the null gate; carries the offending column counts."""

    def __init__(self, rows: int, null_rows: int, columns: Mapping[str, int]):
        self.rows, self.null_rows, self.columns = rows, null_rows, dict(columns)
        detail = ", ".join(f"{c}: {n}" for c, n in self.columns.items())
        super().__init__(f"table contains nulls: rows={rows}, rows with nulls={null_rows}, columns: {detail}")


def assert_no_nulls(df: DataFrame) -> None:
    """Fail with per-column counts when any value is null. One aggregate job."""
    row = null_counts(df).first()
    bad = {c: row[c] for c in df.columns if row[c]}
    if bad:
        raise NullValuesError(row["_rows"], row["_null_rows"], bad)


def cap_within(df: DataFrame, columns: Sequence[str], high: float, by: Sequence[str], low: float | None = None) -> DataFrame:
    """Clip to quantiles fitted inside each group (for example each month).

    The limits are one row per group, joined on the group key.
    """
    by = list(by)
    probs = [high] if low is None else [low, high]
    q = exact_quantiles(df, columns, probs, by)

    def limit(c: str, p: float, name: str):
        hit = (F.col("feature") == c) & (F.col("prob") == float(p))
        return F.max(F.when(hit, F.col("quantile"))).alias(f"_{name}_{c}")

    limits = q.groupBy(*by).agg(
        *[limit(c, high, "hi") for c in columns], *([limit(c, low, "lo") for c in columns] if low is not None else [])
    )

    def clipped(c: str):
        x = F.col(c).cast("double")
        out = F.when(x > F.col(f"_hi_{c}"), F.col(f"_hi_{c}"))
        if low is not None:
            out = out.when(x < F.col(f"_lo_{c}"), F.col(f"_lo_{c}"))
        return out.otherwise(x)

    extra = [c for c in limits.columns if c not in by]
    return df.join(limits, by, "left").withColumns({c: clipped(c) for c in columns}).drop(*extra)
