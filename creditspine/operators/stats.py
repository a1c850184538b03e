"""P-values as column expressions.

The inputs hold one row per tested feature, so their cost does not grow with
the data.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _upper_gamma_share(x: float, dof: int) -> float:
    """Chi-square survival function for an integer number of degrees."""
    if dof <= 0 or math.isnan(x):
        return float("nan") if math.isnan(x) else 1.0
    if math.isinf(x):
        return 0.0
    half = x / 2.0
    if dof % 2:
        total, term, k = math.erfc(math.sqrt(half)), 0.0, 0.5
    else:
        total, k = 0.0, 0.0
    while k < dof / 2.0 - 1e-9:
        term = math.exp(-half + k * math.log(half) - math.lgamma(k + 1.0)) if half > 0 else (1.0 if k == 0 else 0.0)
        total += term
        k += 1.0
    return min(1.0, total)


@F.pandas_udf(DoubleType())
def _chi_square_sf(x: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([
        None if pd.isna(a) or pd.isna(b) else _upper_gamma_share(float(a), int(b)) for a, b in zip(x, dof)
    ], dtype="float64")


def chi_square_pvalue(statistic: Column | str, dof: Column | str) -> Column:
    s = F.col(statistic) if isinstance(statistic, str) else statistic
    d = F.col(dof) if isinstance(dof, str) else dof
    return _chi_square_sf(s.cast("double"), d.cast("int"))


def ks_pvalue(distance: Column, n_a: Column, n_b: Column) -> Column:
    """Asymptotic two-sample Kolmogorov-Smirnov p-value."""
    scale = n_a.cast("double") * n_b / (n_a + n_b)
    lam2 = distance * distance * scale
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(k * k * lam2 * F.lit(-2.0)),
    )
    # the alternating series needs many terms near zero, where the value is 1
    return F.when(lam2 < 0.04, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))
