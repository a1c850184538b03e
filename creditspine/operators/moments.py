"""Pairwise moments of many columns in one scan, and what follows from them.

Every task multiplies its rows as matrices, so a row costs a few dense products
instead of one aggregate per column pair. A task hands on one row per pair of
columns; those rows are plain sums and add up in any order.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows whose medians become the anchors. Any anchors give the same moments; near ones round less.
ANCHOR_ROWS = 1000
#: Share of a sum of squares that is taken for rounding.
ROUNDING = 1e-13
SUMS = ["n", "s_a", "s_b", "s_aa", "s_bb", "s_ab"]


def _numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as doubles, NaN as null."""
    values = {c: F.col(c).cast("double") for c in columns}
    return df.select(*[F.when(~F.isnan(v), v).alias(c) for c, v in values.items()])


def _task_sums(anchors: Sequence[float]):
    """Sums about the anchors over the rows that hold both columns of a pair."""
    centre = np.asarray(anchors, dtype=float)
    left, right = np.triu_indices(len(centre))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(SUMS), len(centre), len(centre)))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]) - centre
            there = (~np.isnan(x)).astype(float)
            x = np.where(there > 0, x, 0.0)
            squares = x * x
            total += [there.T @ there, x.T @ there, there.T @ x, squares.T @ there, there.T @ squares, x.T @ x]
        yield pa.RecordBatch.from_arrays(
            [pa.array(left, pa.int32()), pa.array(right, pa.int32()), *[pa.array(t[left, right]) for t in total]],
            names=["a", "b", *SUMS],
        )

    return sums


def pair_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Moments of every pair of columns over the rows that hold both.

    ``(a, b, n, mean_a, mean_b, ss_a, ss_b, ss_ab)`` for the places ``a <= b`` of
    the list, with sums of squares and products about the pair's own means. Null
    and NaN are missing; a pair without common rows has null means. The sums of
    squares of a column with infinite values are NaN.
    """
    columns = list(columns)
    rows = _numbers(df, columns)
    first = rows.limit(ANCHOR_ROWS).agg(*[F.percentile_approx(c, 0.5).alias(c) for c in columns]).first()
    anchors = [v if v is not None and np.isfinite(v) else 0.0 for v in first]
    fields = "a int, b int, " + ", ".join(f"{s} double" for s in SUMS)
    total = rows.mapInArrow(_task_sums(anchors), fields).groupBy("a", "b").agg(*[F.sum(s).alias(s) for s in SUMS])
    at = F.array(*[F.lit(v) for v in anchors])
    n = F.col("n")

    def about_mean(product: str, one: str, other: str) -> Column:
        return F.col(product) - F.try_divide(F.col(one) * F.col(other), n)

    def squares(product: str, one: str) -> Column:
        # what rounding leaves of a constant column is no variance
        ss = about_mean(product, one, one)
        return F.when(ss <= F.col(product) * ROUNDING, F.lit(0.0)).otherwise(ss)

    return total.select(
        "a", "b", n.cast("bigint").alias("n"),
        (F.get(at, "a") + F.try_divide("s_a", n)).alias("mean_a"),
        (F.get(at, "b") + F.try_divide("s_b", n)).alias("mean_b"),
        squares("s_aa", "s_a").alias("ss_a"),
        squares("s_bb", "s_b").alias("ss_b"),
        about_mean("s_ab", "s_a", "s_b").alias("ss_ab"),
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair over pairwise complete rows:
    ``(column_a, column_b, correlation)`` with a < b in list order. Null where a
    pair has fewer than two common rows or a column that is constant on them."""
    names = F.array(*[F.lit(c) for c in columns])
    spread = F.sqrt(F.when((F.col("ss_a") > 0) & (F.col("ss_b") > 0), F.col("ss_a") * F.col("ss_b")))
    return pair_moments(df, columns).where(F.col("a") < F.col("b")).select(
        F.get(names, "a").alias("column_a"), F.get(names, "b").alias("column_b"),
        F.when(F.col("n") > 1, F.try_divide(F.col("ss_ab"), spread)).alias("correlation"),
    )


def pca_variance(df: DataFrame, columns: Sequence[str], k: int = 9) -> DataFrame:
    """Variance shares of the first ``k`` principal components of the standardised
    columns, ``(component, explained, cumulative)``, over complete rows.

    The components are those of the correlation matrix. Of it one row per pair of
    columns reaches the driver, whatever the table; a constant column has no
    variance to share, and without any variance there are no rows.
    """
    columns = list(columns)
    cells = pair_moments(_numbers(df, columns).dropna(), columns).collect()
    products = np.zeros((len(columns), len(columns)))
    for c in cells:
        products[c["a"], c["b"]] = products[c["b"], c["a"]] = (c["ss_a"] if c["a"] == c["b"] else c["ss_ab"]) or 0.0
    scale = np.sqrt(np.maximum(np.diag(products), 0.0))
    scale[scale == 0.0] = np.inf
    values = np.maximum(np.linalg.eigvalsh(products / np.outer(scale, scale))[::-1], 0.0)
    share = values[:k] / values.sum() if values.sum() > 0 else np.zeros(0)
    rows = [(i + 1, float(s), float(t)) for i, (s, t) in enumerate(zip(share, share.cumsum()))]
    return df.sparkSession.createDataFrame(rows, "component int, explained double, cumulative double")
