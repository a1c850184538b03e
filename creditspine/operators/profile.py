"""Profiling: null shares, counts, contingency, coverage, top-k.

Each report is one aggregate over the table, whatever the number of columns;
the wide one-row result is turned into rows afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditspine import schemas as S
from creditspine.operators.stats import chi_square_pvalue
from creditspine.sources.session import cut_lineage


def is_missing(df: DataFrame, column: str) -> Column:
    """Null, or NaN for floating-point columns."""
    c = F.col(column)
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def null_counts(df: DataFrame) -> DataFrame:
    """One row: null count per column, ``_rows`` and ``_null_rows``."""
    any_null = F.lit(False)
    for c in df.columns:
        any_null = any_null | F.col(c).isNull()
    return df.agg(
        *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns],
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(any_null).alias("_null_rows"),
    )


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, null_share)`` for every column, from one aggregate."""
    columns = list(columns or df.columns)
    wide = df.agg(*[F.avg(is_missing(df, c).cast("double")).alias(c) for c in columns])
    return wide.unpivot([], columns, "column", "null_share")


def worst_null_columns(df: DataFrame, n: int = 15, columns: Sequence[str] | None = None) -> DataFrame:
    return null_profile(df, columns).orderBy(F.col("null_share").desc(), "column").limit(n)


def missing_percent(df: DataFrame, column: str) -> DataFrame:
    return df.agg((F.avg(F.col(column).isNull().cast("double")) * 100).alias("missing_pct"))


def missing_by_group(df: DataFrame, groups: dict[str, Sequence[str]], by: Sequence[str] = ()) -> DataFrame:
    """Share of rows with at least one null in each column group."""
    aggs = []
    for name, columns in groups.items():
        miss = F.lit(False)
        for c in columns:
            miss = miss | F.col(c).isNull()
        aggs.append(F.avg(miss.cast("double")).alias(f"pct_missing_{name}"))
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def group_count(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def contingency(df: DataFrame, column: str, label: str = "label", values: Sequence = (0, 1)) -> DataFrame:
    """Counts of each label value per category, 0 where absent."""
    return df.groupBy(column).agg(*[
        F.count_if(F.col(label) == F.lit(v)).alias(f"label_{v}") for v in values
    ])


def top_contingency(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    table = contingency(df, column)
    return table.orderBy(F.col("label_0").desc(), column).limit(n)


def chi_square_independence(df: DataFrame, columns: Sequence[str], label: str = "label", yates: bool = True) -> DataFrame:
    """Chi-square test of each category column against a label, one job.

    ``(feature, statistic, dof, p_value)``. Null is a category of its own. With
    one degree of freedom the continuity correction is applied (``yates``).
    """
    long = df.select(
        F.col(label).cast("string").alias("label"), *[F.col(c).cast("string").alias(c) for c in columns]
    ).unpivot(["label"], list(columns), "feature", "category")
    # category counts: small, and read by the margins and by the comparison
    cells = cut_lineage(long.groupBy("feature", "category", "label").agg(F.count(F.lit(1)).alias("n")))
    rows = cells.groupBy("feature", "category").agg(F.sum("n").alias("row_n"))
    cols = cells.groupBy("feature", "label").agg(F.sum("n").alias("col_n"))
    size = rows.groupBy("feature").agg(F.sum("row_n").alias("total"), F.count(F.lit(1)).alias("r"))
    width = cols.groupBy("feature").agg(F.count(F.lit(1)).alias("k"))
    dof = (F.col("r") - 1) * (F.col("k") - 1)
    # one row per (category, label), absent cells included: a category row is
    # repeated once per label value, of which there are few by definition
    grid = rows.join(size, "feature").join(width, "feature").join(cols, "feature")
    observed = grid.alias("g").join(
        cells.alias("c"),
        (F.col("g.feature") == F.col("c.feature"))
        & F.col("g.category").eqNullSafe(F.col("c.category"))
        & F.col("g.label").eqNullSafe(F.col("c.label")),
        "left",
    ).select("g.*", F.coalesce(F.col("c.n"), F.lit(0)).cast("double").alias("observed"))
    expected = F.col("row_n") * F.col("col_n") / F.col("total")
    gap = F.abs(F.col("observed") - expected)
    if yates:
        gap = F.when(dof == 1, gap - F.least(gap, F.lit(0.5))).otherwise(gap)
    return (
        observed.groupBy("feature")
        .agg(F.sum(gap * gap / expected).alias("statistic"), F.max(dof).alias("dof"))
        .withColumn("p_value", chi_square_pvalue("statistic", "dof"))
    )


def date_ranges(tables: dict[str, DataFrame], date: str = S.SNAPSHOT) -> DataFrame:
    """First and last date per table."""
    out = None
    for name, t in tables.items():
        row = t.agg(F.min(date).alias("min_date"), F.max(date).alias("max_date")).select(
            F.lit(name).alias("table_name"), "min_date", "max_date"
        )
        out = row if out is None else out.unionByName(row)
    return out


def snapshots_per_customer(df: DataFrame, key: str = S.CUSTOMER, date: str = S.SNAPSHOT) -> DataFrame:
    """Mean, maximum and count above one of the distinct dates per customer."""
    # (key, date) pairs are formed first, so a customer with very many rows is
    # reduced to its distinct dates before the per-customer step
    per_date = df.groupBy(key, date).agg(F.count(F.lit(1)).alias("n"))
    per_key = per_date.groupBy(key).agg(F.count(date).alias("n_dates"))
    return per_key.agg(
        F.count(F.lit(1)).alias("customers"),
        F.avg("n_dates").alias("avg_snapshots"),
        F.max("n_dates").alias("max_snapshots"),
        F.count_if(F.col("n_dates") > 1).alias("multi_customers"),
    )


def snapshot_nature(df: DataFrame, name: str, key: str = S.CUSTOMER, date: str = S.SNAPSHOT) -> DataFrame:
    """Five-rule score telling a snapshot table from an overwrite table."""
    pairs = df.groupBy(key, date).agg(F.count(F.lit(1)).alias("n"))
    per_key = pairs.groupBy(key).agg(
        F.count(date).alias("n_dates"), F.count_if(F.col("n") > 1).alias("dups")
    )
    summary = per_key.agg(
        F.avg("n_dates").alias("avg_snapshots"),
        F.max("n_dates").alias("max_snapshots"),
        F.count_if(F.col("n_dates") > 1).alias("multi_customers"),
        F.sum("dups").alias("duplicate_pairs"),
    )
    dates = pairs.select(date).distinct().agg(F.count(F.lit(1)).alias("n")).scalar()
    rules = [
        F.col("avg_snapshots") > 1.5,
        F.col("max_snapshots") > 1,
        F.col("multi_customers") > 0,
        F.col("distinct_dates") > 3,
        F.col("duplicate_pairs") == 0,
    ]
    score = sum((r.cast("int") for r in rules[1:]), rules[0].cast("int"))
    return (
        summary.withColumn("distinct_dates", dates)
        .withColumn("score", score)
        .select(
            F.lit(name).alias("table_name"), "*",
            F.when(F.col("score") >= 2, "Snapshot").otherwise("Overwrite").alias("classification"),
        )
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str] = tuple(S.KEYS)) -> DataFrame:
    """Key combinations that occur more than once, with their counts."""
    return group_count(df, *keys).where(F.col("count") > 1)


def repeated_rows(df: DataFrame, column: str, row_key: str) -> DataFrame:
    """Rows repeating an earlier value of ``column``, where earlier means a
    smaller ``row_key``. Uses a per-value minimum, not a window over each value,
    because a placeholder value may be held by a large share of the rows."""
    first = df.groupBy(column).agg(F.min(row_key).alias("_first"), F.count(F.lit(1)).alias("_n"))
    first = first.where(F.col("_n") > 1).drop("_n")
    return df.join(first, column).where(F.col(row_key) != F.col("_first")).drop("_first")


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, max per column from one aggregate."""
    stats = F.array(*[
        F.struct(
            F.lit(c).alias("column"), F.col(f"n_{c}").alias("count"), F.col(f"m_{c}").alias("mean"),
            F.col(f"s_{c}").alias("std"), F.col(f"lo_{c}").alias("min"), F.col(f"hi_{c}").alias("max"),
        )
        for c in columns
    ])
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).alias(f"n_{c}"), F.avg(x).alias(f"m_{c}"), F.stddev(x).alias(f"s_{c}"),
            F.min(x).alias(f"lo_{c}"), F.max(x).alias(f"hi_{c}"),
        ]
    return df.agg(*aggs).select(F.inline(stats))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def default_rate_by_category(df: DataFrame, column: str, label: str = "label") -> DataFrame:
    """Counts and default rate per category, highest rate first."""
    return (
        df.groupBy(column)
        .agg(
            F.count_if(F.col(label) == 0).alias("non_default"),
            F.count_if(F.col(label) == 1).alias("default"),
            F.count(F.lit(1)).alias("total"),
            F.avg(F.col(label).cast("double")).alias("default_rate"),
        )
        .orderBy(F.col("default_rate").desc(), column)
    )


def top_categories(df: DataFrame, column: str, n: int) -> DataFrame:
    return group_count(df, column).orderBy(F.col("count").desc(), column).limit(n)


def largest_values(df: DataFrame, column: str, n: int, *ties: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).orderBy(F.col(column).desc(), *ties).limit(n)


def table_report(df: DataFrame, name: str) -> DataFrame:
    """One-row investigation: rows, columns, customers, snapshot nature."""
    size = df.agg(F.count(F.lit(1)).alias("rows")).scalar()
    customers = df.select(S.CUSTOMER).distinct().agg(F.count(F.lit(1)).alias("n")).scalar()
    return snapshot_nature(df, name).withColumns({
        "rows": size, "columns": F.lit(len(df.columns)), "customers": customers
    })


def rank_within(df: DataFrame, keys: Sequence[str], value: str, n: int, *ties: str) -> DataFrame:
    """Top ``n`` rows per key group by a value, largest first."""
    w = Window.partitionBy(*keys).orderBy(F.col(value).desc(), *ties)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
