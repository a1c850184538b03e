"""Projections, filters, column selectors and deterministic sampling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditspine.functions import cleaning as C
from creditspine.operators.ranks import cut_classes, row_hash


def enforce_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the named columns in one projection; bad values become null."""
    source = dict(df.dtypes)

    def cast(name: str) -> Column:
        if name not in types or source[name] == types[name]:
            return F.col(name)
        dtype = types[name]
        if source[name] == "string" and dtype in ("int", "bigint"):
            return C.cast_number(name, dtype).alias(name)
        return F.col(name).try_cast(dtype).alias(name)

    return df.select(*[cast(c) for c in df.columns])


def at_snapshot(df: DataFrame, date, column: str = "snapshot_date") -> DataFrame:
    """Rows of one snapshot; prunes partitions when the table is partitioned by it."""
    return df.where(F.col(column) == F.lit(date).cast("date"))


def between_dates(df: DataFrame, start, end, column: str = "snapshot_date") -> DataFrame:
    """Rows with ``start <= column <= end``; either end may be None."""
    if start is not None:
        df = df.where(F.col(column) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(column) <= F.lit(end).cast("date"))
    return df


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def feature_columns(df: DataFrame, exclude: Sequence[str], categorical: Sequence[str]) -> tuple[list[str], list[str]]:
    """(numeric, categorical) feature columns by exclusion list."""
    skip = set(exclude) | set(categorical)
    return [c for c in df.columns if c not in skip], [c for c in categorical if c in df.columns]


def replace_sentinels(df: DataFrame, tokens: Sequence[str] = ("_", "NA")) -> DataFrame:
    """Null out sentinel tokens in every string column."""
    return df.select(*[
        C.null_tokens(f.name, tokens).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema.fields
    ])


def any_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def rows_with_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.where(any_null(columns or df.columns))


def rows_not_matching(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Distinct values of a column that break a pattern."""
    return df.where(~F.col(column).rlike(pattern)).select(column).distinct()


def hash_order(keys: Sequence[str], seed: int) -> Column:
    """Seeded 64-bit hash of the row key: a repeatable random order."""
    return F.xxhash64(F.lit(seed), *[F.col(k) for k in keys])


def sample_fraction(df: DataFrame, keys: Sequence[str], fraction: float, seed: int) -> DataFrame:
    """Bernoulli sample by key hash: independent of partitioning and of reruns."""
    parts = 1 << 20
    return df.where(F.pmod(hash_order(keys, seed), F.lit(parts)) < F.lit(int(round(fraction * parts))))


def sample_rows(df: DataFrame, keys: Sequence[str], n: int, seed: int) -> DataFrame:
    """Up to ``n`` rows, the same ones on every run; keys may repeat.

    The cut is found on hash counts, so the rows themselves are only filtered:
    no sort and no single task that gathers the candidates of all partitions.
    Rows that repeat the key at the cut are told apart by all their columns;
    equal rows are taken as often as the cut leaves room.
    """
    if n <= 0:
        return df.limit(0)
    return cut_classes(df, [hash_order(keys, seed), row_hash(df, seed)], {None: [n]}).where("_class = 0").drop("_class")


def sample_rows_by(df: DataFrame, keys: Sequence[str], by: Sequence[str], n: int, seed: int) -> DataFrame:
    """Up to ``n`` rows of each group, the same ones on every run; rows that repeat a key go by all their columns.

    All groups are sampled in one job: tasks keep their ``n`` smallest hashes of
    a group before anything is shuffled.
    """
    if not by:
        return sample_rows(df, keys, n, seed)
    order = Window.partitionBy(*by).orderBy("_order", "_again")
    hashed = df.withColumns({"_order": hash_order(keys, seed), "_again": row_hash(df, seed)})
    ranked = hashed.withColumn("_rank", F.row_number().over(order))
    return ranked.where(F.col("_rank") <= n).drop("_order", "_again", "_rank")
