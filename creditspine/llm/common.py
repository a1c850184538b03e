"""Small helpers shared by the operators."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditspine.sources.session import cut_lineage

#: Characters that end a word or pad a line: ``[\x20\x09-\x0D]``.
BLANK = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def store(df: DataFrame) -> DataFrame:
    """Write a table that feeds several jobs to the shared folder, go on from there."""
    return cut_lineage(df)


def shards(rows: int, per_shard: int) -> int:
    return max(1, math.ceil(rows / per_shard))


def usable_vectors(df: DataFrame, id_col: str, vec_col: str) -> Column:
    """True for an id with a vector that is non-empty, finite in each part and not zero."""
    v = F.col(vec_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return (
        F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0)
        & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0)
    )
