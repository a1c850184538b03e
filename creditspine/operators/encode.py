"""Categorical encoders. Vocabularies are fitted once and passed in, so every
month gets the same columns and unseen values become all zeros.

Two forms: one column per value, for vocabularies of at most ``MAX_VOCABULARY``
values that the driver lists; and sparse, for any number of values, where the
vocabulary is a stored dictionary of (value, index) that the rows are joined to.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditspine.functions import cleaning as C
from creditspine.operators.joins import salted_join
from creditspine.operators.ranks import BROADCAST_ROWS, running_totals
from creditspine.sources.session import cut_and_count

#: Values that become columns of their own; more are encoded sparsely.
MAX_VOCABULARY = 1000


def _bounded(values: DataFrame, limit: int, what: str) -> list[str]:
    """Sorted values of a one-column frame; raises when there are too many to
    become columns (nothing is ever cut off silently)."""
    rows = values.orderBy(values.columns[0]).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what} has more than {limit} distinct values: use fit_dictionary")
    return [r[0] for r in rows]


def fit_vocabulary(df: DataFrame, column: str, limit: int = MAX_VOCABULARY) -> list[str]:
    """Distinct non-null values of a category, sorted."""
    return _bounded(df.where(F.col(column).isNotNull()).select(column).distinct(), limit, column)


def fit_list_vocabulary(df: DataFrame, column: str, limit: int = MAX_VOCABULARY) -> list[str]:
    """Distinct items (original spelling) of a list-text column."""
    parts = F.split(F.regexp_replace(column, r"\band\b", ","), ",")
    items = F.explode(F.transform(parts, lambda x: F.trim(x)))
    values = df.select(items.alias(column)).where(F.col(column) != "").distinct()
    return _bounded(values, limit, column)


def fit_list_keys(df: DataFrame, column: str, limit: int = MAX_VOCABULARY) -> list[str]:
    """Distinct snake-case keys of a list-text column."""
    return _bounded(df.select(F.explode(C.list_keys(column)).alias("key")).distinct(), limit, column)


def safe_name(prefix: str, value: str, lower: bool = False) -> str:
    name = value.replace(" ", "_").replace("-", "_")
    return prefix + (name.lower() if lower else name)


def one_hot(df: DataFrame, column: str, vocabulary: Sequence[str], prefix: str = "is_") -> DataFrame:
    """One 0/1 column per known value; null and unseen values give zeros."""
    c = F.col(column)
    return df.withColumns({
        safe_name(prefix, v): F.when(c == v, 1).otherwise(0) for v in vocabulary
    })


def list_flags(df: DataFrame, column: str, vocabulary: Sequence[str], prefix: str = "has_") -> DataFrame:
    """One 0/1 column per loan type named in the list text."""
    c = F.col(column)
    return df.withColumns({
        safe_name(prefix, v, lower=True): F.when(c.contains(v), 1).otherwise(0) for v in vocabulary
    })


def list_counts(df: DataFrame, column: str, keys: Sequence[str], prefix: str = "") -> DataFrame:
    """One count column per list key, 0 where absent."""
    return df.withColumns({f"{prefix}{k}": C.list_count_of(column, k) for k in keys})


def fit_one_hot_ml(df: DataFrame, columns: Sequence[str], drop_last: bool = False) -> PipelineModel:
    """String index + one-hot vectors; an extra index is kept for unseen values."""
    stages = [
        StringIndexer(inputCols=list(columns), outputCols=[f"{c}_idx" for c in columns], handleInvalid="keep"),
        OneHotEncoder(
            inputCols=[f"{c}_idx" for c in columns], outputCols=[f"{c}_vec" for c in columns], dropLast=drop_last
        ),
    ]
    return Pipeline(stages=stages).fit(df)


def apply_one_hot_ml(df: DataFrame, model: PipelineModel, explode: bool = False) -> DataFrame:
    """Vectors per category, or one int column per known label when exploded."""
    indexer = model.stages[0]
    columns = list(indexer.getInputCols())
    out = model.transform(df)
    if explode:
        flags: dict[str, Column] = {}
        for column, labels in zip(columns, indexer.labelsArray):
            values = vector_to_array(F.col(f"{column}_vec"))
            for i, label in enumerate(labels):
                flags[f"{column}_{label.lower()}"] = F.coalesce(F.get(values, F.lit(i)), F.lit(0.0)).cast("int")
        out = out.withColumns(flags).drop(*[f"{c}_vec" for c in columns])
    return out.drop(*columns, *[f"{c}_idx" for c in columns])


def fit_common_values(df: DataFrame, column: str, min_share: float = 0.05) -> list[str]:
    """Values holding at least ``min_share`` of all rows (nulls count in the
    total). At most ``1 / min_share`` values qualify, so the result is bounded."""
    if not 0 < min_share <= 1:
        raise ValueError("min_share must be in (0, 1]")
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    keep = counts.where(F.col(column).isNotNull() & (F.col("n") >= total * F.lit(min_share)))
    return sorted(r[0] for r in keep.select(column).collect())


def group_rare(column: Column | str, common: Sequence[str], other: str = "Other", missing: str = "Unknown") -> Column:
    """Null to ``missing``, values outside ``common`` to ``other``."""
    c = F.col(column) if isinstance(column, str) else column
    return F.when(c.isNull(), F.lit(missing)).when(c.isin(list(common)), c).otherwise(F.lit(other))


@dataclass(frozen=True)
class Dictionary:
    """Stored (value, index) rows, one per distinct value in text order, and their number."""

    table: DataFrame
    size: int


def fit_dictionary(df: DataFrame, column: Column | str) -> Dictionary:
    """Dictionary of the distinct non-null values of a category, of any number.

    The values are numbered by ranges on the cluster; none passes the driver. A
    list text gives its items with ``F.explode(cleaning.list_keys(column))``.
    """
    c = F.col(column) if isinstance(column, str) else column
    values = df.select(c.alias("value")).select(F.col("value").cast("string")).dropna().distinct()
    numbered = running_totals(values.withColumns({"_all": F.lit(0), "n": F.lit(1)}), ["_all"], "value", ["n"])
    return Dictionary(*cut_and_count(numbered.select("value", F.col("n_before").alias("index"))))


def _looked_up(rows: DataFrame, dictionary: Dictionary, on: str, how: str) -> DataFrame:
    """``rows`` with the ``index`` of the value in column ``on``; hot values are salted where the dictionary is large."""
    table = dictionary.table.withColumnRenamed("value", on)
    if dictionary.size <= BROADCAST_ROWS:
        return rows.join(F.broadcast(table), on, how)
    return salted_join(rows, table, [on], how)


def index_category(df: DataFrame, column: str, dictionary: Dictionary) -> DataFrame:
    """Add ``<column>_index``: the value's number in the dictionary, null for null and unseen values."""
    rows = df.withColumn("_value", F.col(column).cast("string"))
    found = _looked_up(rows, dictionary, "_value", "left")
    return found.select(*[F.col(f"`{c}`") for c in df.columns], F.col("index").alias(f"{column}_index"))


def sparse_one_hot(df: DataFrame, column: str, dictionary: Dictionary) -> DataFrame:
    """Add ``<column>_vec``: a sparse vector with a one at the value's index, all zeros for null and unseen values."""
    if not dictionary.size:
        raise ValueError(f"{column} has no value to encode")
    index = f"{column}_index"
    # the encoder learns the length from the column's attribute, without a scan; the number past the last is its "unseen"
    attribute = {"ml_attr": {"type": "nominal", "num_vals": dictionary.size}}
    known = F.coalesce(F.col(index), F.lit(dictionary.size)).cast("double")
    rows = index_category(df, column, dictionary).withColumn(index, known.alias(index, metadata=attribute))
    encoder = OneHotEncoder(inputCol=index, outputCol=f"{column}_vec", handleInvalid="keep", dropLast=True)
    return encoder.fit(rows).transform(rows).drop(index)


def list_entries(df: DataFrame, keys: Sequence[str], column: str, dictionary: Dictionary) -> DataFrame:
    """(keys..., index, n): how often each known item occurs in a row's list text, one row per item that does.

    Rows that repeat their keys add up; items outside the dictionary are left out.
    """
    items = df.select(*keys, F.explode(C.list_keys(column)).alias("_item"))
    counts = items.groupBy(*keys, "_item").agg(F.count(F.lit(1)).alias("n"))
    return _looked_up(counts, dictionary, "_item", "inner").select(*keys, "index", "n")
