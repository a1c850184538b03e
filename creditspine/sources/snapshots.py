"""Snapshot tables: Hive-style folders partitioned by ``snapshot_date``."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditspine import schemas as S
from creditspine.functions.dates import month_floor
from creditspine.sources.session import shuffles_freed

#: Plan nodes that can be read again month by month: nothing is joined, grouped or run in Python.
NARROW = {"Project", "Filter", "Generate", "SubqueryAlias", "LogicalRelation"}
#: A portion written at once holds at most one in so many of a table's rows, or so many bytes of them if that is more.
PORTIONS, PORTION_BYTES = 8, 2 << 30
#: Up to this size of what is read a table is written in one job, without counting its months.
ONE_JOB_BYTES = 64 << 20


@dataclass(frozen=True)
class Datamart:
    """Paths of the layers under one root."""

    root: str

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV with a given schema; the header must match, nothing is inferred."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )


def write_snapshot(df: DataFrame, path: str, partitions: Sequence[str] = (S.SNAPSHOT,), fmt: str = "parquet") -> None:
    """Replace exactly the partitions present in ``df``; others stay untouched.

    Rows are rebalanced by partition value before the write: small months
    become one file and a month with a large share of the rows is split into
    files of the advisory size, instead of one file per task and month.

    A large table is written some months at a time, so that the disk holds the
    shuffled rows of one portion beside the table. Each folder is written by
    one portion, and a failed write is mended by running it again.
    """
    options = {"partitionOverwriteMode": "dynamic", "header": True}
    if fmt == "parquet":
        options["compression"] = "zstd"
    with shuffles_freed(df.sparkSession):
        for portion in portions(df, path, partitions[-1]):
            (
                portion.hint("rebalance", *partitions)
                .write.mode("overwrite")
                .options(**options)
                .partitionBy(*partitions)
                .format(fmt)
                .save(path)
            )


def portions(df: DataFrame, path: str, column: str) -> list[DataFrame]:
    """The rows cut into ranges of a column, for writing them to a path in turn.

    Only rows that come straight from Parquet files are cut, because each range
    reads them again (of a table partitioned by the column, only its own folders);
    others, small tables and those read from the path itself stay whole. A value
    is never divided, so one with a large share of the rows is a large portion.
    """
    if not _read_again(df, path):
        return [df]
    c, kind = F.col(column), df.schema[column].dataType
    # values as text: Python has no dates after the year 9999
    counts = df.groupBy(column).count().orderBy(column).select(c.cast("string"), "count").collect()
    limit = max(sum(n for _, n in counts) / PORTIONS, PORTION_BYTES / df._jdf.schema().defaultSize())
    starts, size = [], 0
    for value, n in counts:
        if size and size + n > limit and value is not None:
            starts.append(F.lit(value).cast(kind))
            size = 0
        size += n
    if not starts:
        return [df]
    middle = [df.where((c >= a) & (c < b)) for a, b in zip(starts, starts[1:])]
    return [df.where(c.isNull() | (c < starts[0])), *middle, df.where(c >= starts[-1])]


def _read_again(df: DataFrame, path: str) -> bool:
    """Whether reading the rows several times is cheap, gives the same rows and pays."""
    plan = df._jdf.queryExecution().optimizedPlan()
    if int(str(plan.stats().sizeInBytes())) <= ONE_JOB_BYTES or not plan.deterministic():
        return False
    nodes = [plan]
    for node in nodes:
        if node.nodeName() not in NARROW or not node.subqueries().isEmpty():
            return False
        nodes.extend(node.children().apply(i) for i in range(node.children().size()))
        if node.nodeName() == "LogicalRelation" and node.relation().toString() != "parquet":
            return False
    spark = df.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target = target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toUri().getPath().rstrip("/")
    return not any(unquote(urlparse(f).path).startswith(f"{target}/") for f in df.inputFiles())


def read_history(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """All months of a table."""
    reader = spark.read.format(fmt).option("header", True)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table was written at the path."""
    try:
        return bool(spark.read.format("binaryFile").load(path).schema)
    except AnalysisException:
        return False


def read_snapshot(spark: SparkSession, path: str, date, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """One month of a table: only its folder is read."""
    df = read_history(spark, path, fmt, schema)
    return df.where(F.col(S.SNAPSHOT) == F.lit(date).cast("date"))


def bronze_schema(raw: T.StructType) -> T.StructType:
    """Raw text columns with the partition column as DATE."""
    return T.StructType([f for f in raw.fields if f.name != S.SNAPSHOT] + [T.StructField(S.SNAPSHOT, T.DateType())])


def ingest_bronze(spark: SparkSession, source: str, mart: Datamart, table: str, start=None, end=None,
                  fmt: str = "parquet") -> None:
    """Split one CSV source into monthly bronze partitions, in one job.

    Rows whose snapshot date cannot be read match no month and are not
    ingested, as with an equality filter per month.
    """
    raw = read_csv(spark, source, S.RAW_SCHEMAS[table])
    dated = raw.withColumn(S.SNAPSHOT, F.col(S.SNAPSHOT).try_cast("date")).where(F.col(S.SNAPSHOT).isNotNull())
    if start is not None:
        dated = dated.where(F.col(S.SNAPSHOT) >= F.lit(start).cast("date"))
    if end is not None:
        dated = dated.where(F.col(S.SNAPSHOT) <= F.lit(end).cast("date"))
    write_snapshot(dated, mart.path("bronze", table), fmt=fmt)


def read_bronze(spark: SparkSession, mart: Datamart, table: str, fmt: str = "parquet") -> DataFrame:
    return read_history(spark, mart.path("bronze", table), fmt, bronze_schema(S.RAW_SCHEMAS[table]))


def write_table(df: DataFrame, path: str) -> None:
    """Replace a whole table."""
    df.write.mode("overwrite").parquet(path)


def write_runs(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Predictions or monitoring rows: one folder per model version and month."""
    write_snapshot(df, path, ("model_version", S.SNAPSHOT), fmt)


def write_preview(df: DataFrame, path: str, n: int = 1000, order: Sequence[str] = ()) -> None:
    """First ``n`` rows as CSV, in the given order; what it leaves open goes by the
    columns in turn, so a rerun writes the same rows."""
    rows = df.orderBy(*order, *[c for c in df.columns if c not in order])
    rows.limit(n).write.mode("overwrite").option("header", True).csv(path)


def month_spine(bounds: DataFrame, start: str, end: str) -> DataFrame:
    """First-of-month dates from the month of ``start`` up to ``end`` inclusive.

    ``bounds`` is a frame with the two date columns, normally one row.
    """
    months = F.sequence(month_floor(start), F.col(end).cast("date"), F.expr("interval 1 month"))
    return bounds.select(F.explode(months).alias(S.SNAPSHOT))
