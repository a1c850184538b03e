"""Session settings the operators rely on."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Runtime settings for skewed keys and uneven months
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even when the split costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session.

    Python workers get the folder of this package on their path, as the driver
    has it; on a cluster it is installed or passed with ``--py-files``.
    """
    home = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if home not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([home, *filter(None, paths)])
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared checkpoint folder named by ``spark.checkpoint.dir``.

    A folder of our own is set only when the session names none and runs on one
    machine, as in tests; on a cluster a machine-local folder would not be shared.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if current:
        return current
    if not named and not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = named or tempfile.mkdtemp(prefix="creditspine-checkpoint-")
    context.setCheckpointDir(root)
    return root


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the checkpoint folder."""
    folder = _SCOPE.get() or f"{checkpoint_root(spark).rstrip('/')}/creditspine/{spark.sparkContext.applicationId}"
    return f"{folder}/{name}-{uuid.uuid4().hex}"


#: Folder of the innermost open scope of this thread.
_SCOPE: ContextVar[str | None] = ContextVar("scope", default=None)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """Intermediate tables written inside are deleted when the block ends, also after an error.

    What leaves the block must be written elsewhere first: a lazy DataFrame that
    reads such a table can't be run afterwards. Scopes nest; other threads and
    sessions keep their own tables.
    """
    folder = scratch(spark, "scope")
    token = _SCOPE.set(folder)
    try:
        yield folder
    finally:
        _SCOPE.reset(token)
        delete_folder(spark, folder)


def scoped(job: Callable) -> Callable:
    """For jobs ``(spark, ...)`` that write their results: a scope of their own."""

    @wraps(job)
    def run(spark: SparkSession, *args, **options):
        with scratch_scope(spark):
            return job(spark, *args, **options)

    return run


def release(spark: SparkSession) -> None:
    """Delete every intermediate table of this application; results that still read one can't be run again."""
    delete_folder(spark, f"{checkpoint_root(spark).rstrip('/')}/creditspine/{spark.sparkContext.applicationId}")


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder through the file system that holds it; a missing one is no error."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Tables written inside delete their shuffle files when the write ends, not
    when the driver next collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def cut_lineage(df: DataFrame, **options: str) -> DataFrame:
    """Write the rows as a table in the checkpoint folder and go on from there.

    Used where a derived table feeds several jobs: it is computed once, the
    copy outlives lost executors, and readers get column pruning and sizes.
    """
    path = scratch(df.sparkSession, "table")
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_and_count(df: DataFrame) -> tuple[DataFrame, int]:
    """As ``cut_lineage``, with the number of rows, read from the files' own counts."""
    out = cut_lineage(df)
    return out, out.count()
