"""Backfill and monthly run over a datamart."""

from __future__ import annotations

from pyspark.sql import SparkSession

from creditspine import schemas as S
from creditspine.plans import gold, silver
from creditspine.sources.snapshots import Datamart, ingest_bronze


def run_datamart(spark: SparkSession, mart: Datamart, sources: dict[str, str], start=None, end=None,
                 label_end=None, mob: int = S.MOB_CUTOFF, dpd: int = S.DPD_CUTOFF) -> None:
    """Bronze, silver and gold for all months in ``[start, end]``.

    Every step is one job over the whole range; a single month is the same call
    with ``start == end``. Labels may run further, to ``label_end``, so that the
    last feature months mature.
    """
    last = {"ledger": label_end or end}
    for table, path in sources.items():
        ingest_bronze(spark, path, mart, table, start, last.get(table, end))
        silver.run_silver(spark, mart, table, start, last.get(table, end))
    gold.run_labels(spark, mart, start, last["ledger"], mob, dpd)
    gold.run_features(spark, mart, start, end)
