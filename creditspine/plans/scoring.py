"""Batch scoring of feature months."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from creditspine import schemas as S
from creditspine.operators.modelling import predictions, scoring_metadata
from creditspine.sources.models import load_model
from creditspine.sources.snapshots import Datamart, read_history, write_runs


def run_scoring(spark: SparkSession, mart: Datamart, bank: str, version: str, start, end=None) -> None:
    """Score every feature month in ``[start, end]`` with one model, in one job."""
    end = end or start
    features = read_history(spark, mart.path("gold", "feature_store")).where(
        F.col(S.SNAPSHOT).between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    )
    write_runs(predictions(features, load_model(spark, bank, version)), mart.path("gold", "predictions"))
    written = read_history(spark, mart.path("gold", "predictions")).where(
        (F.col("model_version") == version)
        & F.col(S.SNAPSHOT).between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    )
    write_runs(scoring_metadata(written), mart.path("gold", "scoring_runs"), fmt="json")
