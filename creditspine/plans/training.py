"""Training: split, fit both families, evaluate every split, persist."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditspine import schemas as S
from creditspine.operators import drift
from creditspine.operators.metrics import classification_metrics, data_stats
from creditspine.operators.modelling import FittedModel, fit_families, score
from creditspine.operators.projection import feature_columns, sample_rows
from creditspine.operators.splits import TimeWindows, stratified_split, tag_windows, time_windows
from creditspine.plans.monitoring import fit_reference
from creditspine.sources.models import model_version, save_model
from creditspine.sources.session import cut_lineage, scoped
from creditspine.sources.snapshots import Datamart, read_history

REFERENCE_ROWS = 5000
REFERENCE_SEED = 42


def tag_splits(training: DataFrame, windows: TimeWindows, keys=tuple(S.ID_COLS)) -> DataFrame:
    """Rows of both windows with ``split`` train/val/test/oot and ``oot_part``."""
    tagged = tag_windows(training, windows).where(F.col("window").isNotNull())
    inside = stratified_split(tagged.where(F.col("window") == "train_test"), keys)
    outside = tagged.where(F.col("window") == "oot").withColumn("split", F.lit("oot"))
    return inside.unionByName(outside).drop("window")


def evaluation_rows(scored: DataFrame) -> DataFrame:
    """Each out-of-time row also counts for its own month's split."""
    parts = F.when(F.col("oot_part").isNull(), F.array("split")).otherwise(F.array("split", "oot_part"))
    return scored.withColumn("split", F.explode(parts))


def split_metrics(scored: DataFrame) -> DataFrame:
    """Metrics per (model_version, split); for train only auc and gini are kept."""
    m = classification_metrics(evaluation_rows(scored), ["model_version", "split"])
    kept = ["accuracy", "precision", "recall", "f1", "tp", "fp", "tn", "fn"]
    return m.withColumns({c: F.when(F.col("split") != "train", F.col(c)) for c in kept})


@dataclass
class TrainingResult:
    models: dict[str, FittedModel]
    metrics: DataFrame
    data_stats: DataFrame
    score_distribution: DataFrame
    feature_distributions: DataFrame
    reference_sample: DataFrame


def train(training: DataFrame, train_date: str = S.TRAIN_DATE, train_months: int = S.TRAIN_TEST_MONTHS,
          oot_months: int = S.OOT_MONTHS, grids: dict | None = None) -> TrainingResult:
    """Fit champion and challenger on a stored training table.

    Fitting is eager; the result tables are lazy and derive from the input.
    """
    windows = time_windows(train_date, train_months, oot_months)
    numeric, categorical = feature_columns(training, [*S.ID_COLS, *S.LABEL_COLS], S.CATEGORICAL_COLS)
    split = tag_splits(training, windows)
    models = fit_families(split, numeric, categorical, grids)
    scored = None
    for family, model in models.items():
        model.version = model_version(family, train_date)
        part = score(split, model).select(
            "split", "oot_part", "label", "score", F.lit(model.version).alias("model_version")
        )
        scored = part if scored is None else scored.unionByName(part)
    train_test = split.where(F.col("split") != "oot")
    usable = next(iter(models.values())).numeric
    return TrainingResult(
        models=models,
        metrics=split_metrics(scored),
        data_stats=data_stats(evaluation_rows(split)),
        score_distribution=drift.score_distribution(scored.where(F.col("split") != "oot"), "score", ["model_version"]),
        feature_distributions=drift.feature_distributions(train_test, usable, categorical),
        reference_sample=sample_rows(train_test, S.ID_COLS, REFERENCE_ROWS, REFERENCE_SEED).drop("split", "oot_part"),
    )


@scoped
def run_training(spark: SparkSession, mart: Datamart, bank: str, train_date: str = S.TRAIN_DATE,
                 train_months: int = S.TRAIN_TEST_MONTHS, oot_months: int = S.OOT_MONTHS,
                 grids: dict | None = None) -> list[str]:
    """Train on the stored training table and save every model; returns versions."""
    result = train(read_history(spark, mart.path("gold", "training")), train_date, train_months, oot_months, grids)
    # what does not depend on the model is computed once
    shared = {name: cut_lineage(getattr(result, name)) for name in ("data_stats", "feature_distributions", "reference_sample")}
    metrics, scores = cut_lineage(result.metrics), cut_lineage(result.score_distribution)
    for model in result.models.values():
        mine = F.col("model_version") == model.version
        reference = fit_reference(shared["reference_sample"], model)
        save_model(spark, model, bank, {
            "metrics": metrics.where(mine),
            "score_distribution": scores.where(mine),
            **shared,
            "reference_counts": reference.counts,
            "reference_edges": reference.edges,
            "reference_scores": reference.scores,
        })
    return [m.version for m in result.models.values()]
