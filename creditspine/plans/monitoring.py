"""Monthly monitoring: drift, data quality, attribution, matured performance."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditspine import schemas as S
from creditspine.operators import attribution as A
from creditspine.operators import drift, monitor
from creditspine.operators.modelling import FittedModel, compare_models, score, scoring_metadata
from creditspine.operators.profile import missing_by_group
from creditspine.sources.models import load_model, side_table
from creditspine.sources.session import cut_lineage, scoped
from creditspine.sources.snapshots import Datamart, exists, read_history, write_runs, write_snapshot

#: Names of the stored tables of a ``Reference``.
REFERENCE_TABLES = ("reference_sample", "reference_counts", "reference_edges", "reference_scores")


def attribution_rows(reference: DataFrame, current: DataFrame, model: FittedModel, **sampling) -> DataFrame:
    """Top-feature JSON per month of one model, of either family on the probability scale, all months in one job."""
    table = A.sampled_attribution(reference, current, model, S.KEYS, [S.SNAPSHOT], **sampling)
    return A.top_features_json(table, [S.SNAPSHOT]).withColumn("model_version", F.lit(model.version))


@dataclass(frozen=True)
class Reference:
    """What drift is measured against, fitted once with the model."""

    rows: DataFrame
    counts: DataFrame
    edges: DataFrame
    scores: DataFrame


def fit_reference(rows: DataFrame, model: FittedModel) -> Reference:
    """Value counts, bin edges and scores of the reference rows, each stored."""
    scores = score(rows, model).select(F.lit(model.version).alias("model_version"), F.col("score").alias("model_predictions"))
    return Reference(
        rows, cut_lineage(drift.value_counts(rows, model.numeric, model.categorical)),
        drift.fit_edges(rows, model.numeric, drift.N_BINS), cut_lineage(scores),
    )


def month_state(features: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Value counts per month: all that the drift of a month is told from."""
    return drift.value_counts(features, numeric, categorical, [S.SNAPSHOT])


def monitor_model(features: DataFrame, preds: DataFrame, labels: DataFrame, reference: Reference,
                  model: FittedModel, state: DataFrame | None = None, **sampling) -> DataFrame:
    """Monitoring rows of one model for every month present in ``features``.

    Drift comes from ``state``, the value counts of these months, so the feature
    rows are scanned for it once, and not at all where the state is stored.
    """
    if state is None:
        state = cut_lineage(month_state(features, model.numeric, model.categorical))
    pvalues = [drift.ks_from_counts(reference.counts, state)]
    if model.categorical:
        pvalues.append(drift.chi_square_from_counts(reference.counts, state))
    return monitor.monitoring_rows(
        scoring=scoring_metadata(preds),
        missing=missing_by_group(features, {
            s: [c for c in cols if c in features.columns] for s, cols in S.FEATURE_SOURCES.items()
        }, [S.SNAPSHOT]),
        psi=drift.prediction_psi(reference.scores, preds),
        csi=drift.csi_summary(drift.csi_from_counts(reference.counts, state, reference.edges, model.categorical)),
        pvalues=drift.min_pvalue(pvalues),
        attribution=attribution_rows(reference.rows, features, model, **sampling),
        performance=monitor.matured_performance(preds, labels),
    )


def run_state(spark: SparkSession, mart: Datamart, numeric: Sequence[str], categorical: Sequence[str], start, end=None,
              refresh: bool = False) -> DataFrame:
    """Store the state of the months in ``[start, end]`` that have none yet, and return it.

    The state depends on the features alone, so the models of a mart share it.
    ``refresh`` counts the months anew, as is due after their features were
    written again.
    """
    end = end or start
    inside = F.col(S.SNAPSHOT).between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    path = mart.path("gold", "monitoring_state")
    months = read_history(spark, mart.path("gold", "feature_store")).where(inside)
    if not refresh and exists(spark, path):
        stored = read_history(spark, path).where(inside & F.col("feature").isin(*numeric, *categorical))
        whole = stored.groupBy(S.SNAPSHOT).agg(F.count_distinct("feature").alias("n")).where(F.col("n") == len(numeric) + len(categorical))
        months = months.join(cut_lineage(whole), S.SNAPSHOT, "left_anti")
    write_snapshot(month_state(months, numeric, categorical), path)
    return read_history(spark, path).where(inside & F.col("feature").isin(*numeric, *categorical))


@scoped
def run_monitoring(spark: SparkSession, mart: Datamart, bank: str, version: str, start, end=None, refresh: bool = False) -> None:
    """Monitor the months in ``[start, end]`` of one model and store the rows.

    A month reads its own rows and the tables that were stored with the model;
    see ``run_state`` for ``refresh``.
    """
    end = end or start
    inside = F.col(S.SNAPSHOT).between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    features = read_history(spark, mart.path("gold", "feature_store")).where(inside)
    preds = read_history(spark, mart.path("gold", "predictions")).where(inside & (F.col("model_version") == version))
    labels = read_history(spark, mart.path("gold", "label_store"))
    model = load_model(spark, bank, version)
    state = run_state(spark, mart, model.numeric, model.categorical, start, end, refresh)
    reference = Reference(*[side_table(spark, bank, version, name) for name in REFERENCE_TABLES])
    write_runs(monitor_model(features, preds, labels, reference, model, state), mart.path("gold", "monitoring"))


@scoped
def run_comparison(spark: SparkSession, mart: Datamart, bank: str, champion: str, challenger: str, date) -> None:
    """Store the champion/challenger comparison row of one date."""
    metrics = side_table(spark, bank, champion, "metrics").unionByName(side_table(spark, bank, challenger, "metrics"))
    row = compare_models(metrics, champion, challenger).withColumn(S.SNAPSHOT, F.lit(date).cast("date"))
    write_snapshot(row, mart.path("gold", "champion_vs_challenger"))


def run_summary(spark: SparkSession, mart: Datamart, versions: list[str], as_of, train_date=S.TRAIN_DATE) -> dict[str, DataFrame]:
    """Chart-ready tables over the stored monitoring history."""
    rows = read_history(spark, mart.path("gold", "monitoring"))
    history = monitor.require_history(monitor.monitoring_history(rows, versions, as_of, train_date), versions, as_of)
    return {
        "history": history,
        "metrics": monitor.metric_series(history),
        "alerts": monitor.alert_series(history),
        "attribution": monitor.attribution_history(history),
        "agreement": monitor.version_agreement(history),
    }
