"""Alert levels, monitoring rows and their history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditspine import schemas as S
from creditspine.operators.joins import label_months, prediction_labels
from creditspine.operators.metrics import classification_metrics
from creditspine.sources.session import cut_lineage

RUN = [S.SNAPSHOT, "model_version"]
PERFORMANCE_METRICS = ["auc", "gini", "accuracy", "precision", "recall", "f1"]


def _fixed(c: Column, digits: int) -> Column:
    """Fixed-point text with round-half-even on the exact binary value."""
    return F.translate(F.format_number(c, digits), ",", "")


def _known(name: str) -> Column:
    return F.col(name).isNotNull() & ~F.isnan(F.col(name))


def _alert(checks: Sequence[tuple[Column, Column]], level: str, reasons: str) -> dict[str, Column]:
    """Worst level and joined reason texts of (rank, reason) pairs; a check that
    does not apply is null on both sides."""
    names = F.array(*[F.lit(n) for n, _ in sorted(S.ALERT_RANK.items(), key=lambda x: x[1])])
    worst = F.greatest(F.lit(0), *[F.coalesce(rank, F.lit(0)) for rank, _ in checks])
    return {level: F.get(names, worst), reasons: F.concat_ws("; ", *[r for _, r in checks])}


def performance_alerts(df: DataFrame) -> DataFrame:
    """Add the performance alert from recall, accuracy and auc (in this order).

    A value between the yellow top and the green floor is yellow. Nothing is
    checked before the label has matured.
    """
    checks = []
    for metric, (green, low, top) in S.PERFORMANCE_BANDS.items():
        on = F.col("label_available") & _known(metric)
        v, text = F.col(metric), _fixed(F.col(metric), 3)
        rank = F.when(on, F.when(v >= green, 0).when(v >= low, 1).otherwise(2))
        reason = F.when(on, F.when(
            v >= green, F.concat(F.lit(f"{metric} "), text, F.lit(f" >= {green} [GREEN]"))
        ).when(
            v >= low, F.concat(F.lit(f"{metric} "), text, F.lit(f" in [{low}, {top}] [YELLOW]"))
        ).otherwise(F.concat(F.lit(f"{metric} "), text, F.lit(f" < {low} [RED]"))))
        checks.append((rank, reason))
    return df.withColumns(_alert(checks, "performance_alert_level", "performance_alert_reasons"))


def feature_alerts(df: DataFrame) -> DataFrame:
    """Add the drift and data-quality alert: psi, minimum p-value, missing share
    per source, error rate (in this order)."""
    green, yellow = S.PSI_BANDS
    psi, text = F.col("psi_score"), _fixed(F.col("psi_score"), 3)
    on = _known("psi_score")
    checks = [(
        F.when(on, F.when(psi <= green, 0).when(psi <= yellow, 1).otherwise(2)),
        F.when(on, F.when(
            psi <= green, F.concat(F.lit("psi "), text, F.lit(f" <= {green} [GREEN]"))
        ).when(
            psi <= yellow, F.concat(F.lit("psi "), text, F.lit(f" in ({green}, {yellow}] [YELLOW]"))
        ).otherwise(F.concat(F.lit("psi "), text, F.lit(f" > {yellow} [RED]")))),
    )]
    green, yellow = S.PVALUE_BANDS
    p, text = F.col("min_csi_pvalue"), _fixed(F.col("min_csi_pvalue"), 6)
    on = _known("min_csi_pvalue")
    checks.append((
        F.when(on, F.when(p > green, 0).when(p > yellow, 1).otherwise(2)),
        F.when(on, F.when(
            p > green, F.concat(F.lit("min_csi_pvalue "), text, F.lit(f" > {green} [GREEN]"))
        ).when(
            p > yellow, F.concat(F.lit("min_csi_pvalue "), text, F.lit(f" in ({yellow}, {green}] [YELLOW]"))
        ).otherwise(F.concat(F.lit("min_csi_pvalue "), text, F.lit(f" <= {yellow} [RED]")))),
    ))
    for source in S.FEATURE_SOURCES:
        name = f"pct_missing_{source}"
        bad = F.col(name) >= S.MISSING_RED
        checks.append((
            F.when(bad, 2),
            F.when(bad, F.concat(F.lit(f"{name} "), _fixed(F.col(name), 3), F.lit(f" >= {S.MISSING_RED} [RED]"))),
        ))
    bad = F.col("error_rate") > 0
    checks.append((
        F.when(bad, 2),
        F.when(bad, F.concat(F.lit("error_rate "), _fixed(F.col("error_rate"), 3), F.lit(" > 0 [RED]"))),
    ))
    return df.withColumns(_alert(checks, "feature_alert_level", "feature_alert_reasons"))


def matured_performance(predictions: DataFrame, labels: DataFrame, months: int = S.MOB_CUTOFF) -> DataFrame:
    """Metrics per (snapshot, version) over predictions whose label matured.

    Runs without a label month yet are kept with ``label_available`` false and
    null metrics.
    """
    joined = prediction_labels(predictions, labels, months)
    metrics = classification_metrics(joined, RUN, "model_predictions").select(*RUN, *PERFORMANCE_METRICS)
    runs = predictions.select(*RUN).distinct()
    ready = label_months(labels, months).withColumn("label_available", F.lit(True))
    return (
        runs.join(ready, S.SNAPSHOT, "left")
        .withColumn("label_available", F.coalesce("label_available", F.lit(False)))
        .join(metrics, RUN, "left")
    )


def monitoring_rows(scoring: DataFrame, missing: DataFrame, psi: DataFrame, csi: DataFrame, pvalues: DataFrame,
                    attribution: DataFrame, performance: DataFrame) -> DataFrame:
    """One row per (snapshot, version) from the per-run aggregates, with alerts.

    ``missing``, ``csi`` and ``pvalues`` depend on the features only and are
    keyed by snapshot; the others by snapshot and version. Every input has one
    row per run, so these joins are small whatever the size of the tables. Each
    is stored before it is joined (eager), so no plan holds more than one test.
    """
    scoring, missing, psi, csi, pvalues, attribution, performance = (
        cut_lineage(t) for t in (scoring, missing, psi, csi, pvalues, attribution, performance))
    wide = (
        scoring.join(missing, S.SNAPSHOT, "left")
        .join(psi, RUN, "left")
        .join(csi, S.SNAPSHOT, "left")
        .join(pvalues, S.SNAPSHOT, "left")
        .join(attribution, RUN, "left")
        .join(performance, RUN, "left")
        .withColumn("label_available", F.coalesce("label_available", F.lit(False)))
    )
    columns = [
        S.SNAPSHOT, "model_name", "model_version", "n_scored",
        *[f"pct_missing_{s}" for s in S.FEATURE_SOURCES],
        "psi_score", "max_csi", "mean_csi", "min_csi_pvalue", "error_rate", "top5_shap",
        "label_available", *PERFORMANCE_METRICS,
    ]
    return feature_alerts(performance_alerts(wide.select(*columns)))


def monitoring_history(rows: DataFrame, versions: Sequence[str], as_of, train_date=S.TRAIN_DATE) -> DataFrame:
    """Rows of the versions from the train date up to ``as_of``, oldest first."""
    return rows.where(
        F.col("model_version").isin(*versions)
        & F.col(S.SNAPSHOT).between(F.lit(train_date).cast("date"), F.lit(as_of).cast("date"))
    ).orderBy(S.SNAPSHOT, "model_version")


def require_history(history: DataFrame, versions: Sequence[str], as_of) -> DataFrame:
    if history.isEmpty():
        raise ValueError(f"no monitoring history for {list(versions)} as of {as_of}")
    return history


def attribution_history(rows: DataFrame) -> DataFrame:
    """Explode the JSON attribution column to (snapshot, version, feature, value)."""
    parsed = F.from_json("top5_shap", "array<struct<feature:string,mean_abs_shap:double>>")
    return rows.where(F.col("top5_shap").isNotNull()).select(*RUN, F.inline(parsed))


def version_agreement(rows: DataFrame, column: str = "max_csi") -> DataFrame:
    """Whether all versions report the same value on every date (one row)."""
    per_date = rows.groupBy(S.SNAPSHOT).agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    return per_date.agg(F.coalesce(F.bool_and(F.coalesce(F.col("lo") == F.col("hi"), F.lit(True))), F.lit(True)).alias("aligned"))


def metric_series(rows: DataFrame, metrics: Sequence[str] = ("auc", "accuracy", "recall")) -> DataFrame:
    """Long metric table of the runs that have labels."""
    return rows.where("label_available").unpivot(RUN, list(metrics), "metric", "value").where(F.col("value").isNotNull())


def alert_series(rows: DataFrame) -> DataFrame:
    """Long table of alert ranks per run and alert kind."""
    ranks = F.create_map(*[F.lit(x) for kv in S.ALERT_RANK.items() for x in kv])
    kinds = ["performance_alert_level", "feature_alert_level"]
    long = rows.unpivot(RUN, kinds, "alert", "level")
    return long.withColumn("rank", F.try_element_at(ranks, F.col("level")))
