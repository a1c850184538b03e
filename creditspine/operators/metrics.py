"""Classification metrics as grouped aggregates.

One job gives the metrics of every group (split, model version, month) at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditspine.operators.ranks import running_totals


def auc_by(scored: DataFrame, keys: Sequence[str], score: str = "score", label: str = "label") -> DataFrame:
    """Exact area under the ROC curve per group, ties counted half.

    Rows are first counted per distinct score; the rank sum then runs over
    score ranges (see :mod:`creditspine.operators.ranks`). Null when a group
    holds one class only.
    """
    counts = (
        scored.where(F.col(score).isNotNull())
        .groupBy(*keys, F.col(score).alias("_score"))
        .agg(
            F.sum(F.col(label).cast("bigint")).alias("pos"),
            F.sum(F.lit(1) - F.col(label).cast("bigint")).alias("neg"),
        )
    )
    ranked = running_totals(counts, keys, "_score", ["neg", "pos"])
    wins = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / F.lit(2.0)))
    return ranked.groupBy(*keys).agg(
        F.try_divide(wins, (F.max("pos_total").cast("double") * F.max("neg_total"))).alias("auc")
    )


def confusion_by(scored: DataFrame, keys: Sequence[str], score: str = "score", label: str = "label",
                 threshold: float = 0.5) -> DataFrame:
    """tp, fp, tn, fn per group at a score threshold."""
    hit = F.col(score) >= threshold
    bad = F.col(label) == 1
    return scored.groupBy(*keys).agg(
        F.count_if(hit & bad).alias("tp"),
        F.count_if(hit & ~bad).alias("fp"),
        F.count_if(~hit & ~bad).alias("tn"),
        F.count_if(~hit & bad).alias("fn"),
    )


def classification_metrics(scored: DataFrame, keys: Sequence[str], score: str = "score", label: str = "label",
                           threshold: float = 0.5) -> DataFrame:
    """auc, gini, accuracy, precision, recall, f1 and the confusion counts per
    group; a zero denominator gives 0."""
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))

    def share(a, b):
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    rates = confusion_by(scored, keys, score, label, threshold).withColumns({
        "accuracy": share(tp + tn, tp + fp + tn + fn),
        "precision": share(tp, tp + fp),
        "recall": share(tp, tp + fn),
        "f1": share(tp * 2, tp * 2 + fp + fn),
    })
    return (
        rates.join(auc_by(scored, keys, score, label), list(keys), "left")
        .withColumn("gini", F.col("auc") * 2 - 1)
    )


def data_stats(df: DataFrame, split: str = "split", label: str = "label") -> DataFrame:
    """Row count and bad rate (4 decimals) per split."""
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.avg(F.col(label).cast("double")), 4).alias("bad_rate")
    )
