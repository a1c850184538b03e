"""Joins between snapshot tables.

Equi joins of tables that grow with the customers are merge joins with skew
splitting by AQE (``shuffled``): a broadcast is decided by the size of compressed
files and would pass the rows of a side through the driver.
``salted_join`` handles a key that holds a large share of the rows explicitly.
History joins never form (history row, loan row) pairs: both sides are reduced
to one row per customer and month first.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditspine import schemas as S
from creditspine.functions.dates import shift_months


def shuffled(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the table: shuffled, never broadcast."""
    return df.hint("merge")


def hot_keys(df: DataFrame, keys: Sequence[str], share: float) -> DataFrame:
    """Keys holding at least ``share`` of all rows: at most ``1 / share`` rows."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    return counts.where(F.col("_n") >= total * F.lit(share)).select(*keys, F.lit(True).alias("_hot"))


def salted_join(
    many: DataFrame,
    one: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    share: float = 0.01,
    salts: int = 32,
) -> DataFrame:
    """Equi join that spreads hot keys of ``many`` over ``salts`` tasks.

    Only keys above ``share`` of the rows are salted, and only their rows of
    ``one`` are repeated, so ordinary keys cost nothing extra. The salt is a
    hash of the row, hence the same when a lost task is run again. ``how`` is
    inner, left or left_semi; the result equals the plain join.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"unsupported join type {how}")
    on = list(on)
    hot = F.broadcast(hot_keys(many, on, share))  # at most 1 / share rows
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in many.columns]), F.lit(salts)).cast("int")
    no_key = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])  # never matches, may be many
    left = many.join(hot, on, "left").withColumn(
        "_salt", F.when(F.col("_hot") | no_key, spread).otherwise(F.lit(0))
    ).drop("_hot")
    every = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = one.join(hot, on, "left").withColumn("_salt", F.explode(every)).drop("_hot")
    return left.join(shuffled(right), [*on, "_salt"], how).drop("_salt")


def feature_store(attributes: DataFrame, financials: DataFrame, clickstream: DataFrame,
                  clickstream_how: str = "left", drop: Sequence[str] = S.LEAKAGE_COLS) -> DataFrame:
    """Wide features per customer and snapshot, without leakage columns.

    All three tables share the join key, so one partitioning serves both joins.
    """
    a, f, c = (t.drop(*drop) for t in (attributes, financials, clickstream))
    return a.join(shuffled(f), S.KEYS, "inner").join(shuffled(c), S.KEYS, clickstream_how)


def join_all(tables: Sequence[DataFrame], on: Sequence[str], how: str = "inner") -> DataFrame:
    return reduce(lambda l, r: l.join(shuffled(r), list(on), how), tables)


def label_join(features: DataFrame, labels: DataFrame, months: int = S.MOB_CUTOFF,
               direction: str = "back") -> DataFrame:
    """Training rows: features of a month with the label ``months`` later.

    ``forward`` moves features to the label date, ``back`` moves labels to the
    feature date; the snapshot column keeps the date of the unmoved side. A
    customer-month holds one feature row but any number of labelled loans, so
    labels are the side whose keys may be hot.
    """
    if direction == "forward":
        features = features.withColumn(S.SNAPSHOT, shift_months(S.SNAPSHOT, months))
    elif direction == "back":
        labels = labels.withColumn(S.SNAPSHOT, shift_months(S.SNAPSHOT, -months))
    else:
        raise ValueError(f"unknown direction {direction}")
    return features.join(shuffled(labels), S.KEYS, "inner")


def with_labels_only(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Features of customers that have any label."""
    return features.join(shuffled(labels.select(S.CUSTOMER).distinct()), S.CUSTOMER, "left_semi")


def history_means(history: DataFrame, anchors: DataFrame, columns: Sequence[str],
                  inclusive: bool, anchor_date: str = "mob_date", prefix: str = "avg_") -> DataFrame:
    """Mean of each column over all (history row, anchor row) pairs of a
    customer with history date before (or at) the anchor date.

    Equal to an equi join with a date inequality followed by ``avg``, but the
    pairs are counted instead of formed: history is summed per customer-month,
    anchors are counted per customer-month, and a month's weight is the number
    of anchors after it. Both reductions combine before the shuffle, so a
    customer with very many rows is a few hundred month rows afterwards.
    """
    c, d = S.CUSTOMER, S.SNAPSHOT
    months = history.groupBy(c, d).agg(
        *[F.sum(F.col(x).cast("double")).alias(f"_s_{x}") for x in columns],
        *[F.count(x).alias(f"_n_{x}") for x in columns],
    )
    dates = anchors.groupBy(c, F.col(anchor_date).alias(d)).agg(F.count(F.lit(1)).alias("_anchors"))
    line = months.withColumn("_anchors", F.lit(0).cast("bigint")).unionByName(dates, allowMissingColumns=True)
    later_first = Window.partitionBy(c).orderBy(F.col(d).desc())
    weight = F.sum("_anchors").over(later_first.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    if not inclusive:
        weight = weight - F.sum("_anchors").over(later_first.rangeBetween(Window.currentRow, Window.currentRow))
    weighted = line.withColumn("_w", weight).where(F.col("_w") > 0)
    weighted = weighted.where(reduce(lambda a, b: a | b, [F.col(f"_n_{x}").isNotNull() for x in columns]))
    return weighted.groupBy(c).agg(*[
        F.try_divide(F.sum(F.col(f"_s_{x}") * F.col("_w")), F.sum(F.col(f"_n_{x}") * F.col("_w"))).alias(f"{prefix}{x}")
        for x in columns
    ])


def latest_record(df: DataFrame, key: str = S.CUSTOMER, date: str = S.SNAPSHOT,
                  tie_break: Sequence[str] = (), drop: Sequence[str] = ()) -> DataFrame:
    """Latest row per key; rows still tied go by a hash of the row, whatever the layout.

    Spark limits each key to one row before the shuffle.
    """
    order = [F.col(date).desc(), *[F.col(c) for c in tie_break], F.xxhash64(*df.columns)]
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.where(F.col("_rn") == 1).drop("_rn", date, *drop)


def spine_features(spine: DataFrame, attributes: DataFrame, financials: DataFrame, loans: DataFrame) -> DataFrame:
    """Clickstream spine with latest static records and loan aggregates."""
    a = latest_record(attributes, drop=S.IDENTIFIER_COLS)
    f = latest_record(financials)
    wide = spine.withColumnRenamed(S.SNAPSHOT, "feature_snapshot_date")
    return (
        wide.join(shuffled(a), S.CUSTOMER, "left")
        .join(shuffled(f), S.CUSTOMER, "left")
        .join(shuffled(loans), [S.CUSTOMER, "feature_snapshot_date"], "left")
    )


def loan_aggregates(ledger: DataFrame, feature_dates: DataFrame) -> DataFrame:
    """Loan totals per customer as known at each feature date.

    The state of a loan at a date is its ledger row of that month, so this is an
    equi join on (customer, month), never a date-range join.
    """
    per_month = ledger.groupBy(S.CUSTOMER, F.col(S.SNAPSHOT).alias("feature_snapshot_date")).agg(
        F.sum("loan_amt").cast("double").alias("tot_loan_amt"),
        F.sum("overdue_amt").cast("double").alias("tot_overdue"),
        F.sum("balance").cast("double").alias("tot_balance"),
        F.avg("dpd").alias("avg_dpd"),
    )
    wanted = feature_dates.select(S.CUSTOMER, "feature_snapshot_date").distinct()
    return per_month.join(shuffled(wanted), [S.CUSTOMER, "feature_snapshot_date"], "left_semi")


def multi_snapshot_training(features: DataFrame, ledger: DataFrame, mob: int = S.MOB_CUTOFF,
                            dpd: int = S.DPD_CUTOFF) -> DataFrame:
    """Features of every month joined to labels ``mob`` months later, both dates
    kept. One equi join replaces a join per month plus unions."""
    from creditspine.operators.ledger import build_labels

    labels = build_labels(ledger, mob, dpd).select(
        S.CUSTOMER, "label", F.col(S.SNAPSHOT).alias("label_snapshot_date")
    )
    dated = features.withColumns({
        "feature_snapshot_date": F.col(S.SNAPSHOT),
        "label_snapshot_date": shift_months(S.SNAPSHOT, mob),
    })
    return dated.join(shuffled(labels), [S.CUSTOMER, "label_snapshot_date"], "inner")


def same_date_labels(features: DataFrame, labels: DataFrame) -> DataFrame:
    return features.join(shuffled(labels.select(*S.KEYS, "label")), S.KEYS, "inner")


def prediction_labels(predictions: DataFrame, labels: DataFrame, months: int = S.MOB_CUTOFF) -> DataFrame:
    """Predictions with the label that matured ``months`` after the snapshot."""
    matured = labels.select(S.CUSTOMER, shift_months(S.SNAPSHOT, -months).alias(S.SNAPSHOT), "label")
    return predictions.join(shuffled(matured), S.KEYS, "inner")


def label_months(labels: DataFrame, months: int = S.MOB_CUTOFF) -> DataFrame:
    """Feature snapshots whose label month exists (one row per month)."""
    return labels.select(shift_months(S.SNAPSHOT, -months).alias(S.SNAPSHOT)).distinct()


def common_dates(tables: Sequence[DataFrame], date: str = S.SNAPSHOT) -> DataFrame:
    """Snapshot dates present in every table."""
    return reduce(lambda a, b: a.intersect(b), [t.select(date).distinct() for t in tables])


def candidate_dates(dates: DataFrame, ledger: DataFrame, months: int = S.MOB_CUTOFF) -> DataFrame:
    """Feature dates with any ledger date at least ``months`` later. Existence
    only depends on the last ledger date, so no range join is needed."""
    last = ledger.agg(F.max(S.SNAPSHOT)).scalar()
    cutoff = shift_months(S.SNAPSHOT, months)
    return dates.withColumn("label_cutoff", cutoff).where(F.col("label_cutoff") <= last)


def latest_valid_date(dates: DataFrame, ledger: DataFrame, months: int = S.MOB_CUTOFF) -> DataFrame:
    return candidate_dates(dates, ledger, months).agg(F.max(S.SNAPSHOT).alias(S.SNAPSHOT))
