"""Loan-ledger operators: month on book, days past due, labels, bad rates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditspine import schemas as S


def add_delinquency(df: DataFrame, fill_all: bool = True) -> DataFrame:
    """Add ``mob``, ``installments_missed``, ``first_missed_date`` and ``dpd``.

    A positive overdue amount over a zero or null due amount leaves the first
    missed date and ``dpd`` null. With ``fill_all`` every null number of the
    ledger becomes 0, which is what older tables hold; otherwise only
    ``installments_missed`` is filled. Amounts are decimals, so an exact
    multiple of the instalment is not rounded up to one more missed month.
    """
    missed = F.ceil(F.try_divide(F.col("overdue_amt"), F.col("due_amt"))).try_cast("int")
    numbers = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}

    def base(name: str):
        c = F.col(name)
        if fill_all and name in numbers:
            return F.coalesce(c, F.lit(0).cast(df.schema[name].dataType)).alias(name)
        return c

    mob = F.col("installment_num").cast("int")
    known = df.select(
        *[base(c) for c in df.columns],
        (F.coalesce(mob, F.lit(0)) if fill_all else mob).alias("mob"),
        F.coalesce(missed, F.lit(0)).alias("installments_missed"),
    )
    first = F.when(
        F.col("installments_missed") > 0, F.add_months(S.SNAPSHOT, -F.col("installments_missed"))
    )
    return known.withColumn("first_missed_date", first).withColumn(
        "dpd",
        F.when(F.col("overdue_amt") > 0, F.datediff(S.SNAPSHOT, "first_missed_date")).otherwise(F.lit(0)),
    )


def label_name(dpd: int, mob: int) -> str:
    return f"{dpd}dpd_{mob}mob"


def bad_flag(dpd: int):
    return F.when(F.col("dpd") >= dpd, 1).otherwise(0)


def build_labels(ledger: DataFrame, mob: int = S.MOB_CUTOFF, dpd: int = S.DPD_CUTOFF) -> DataFrame:
    """One label per loan observed at month ``mob``."""
    return ledger.where(F.col("mob") == mob).select(
        S.LOAN, S.CUSTOMER, bad_flag(dpd).alias("label"), F.lit(label_name(dpd, mob)).alias("label_def"), S.SNAPSHOT
    )


def bad_rate_curve(ledger: DataFrame, dpd: int = S.DPD_CUTOFF, started_before=None) -> DataFrame:
    """Share of ledger rows past due per month on book, in order."""
    if started_before is not None:
        ledger = ledger.where(F.col("loan_start_date") < F.lit(started_before).cast("date"))
    return ledger.groupBy("mob").agg(F.avg(bad_flag(dpd)).alias("bad_rate")).orderBy("mob")


def final_bads(ledger: DataFrame, installment: int = 10) -> DataFrame:
    """Ledger rows at the last instalment looked at."""
    return ledger.where(F.col("installment_num") == installment)


def default_rate_by_snapshot(ledger: DataFrame, mob: int = S.MOB_CUTOFF, dpd: int = S.DPD_CUTOFF) -> DataFrame:
    flag = bad_flag(dpd)
    return (
        ledger.where(F.col("mob") == mob)
        .groupBy(S.SNAPSHOT)
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.sum(flag).alias("label_1"),
            F.round(F.avg(flag), 3).alias("pct_label_1"),
        )
        .orderBy(S.SNAPSHOT)
    )


def label_distribution(labels: DataFrame) -> DataFrame:
    """Count and percentage (one decimal) per label."""
    counts = labels.groupBy("label").agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("percentage", F.round(F.col("count") * 100.0 / total, 1))


def matured_customers(ledger: DataFrame, mob: int = S.MOB_CUTOFF) -> DataFrame:
    """Customers seen at month ``mob`` and customers overall (one row)."""
    per_customer = ledger.groupBy(S.CUSTOMER).agg(F.max((F.col("mob") == mob).cast("int")).alias("reached"))
    return per_customer.agg(
        F.count(F.lit(1)).alias("customers"), F.sum(F.coalesce("reached", F.lit(0))).alias("matured")
    )
