"""Silver to gold: label store, feature store, training table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditspine import schemas as S
from creditspine.functions import cleaning as C
from creditspine.functions import ratios as R
from creditspine.operators import encode, impute
from creditspine.operators.joins import feature_store, history_means, join_all, label_join, shuffled, with_labels_only
from creditspine.operators.ledger import build_labels
from creditspine.operators.projection import numeric_columns
from creditspine.plans.silver import financial_ratios
from creditspine.sources.session import cut_lineage, scoped
from creditspine.sources.snapshots import Datamart, read_history, write_snapshot, write_table

# The columns that these feature sets encode and cap
DETAIL_CATEGORIES = [
    "occupation", "payment_of_min_amount", "credit_mix", "payment_behaviour_spent", "payment_behaviour_value",
]
QUANTILE_CAPPED = [
    "Num_Bank_Accounts", "Num_Credit_Card", "Interest_Rate", "Num_of_Delayed_Payment", "Num_Credit_Inquiries",
]
FINANCIAL_CATEGORIES = ["Credit_Mix", "Payment_Behaviour", "Payment_of_Min_Amount"]


def _months(df: DataFrame, start, end) -> DataFrame:
    if start is not None:
        df = df.where(F.col(S.SNAPSHOT) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(S.SNAPSHOT) <= F.lit(end).cast("date"))
    return df


def run_labels(spark: SparkSession, mart: Datamart, start=None, end=None,
               mob: int = S.MOB_CUTOFF, dpd: int = S.DPD_CUTOFF) -> None:
    ledger = _months(read_history(spark, mart.path("silver", "ledger")), start, end)
    write_snapshot(build_labels(ledger, mob, dpd), mart.path("gold", "label_store"))


def run_features(spark: SparkSession, mart: Datamart, start=None, end=None, clickstream_how: str = "left") -> None:
    a, f, c = (_months(read_history(spark, mart.path("silver", t)), start, end)
               for t in ("attributes", "financials", "clickstream"))
    write_snapshot(feature_store(a, f, c, clickstream_how), mart.path("gold", "feature_store"))


def run_training_table(spark: SparkSession, mart: Datamart, months: int = S.MOB_CUTOFF) -> None:
    features = read_history(spark, mart.path("gold", "feature_store"))
    labels = read_history(spark, mart.path("gold", "label_store"))
    write_table(label_join(features, labels, months, "back"), mart.path("gold", "training"))


def imputed_training(features: DataFrame, labels: DataFrame, occupations: Sequence[str] | None = None,
                     months: int = S.MOB_CUTOFF, exact: bool = True) -> DataFrame:
    """Training rows keyed by label date, medians filled, occupation as flags.

    The joined rows are stored: both fits and the result read them from there.
    """
    joined = cut_lineage(label_join(features, labels, months, "forward"))
    columns = [c for c in S.MEDIAN_IMPUTE_COLS if c in joined.columns]
    filled = impute.fill(joined, impute.fit_medians(joined, columns, exact))
    vocabulary = encode.fit_vocabulary(joined, "Occupation") if occupations is None else list(occupations)
    return encode.one_hot(filled, "Occupation", vocabulary).drop("Occupation")


@scoped
def run_imputed_training(spark: SparkSession, mart: Datamart, months: int = S.MOB_CUTOFF) -> None:
    """Write the imputed training table after the null gate has passed."""
    features = read_history(spark, mart.path("gold", "feature_store"))
    labels = read_history(spark, mart.path("gold", "label_store"))
    table = imputed_training(features, labels, months=months)
    impute.assert_no_nulls(table)
    write_table(table, mart.path("gold", "training_imputed"))


def detail_features(attributes: DataFrame, financials: DataFrame, loan_types: DataFrame, clickstream: DataFrame,
                    ledger: DataFrame, labels: DataFrame, encoder: PipelineModel | None = None) -> DataFrame:
    """Feature store of the lenient tables: joins, label filter, mean filling,
    exploded one-hot columns and clickstream means up to the first month. The
    joined rows are stored: both fits and the result read them from there."""
    keys = ["customer_id", "snapshot_date"]
    joined = join_all([attributes, financials, loan_types.drop("type_of_loan")], keys)
    joined = joined.drop("name", "ssn", "credit_history_age")
    named = labels.select(F.col(S.CUSTOMER).alias("customer_id")).distinct()
    joined = joined.join(shuffled(named), "customer_id", "left_semi")
    joined = joined.withColumn(
        "credit_history_age_month", F.col("credit_history_age_year") * 12 + F.col("credit_history_age_month")
    ).drop("credit_history_age_year")
    joined = cut_lineage(joined)
    filled = impute.fill(joined, impute.fit_means(joined, numeric_columns(joined)))
    if encoder is None:
        encoder = encode.fit_one_hot_ml(filled, DETAIL_CATEGORIES)
    wide = encode.apply_one_hot_ml(filled, encoder, explode=True)
    starts = ledger.where(F.col("mob") == 0).select(S.CUSTOMER, F.col(S.SNAPSHOT).alias("mob_date"))
    means = history_means(clickstream, starts, S.CLICKSTREAM_COLS, inclusive=True)
    return wide.join(shuffled(means.withColumnRenamed(S.CUSTOMER, "customer_id")), "customer_id", "left")


def financial_features(training: DataFrame, exact: bool = True) -> DataFrame:
    """Modelling features of the financials: fill, filter, cap, ratios, one-hot.

    Expects typed financials with the text categories kept (Credit_Mix,
    Payment_Behaviour, Payment_of_Min_Amount, Credit_History_Age, Type_of_Loan).
    The rows are stored before the first fit: all three fits and the result read
    them from there, so the sources are scanned and joined once.
    """
    df = training.withColumns({
        "Credit_Mix": C.fill_category("Credit_Mix"),
        "Payment_Behaviour": C.fill_category("Payment_Behaviour"),
        "Changed_Credit_Limit": F.coalesce("Changed_Credit_Limit", F.lit(0.0)),
    }).where(F.col("Monthly_Balance").isNotNull())
    df = cut_lineage(df)
    df = impute.fill(df, impute.fit_medians(df, ["Outstanding_Debt"], exact))
    df = df.withColumns({
        "credit_history_months": C.duration_to_months("Credit_History_Age", months_required=False),
        "num_loan_types": C.list_distinct_count("Type_of_Loan"),
    }).drop("Credit_History_Age", "Type_of_Loan")
    df = impute.cap(df, impute.fit_caps(df, QUANTILE_CAPPED, 0.01, 0.95, exact))
    df = df.withColumns({c: C.cap_constant(c, float(high)) for c, high in S.BUSINESS_CAPS.items()})
    df = df.withColumns({
        **financial_ratios(),
        "has_credit_limit_change": R.change_flag("Changed_Credit_Limit", null_as_zero=True),
        "credit_limit_decreased": R.decrease_flag("Changed_Credit_Limit"),
        "abs_credit_change": F.abs("Changed_Credit_Limit"),
    })
    encoder = encode.fit_one_hot_ml(df, FINANCIAL_CATEGORIES, drop_last=True)
    return encode.apply_one_hot_ml(df, encoder)


def attribute_features(training: DataFrame, exact: bool = True) -> DataFrame:
    """Modelling features of the attributes: age filled and banded, rare
    occupations grouped, both one-hot encoded. The rows are stored before the
    first fit: all fits and the result read them from there."""
    df = cut_lineage(training.withColumn("Age_clean", C.digits_only("Age")))
    median = impute.fit_medians(df, ["Age_clean"], exact)
    edges, labels = S.AGE_BANDS_FEATURE
    common = encode.fit_common_values(df, "Occupation")
    df = df.withColumn("Age_clean", F.coalesce("Age_clean", F.lit(int(median["Age_clean"])))).withColumns({
        "Age_group": C.bin_numeric("Age_clean", edges, labels),
        "Occ_clean": encode.group_rare("Occupation", common),
    })
    return encode.apply_one_hot_ml(df, encode.fit_one_hot_ml(df, ["Age_group", "Occ_clean"], drop_last=True))


def fill_spine(features: DataFrame, exact: bool = True) -> DataFrame:
    """Fill the left-joined spine table and add presence flags."""
    loans = {c: 0.0 for c in ("tot_loan_amt", "tot_overdue", "tot_balance", "avg_dpd")}
    texts = {"Credit_Mix": "Unknown", "Payment_Behaviour": "Unknown", "Type_of_Loan": "None"}
    df = impute.fill(features, {**loans, **texts})
    df = impute.fill(df, impute.fit_medians(df, ["Age"], exact))
    flags = {"has_loan": R.presence_flag(F.col("tot_loan_amt") > 0)}
    if "Credit_Mix" in df.columns:
        flags["has_credit_mix"] = R.presence_flag(F.col("Credit_Mix") != "Unknown")
    return df.withColumns(flags)
