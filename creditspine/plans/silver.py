"""Bronze to silver: cleaned, typed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditspine import schemas as S
from creditspine.functions import cleaning as C
from creditspine.functions import ratios as R
from creditspine.operators.encode import fit_list_keys, list_counts, list_flags, one_hot
from creditspine.operators.impute import cap_within
from creditspine.operators.ledger import add_delinquency
from creditspine.operators.projection import enforce_types, lower_columns
from creditspine.sources.snapshots import Datamart, read_bronze, write_snapshot

CAPPED_IN_DETAIL = ["num_bank_accounts", "num_credit_card", "interest_rate", "num_of_loan", "num_of_delayed_payment"]
NON_NEGATIVE_IN_DETAIL = ["num_of_loan", "delay_from_due_date", "num_of_delayed_payment"]


def silver_ledger(raw: DataFrame, fill_all: bool = True) -> DataFrame:
    return add_delinquency(enforce_types(raw, S.LEDGER_TYPES), fill_all)


def silver_clickstream(raw: DataFrame) -> DataFrame:
    return enforce_types(raw, S.CLICKSTREAM_TYPES)


def silver_attributes(raw: DataFrame) -> DataFrame:
    """Age 1..100 with its band, clean occupation, no identifiers."""
    age = C.clean_numeric("Age", "int", 1, 100)
    edges, labels = S.AGE_BANDS_SILVER
    return raw.select(
        S.CUSTOMER, F.col(S.SNAPSHOT).try_cast("date").alias(S.SNAPSHOT), age.alias("Age"),
        C.null_placeholder("Occupation").alias("Occupation"),
    ).withColumn("Age_group", C.bin_numeric("Age", edges, labels))


def silver_attributes_flags(raw: DataFrame, occupations: Sequence[str]) -> DataFrame:
    """The form with one 0/1 column per occupation of a fitted vocabulary."""
    return one_hot(silver_attributes(raw).drop("Age_group"), "Occupation", occupations)


def detail_attributes(raw: DataFrame) -> DataFrame:
    """The lenient form: first number as age 0..120, identifiers kept but checked."""
    t = lower_columns(raw)
    return t.select(
        "customer_id", "name",
        C.valid_range(C.extract_number("age", "int"), 0, 120).alias("age"),
        C.valid_pattern("ssn").alias("ssn"),
        C.null_tokens("occupation", ["_______"]).alias("occupation"),
        F.col("snapshot_date").try_cast("date").alias("snapshot_date"),
    )


def _financial_numbers() -> dict:
    return {c: C.clean_numeric(c, dtype, low, high) for c, (dtype, low, high) in S.FINANCIAL_RULES.items()}


def _financial_categories(value_ranks) -> dict:
    return {
        "Credit_Mix_Label": C.ordinal_map("Credit_Mix", S.CREDIT_MIX_RANK),
        "Credit_History_Months": C.duration_to_months("Credit_History_Age"),
        "Payment_of_Min_Amount": C.yes_flag("Payment_of_Min_Amount"),
        "Spending_Level": C.behaviour_level("Payment_Behaviour", S.SPENT_RANK),
        "Payment_Value": C.behaviour_value("Payment_Behaviour", value_ranks),
    }


def financial_ratios() -> dict:
    """Log, ratio and change columns over cleaned financials."""
    return {
        "log_Annual_Income": R.log1p("Annual_Income"),
        "debt_to_income": R.safe_ratio("Outstanding_Debt", "Annual_Income", 1),
        "emi_to_salary": R.safe_ratio("Total_EMI_per_month", "Monthly_Inhand_Salary", 1),
        "investment_rate": R.safe_ratio("Amount_invested_monthly", "Monthly_Inhand_Salary", 1),
        "balance_to_debt": R.safe_ratio("Monthly_Balance", "Outstanding_Debt", 1, 1),
        "inq_per_loan": R.safe_ratio("Num_Credit_Inquiries", "Num_of_Loan", 1),
    }


def silver_financials(raw: DataFrame, value_ranks=S.VALUE_RANK, legacy_split: bool = False) -> DataFrame:
    """Typed financials with loan-type count, category ranks and ratios."""
    numbers = _financial_numbers()
    cleaned = raw.select(
        S.CUSTOMER, F.col(S.SNAPSHOT).try_cast("date").alias(S.SNAPSHOT),
        *[e.alias(c) for c, e in numbers.items()],
        C.list_distinct_count("Type_of_Loan", legacy_split).alias("num_loan_types"),
        *[e.alias(c) for c, e in _financial_categories(value_ranks).items()],
    )
    return cleaned.withColumns({
        **financial_ratios(),
        "has_credit_limit_change": R.change_flag("Changed_Credit_Limit"),
    })


def silver_financials_flags(raw: DataFrame, loan_types: Sequence[str], value_ranks=S.VALUE_RANK) -> DataFrame:
    """The form with one 0/1 column per loan type of a fitted vocabulary."""
    flagged = list_flags(raw, "Type_of_Loan", loan_types)
    flags = [c for c in flagged.columns if c not in raw.columns]
    return flagged.select(
        S.CUSTOMER, F.col(S.SNAPSHOT).try_cast("date").alias(S.SNAPSHOT),
        *[e.alias(c) for c, e in _financial_numbers().items()],
        *[e.alias(c) for c, e in _financial_categories(value_ranks).items()],
        *flags,
    )


def detail_financials(raw: DataFrame, cap_share: float = 0.97) -> DataFrame:
    """The lenient form: first numeric token, negatives of counts nulled, counts
    capped at a quantile of their own month, behaviour split into two texts."""
    t = lower_columns(raw)
    numbers = {}
    for name, (dtype, _, _) in S.FINANCIAL_RULES.items():
        c = name.lower()
        value = C.extract_number(c, "double" if c == "num_credit_inquiries" else dtype)
        numbers[c] = C.valid_range(value, 0) if c in NON_NEGATIVE_IN_DETAIL else value
    cleaned = t.select(
        "customer_id", F.col("snapshot_date").try_cast("date").alias("snapshot_date"),
        *[e.alias(c) for c, e in numbers.items()],
        C.null_tokens("credit_mix", ["_"]).alias("credit_mix"),
        "credit_history_age",
        C.duration_part("credit_history_age", "Year").alias("credit_history_age_year"),
        C.duration_part("credit_history_age", "Month").alias("credit_history_age_month"),
        "payment_of_min_amount",
        C.behaviour_part("payment_behaviour", 1).alias("payment_behaviour_spent"),
        C.behaviour_part("payment_behaviour", 2).alias("payment_behaviour_value"),
    )
    return cap_within(cleaned, CAPPED_IN_DETAIL, cap_share, ["snapshot_date"])


def loan_type_table(raw: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Side table: loans per type and customer snapshot."""
    t = lower_columns(raw).select(
        "customer_id", F.col("snapshot_date").try_cast("date").alias("snapshot_date"), "type_of_loan"
    )
    return list_counts(t, "type_of_loan", keys)


SILVER = {
    "ledger": silver_ledger,
    "attributes": silver_attributes,
    "financials": silver_financials,
    "clickstream": silver_clickstream,
}


def run_silver(spark: SparkSession, mart: Datamart, table: str, start=None, end=None, fmt: str = "parquet") -> None:
    """Clean the months in ``[start, end]`` of one table (all by default)."""
    raw = read_bronze(spark, mart, table, fmt)
    if start is not None:
        raw = raw.where(F.col(S.SNAPSHOT) >= F.lit(start).cast("date"))
    if end is not None:
        raw = raw.where(F.col(S.SNAPSHOT) <= F.lit(end).cast("date"))
    write_snapshot(SILVER[table](raw), mart.path("silver", table))
    if table == "financials":
        # one list of loan types, from all months, so that every month has the same columns
        keys = fit_list_keys(read_bronze(spark, mart, table, fmt), "Type_of_Loan")
        write_snapshot(loan_type_table(raw, keys), mart.path("silver", "loan_types"))
