"""Loan tables derived from the driver tables.

The driver tables hold no loans and no dirt, so four raw sources (ledger,
attributes, financials, clickstream) and a prediction table are derived from
``orders``, ``customer`` and ``events`` by deterministic rules. Column rules
are SQL expressions both engines read (``DIV`` becomes ``//`` for DuckDB); the
row logic is built twice, with DataFrames here and as common table expressions
in :mod:`checks.oracles`. Every rule covers the whole table.
"""

from __future__ import annotations

import math
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditspine import schemas as S
from creditspine.operators.joins import feature_store, label_join, shuffled
from creditspine.operators.ledger import build_labels
from creditspine.plans import silver
from creditspine.sources.session import cut_lineage, shuffles_freed

TRAIN_DATE = "1996-01-01"
TRAIN_MONTHS = 10
OOT_MONTHS = 2
LOAN_TYPES = [
    "Auto Loan", "Credit-Builder Loan", "Home Equity Loan", "Mortgage Loan", "Not Specified", "Payday Loan",
    "Personal Loan", "Student Loan",
]
EVENT_TYPES = ["view", "signup", "click", "error", "purchase"]


def money(cents: str) -> str:
    """Cents as decimal text."""
    return (
        f"case when ({cents}) < 0 then '-' else '' end || cast(abs({cents}) DIV 100 as string) || '.' || "
        f"lpad(cast(abs({cents}) % 100 as string), 2, '0')"
    )


# --- ledger: one row per order and month 0..10 -----------------------------------
ORDER_RULES = {
    "k": "o_orderkey",
    "c": "o_custkey",
    "start": "cast(date_trunc('month', o_orderdate) as date)",
    "loan_c": "cast(round(o_totalprice * 100) as bigint)",
}
RISK_RULES = {  # how a loan goes bad: 0, 1 = misses all, 2 = pays halves, 3 = misses month 6, 9 = pays
    "kind": (
        "case when (k * 31 + c * 17) % 100 < case when c % 3 = 0 then 50 when c % 3 = 1 then 25 else 12 end "
        "then (k * 31 + c * 17) % 4 else 9 end"
    ),
    "first_miss": "2 + k % 5",
    "due_base": "loan_c DIV 10",
}
MONTH_RULES = {
    "halves": (
        "case when kind in (0, 1) and i >= first_miss then 2 * (i - first_miss + 1) "
        "when kind = 2 and i >= first_miss then 2 * (i - first_miss) + 1 "
        "when kind = 3 and i = 6 then 2 else 0 end"
    ),
    "due_c": "case when i = 0 or (k % 97 = 0 and i = 6) then 0 when k % 101 = 0 and i = 5 then null else due_base end",
}
AMOUNT_RULES = {
    "overdue_c": (
        "case when k % 83 = 0 and i = 4 then null when k % 97 = 0 and i = 6 then 50000 "
        "when k % 101 = 0 and i = 5 then 700 else due_base * halves DIV 2 end"
    ),
    "paid_c": "case when k % 89 = 0 then null when halves > 0 or i = 0 then 0 else due_base end",
    "balance_c": "loan_c - due_base * i",
}
LEDGER_TEXT = {
    "loan_id": "'L' || cast(k as string)",
    "Customer_ID": "'C' || cast(c as string)",
    "loan_start_date": "cast(start as string)",
    "tenure": "'10'",
    "installment_num": "cast(i as string)",
    "loan_amt": money("loan_c"),
    "due_amt": money("due_c"),
    "paid_amt": money("paid_c"),
    "overdue_amt": money("overdue_c"),
    "balance": money("balance_c"),
    "snapshot_date": "cast(snap as string)",
}

# --- attributes and financials: one row per customer at the first loan month --------
PERSON_RULES = {
    "c": "c_custkey",
    "seg": "c_mktsegment",
    "a": "18 + (c_custkey * 7) % 60",
    "bal_c": "abs(cast(round(c_acctbal * 100) as bigint))",
}
ATTRIBUTE_TEXT = {
    "Customer_ID": "'C' || cast(c as string)",
    "Name": "case when c % 6 = 0 then 'Doe, Jo \"J\" ' || cast(c as string) else 'Person ' || cast(c as string) end",
    "Age": (
        "case when c % 43 = 0 then null when c % 29 = 0 then '-500' when c % 31 = 0 then '8547' "
        "when c % 37 = 0 then cast(a as string) || '00_' when c % 13 = 0 then cast(a as string) || '_' "
        "when c % 41 = 0 then cast(a DIV 10 as string) || '_' || cast(a % 10 as string) "
        "when c % 47 = 0 then cast(a as string) || '.7' else cast(a as string) end"
    ),
    "SSN": (
        "case when c % 19 = 0 then '#F%$D@*&8' else lpad(cast(c % 1000 as string), 3, '0') || '-' || "
        "lpad(cast(c % 100 as string), 2, '0') || '-' || lpad(cast((c * 7) % 10000 as string), 4, '0') end"
    ),
    "Occupation": (
        "case when c % 53 = 0 then null when c % 14 = 0 then '_______' when c % 50 = 1 then 'Astronaut' "
        "when c % 23 = 0 then '  ' || seg || ' ' else seg end"
    ),
    "snapshot_date": "cast(snap as string)",
}
FINANCIAL_TEXT = {
    "Customer_ID": "'C' || cast(c as string)",
    "Annual_Income": (
        f"case when c % 59 = 0 then '_' || {money('2000000 + bal_c * 12')} "
        f"when c % 17 = 0 then {money('2000000 + bal_c * 12')} || '_' else {money('2000000 + bal_c * 12')} end"
    ),
    "Monthly_Inhand_Salary": f"case when c % 27 = 0 then null else {money('(2000000 + bal_c * 12) DIV 12')} end",
    "Num_Bank_Accounts": "case when c % 67 = 0 then '1798' when c % 71 = 0 then '-1' else cast(c % 11 as string) end",
    "Num_Credit_Card": "case when c % 73 = 0 then '1499' else cast(c % 9 + 1 as string) end",
    "Interest_Rate": "case when c % 79 = 0 then '5797' else cast(c % 30 + 1 as string) end",
    "Num_of_Loan": "case when c % 33 = 0 then '-100' when c % 17 = 3 then cast(n % 8 as string) || '_' else cast(n % 8 as string) end",
    "Delay_from_due_date": "cast(c % 45 - 3 as string)",
    "Num_of_Delayed_Payment": "case when c % 61 = 0 then '_' when c % 33 = 5 then '-2' else cast(c % 25 as string) end",
    "Changed_Credit_Limit": f"case when c % 21 = 0 then '_' when c % 25 = 0 then '0.00' else {money('(c * 37) % 2000 - 500')} end",
    "Num_Credit_Inquiries": "case when c % 35 = 0 then null when c % 77 = 0 then '1050' else cast(c % 18 as string) end",
    "Outstanding_Debt": f"case when c % 39 = 0 then {money('s % 500000')} || '_' else {money('s % 500000')} end",
    "Credit_Utilization_Ratio": money("2000 + (c * 11) % 2000"),
    "Total_EMI_per_month": money("(c * 13) % 30000"),
    "Amount_invested_monthly": f"case when c % 45 = 0 then '__10000__' else {money('(c * 29) % 60000')} end",
    "Monthly_Balance": f"case when c % 111 = 0 then null else {money('(c * 53) % 90000 - 10000')} end",
    "Type_of_Loan": (
        "case c % 7 when 0 then null when 1 then 'Auto Loan' when 2 then 'Auto Loan, and Personal Loan' "
        "when 3 then 'Student Loan, Mortgage Loan, and Student Loan' when 4 then 'Personal Loan and Auto Loan' "
        "when 5 then 'Credit-Builder Loan, Home Equity Loan, and Payday Loan' else 'Not Specified' end"
    ),
    "Credit_Mix": "case when c % 16 = 0 then '_' when c % 3 = 0 then 'Bad' when c % 3 = 1 then 'Standard' else 'Good' end",
    "Credit_History_Age": (
        "case when c % 65 = 0 then 'NA' when c % 63 = 0 then cast(c % 30 as string) || ' Years' "
        "else cast(c % 30 as string) || ' Years and ' || cast(c % 12 as string) || ' Months' end"
    ),
    "Payment_of_Min_Amount": "case when c % 5 < 2 then 'Yes' when c % 5 < 4 then 'No' else 'NM' end",
    "Payment_Behaviour": (
        "case when c % 22 = 0 then '!@9#%8' else case when c % 2 = 0 then 'High' else 'Low' end || '_spent_' || "
        "case when c DIV 2 % 3 = 0 then 'Small' when c DIV 2 % 3 = 1 then 'Medium' else 'Large' end || '_value_payments' end"
    ),
    "snapshot_date": "cast(snap as string)",
}

# --- clickstream: one row per event user and panel month ------------------------------
CLICK_TEXT = {
    **{f"fe_{t + 1}": f"cast(n_{t} as string)" for t in range(5)},
    **{f"fe_{t + 6}": f"cast(v_{t} as string)" for t in range(5)},
    **{f"fe_{t + 11}": f"cast(v_{t} % 97 - 40 as string)" for t in range(5)},
    **{f"fe_{t + 16}": f"cast(n_{t} * (c % 7) as string)" for t in range(5)},
    "Customer_ID": "'C' || cast(c as string)",
    "snapshot_date": "cast(snap as string)",
}

# --- predictions of two model versions ---------------------------------------------------
SCORES = {
    "A": "cast((c * 37) % 600 + (2 - c % 3) * 200 as double) / 1000",
    "B": "case when c % 211 = 0 then null else cast((c * 53) % 800 + (2 - c % 3) * 100 as double) / 1000 end",
}


def duck(expr: str) -> str:
    return expr.replace(" DIV ", " // ")


def _select(df: DataFrame, rules: dict[str, str], *keep: str) -> DataFrame:
    return df.selectExpr(*keep, *[f"{e} as {n}" for n, e in rules.items()])


_STORED: dict[tuple[str, str, str], DataFrame] = {}
#: Driver rows of a part; a loan becomes eleven ledger rows of text.
ROWS_PER_PART = 1 << 17


class Testbed:
    """The derived tables over one driver data folder (all lazy, built once)."""

    __test__ = False  # not a test case, despite the name

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    @cache
    def table(self, name: str) -> DataFrame:
        """A driver table in parts of about equal size: a file may hold all its
        rows in one row group, so its splits say nothing about where rows are."""
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return df.repartition(max(self.spark.sparkContext.defaultParallelism, math.ceil(df.count() / ROWS_PER_PART)))

    def _spread(self, df: DataFrame) -> DataFrame:
        """Give a stored table of fewer splits than there are cores one part per
        core; tables of any size have more splits and are left alone."""
        cores = self.spark.sparkContext.defaultParallelism
        return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df

    # raw sources ------------------------------------------------------------
    @cache
    def _orders(self) -> DataFrame:
        return _select(self.table("orders"), ORDER_RULES)

    @cache
    def _first_month(self) -> DataFrame:
        return self._orders().groupBy("c").agg(
            F.min("start").alias("snap"), F.count(F.lit(1)).alias("n"), F.sum("loan_c").alias("s")
        )

    @cache
    def _people(self) -> DataFrame:
        return _select(self.table("customer"), PERSON_RULES).join(shuffled(self._first_month()), "c")

    @cache
    def raw_ledger(self) -> DataFrame:
        loans = _select(self._orders(), RISK_RULES, "*")
        months = loans.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(10))))
        months = _select(_select(months, MONTH_RULES, "*"), AMOUNT_RULES, "*")
        return _select(months.withColumn("snap", F.add_months("start", F.col("i"))), LEDGER_TEXT)

    @cache
    def raw_attributes(self) -> DataFrame:
        return _select(self._people(), ATTRIBUTE_TEXT)

    @cache
    def raw_financials(self) -> DataFrame:
        return _select(self._people(), FINANCIAL_TEXT)

    @cache
    def raw_clickstream(self) -> DataFrame:
        cents = F.round(F.col("value") * 100).cast("bigint")
        events = self.table("events").select(
            F.col("user_id").alias("c"), F.col("event_type"), cents.alias("v"),
            ((F.dayofmonth("ts") - 1) % 12).alias("m"),
        )
        panel = events.groupBy("c", "m").agg(
            *[F.count_if(F.col("event_type") == e).alias(f"n_{t}") for t, e in enumerate(EVENT_TYPES)],
            *[F.sum(F.when(F.col("event_type") == e, F.col("v"))).alias(f"v_{t}") for t, e in enumerate(EVENT_TYPES)],
        )
        dated = panel.join(shuffled(self._first_month().select("c", "snap")), "c")
        return _select(dated.withColumn("snap", F.add_months("snap", F.col("m") - 4)), CLICK_TEXT)

    # silver and gold ------------------------------------------------------------
    @cache
    def ledger(self) -> DataFrame:
        return silver.silver_ledger(self.stored("raw_ledger"))

    @cache
    def attributes(self) -> DataFrame:
        return silver.silver_attributes(self.stored("raw_attributes"))

    @cache
    def financials(self) -> DataFrame:
        return silver.silver_financials(self.stored("raw_financials"))

    @cache
    def clickstream(self) -> DataFrame:
        return silver.silver_clickstream(self.stored("raw_clickstream"))

    @cache
    def labels(self) -> DataFrame:
        return build_labels(self.ledger())

    @cache
    def features(self) -> DataFrame:
        return feature_store(self.attributes(), self.financials(), self.clickstream(), "left")

    @cache
    def training(self) -> DataFrame:
        return label_join(self.features(), self.labels(), direction="back")

    @cache
    def detail_training(self) -> DataFrame:
        """Cleaned numbers with the raw text categories and the label."""
        raw = self.stored("raw_financials")
        typed = raw.withColumns({
            **silver._financial_numbers(),
            "snapshot_date": F.to_date("snapshot_date"),
            "Credit_Mix": F.when(F.col("Credit_Mix") != "_", F.col("Credit_Mix")),
            "Payment_Behaviour": F.when(~F.col("Payment_Behaviour").startswith("!"), F.col("Payment_Behaviour")),
        })
        return label_join(typed, self.labels(), direction="back")

    @cache
    def attribute_training(self) -> DataFrame:
        raw = self.stored("raw_attributes").withColumns({
            "snapshot_date": F.to_date("snapshot_date"),
            "Occupation": F.when(F.col("Occupation") != "_______", F.trim("Occupation")),
        })
        return label_join(raw, self.labels(), direction="back")

    def stored(self, name: str) -> DataFrame:
        """A derived table written out once per session, so that queries start
        from stored tables as the jobs do."""
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _STORED:
            with shuffles_freed(self.spark):
                _STORED[key] = cut_lineage(getattr(self, name)(), compression="zstd")
        return self._spread(_STORED[key])

    # scores -------------------------------------------------------------------------
    @cache
    def predictions(self) -> DataFrame:
        people = self._people()
        parts = [
            people.selectExpr(
                "'C' || cast(c as string) as Customer_ID", "snap as snapshot_date", f"'model_{v}' as model_name",
                f"'{v}' as model_version", f"{e} as model_predictions", "c",
            )
            for v, e in SCORES.items()
        ]
        return parts[0].unionByName(parts[1])

    @cache
    def scored(self) -> DataFrame:
        """Predictions with matured label and a fixed split by customer."""
        labels = self.labels().select(
            S.CUSTOMER, F.add_months(S.SNAPSHOT, -6).alias(S.SNAPSHOT), "label"
        )
        joined = self.predictions().join(shuffled(labels), S.KEYS)
        part = F.when(F.col("c") % 10 < 7, "train").when(F.col("c") % 10 < 9, "val").otherwise("test")
        return joined.withColumn("split", part)
