"""Schemas, column groups and thresholds.

Everything in this module is a fixed value: column names, category ranks and
alert bands that results depend on.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Keys -------------------------------------------------------
CUSTOMER = "Customer_ID"
SNAPSHOT = "snapshot_date"
LOAN = "loan_id"
KEYS = [CUSTOMER, SNAPSHOT]

# Source columns ---------------------------------------------
CLICKSTREAM_COLS = [f"fe_{i}" for i in range(1, 21)]
ATTRIBUTES_COLS = ["Age", "Occupation", "Age_group"]
FINANCIALS_COLS = [
    "Annual_Income",
    "Monthly_Inhand_Salary",
    "Num_Bank_Accounts",
    "Num_Credit_Card",
    "Interest_Rate",
    "Num_of_Loan",
    "Changed_Credit_Limit",
    "Num_Credit_Inquiries",
    "Credit_Utilization_Ratio",
    "Total_EMI_per_month",
    "Amount_invested_monthly",
    "Monthly_Balance",
    "num_loan_types",
    "Credit_Mix_Label",
    "Credit_History_Months",
    "Spending_Level",
    "Payment_Value",
    "log_Annual_Income",
    "debt_to_income",
    "emi_to_salary",
    "investment_rate",
    "balance_to_debt",
    "inq_per_loan",
    "has_credit_limit_change",
]
FEATURE_SOURCES = {
    "attributes": ATTRIBUTES_COLS,
    "financials": FINANCIALS_COLS,
    "clickstream": CLICKSTREAM_COLS,
}
IDENTIFIER_COLS = ["Name", "SSN"]
LEAKAGE_COLS = [
    "Num_of_Delayed_Payment",
    "Delay_from_due_date",
    "Outstanding_Debt",
    "Payment_of_Min_Amount",
]
MEDIAN_IMPUTE_COLS = [
    "Age",
    "Num_Bank_Accounts",
    "Num_Credit_Card",
    "Interest_Rate",
    "Num_of_Loan",
    "Changed_Credit_Limit",
    "Amount_invested_monthly",
    "Monthly_Balance",
    "Credit_Mix_Label",
    "Spending_Level",
    "Payment_Value",
    "Annual_Income",
]
CATEGORICAL_COLS = ["Occupation", "Age_group"]
ID_COLS = [CUSTOMER, LOAN, SNAPSHOT]
LABEL_COLS = ["label", "label_def"]

# Numeric rules of the financials table (type, low, high) ------
FINANCIAL_RULES = {
    "Annual_Income": ("double", 0, None),
    "Monthly_Inhand_Salary": ("double", 0, None),
    "Num_Bank_Accounts": ("int", 0, 100),
    "Num_Credit_Card": ("int", 0, 100),
    "Interest_Rate": ("int", 0, 100),
    "Num_of_Loan": ("int", 0, 100),
    "Delay_from_due_date": ("int", 0, None),
    "Num_of_Delayed_Payment": ("int", 0, None),
    "Changed_Credit_Limit": ("double", None, None),
    "Num_Credit_Inquiries": ("int", 0, None),
    "Outstanding_Debt": ("double", 0, None),
    "Credit_Utilization_Ratio": ("double", 0, None),
    "Total_EMI_per_month": ("double", 0, None),
    "Amount_invested_monthly": ("double", 0, None),
    "Monthly_Balance": ("double", None, None),
}
FINANCIAL_TEXT_COLS = [
    "Type_of_Loan",
    "Credit_Mix",
    "Credit_History_Age",
    "Payment_of_Min_Amount",
    "Payment_Behaviour",
]

# Category ranks ----------------------------------------------
CREDIT_MIX_RANK = {"Good": 2, "Standard": 1, "Bad": 0}
SPENT_RANK = {"High": 1, "Low": 0}
VALUE_RANK = {"Large": 2, "Medium": 1, "Small": 0}
VALUE_RANK_LEGACY = {"High": 2, "Medium": 1, "Small": 0}

# Age bands (upper edges, labels) -------------------------------
AGE_BANDS_SILVER = ([25, 40, 60], ["<25", "25-39", "40-59", "60+"])
AGE_BANDS_FEATURE = ([25, 35, 50], ["<25", "25-34", "35-49", "50+"])
AGE_BANDS_REPORT = (
    [25, 35, 45, 55],
    ["Under 25", "25-34", "35-44", "45-54", "55+"],
)

# Business caps --------------------------------------------------
BUSINESS_CAPS = {
    "Num_Bank_Accounts": 20,
    "Num_Credit_Card": 10,
    "Interest_Rate": 100,
    "Num_of_Delayed_Payment": 30,
    "Num_Credit_Inquiries": 20,
}
REPORT_CAPS = {
    "Num_Bank_Accounts": 20,
    "Num_Credit_Card": 20,
    "Num_Credit_Inquiries": 50,
}

# Label definition and training window -----------------------------
DPD_CUTOFF = 30
MOB_CUTOFF = 6
TRAIN_DATE = "2024-07-01"
TRAIN_TEST_MONTHS = 16
OOT_MONTHS = 2
SPLIT_SHARES = (0.7, 0.2, 0.1)
CHALLENGER_UPLIFT = 0.05
MODEL_ROLES = {"logistic_regression": "champion", "boosted_trees": "challenger"}

# Alert bands ---------------------------------------------------------
PERFORMANCE_BANDS = {  # metric: (green at or above, yellow at or above, yellow top shown)
    "recall": (0.80, 0.60, 0.79),
    "accuracy": (0.78, 0.70, 0.77),
    "auc": (0.90, 0.75, 0.89),
}
PSI_BANDS = (0.10, 0.20)  # green up to, yellow up to
PVALUE_BANDS = (0.05, 0.01)  # green above, yellow above
MISSING_RED = 0.5
ALERT_RANK = {"GREEN": 0, "YELLOW": 1, "RED": 2}


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Raw sources: every column that may be dirty is read as text, never inferred.
RAW_LEDGER = _strings(
    LOAN, CUSTOMER, "loan_start_date", "tenure", "installment_num", "loan_amt",
    "due_amt", "paid_amt", "overdue_amt", "balance", SNAPSHOT,
)
RAW_ATTRIBUTES = _strings(CUSTOMER, "Name", "Age", "SSN", "Occupation", SNAPSHOT)
RAW_FINANCIALS = _strings(CUSTOMER, *FINANCIAL_RULES, *FINANCIAL_TEXT_COLS, SNAPSHOT)
RAW_CLICKSTREAM = _strings(*CLICKSTREAM_COLS, CUSTOMER, SNAPSHOT)
RAW_SCHEMAS = {
    "ledger": RAW_LEDGER,
    "attributes": RAW_ATTRIBUTES,
    "financials": RAW_FINANCIALS,
    "clickstream": RAW_CLICKSTREAM,
}

MONEY = "decimal(18,2)"
LEDGER_TYPES = {
    LOAN: "string",
    CUSTOMER: "string",
    "loan_start_date": "date",
    "tenure": "int",
    "installment_num": "int",
    "loan_amt": MONEY,
    "due_amt": MONEY,
    "paid_amt": MONEY,
    "overdue_amt": MONEY,
    "balance": MONEY,
    SNAPSHOT: "date",
}
CLICKSTREAM_TYPES = {CUSTOMER: "string", SNAPSHOT: "date", **{c: "int" for c in CLICKSTREAM_COLS}}
