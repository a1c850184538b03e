"""Ledger, cleaning, table-building and join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import oracles as O
from checks import testbed as T
from checks.registry import query
from creditspine import schemas as S
from creditspine.functions import cleaning as C
from creditspine.functions import ratios as R
from creditspine.operators import encode, impute, joins, ledger, projection
from creditspine.plans import gold, silver
from creditspine.sources.snapshots import month_spine

KEY = {"Customer_ID": "s", "snapshot_date": "d"}
LEDGER_KINDS = {
    "loan_id": "s", "Customer_ID": "s", "loan_start_date": "d", "tenure": "i", "installment_num": "i", "loan_amt": "f",
    "due_amt": "f", "paid_amt": "f", "overdue_amt": "f", "balance": "f", "snapshot_date": "d", "mob": "i",
    "installments_missed": "i", "first_missed_date": "d", "dpd": "i",
}
LABEL_KINDS = {"loan_id": "s", "Customer_ID": "s", "label": "i", "label_def": "s", "snapshot_date": "d"}
ATTRIBUTE_KINDS = {**KEY, "Age": "i", "Occupation": "s", "Age_group": "s"}
INTEGER_FINANCIALS = {
    *[c for c, r in S.FINANCIAL_RULES.items() if r[0] == "int"], "num_loan_types", "Credit_Mix_Label",
    "Credit_History_Months", "Payment_of_Min_Amount", "Spending_Level", "Payment_Value", "has_credit_limit_change",
}
FINANCIAL_KINDS = {c: ("i" if c in INTEGER_FINANCIALS else "f") for c in S.FINANCIALS_COLS}
FULL_FINANCIAL_KINDS = {
    **KEY, **FINANCIAL_KINDS, "Delay_from_due_date": "i", "Num_of_Delayed_Payment": "i", "Outstanding_Debt": "f",
    "Payment_of_Min_Amount": "i",
}
CLICK_KINDS = {c: "i" for c in S.CLICKSTREAM_COLS}
FEATURE_KINDS = {**ATTRIBUTE_KINDS, **FINANCIAL_KINDS, **CLICK_KINDS}
TRAINING_KINDS = {**FEATURE_KINDS, "loan_id": "s", "label": "i", "label_def": "s"}


# --- spine and ledger --------------------------------------------------------------
@query("month_spine", "snapshot_date:d", (
    "SELECT CAST(unnest(generate_series(date_trunc('month', lo), hi, INTERVAL 1 MONTH)) AS DATE) AS snapshot_date "
    "FROM (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders)"
))
def _(t):
    bounds = t.table("orders").agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    return month_spine(bounds, "lo", "hi")


query("silver_ledger", LEDGER_KINDS, "SELECT * FROM led")(lambda t: t.ledger())
query("label_store", LABEL_KINDS, "SELECT * FROM labels")(lambda t: t.labels())
query("labels_at_mob_9_dpd_60", LABEL_KINDS, (
    "SELECT loan_id, Customer_ID, CASE WHEN dpd >= 60 THEN 1 ELSE 0 END AS label, '60dpd_9mob' AS label_def, snapshot_date "
    "FROM led WHERE mob = 9"
))(lambda t: ledger.build_labels(t.ledger(), mob=9, dpd=60))
query("silver_ledger_fill_missed_only", "loan_id:s installment_num:i due_amt:f paid_amt:f overdue_amt:f installments_missed:i dpd:i", (
    "SELECT l.loan_id, l.installment_num, a.due_c / 100 AS due_amt, a.paid_c / 100 AS paid_amt, a.overdue_c / 100 AS overdue_amt, "
    "l.installments_missed, l.dpd FROM led l JOIN amounts a ON l.loan_id = 'L' || a.k AND l.installment_num = a.i"
))(lambda t: silver.silver_ledger(t.stored("raw_ledger"), fill_all=False))
query("bad_rate_curve", "mob:i bad_rate:f", (
    "SELECT mob, avg(CASE WHEN dpd >= 30 THEN 1.0 ELSE 0 END) AS bad_rate FROM led WHERE loan_start_date < DATE '2000-01-01' GROUP BY mob"
))(lambda t: ledger.bad_rate_curve(t.ledger(), 30, "2000-01-01"))
query("final_bads", LEDGER_KINDS, "SELECT * FROM led WHERE installment_num = 10")(lambda t: ledger.final_bads(t.ledger()))
query("default_rate_by_snapshot", "snapshot_date:d total:i label_1:i pct_label_1:f", (
    "SELECT snapshot_date, count(*) AS total, sum(label) AS label_1, round(avg(label), 3) AS pct_label_1 FROM labels GROUP BY snapshot_date"
))(lambda t: ledger.default_rate_by_snapshot(t.ledger()))
query("label_distribution", "label:i count:i percentage:f", (
    "SELECT label, count(*) AS count, round(count(*) * 100.0 / sum(count(*)) OVER (), 1) AS percentage FROM labels GROUP BY label"
))(lambda t: ledger.label_distribution(t.labels()))
query("matured_customers", "customers:i matured:i", (
    "SELECT count(DISTINCT Customer_ID) AS customers, count(DISTINCT CASE WHEN mob = 6 THEN Customer_ID END) AS matured FROM led"
))(lambda t: ledger.matured_customers(t.ledger()))
query("date_range_filter", "snapshot_date:d n:i", (
    "SELECT snapshot_date, count(*) AS n FROM led WHERE snapshot_date BETWEEN DATE '1996-02-01' AND DATE '1996-07-01' GROUP BY snapshot_date"
))(lambda t: projection.between_dates(t.ledger(), "1996-02-01", "1996-07-01").groupBy("snapshot_date").agg(F.count("*").alias("n")))
query("one_snapshot", LEDGER_KINDS, "SELECT * FROM led WHERE snapshot_date = DATE '1996-03-01'")(
    lambda t: projection.at_snapshot(t.ledger(), "1996-03-01"))


# --- cleaning ---------------------------------------------------------------------
@query("clean_numeric", "Customer_ID:s Annual_Income:f Num_Bank_Accounts:i Changed_Credit_Limit:f Amount_invested_monthly:f", (
    "SELECT Customer_ID, " + ", ".join(
        f"{O.clean(c, *S.FINANCIAL_RULES[c])} AS {c}"
        for c in ("Annual_Income", "Num_Bank_Accounts", "Changed_Credit_Limit", "Amount_invested_monthly")
    ) + " FROM fin_raw"
))
def _(t):
    return t.stored("raw_financials").select("Customer_ID", *[
        C.clean_numeric(c, *S.FINANCIAL_RULES[c]).alias(c)
        for c in ("Annual_Income", "Num_Bank_Accounts", "Changed_Credit_Limit", "Amount_invested_monthly")
    ])


query("extract_number", "Customer_ID:s Num_of_Loan:i Annual_Income:f", (
    f"SELECT Customer_ID, {O.lenient('Num_of_Loan', 'int')} AS Num_of_Loan, {O.lenient('Annual_Income', 'double')} AS Annual_Income FROM fin_raw"
))(lambda t: t.stored("raw_financials").select(
    "Customer_ID", C.extract_number("Num_of_Loan", "int").alias("Num_of_Loan"),
    C.extract_number("Annual_Income", "double").alias("Annual_Income")))
query("digits_only", "Customer_ID:s Age_clean:i", (
    "SELECT Customer_ID, CASE WHEN v BETWEEN 18 AND 100 THEN v END AS Age_clean FROM "
    "(SELECT Customer_ID, try_cast(nullif(regexp_replace(Age, '[^0-9]', '', 'g'), '') AS INTEGER) AS v FROM att_raw)"
))(lambda t: t.stored("raw_attributes").select("Customer_ID", C.digits_only("Age").alias("Age_clean")))
query("valid_range", "Customer_ID:s age:i delay:i", (
    f"SELECT a.Customer_ID, CASE WHEN a.v BETWEEN 0 AND 120 THEN a.v END AS age, CASE WHEN f.d >= 0 THEN f.d END AS delay "
    f"FROM (SELECT Customer_ID, {O.lenient('Age', 'int')} AS v FROM att_raw) a "
    f"JOIN (SELECT Customer_ID, {O.lenient('Delay_from_due_date', 'int')} AS d FROM fin_raw) f USING (Customer_ID)"
))(lambda t: t.stored("raw_attributes").join(t.stored("raw_financials"), "Customer_ID").select(
    "Customer_ID", C.valid_range(C.extract_number("Age", "int"), 0, 120).alias("age"),
    C.valid_range(C.extract_number("Delay_from_due_date", "int"), 0).alias("delay")))
query("null_placeholder", "Customer_ID:s by_pattern:s by_token:s", (
    f"SELECT Customer_ID, {O.clean_occupation()} AS by_pattern, nullif(Occupation, '_______') AS by_token FROM att_raw"
))(lambda t: t.stored("raw_attributes").select(
    "Customer_ID", C.null_placeholder("Occupation").alias("by_pattern"),
    C.null_tokens("Occupation", ["_______"]).alias("by_token")))
query("valid_pattern", "Customer_ID:s SSN:s", (
    "SELECT Customer_ID, CASE WHEN regexp_matches(SSN, '^\\d{3}-\\d{2}-\\d{4}$') THEN SSN END AS SSN FROM att_raw"
))(lambda t: t.stored("raw_attributes").select("Customer_ID", C.valid_pattern("SSN").alias("SSN")))
query("malformed_ssn", "SSN:s", (
    "SELECT DISTINCT SSN FROM att_raw WHERE NOT regexp_matches(SSN, '^\\d{3}-\\d{2}-\\d{4}$')"
))(lambda t: projection.rows_not_matching(t.stored("raw_attributes"), "SSN", C.SSN_PATTERN))
query("ordinal_map", "Customer_ID:s rank:i", (
    f"SELECT Customer_ID, {O.CATEGORY_RANKS['Credit_Mix_Label']} AS rank FROM fin_raw"
))(lambda t: t.stored("raw_financials").select("Customer_ID", C.ordinal_map("Credit_Mix", S.CREDIT_MIX_RANK).alias("rank")))
query("yes_flag", "Customer_ID:s flag:i", (
    "SELECT Customer_ID, CAST(Payment_of_Min_Amount = 'Yes' AS INTEGER) AS flag FROM fin_raw"
))(lambda t: t.stored("raw_financials").select("Customer_ID", C.yes_flag("Payment_of_Min_Amount").alias("flag")))
query("split_behaviour", "Customer_ID:s level:i value:i legacy:i spent:s size:s", (
    f"SELECT Customer_ID, {O.CATEGORY_RANKS['Spending_Level']} AS level, {O.CATEGORY_RANKS['Payment_Value']} AS value, "
    "CASE WHEN contains(Payment_Behaviour, 'High_value') THEN 2 WHEN contains(Payment_Behaviour, 'Medium_value') THEN 1 "
    "WHEN contains(Payment_Behaviour, 'Small_value') THEN 0 END AS legacy, "
    "CASE WHEN Payment_Behaviour LIKE '%spent%' THEN split_part(Payment_Behaviour, '_', 1) END AS spent, "
    "CASE WHEN Payment_Behaviour LIKE '%spent%' THEN split_part(Payment_Behaviour, '_', 3) END AS size FROM fin_raw"
))(lambda t: t.stored("raw_financials").select(
    "Customer_ID", C.behaviour_level("Payment_Behaviour", S.SPENT_RANK).alias("level"),
    C.behaviour_value("Payment_Behaviour", S.VALUE_RANK).alias("value"),
    C.behaviour_value("Payment_Behaviour", S.VALUE_RANK_LEGACY).alias("legacy"),
    C.behaviour_part("Payment_Behaviour", 1).alias("spent"), C.behaviour_part("Payment_Behaviour", 2).alias("size")))
query("duration_months", "Customer_ID:s strict:i lenient:i years:i months:i", (
    f"SELECT Customer_ID, y * 12 + m AS strict, y * 12 + coalesce(m, 0) AS lenient, y AS years, m AS months FROM "
    f"(SELECT Customer_ID, {O.part_of('Credit_History_Age', 'Year')} AS y, {O.part_of('Credit_History_Age', 'Month')} AS m FROM fin_raw)"
))(lambda t: t.stored("raw_financials").select(
    "Customer_ID", C.duration_to_months("Credit_History_Age").alias("strict"),
    C.duration_to_months("Credit_History_Age", months_required=False).alias("lenient"),
    C.duration_part("Credit_History_Age", "Year").alias("years"), C.duration_part("Credit_History_Age", "Month").alias("months")))
query("list_distinct_count", "Customer_ID:s n:i n_legacy:i", (
    f"SELECT Customer_ID, {O.list_count('Type_of_Loan', O.SEPARATOR)} AS n, {O.list_count('Type_of_Loan', O.SEPARATOR_LEGACY)} AS n_legacy FROM fin_raw"
))(lambda t: t.stored("raw_financials").select(
    "Customer_ID", C.list_distinct_count("Type_of_Loan").alias("n"), C.list_distinct_count("Type_of_Loan", True).alias("n_legacy")))
query("age_bins", "Customer_ID:s silver:s feature:s report:s", (
    f"SELECT Customer_ID, {O.band('Age', *S.AGE_BANDS_SILVER)} AS silver, {O.band('Age', *S.AGE_BANDS_FEATURE)} AS feature, "
    "CASE WHEN Age IS NULL THEN 'Unknown' WHEN Age < 25 THEN 'Under 25' WHEN Age BETWEEN 25 AND 34 THEN '25-34' "
    "WHEN Age BETWEEN 35 AND 44 THEN '35-44' WHEN Age BETWEEN 45 AND 54 THEN '45-54' ELSE '55+' END AS report FROM att"
))(lambda t: t.attributes().select(
    "Customer_ID", C.bin_numeric("Age", *S.AGE_BANDS_SILVER).alias("silver"),
    C.bin_numeric("Age", *S.AGE_BANDS_FEATURE).alias("feature"),
    C.bin_numeric("Age", *S.AGE_BANDS_REPORT, "Unknown").alias("report")))
query("cap_constant", {"Customer_ID": "s", **{c: "i" for c in S.REPORT_CAPS}}, (
    "SELECT Customer_ID, " + ", ".join(f"CASE WHEN {c} > {h} THEN {h} ELSE {c} END AS {c}" for c, h in S.REPORT_CAPS.items()) + " FROM fin"
))(lambda t: t.financials().select("Customer_ID", *[C.cap_constant(c, h).alias(c) for c, h in S.REPORT_CAPS.items()]))
query("ratios", "Customer_ID:s plus_one:f plain:f tiny:f balance:f log_income:f log_debt:f", (
    "SELECT Customer_ID, Outstanding_Debt / (Annual_Income + 1) AS plus_one, Total_EMI_per_month / nullif(Monthly_Inhand_Salary, 0) AS plain, "
    "Num_of_Loan / (Num_Credit_Inquiries + 0.001) AS tiny, (Monthly_Balance + 1) / (Outstanding_Debt + 1) AS balance, "
    "ln(1 + Annual_Income) AS log_income, ln(1 + Outstanding_Debt) AS log_debt FROM fin"
))(lambda t: t.financials().select(
    "Customer_ID", R.safe_ratio("Outstanding_Debt", "Annual_Income", 1).alias("plus_one"),
    R.safe_ratio("Total_EMI_per_month", "Monthly_Inhand_Salary").alias("plain"),
    R.safe_ratio("Num_of_Loan", "Num_Credit_Inquiries", 1e-3).alias("tiny"),
    R.safe_ratio("Monthly_Balance", "Outstanding_Debt", 1, 1).alias("balance"),
    R.log1p("Annual_Income").alias("log_income"), R.log1p("Outstanding_Debt").alias("log_debt")))
query("change_flags", "Customer_ID:s changed:i changed_or_zero:i decreased:i amount:f", (
    "SELECT Customer_ID, CAST(Changed_Credit_Limit <> 0 AS INTEGER) AS changed, coalesce(CAST(Changed_Credit_Limit <> 0 AS INTEGER), 0) AS changed_or_zero, "
    "coalesce(CAST(Changed_Credit_Limit < 0 AS INTEGER), 0) AS decreased, abs(Changed_Credit_Limit) AS amount FROM fin"
))(lambda t: t.financials().select(
    "Customer_ID", R.change_flag("Changed_Credit_Limit").alias("changed"),
    R.change_flag("Changed_Credit_Limit", True).alias("changed_or_zero"),
    R.decrease_flag("Changed_Credit_Limit").alias("decreased"), F.abs("Changed_Credit_Limit").alias("amount")))
query("sentinel_replace", "Customer_ID:s Credit_Mix:s Credit_History_Age:s Num_of_Delayed_Payment:s", (
    "SELECT Customer_ID, " + ", ".join(
        f"CASE WHEN {c} NOT IN ('_', 'NA') THEN {c} END AS {c}" for c in ("Credit_Mix", "Credit_History_Age", "Num_of_Delayed_Payment")
    ) + " FROM fin_raw"
))(lambda t: projection.replace_sentinels(t.stored("raw_financials")))
query("not_null_filter", "Customer_ID:s Monthly_Balance:f", (
    "SELECT Customer_ID, Monthly_Balance FROM fin WHERE Monthly_Balance IS NOT NULL"
))(lambda t: t.financials().where(F.col("Monthly_Balance").isNotNull()))
query("null_rows", "Customer_ID:s Age:i Occupation:s", (
    "SELECT Customer_ID, Age, Occupation FROM att WHERE Age IS NULL OR Occupation IS NULL OR Age_group IS NULL"
))(lambda t: projection.rows_with_nulls(t.attributes()))
query("fill_category", "Customer_ID:s Occupation:s", (
    "SELECT Customer_ID, coalesce(Occupation, 'Unknown') AS Occupation FROM att"
))(lambda t: t.attributes().withColumn("Occupation", C.fill_category("Occupation")))


# --- silver tables -------------------------------------------------------------------
query("silver_attributes", ATTRIBUTE_KINDS, "SELECT * FROM att")(lambda t: t.attributes())
query("silver_financials", FULL_FINANCIAL_KINDS, "SELECT * FROM fin")(lambda t: t.financials())
query("silver_clickstream", {**KEY, **CLICK_KINDS}, "SELECT * FROM clk")(lambda t: t.clickstream())


@query("silver_attributes_flags", "Customer_ID:s Age:i is_Astronaut:i is_BUILDING:i is_MACHINERY:i", (
    "SELECT Customer_ID, Age, " + ", ".join(
        f"CASE WHEN Occupation = '{v}' THEN 1 ELSE 0 END AS is_{v}" for v in ("Astronaut", "BUILDING", "MACHINERY")
    ) + " FROM att"
))
def _(t):
    return silver.silver_attributes_flags(t.stored("raw_attributes"), encode.fit_vocabulary(t.attributes(), "Occupation"))


LOAN_FLAGS = {encode.safe_name("has_", v, lower=True): v for v in T.LOAN_TYPES}


@query("list_flags", {"Customer_ID": "s", **{f: "i" for f in LOAN_FLAGS}}, (
    "SELECT Customer_ID, " + ", ".join(
        f"CASE WHEN contains(Type_of_Loan, '{v}') THEN 1 ELSE 0 END AS {f}" for f, v in LOAN_FLAGS.items()
    ) + " FROM fin_raw"
))
def _(t):
    raw = t.stored("raw_financials")
    return silver.silver_financials_flags(raw, encode.fit_list_vocabulary(raw, "Type_of_Loan"))


LOAN_KEYS = ["auto_loan", "credit-builder_loan", "home_equity_loan", "mortgage_loan", "not_specified", "payday_loan", "personal_loan", "student_loan"]


@query("loan_type_table", {"customer_id": "s", "snapshot_date": "d", **{k: "i" for k in LOAN_KEYS}}, (
    "SELECT Customer_ID AS customer_id, snapshot_date, " + ", ".join(
        f"CASE WHEN Type_of_Loan IS NULL THEN 0 ELSE (length(Type_of_Loan) - length(replace(Type_of_Loan, '{v}', ''))) // {len(v)} END AS \"{k}\""
        for k, v in zip(LOAN_KEYS, T.LOAN_TYPES)
    ) + " FROM fin_raw"
))
def _(t):
    raw = t.stored("raw_financials")
    return silver.loan_type_table(raw, encode.fit_list_keys(raw, "Type_of_Loan"))


query("detail_attributes", "customer_id:s name:s age:i ssn:s occupation:s snapshot_date:d", (
    f"SELECT Customer_ID AS customer_id, Name AS name, CASE WHEN v BETWEEN 0 AND 120 THEN v END AS age, "
    "CASE WHEN regexp_matches(SSN, '^\\d{3}-\\d{2}-\\d{4}$') THEN SSN END AS ssn, nullif(Occupation, '_______') AS occupation, snapshot_date "
    f"FROM (SELECT *, {O.lenient('Age', 'int')} AS v FROM att_raw)"
))(lambda t: silver.detail_attributes(t.stored("raw_attributes")))

_detail = {c: ("double" if c == "Num_Credit_Inquiries" else r[0]) for c, r in S.FINANCIAL_RULES.items()}
_capped = [c for c in S.FINANCIAL_RULES if c.lower() in silver.CAPPED_IN_DETAIL]
O.CTES["detail0"] = "SELECT Customer_ID AS customer_id, CAST(snapshot_date AS DATE) AS snapshot_date, " + ", ".join(
    (f"CASE WHEN {O.lenient(c, d)} >= 0 THEN {O.lenient(c, d)} END" if c.lower() in silver.NON_NEGATIVE_IN_DETAIL else O.lenient(c, d)) + f" AS {c.lower()}"
    for c, d in _detail.items()
) + (
    f", nullif(Credit_Mix, '_') AS credit_mix, {O.part_of('Credit_History_Age', 'Year')} AS credit_history_age_year, "
    f"{O.part_of('Credit_History_Age', 'Month')} AS credit_history_age_month, Payment_of_Min_Amount AS payment_of_min_amount, "
    "CASE WHEN Payment_Behaviour LIKE '%spent%' THEN split_part(Payment_Behaviour, '_', 1) END AS payment_behaviour_spent, "
    "CASE WHEN Payment_Behaviour LIKE '%spent%' THEN split_part(Payment_Behaviour, '_', 3) END AS payment_behaviour_value FROM fin_raw"
)
O.CTES["detail_caps"] = "SELECT snapshot_date, " + ", ".join(
    f"quantile_cont(CAST({c.lower()} AS DOUBLE), 0.97) AS q_{c.lower()}" for c in _capped
) + " FROM detail0 GROUP BY snapshot_date"
O.CTES["detail"] = "SELECT d.* REPLACE (" + ", ".join(
    f"CASE WHEN d.{c.lower()} > q_{c.lower()} THEN q_{c.lower()} ELSE d.{c.lower()} END AS {c.lower()}" for c in _capped
) + ") FROM detail0 d JOIN detail_caps USING (snapshot_date)"
query("detail_financials", {
    "customer_id": "s", "snapshot_date": "d", **{c.lower(): "f" for c in S.FINANCIAL_RULES}, "credit_mix": "s",
    "credit_history_age_year": "i", "credit_history_age_month": "i", "payment_of_min_amount": "s",
    "payment_behaviour_spent": "s", "payment_behaviour_value": "s",
}, "SELECT * FROM detail")(lambda t: silver.detail_financials(t.stored("raw_financials")))


# --- joins -----------------------------------------------------------------------------
query("feature_store_left", FEATURE_KINDS, "SELECT * FROM features")(lambda t: t.features())
query("feature_store_inner", FEATURE_KINDS, (
    "SELECT f.* FROM features f SEMI JOIN clk k ON f.Customer_ID = k.Customer_ID AND f.snapshot_date = k.snapshot_date"
))(lambda t: joins.feature_store(t.attributes(), t.financials(), t.clickstream(), "inner"))
query("label_join_back", TRAINING_KINDS, "SELECT * FROM training")(lambda t: t.training())
query("label_join_forward", TRAINING_KINDS, (
    "SELECT f.* EXCLUDE (snapshot_date), l.* EXCLUDE (Customer_ID) FROM features f JOIN labels l "
    "ON f.Customer_ID = l.Customer_ID AND CAST(f.snapshot_date + INTERVAL 6 MONTH AS DATE) = l.snapshot_date"
))(lambda t: joins.label_join(t.features(), t.labels(), direction="forward"))
query("label_join_salted", TRAINING_KINDS, "SELECT * FROM training")(lambda t: joins.salted_join(
    t.labels().withColumn("snapshot_date", F.add_months("snapshot_date", -6)), t.features(), S.KEYS, share=0.001, salts=8))
query("label_semi", ATTRIBUTE_KINDS, "SELECT * FROM att SEMI JOIN labels USING (Customer_ID)")(
    lambda t: joins.with_labels_only(t.attributes(), t.labels()))

_means = ", ".join(f"avg({c}) AS avg_{c}" for c in S.CLICKSTREAM_COLS)
MEAN_KINDS = {"Customer_ID": "s", **{f"avg_{c}": "f" for c in S.CLICKSTREAM_COLS}}
query("clickstream_history_before_label", MEAN_KINDS, (
    f"SELECT k.Customer_ID, {_means} FROM clk k JOIN labels l ON k.Customer_ID = l.Customer_ID AND k.snapshot_date < l.snapshot_date GROUP BY k.Customer_ID"
))(lambda t: joins.history_means(
    t.clickstream(), t.labels().withColumnRenamed("snapshot_date", "mob_date"), S.CLICKSTREAM_COLS, inclusive=False))
query("clickstream_history_to_start", MEAN_KINDS, (
    f"SELECT k.Customer_ID, {_means} FROM clk k JOIN led l ON k.Customer_ID = l.Customer_ID AND k.snapshot_date <= l.snapshot_date "
    "WHERE l.mob = 0 GROUP BY k.Customer_ID"
))(lambda t: joins.history_means(
    t.clickstream(), t.ledger().where("mob = 0").withColumnRenamed("snapshot_date", "mob_date"), S.CLICKSTREAM_COLS, inclusive=True))

_common = "SELECT snapshot_date FROM fin INTERSECT SELECT snapshot_date FROM clk INTERSECT SELECT snapshot_date FROM att"
query("common_dates", "snapshot_date:d", _common + " INTERSECT SELECT snapshot_date FROM led")(
    lambda t: joins.common_dates([t.financials(), t.clickstream(), t.attributes(), t.ledger()]))
query("candidate_dates", "snapshot_date:d label_cutoff:d", (
    f"SELECT snapshot_date, CAST(snapshot_date + INTERVAL 6 MONTH AS DATE) AS label_cutoff FROM ({_common}) c "
    "WHERE EXISTS (SELECT 1 FROM led l WHERE l.snapshot_date >= c.snapshot_date + INTERVAL 6 MONTH)"
))(lambda t: joins.candidate_dates(joins.common_dates([t.financials(), t.clickstream(), t.attributes()]), t.ledger()))
query("latest_valid_date", "snapshot_date:d", (
    f"SELECT max(snapshot_date) AS snapshot_date FROM ({_common}) c WHERE EXISTS (SELECT 1 FROM led l WHERE l.snapshot_date >= c.snapshot_date + INTERVAL 6 MONTH)"
))(lambda t: joins.latest_valid_date(joins.common_dates([t.financials(), t.clickstream(), t.attributes()]), t.ledger()))
query("latest_record", {"Customer_ID": "s", **CLICK_KINDS}, (
    "SELECT * FROM clk QUALIFY row_number() OVER (PARTITION BY Customer_ID ORDER BY snapshot_date DESC) = 1"
))(lambda t: joins.latest_record(t.clickstream()))
O.CTES["loan_agg"] = (
    "SELECT Customer_ID, snapshot_date AS feature_snapshot_date, sum(loan_c) / 100 AS tot_loan_amt, sum(overdue_c) / 100 AS tot_overdue, "
    "sum(balance_c) / 100 AS tot_balance, avg(dpd) AS avg_dpd FROM led GROUP BY ALL"
)
query("loan_aggregates", "Customer_ID:s feature_snapshot_date:d tot_loan_amt:f tot_overdue:f tot_balance:f avg_dpd:f", (
    "SELECT a.* FROM loan_agg a SEMI JOIN clk k ON a.Customer_ID = k.Customer_ID AND a.feature_snapshot_date = k.snapshot_date"
))(lambda t: joins.loan_aggregates(t.ledger(), t.clickstream().withColumnRenamed("snapshot_date", "feature_snapshot_date")))

O.CTES["spine"] = (
    "SELECT k.Customer_ID, k.snapshot_date AS feature_snapshot_date, k.fe_1, a.Age, a.Occupation, f.Annual_Income, f.Num_of_Loan, "
    "g.tot_loan_amt, g.tot_overdue, g.tot_balance, g.avg_dpd FROM clk k LEFT JOIN att a ON k.Customer_ID = a.Customer_ID "
    "LEFT JOIN fin f ON k.Customer_ID = f.Customer_ID LEFT JOIN loan_agg g ON k.Customer_ID = g.Customer_ID AND k.snapshot_date = g.feature_snapshot_date"
)
SPINE_KINDS = "Customer_ID:s feature_snapshot_date:d fe_1:i Age:f Occupation:s Annual_Income:f Num_of_Loan:i tot_loan_amt:f tot_overdue:f tot_balance:f avg_dpd:f"


def spine(t):
    clicks = t.clickstream()
    loans = joins.loan_aggregates(t.ledger(), clicks.withColumnRenamed("snapshot_date", "feature_snapshot_date"))
    return joins.spine_features(clicks, t.attributes(), t.financials(), loans)


query("spine_features", SPINE_KINDS, "SELECT * FROM spine")(spine)
query("spine_filled", SPINE_KINDS + " has_loan:i", (
    "SELECT * REPLACE (coalesce(tot_loan_amt, 0) AS tot_loan_amt, coalesce(tot_overdue, 0) AS tot_overdue, coalesce(tot_balance, 0) AS tot_balance, "
    "coalesce(avg_dpd, 0) AS avg_dpd, coalesce(Age, (SELECT quantile_cont(CAST(Age AS DOUBLE), 0.5) FROM spine)) AS Age), "
    "CAST(coalesce(tot_loan_amt, 0) > 0 AS INTEGER) AS has_loan FROM spine"
))(lambda t: gold.fill_spine(spine(t)))
query("multi_snapshot_training", {**ATTRIBUTE_KINDS, "feature_snapshot_date": "d", "label_snapshot_date": "d", "label": "i"}, (
    "SELECT a.*, a.snapshot_date AS feature_snapshot_date, l.snapshot_date AS label_snapshot_date, l.label FROM att a JOIN labels l "
    "ON a.Customer_ID = l.Customer_ID AND l.snapshot_date = CAST(a.snapshot_date + INTERVAL 6 MONTH AS DATE)"
))(lambda t: joins.multi_snapshot_training(t.attributes(), t.ledger()))
query("multi_snapshot_clickstream", {**KEY, **CLICK_KINDS, "label_snapshot_date": "d", "label": "i"}, (
    "SELECT a.*, l.snapshot_date AS label_snapshot_date, l.label FROM clk a JOIN labels l "
    "ON a.Customer_ID = l.Customer_ID AND l.snapshot_date = CAST(a.snapshot_date + INTERVAL 6 MONTH AS DATE)"
))(lambda t: joins.multi_snapshot_training(t.clickstream(), t.ledger()))
query("same_date_labels", {**KEY, **CLICK_KINDS, "label": "i"}, (
    "SELECT k.*, l.label FROM clk k JOIN labels l USING (Customer_ID, snapshot_date)"
))(lambda t: joins.same_date_labels(t.clickstream(), t.labels()))
query("prediction_labels", "Customer_ID:s snapshot_date:d model_version:s model_predictions:f label:i", "SELECT * FROM scored")(
    lambda t: joins.prediction_labels(t.predictions(), t.labels()))


# --- composed feature jobs -------------------------------------------------------------------
_impute = [c for c in S.MEDIAN_IMPUTE_COLS]
query("imputed_training", {"loan_id": "s", "snapshot_date": "d", **{c: "f" for c in _impute}, "is_BUILDING": "i", "is_Astronaut": "i", "label": "i"}, (
    "SELECT loan_id, CAST(snapshot_date + INTERVAL 6 MONTH AS DATE) AS snapshot_date, " + ", ".join(
        f"coalesce(CAST({c} AS DOUBLE), (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM training)) AS {c}" for c in _impute
    ) + ", CASE WHEN Occupation = 'BUILDING' THEN 1 ELSE 0 END AS \"is_BUILDING\", CASE WHEN Occupation = 'Astronaut' THEN 1 ELSE 0 END AS \"is_Astronaut\", "
    "label FROM training"
))(lambda t: gold.imputed_training(t.features(), t.labels()))


@query("attribute_features", "loan_id:s Age_clean:i n_age:i n_occ:i", (
    "SELECT loan_id, coalesce(v, (SELECT CAST(trunc(quantile_cont(CAST(v AS DOUBLE), 0.5)) AS INTEGER) FROM "
    "(SELECT CASE WHEN x BETWEEN 18 AND 100 THEN x END AS v FROM (SELECT try_cast(nullif(regexp_replace(Age, '[^0-9]', '', 'g'), '') AS INTEGER) AS x FROM att_training)))) AS Age_clean, "
    "1 AS n_age, 1 AS n_occ FROM (SELECT loan_id, CASE WHEN x BETWEEN 18 AND 100 THEN x END AS v FROM "
    "(SELECT loan_id, try_cast(nullif(regexp_replace(Age, '[^0-9]', '', 'g'), '') AS INTEGER) AS x FROM att_training))"
))
def _(t):
    from pyspark.ml.functions import vector_to_array

    def ones(c):
        return F.aggregate(vector_to_array(c), F.lit(0.0), lambda a, x: a + x)

    return gold.attribute_features(t.attribute_training()).select(
        "loan_id", "Age_clean", ones("Age_group_vec").alias("n_age"), ones("Occ_clean_vec").alias("n_occ"))


_quant = gold.QUANTILE_CAPPED
query("financial_features", {
    "loan_id": "s", "Outstanding_Debt": "f", "credit_history_months": "i", "num_loan_types": "i", **{c: "f" for c in _quant},
    "debt_to_income": "f", "inq_per_loan": "f", "credit_limit_decreased": "i", "abs_credit_change": "f", "has_credit_limit_change": "i",
}, (
    "WITH base AS (SELECT * REPLACE (coalesce(Changed_Credit_Limit, 0) AS Changed_Credit_Limit) FROM detail_training WHERE Monthly_Balance IS NOT NULL), "
    "q AS (SELECT quantile_cont(Outstanding_Debt, 0.5) AS med, " + ", ".join(
        f"quantile_cont(CAST({c} AS DOUBLE), 0.01) AS lo_{c}, quantile_cont(CAST({c} AS DOUBLE), 0.95) AS hi_{c}" for c in _quant
    ) + " FROM base), capped AS (SELECT base.* REPLACE (coalesce(Outstanding_Debt, med) AS Outstanding_Debt, " + ", ".join(
        f"CASE WHEN {c} IS NOT NULL THEN least({S.BUSINESS_CAPS[c]}, greatest(lo_{c}, least(hi_{c}, {c}))) END AS {c}" for c in _quant
    ) + ") FROM base CROSS JOIN q) SELECT loan_id, Outstanding_Debt, "
    f"{O.part_of('Credit_History_Age', 'Years')} * 12 + coalesce({O.part_of('Credit_History_Age', 'Months')}, 0) AS credit_history_months, num_loan_types, "
    + ", ".join(_quant) + ", Outstanding_Debt / (Annual_Income + 1) AS debt_to_income, Num_Credit_Inquiries / nullif(Num_of_Loan + 1, 0) AS inq_per_loan, "
    "CASE WHEN Changed_Credit_Limit < 0 THEN 1 ELSE 0 END AS credit_limit_decreased, abs(Changed_Credit_Limit) AS abs_credit_change, "
    "CASE WHEN Changed_Credit_Limit <> 0 THEN 1 ELSE 0 END AS has_credit_limit_change FROM capped"
))(lambda t: gold.financial_features(t.detail_training()))


@query("detail_features", {
    "customer_id": "s", "snapshot_date": "d", "age": "f", "annual_income": "f", "num_of_loan": "f", "credit_history_age_month": "f",
    "credit_mix_good": "i", "payment_behaviour_spent_high": "i", "occupation_building": "i", "auto_loan": "f", "avg_fe_1": "f", "avg_fe_8": "f",
}, (
    "WITH j AS (SELECT d.customer_id, d.snapshot_date, CASE WHEN a.v BETWEEN 0 AND 120 THEN a.v END AS age, d.annual_income, d.num_of_loan, "
    "d.credit_history_age_year * 12 + d.credit_history_age_month AS credit_history_age_month, d.credit_mix, d.payment_behaviour_spent, "
    "nullif(a.Occupation, '_______') AS occupation, CASE WHEN contains(a.Type_of_Loan, 'Auto Loan') THEN 1 ELSE 0 END AS auto_loan FROM detail d JOIN "
    f"(SELECT x.Customer_ID, {O.lenient('x.Age', 'int')} AS v, x.Occupation, y.Type_of_Loan FROM att_raw x JOIN fin_raw y ON x.Customer_ID = y.Customer_ID) a "
    "ON d.customer_id = a.Customer_ID WHERE d.customer_id IN (SELECT Customer_ID FROM labels)), "
    "h AS (SELECT k.Customer_ID, avg(fe_1) AS avg_fe_1, avg(fe_8) AS avg_fe_8 FROM clk k JOIN led l ON k.Customer_ID = l.Customer_ID "
    "AND k.snapshot_date <= l.snapshot_date WHERE l.mob = 0 GROUP BY k.Customer_ID) "
    "SELECT j.customer_id, snapshot_date, coalesce(age, (SELECT avg(age) FROM j)) AS age, coalesce(annual_income, (SELECT avg(annual_income) FROM j)) AS annual_income, "
    "coalesce(num_of_loan, (SELECT avg(num_of_loan) FROM j)) AS num_of_loan, "
    "coalesce(credit_history_age_month, (SELECT avg(credit_history_age_month) FROM j)) AS credit_history_age_month, "
    "CASE WHEN credit_mix = 'Good' THEN 1 ELSE 0 END AS credit_mix_good, CASE WHEN payment_behaviour_spent = 'High' THEN 1 ELSE 0 END AS payment_behaviour_spent_high, "
    "CASE WHEN occupation = 'BUILDING' THEN 1 ELSE 0 END AS occupation_building, auto_loan, h.avg_fe_1, h.avg_fe_8 FROM j LEFT JOIN h ON j.customer_id = h.Customer_ID"
))
def _(t):
    raw = t.stored("raw_financials")
    types = silver.loan_type_table(raw, encode.fit_list_keys(raw, "Type_of_Loan"))
    return gold.detail_features(
        silver.detail_attributes(t.stored("raw_attributes")), silver.detail_financials(raw), types, t.clickstream(), t.ledger(), t.labels())
