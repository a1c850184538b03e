"""Encoding, imputation, profiling, modelling and monitoring queries."""

from __future__ import annotations

from datetime import date

import numpy as np
from pyspark.sql import functions as F

from checks import oracles as O
from checks import testbed as T
from checks.queries_tables import FEATURE_KINDS, KEY
from checks.registry import query
from creditspine import schemas as S
from creditspine.functions import cleaning as C
from creditspine.operators import (
    attribution, drift, encode, impute, metrics, modelling, moments, monitor, profile, projection, ranks, scorers, splits,
)
from creditspine.plans import monitoring as monitoring_plan
from creditspine.plans import training as training_plan
from creditspine.sources import models
from creditspine.sources.session import cut_lineage, scratch

FIN_NUMERIC = [
    "Annual_Income", "Monthly_Inhand_Salary", "Outstanding_Debt", "Monthly_Balance", "Amount_invested_monthly",
    "Changed_Credit_Limit", "Total_EMI_per_month", "Credit_Utilization_Ratio", "Num_Bank_Accounts", "Num_Credit_Card",
    "Interest_Rate", "Num_of_Loan", "Num_of_Delayed_Payment", "Num_Credit_Inquiries",
]
WINDOWS = splits.time_windows(T.TRAIN_DATE, T.TRAIN_MONTHS, T.OOT_MONTHS)
REF_RANGE = (WINDOWS.train_start, date(1995, 10, 1))


def reference(t):
    """Feature rows of the training window."""
    return projection.between_dates(t.stored("features"), *REF_RANGE)


def every_month(t):
    """Feature rows of all months from the train date on."""
    return projection.between_dates(t.stored("features"), O.RUN_START, None)


# --- encoding -------------------------------------------------------------------------
@query("one_hot", "Customer_ID:s is_AUTOMOBILE:i is_Astronaut:i is_BUILDING:i is_FURNITURE:i is_HOUSEHOLD:i is_MACHINERY:i", (
    "SELECT Customer_ID, " + ", ".join(
        f"CASE WHEN Occupation = '{v}' THEN 1 ELSE 0 END AS \"is_{v}\""
        for v in ("AUTOMOBILE", "Astronaut", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
    ) + " FROM att"
))
def _(t):
    return encode.one_hot(t.attributes(), "Occupation", encode.fit_vocabulary(t.attributes(), "Occupation"))


@query("one_hot_ml", "Customer_ID:s credit_mix_good:i credit_mix_standard:i credit_mix_bad:i payment_of_min_amount_nm:i", (
    "SELECT Customer_ID, " + ", ".join(
        f"CASE WHEN Credit_Mix = '{v}' THEN 1 ELSE 0 END AS credit_mix_{v.lower()}" for v in ("Good", "Standard", "Bad")
    ) + ", CASE WHEN Payment_of_Min_Amount = 'NM' THEN 1 ELSE 0 END AS payment_of_min_amount_nm FROM fin_raw"
))
def _(t):
    df = projection.replace_sentinels(t.stored("raw_financials")).select(
        "Customer_ID", F.col("Credit_Mix").alias("credit_mix"), F.col("Payment_of_Min_Amount").alias("payment_of_min_amount"))
    model = encode.fit_one_hot_ml(df, ["credit_mix", "payment_of_min_amount"])
    return encode.apply_one_hot_ml(df, model, explode=True)


@query("group_rare", "Customer_ID:s Occ_clean:s", (
    "SELECT Customer_ID, CASE WHEN Occupation IS NULL THEN 'Unknown' WHEN count(*) OVER (PARTITION BY Occupation) < 0.05 * count(*) OVER () "
    "THEN 'Other' ELSE Occupation END AS Occ_clean FROM att"
))
def _(t):
    common = encode.fit_common_values(t.attributes(), "Occupation")
    return t.attributes().withColumn("Occ_clean", encode.group_rare("Occupation", common))


# --- imputation and capping --------------------------------------------------------------
_caps = ["Num_Bank_Accounts", "Num_Credit_Card", "Interest_Rate", "Num_of_Delayed_Payment", "Num_Credit_Inquiries"]


@query("cap_quantile", {"Customer_ID": "s", **{c: "f" for c in _caps}}, (
    "SELECT Customer_ID, " + ", ".join(
        f"CASE WHEN {c} IS NOT NULL THEN greatest((SELECT quantile_cont(CAST({c} AS DOUBLE), 0.01) FROM fin), "
        f"least((SELECT quantile_cont(CAST({c} AS DOUBLE), 0.95) FROM fin), {c})) END AS {c}" for c in _caps
    ) + " FROM fin"
))
def _(t):
    fin = t.stored("financials")
    return impute.cap(fin, impute.fit_caps(fin, _caps, 0.01, 0.95))


query("cap_by_month", {**KEY, "Annual_Income": "f", "Interest_Rate": "f"}, (
    "SELECT Customer_ID, snapshot_date, " + ", ".join(
        f"CASE WHEN {c} IS NOT NULL THEN least(quantile_cont(CAST({c} AS DOUBLE), 0.97) OVER (PARTITION BY snapshot_date), {c}) END AS {c}"
        for c in ("Annual_Income", "Interest_Rate")
    ) + " FROM fin"
))(lambda t: impute.cap_within(t.stored("financials"), ["Annual_Income", "Interest_Rate"], 0.97, ["snapshot_date"]))
query("winsorize", "Customer_ID:s emi_to_salary:f investment_rate:f", (
    "SELECT Customer_ID, " + ", ".join(
        f"CASE WHEN {c} IS NOT NULL THEN least((SELECT quantile_cont({c}, 0.99) FROM fin), {c}) END AS {c}" for c in ("emi_to_salary", "investment_rate")
    ) + " FROM fin"
))(lambda t: impute.cap(t.financials(), impute.fit_caps(t.financials(), ["emi_to_salary", "investment_rate"], None, 0.99)))
query("trimmed_median", "feature:s median:f", (
    "SELECT 'Annual_Income' AS feature, quantile_cont(Annual_Income, 0.5) AS median FROM fin "
    "WHERE Annual_Income < (SELECT quantile_cont(Annual_Income, 0.99) FROM fin)"
))(lambda t: impute.trimmed_median(t.stored("financials"), "Annual_Income"))


def _filled(strategy: str, columns: list[str]) -> str:
    return "SELECT Customer_ID, " + ", ".join(
        f"coalesce(CAST({c} AS DOUBLE), (SELECT {strategy.format(c=c)} FROM fin)) AS {c}" for c in columns
    ) + " FROM fin"


_gaps = ["Annual_Income", "Num_Bank_Accounts", "Num_of_Loan", "Credit_Mix_Label", "Payment_Value"]
query("impute_median", {"Customer_ID": "s", **{c: "f" for c in _gaps}}, _filled("quantile_cont(CAST({c} AS DOUBLE), 0.5)", _gaps))(
    lambda t: impute.fill(t.stored("financials"), impute.fit_medians(t.stored("financials"), _gaps)))
query("impute_mean", {"Customer_ID": "s", **{c: "f" for c in _gaps}}, _filled("avg({c})", _gaps))(
    lambda t: impute.fill(t.financials(), impute.fit_means(t.financials(), _gaps)))
query("fill_constants", "Customer_ID:s Changed_Credit_Limit:f Num_of_Loan:i", (
    "SELECT Customer_ID, coalesce(Changed_Credit_Limit, 0) AS Changed_Credit_Limit, coalesce(Num_of_Loan, -1) AS Num_of_Loan FROM fin"
))(lambda t: impute.fill(t.financials(), {"Changed_Credit_Limit": 0.0, "Num_of_Loan": -1}))
query("presence_flags", "Customer_ID:s has_credit_mix:i", (
    "SELECT Customer_ID, CAST(nullif(Credit_Mix, '_') IS NOT NULL AS INTEGER) AS has_credit_mix FROM fin_raw"
))(lambda t: t.stored("raw_financials").withColumn(
    "has_credit_mix", (C.fill_category(C.null_tokens("Credit_Mix", ["_"])) != "Unknown").cast("int")))


# --- profiling --------------------------------------------------------------------------------
_profiled = list(FEATURE_KINDS)
_null_sql = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0 END) AS null_share FROM features" for c in _profiled
)
query("null_profile", "column:s null_share:f", _null_sql)(lambda t: profile.null_profile(t.features(), _profiled))
query("worst_nulls", "column:s null_share:f", f"SELECT * FROM ({_null_sql}) ORDER BY null_share DESC, 1 LIMIT 15")(
    lambda t: profile.worst_null_columns(t.features(), 15, _profiled))
query("null_counts", "_rows:i _null_rows:i Age:i Occupation:i", (
    "SELECT count(*) AS _rows, count(*) FILTER (WHERE Age IS NULL OR Occupation IS NULL OR Age_group IS NULL) AS _null_rows, "
    "count(*) FILTER (WHERE Age IS NULL) AS Age, count(*) FILTER (WHERE Occupation IS NULL) AS Occupation FROM att"
))(lambda t: profile.null_counts(t.attributes()))
query("missing_percent", "missing_pct:f", "SELECT avg(CASE WHEN Annual_Income IS NULL THEN 100.0 ELSE 0 END) AS missing_pct FROM fin")(
    lambda t: profile.missing_percent(t.financials(), "Annual_Income"))
query("missing_by_group", "snapshot_date:d pct_missing_attributes:f pct_missing_financials:f pct_missing_clickstream:f", "SELECT * FROM missing")(
    lambda t: profile.missing_by_group(every_month(t), S.FEATURE_SOURCES, ["snapshot_date"]))
query("group_counts", "Occupation:s label:i count:i", "SELECT Occupation, label, count(*) AS count FROM training GROUP BY ALL")(
    lambda t: profile.group_count(t.training(), "Occupation", "label"))
query("contingency", "Age_group:s label_0:i label_1:i", (
    "SELECT Age_group, count(*) FILTER (WHERE label = 0) AS label_0, count(*) FILTER (WHERE label = 1) AS label_1 FROM training GROUP BY Age_group"
))(lambda t: profile.contingency(t.training(), "Age_group"))
query("top_contingency", "Occupation:s label_0:i label_1:i", (
    "SELECT Occupation, count(*) FILTER (WHERE label = 0) AS label_0, count(*) FILTER (WHERE label = 1) AS label_1 FROM training "
    "GROUP BY Occupation ORDER BY label_0 DESC, Occupation NULLS FIRST LIMIT 4"
))(lambda t: profile.top_contingency(t.training(), "Occupation", 4))

_tested = {"Credit_Mix": "Credit_Mix", "Payment_Behaviour": "Payment_Behaviour", "Payment_of_Min_Amount": "Min_Text"}
O.CTES["tested"] = " UNION ALL ".join(
    f"SELECT '{name}' AS feature, CAST({c} AS VARCHAR) AS category, label FROM detail_training" for name, c in _tested.items()
) + " UNION ALL SELECT 'Paid_Minimum', CAST(Payment_of_Min_Amount AS VARCHAR), label FROM detail_training"
O.CTES["tested_n"] = "SELECT feature, category, label, count(*) AS n FROM tested GROUP BY ALL"
O.CTES["tested_rows"] = "SELECT feature, category, sum(n) AS rn FROM tested_n GROUP BY ALL"
O.CTES["tested_cols"] = "SELECT feature, label, sum(n) AS cn FROM tested_n GROUP BY ALL"
O.CTES["tested_size"] = (
    "SELECT feature, sum(rn) AS total, (count(*) - 1) * ((SELECT count(*) FROM tested_cols c WHERE c.feature = r.feature) - 1) AS dof "
    "FROM tested_rows r GROUP BY feature"
)
O.CTES["tested_cells"] = (
    "SELECT r.feature, s.dof, coalesce(n.n, 0) AS observed, r.rn * c.cn / s.total AS expected FROM tested_rows r JOIN tested_cols c USING (feature) "
    "JOIN tested_size s USING (feature) LEFT JOIN tested_n n ON n.feature = r.feature AND n.label = c.label AND n.category IS NOT DISTINCT FROM r.category"
)
O.CTES["tested_stat"] = (
    "SELECT feature, max(dof) AS dof, sum(pow(CASE WHEN dof = 1 THEN abs(observed - expected) - least(abs(observed - expected), 0.5) "
    "ELSE abs(observed - expected) END, 2) / expected) AS statistic FROM tested_cells GROUP BY feature"
)
query("chi_square", "feature:s statistic:f dof:i p_value:f", f"SELECT feature, statistic, dof, {O.p_chi('statistic', 'dof')} AS p_value FROM tested_stat")(
    lambda t: profile.chi_square_independence(
        t.detail_training().withColumns({
            "Paid_Minimum": C.yes_flag("Payment_of_Min_Amount"),
        }), ["Credit_Mix", "Payment_Behaviour", "Payment_of_Min_Amount", "Paid_Minimum"]))
query("correlation", "column_a:s column_b:s correlation:f", " UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, corr({a}, {b}) AS correlation FROM fin"
    for i, a in enumerate(FIN_NUMERIC) for b in FIN_NUMERIC[i + 1:]
))(lambda t: moments.correlation_matrix(t.stored("financials"), FIN_NUMERIC))


_averages = [f"avg_{c}" for c in S.CLICKSTREAM_COLS]
O.CTES["click_means"] = (
    f"SELECT k.Customer_ID, {', '.join(f'avg({c}) AS avg_{c}' for c in S.CLICKSTREAM_COLS)} FROM clk k JOIN labels l "
    "ON k.Customer_ID = l.Customer_ID AND k.snapshot_date < l.snapshot_date GROUP BY k.Customer_ID"
)
_size = len(_averages)
_places = f"range({_size * _size})"
# Jacobi rotations of the correlation matrix, one row per rotation: the pair (p, q) of a step loses its off-diagonal entry
_pairs = ", ".join(f"[{p}, {q}]" for p in range(_size) for q in range(p + 1, _size))
_steps = 8 * _size * (_size - 1) // 2


def _rotated(matrix: str, mine: str, partner: str) -> str:
    """Entries of a matrix (list by rows, lambda x over places) after turning the lines p and q."""
    return (
        f"CASE {mine} WHEN p THEN c * {matrix}[x + 1] - s * {matrix}[{partner.format(to='q')} + 1] "
        f"WHEN q THEN s * {matrix}[{partner.format(to='p')} + 1] + c * {matrix}[x + 1] ELSE {matrix}[x + 1] END"
    )


_row, _column = f"x // {_size}", f"x % {_size}"
_eigenvalues = (
    f"SELECT unnest(list_transform(range({_size}), lambda x: m[x * {_size + 1} + 1])) AS v FROM jacobi WHERE step = {_steps}"
)
O.CTES["jacobi"] = (
    f"SELECT * FROM (WITH RECURSIVE turned AS (SELECT 0 AS step, ["
    + ", ".join("1.0" if a == b else f"corr({min(a, b)}, {max(a, b)})" for a in _averages for b in _averages)
    + f"]::DOUBLE[] AS m FROM click_means WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _averages)} "
    f"UNION ALL SELECT step, list_transform({_places}, lambda x: {_rotated('h', _row, f'({{to}} * {_size} + {_column})')}) AS m FROM ("
    f"SELECT step, p, q, c, s, list_transform({_places}, lambda x: {_rotated('m', _column, f'({_row} * {_size} + {{to}})')}) AS h FROM ("
    "SELECT *, t * c AS s FROM (SELECT *, 1 / sqrt(t * t + 1) AS c FROM (SELECT *, CASE WHEN abs(pq) < 1e-300 THEN 0.0 "
    "ELSE (CASE WHEN gap < 0 THEN -1 ELSE 1 END) / (abs(gap) + sqrt(gap * gap + 1)) END AS t FROM (SELECT *, "
    f"CASE WHEN abs(pq) < 1e-300 THEN 0.0 ELSE (m[q * {_size + 1} + 1] - m[p * {_size + 1} + 1]) / (2 * pq) END AS gap FROM ("
    f"SELECT *, m[p * {_size} + q + 1] AS pq FROM (SELECT step + 1 AS step, m, w[1 + step % len(w)][1] AS p, w[1 + step % len(w)][2] AS q "
    f"FROM (SELECT *, [{_pairs}] AS w FROM turned WHERE step < {_steps}))))))))) SELECT * FROM turned)"
)


@query("pca_variance", "component:i explained:f cumulative:f", (
    f"SELECT component, explained, sum(explained) OVER (ORDER BY component) AS cumulative FROM ("
    f"SELECT row_number() OVER (ORDER BY v DESC) AS component, v / sum(v) OVER () AS explained FROM ({_eigenvalues})) QUALIFY component <= 9"
))
def _(t):
    from creditspine.operators.joins import history_means

    anchors = t.labels().withColumnRenamed("snapshot_date", "mob_date")
    means = cut_lineage(history_means(t.clickstream(), anchors, S.CLICKSTREAM_COLS, inclusive=False))
    return moments.pca_variance(means, _averages)


query("date_ranges", "table_name:s min_date:d max_date:d", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, min(snapshot_date) AS min_date, max(snapshot_date) AS max_date FROM {c}"
    for n, c in {"financials": "fin", "clickstream": "clk", "attributes": "att", "ledger": "led"}.items()
))(lambda t: profile.date_ranges({
    "financials": t.financials(), "clickstream": t.clickstream(), "attributes": t.attributes(), "ledger": t.ledger()}))
query("snapshots_per_customer", "customers:i avg_snapshots:f max_snapshots:i multi_customers:i", (
    "SELECT count(*) AS customers, avg(n) AS avg_snapshots, max(n) AS max_snapshots, count(*) FILTER (WHERE n > 1) AS multi_customers "
    "FROM (SELECT Customer_ID, count(DISTINCT snapshot_date) AS n FROM led GROUP BY Customer_ID)"
))(lambda t: profile.snapshots_per_customer(t.ledger()))


def _nature(name: str, cte: str) -> str:
    return (
        f"SELECT '{name}' AS table_name, *, CASE WHEN score >= 2 THEN 'Snapshot' ELSE 'Overwrite' END AS classification FROM (SELECT *, "
        "CAST(avg_snapshots > 1.5 AS INTEGER) + CAST(max_snapshots > 1 AS INTEGER) + CAST(multi_customers > 0 AS INTEGER) "
        "+ CAST(distinct_dates > 3 AS INTEGER) + CAST(duplicate_pairs = 0 AS INTEGER) AS score FROM (SELECT avg(n) AS avg_snapshots, max(n) AS max_snapshots, "
        f"count(*) FILTER (WHERE n > 1) AS multi_customers, (SELECT count(DISTINCT snapshot_date) FROM {cte}) AS distinct_dates, "
        f"(SELECT count(*) FROM (SELECT 1 FROM {cte} GROUP BY Customer_ID, snapshot_date HAVING count(*) > 1)) AS duplicate_pairs "
        f"FROM (SELECT Customer_ID, count(DISTINCT snapshot_date) AS n FROM {cte} GROUP BY Customer_ID)))"
    )


_nature_kinds = "table_name:s avg_snapshots:f max_snapshots:i multi_customers:i distinct_dates:i duplicate_pairs:i score:i classification:s"
query("snapshot_nature", _nature_kinds, " UNION ALL ".join([_nature("attributes", "att"), _nature("clickstream", "clk"), _nature("ledger", "led")]))(
    lambda t: profile.snapshot_nature(t.attributes(), "attributes")
    .unionByName(profile.snapshot_nature(t.clickstream(), "clickstream"))
    .unionByName(profile.snapshot_nature(t.ledger(), "ledger")))
query("table_report", _nature_kinds + " rows:i columns:i customers:i", (
    f"SELECT *, (SELECT count(*) FROM led) AS rows, 15 AS columns, (SELECT count(DISTINCT Customer_ID) FROM led) AS customers FROM ({_nature('ledger', 'led')})"
))(lambda t: profile.table_report(t.ledger(), "ledger"))
query("duplicate_keys", "Customer_ID:s snapshot_date:d count:i", (
    "SELECT Customer_ID, snapshot_date, count(*) AS count FROM led GROUP BY ALL HAVING count(*) > 1"
))(lambda t: profile.duplicate_keys(t.ledger()))
query("repeated_ssn", "Customer_ID:s SSN:s", (
    "SELECT Customer_ID, SSN FROM att_raw QUALIFY row_number() OVER (PARTITION BY SSN ORDER BY Customer_ID) > 1"
))(lambda t: profile.repeated_rows(t.stored("raw_attributes"), "SSN", "Customer_ID"))
query("numeric_summary", "column:s count:i mean:f std:f min:f max:f", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, avg({c}) AS mean, stddev({c}) AS std, min({c}) AS min, max({c}) AS max FROM fin"
    for c in FIN_NUMERIC
))(lambda t: profile.numeric_summary(t.financials(), FIN_NUMERIC))
_probs = [0.0, 0.1, 0.5, 0.9, 0.97, 0.99, 1.0]
query("quantiles", "feature:s prob:f quantile:f", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {p} AS prob, quantile_cont(CAST({c} AS DOUBLE), {p}) AS quantile FROM fin" for c in FIN_NUMERIC for p in _probs
))(lambda t: ranks.exact_quantiles(t.stored("financials"), FIN_NUMERIC, _probs))
query("quantiles_of_ledger", "feature:s prob:f quantile:f", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {p} AS prob, quantile_cont({c[:-4]}_c / 100, {p}) AS quantile FROM led" for c in ("loan_amt", "overdue_amt") for p in _probs
))(lambda t: ranks.exact_quantiles(t.stored("ledger"), ["loan_amt", "overdue_amt"], _probs))
query("quantiles_by_snapshot", "snapshot_date:d feature:s prob:f quantile:f", (
    "SELECT snapshot_date, 'Annual_Income' AS feature, 0.25 AS prob, quantile_cont(Annual_Income, 0.25) AS quantile FROM fin "
    "WHERE Annual_Income IS NOT NULL GROUP BY snapshot_date"
))(lambda t: ranks.exact_quantiles(t.stored("financials"), ["Annual_Income"], [0.25], ["snapshot_date"]))
query("approx_quantile_count", "feature:s n:i", " UNION ALL ".join(f"SELECT '{c}' AS feature, 2 AS n FROM (SELECT count(*) FROM fin)" for c in _caps))(
    lambda t: ranks.approx_quantiles(t.financials(), _caps, [0.01, 0.95]).groupBy("feature").agg(F.count("quantile").alias("n")))
query("distinct_values", "Payment_Behaviour:s", "SELECT DISTINCT Payment_Behaviour FROM fin_raw")(
    lambda t: profile.distinct_values(t.stored("raw_financials"), "Payment_Behaviour"))
query("default_rate_by_category", "Credit_Mix:s non_default:i default:i total:i default_rate:f", (
    "SELECT coalesce(Credit_Mix, 'Unknown') AS Credit_Mix, count(*) FILTER (WHERE label = 0) AS non_default, "
    "count(*) FILTER (WHERE label = 1) AS default, count(*) AS total, avg(label) AS default_rate FROM detail_training GROUP BY 1"
))(lambda t: profile.default_rate_by_category(t.detail_training().withColumn("Credit_Mix", C.fill_category("Credit_Mix")), "Credit_Mix"))
query("top_categories", "Occupation:s count:i", (
    "SELECT Occupation, count(*) AS count FROM att GROUP BY Occupation ORDER BY count(*) DESC, Occupation NULLS FIRST LIMIT 3"
))(lambda t: profile.top_categories(t.attributes(), "Occupation", 3))
query("largest_values", "Customer_ID:s Annual_Income:f", (
    "SELECT Customer_ID, Annual_Income FROM fin WHERE Annual_Income IS NOT NULL ORDER BY Annual_Income DESC, Customer_ID LIMIT 20"
))(lambda t: profile.largest_values(t.financials(), "Annual_Income", 20, "Customer_ID"))


# --- splits and model statistics ------------------------------------------------------------------
query("time_window_tags", "loan_id:s window:s oot_part:s", (
    "SELECT loan_id, CASE WHEN snapshot_date BETWEEN DATE '1995-01-01' AND DATE '1995-10-31' THEN 'train_test' "
    "WHEN snapshot_date BETWEEN DATE '1995-11-01' AND DATE '1995-12-31' THEN 'oot' END AS window, "
    "CASE WHEN snapshot_date BETWEEN DATE '1995-11-01' AND DATE '1995-11-30' THEN 'oot1' "
    "WHEN snapshot_date BETWEEN DATE '1995-12-01' AND DATE '1995-12-31' THEN 'oot2' END AS oot_part FROM training"
))(lambda t: splits.tag_windows(t.training(), WINDOWS))
_n_train = "CAST(round_even(n * 0.7, 0) AS BIGINT)"
query("stratified_split", "label:i split:s n:i", (
    f"SELECT label, unnest(['train', 'val', 'test']) AS split, unnest([tr, va, n - tr - va]) AS n FROM (SELECT *, "
    f"CAST(round_even((n - tr) * 0.2 / (0.2 + 0.1), 0) AS BIGINT) AS va FROM (SELECT label, n, {_n_train} AS tr FROM "
    "(SELECT label, count(*) AS n FROM labels GROUP BY label)))"
))(lambda t: splits.stratified_split(t.stored("labels"), S.ID_COLS).groupBy("label", "split").agg(F.count("*").alias("n")))
query("random_split", "n:i both:i", "SELECT count(*) AS n, 2 AS both FROM labels")(
    lambda t: splits.random_split(t.labels(), S.ID_COLS).agg(F.count("*").alias("n"), F.count_distinct("split").alias("both")))
query("reference_sample", "n:i distinct_rows:i", (
    "SELECT least(5000, count(*)) AS n, least(5000, count(*)) AS distinct_rows FROM labels"
))(lambda t: projection.sample_rows(t.stored("labels"), S.ID_COLS, 5000, 42).agg(
    F.count("*").alias("n"), F.count_distinct("loan_id").alias("distinct_rows")))
query("sample_fraction", "within:b", "SELECT true AS within FROM (SELECT count(*) FROM led)")(
    lambda t: projection.sample_fraction(t.ledger(), ["loan_id", "installment_num"], 0.2, 42).agg(
        F.count("*").alias("k")).select((F.abs(F.col("k") / t.ledger().agg(F.count("*")).scalar() - 0.2) < 0.02).alias("within")))
query("data_stats", "split:s n_rows:i bad_rate:f", (
    "SELECT split, count(*) AS n_rows, round(avg(label), 4) AS bad_rate FROM scored WHERE model_version = 'A' GROUP BY split"
))(lambda t: metrics.data_stats(t.scored().where("model_version = 'A'")))
query("class_weights", "negatives:i positives:i weight_0:f weight_1:f positive_weight:f", (
    "SELECT n0 AS negatives, n1 AS positives, (n0 + n1) / (2 * n0) AS weight_0, (n0 + n1) / (2 * n1) AS weight_1, n0 / n1 AS positive_weight "
    "FROM (SELECT count(*) FILTER (WHERE label = 0) AS n0, count(*) FILTER (WHERE label = 1) AS n1 FROM training)"
))(lambda t: modelling.class_counts(t.training()))
query("auc_gini", "model_version:s split:s auc:f gini:f", "SELECT *, 2 * auc - 1 AS gini FROM auc_split")(
    lambda t: metrics.auc_by(t.stored("scored"), ["model_version", "split"], "model_predictions").withColumn("gini", F.col("auc") * 2 - 1))
query("confusion_matrix", "model_version:s split:s tp:i fp:i tn:i fn:i", "SELECT * FROM conf_split")(
    lambda t: metrics.confusion_by(t.stored("scored"), ["model_version", "split"], "model_predictions"))
query("classification_metrics", "model_version:s split:s auc:f gini:f accuracy:f precision:f recall:f f1:f", (
    "SELECT c.model_version, c.split, a.auc, 2 * a.auc - 1 AS gini, (tp + tn) / (tp + fp + tn + fn) AS accuracy, "
    "coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall, "
    "coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM conf_split c JOIN auc_split a "
    "ON c.model_version = a.model_version AND c.split = a.split"
))(lambda t: metrics.classification_metrics(t.stored("scored"), ["model_version", "split"], "model_predictions"))
query("champion_challenger", "champion_auc_oot:f challenger_auc_oot:f challenger_auc_uplift:f ab_test_recommended:b", (
    "SELECT a AS champion_auc_oot, b AS challenger_auc_oot, b - a AS challenger_auc_uplift, b - a >= 0.05 AS ab_test_recommended FROM "
    "(SELECT max(auc) FILTER (WHERE model_version = 'B') AS a, max(auc) FILTER (WHERE model_version = 'A') AS b FROM auc_split WHERE split = 'test')"
))(lambda t: modelling.compare_models(
    metrics.auc_by(t.stored("scored"), ["model_version", "split"], "model_predictions"), "B", "A", split="test"))
O.CTES["sd_edges"] = f"SELECT model_version, quantile_cont(model_predictions, {O.DECILES}) AS e FROM scored GROUP BY ALL"
query("score_distribution", "model_version:s bin:s lower:f upper:f share:f", (
    "SELECT x.model_version, lpad(CAST(x.i AS VARCHAR), 2, '0') AS bin, lower, upper, coalesce(n, 0) / sum(coalesce(n, 0)) OVER (PARTITION BY x.model_version) AS share "
    "FROM (SELECT model_version, i, CASE WHEN i = 0 THEN 0.0 ELSE e[i] END AS lower, CASE WHEN i = 9 THEN 1.0 ELSE e[i + 1] END AS upper "
    "FROM sd_edges CROSS JOIN (SELECT unnest(range(0, 10)) AS i)) x LEFT JOIN (SELECT s.model_version, len([y for y in e if y <= model_predictions]) AS i, count(*) AS n "
    "FROM scored s JOIN sd_edges USING (model_version) WHERE model_predictions IS NOT NULL GROUP BY ALL) c ON x.model_version = c.model_version AND x.i = c.i"
))(lambda t: drift.score_distribution(t.stored("scored"), "model_predictions", ["model_version"]))
_dist = ["Age", "Annual_Income", "Interest_Rate", "Payment_Value", "fe_1", "fe_9"]
query("numeric_distribution", "feature:s bin:s lower:f upper:f share:f", (
    "SELECT x.feature, lpad(CAST(x.i AS VARCHAR), 2, '0') AS bin, lower, upper, coalesce(n, 0) / sum(coalesce(n, 0)) OVER (PARTITION BY x.feature) AS share "
    "FROM (SELECT feature, i, CASE WHEN i = 0 THEN NULL ELSE e[i] END AS lower, CASE WHEN i = 9 THEN NULL ELSE e[i + 1] END AS upper "
    "FROM edges CROSS JOIN (SELECT unnest(range(0, 10)) AS i)) x LEFT JOIN (SELECT l.feature, len([y for y in e if y <= value]) AS i, count(*) AS n "
    "FROM ref_long l JOIN edges USING (feature) GROUP BY ALL) c ON x.feature = c.feature AND x.i = c.i WHERE x.feature IN ("
    + ", ".join(f"'{c}'" for c in _dist) + ")"
))(lambda t: drift.numeric_distribution(reference(t), _dist).withColumns({
    c: F.when(F.abs(c) != F.lit(float("inf")), F.col(c)) for c in ("lower", "upper")}))
query("category_distribution", "feature:s category:s share:f", (
    "SELECT feature, bin AS category, p AS share FROM ref_share WHERE feature IN ('Occupation', 'Age_group')"
))(lambda t: drift.category_distribution(reference(t), ["Occupation", "Age_group"]))
query("scoring_metadata", "snapshot_date:d model_name:s model_version:s n_scored:i error_rate:f", (
    "SELECT snapshot_date, model_name, model_version, count(*) AS n_scored, avg(CASE WHEN model_predictions IS NULL THEN 1.0 ELSE 0 END) AS error_rate "
    "FROM preds GROUP BY ALL"
))(lambda t: modelling.scoring_metadata(t.predictions()))


_BANKS: dict[tuple[str, str, str], str] = {}


def fitted(t, family: str):
    """Best candidate of one family's grid on the training windows, plus the tagged rows.

    A grid is fitted once a session: the model is saved, and every query loads it.
    """
    table = t.stored("training")
    split = training_plan.tag_splits(table, WINDOWS)
    key = (t.spark.sparkContext.applicationId, t.folder, family)
    if key not in _BANKS:
        numeric, categorical = projection.feature_columns(table, [*S.ID_COLS, *S.LABEL_COLS], S.CATEGORICAL_COLS)
        model = modelling.fit_families(split, numeric, categorical, {family: modelling.FAMILIES[family][1]})[family]
        model.version = family
        bank = scratch(t.spark, "bank")
        models.save_model(t.spark, model, bank)
        _BANKS[key] = bank
    return models.load_model(t.spark, _BANKS[key], family), split


def fit_report(t, family: str):
    model, split = fitted(t, family)
    scored = modelling.score(split, model).withColumn("model_version", F.lit(model.version))
    return training_plan.split_metrics(scored)


_fit_kinds = "model_version:s split:s auc:f gini:f accuracy:f recall:f"
query("lr_fit_score", _fit_kinds)(lambda t: fit_report(t, "logistic_regression"))
query("gbt_fit_score", _fit_kinds)(lambda t: fit_report(t, "boosted_trees"))


@query("coef_top10", "feature:s coefficient:f")
def _(t):
    model, split = fitted(t, "logistic_regression")
    return modelling.coefficient_ranking(split, model)


@query("attribution_linear", "snapshot_date:d feature:s mean_abs_shap:f")
def _(t):
    model, split = fitted(t, "logistic_regression")
    return attribution.linear_attribution(split.where("split = 'train'"), every_month(t), model, ["snapshot_date"])


def sampled(t, family: str):
    model, split = fitted(t, family)
    return attribution.sampled_attribution(split.where("split = 'train'"), every_month(t), model, S.KEYS, ["snapshot_date"])


_month_kinds = "snapshot_date:d feature:s mean_abs_shap:f"
query("attribution_sampled", _month_kinds)(lambda t: sampled(t, "boosted_trees"))
query("attribution_sampled_linear", _month_kinds)(lambda t: sampled(t, "logistic_regression"))

# --- attribution of given models, whose Shapley values SQL can tell from all coalitions ----------
EXACT_FEATURES = {"Age": 40.0, "Interest_Rate": 12.0, "fe_1": 3.0, "Num_Bank_Accounts": 5.0}  # with the value of a missing one
BACKGROUND = 50
#: Two trees: (feature, threshold, left, right, value), and a linear model over the same features.
GIVEN_TREES = [
    [(1, 15.0, 1, 2, 0.0), (0, 42.0, 3, 4, 0.0), (2, 2.0, 5, 6, 0.0), (-1, 0, 0, 0, -0.9), (-1, 0, 0, 0, 0.2), (-1, 0, 0, 0, 0.4), (-1, 0, 0, 0, 1.1)],
    [(3, 6.0, 1, 2, 0.0), (-1, 0, 0, 0, -0.3), (1, 22.0, 3, 4, 0.0), (-1, 0, 0, 0, 0.1), (-1, 0, 0, 0, 0.8)],
]
GIVEN_WEIGHTS = [1.0, 0.5]
GIVEN_LINEAR = ([0.02, 0.05, -0.1, 0.15], -1.5)
GIVEN = {
    "A": scorers.forest(GIVEN_TREES, GIVEN_WEIGHTS),
    "B": scorers.LinearScorer(np.array(GIVEN_LINEAR[0]), GIVEN_LINEAR[1]),
}


def _tree_sql(nodes, at=0) -> str:
    f, threshold, left, right, value = nodes[at]
    if f < 0:
        return str(value)
    return f"CASE WHEN v{f} <= {threshold} THEN {_tree_sql(nodes, left)} ELSE {_tree_sql(nodes, right)} END"


_margins = {
    "A": "2 * (" + " + ".join(f"{w} * ({_tree_sql(tree)})" for tree, w in zip(GIVEN_TREES, GIVEN_WEIGHTS)) + ")",
    "B": " + ".join(f"{w} * v{k}" for k, w in enumerate(GIVEN_LINEAR[0])) + f" + {GIVEN_LINEAR[1]}",
}
_given = ", ".join(f"CAST(coalesce({c}, {v}) AS DOUBLE) AS x{k}" for k, (c, v) in enumerate(EXACT_FEATURES.items()))
O.CTES["given_cur"] = f"SELECT Customer_ID, snapshot_date, {_given} FROM cur"
O.CTES["given_ref"] = (
    f"SELECT {_given.replace(' AS x', ' AS z')} FROM (SELECT * FROM ref ORDER BY snapshot_date, Customer_ID LIMIT {BACKGROUND})"
)
O.CTES["coalitions"] = (
    "SELECT Customer_ID, snapshot_date, mask, " + ", ".join(f"CASE WHEN mask & {1 << k} > 0 THEN x{k} ELSE z{k} END AS v{k}" for k in range(4))
    + " FROM given_cur CROSS JOIN given_ref CROSS JOIN (SELECT unnest(range(16)) AS mask)"
)
O.CTES["coalition_scores"] = "SELECT snapshot_date, Customer_ID, mask, " + ", ".join(
    f"avg(1 / (1 + exp(-({m})))) AS s_{v}" for v, m in _margins.items()) + " FROM coalitions GROUP BY ALL"
# a coalition of s features with the feature weighs (s - 1)! (4 - s)! / 4!, one of s without it -s! (3 - s)! / 4!
_weight = "CASE WHEN mask & (1 << k) > 0 THEN [6, 2, 2, 6][bit_count(mask)] ELSE -[6, 2, 2, 6][bit_count(mask) + 1] END / 24.0"
O.CTES["given_phi"] = (
    "SELECT model_version, snapshot_date, Customer_ID, k, sum(score * w) AS phi FROM ("
    + " UNION ALL ".join(f"SELECT '{v}' AS model_version, snapshot_date, Customer_ID, k, s_{v} AS score, {_weight} AS w "
                         "FROM coalition_scores CROSS JOIN (SELECT unnest(range(4)) AS k)" for v in _margins)
    + ") GROUP BY ALL"
)
O.CTES["given_shap"] = (
    f"SELECT model_version, snapshot_date, {list(EXACT_FEATURES)}[k + 1] AS feature, avg(abs(phi)) AS mean_abs_shap FROM given_phi GROUP BY ALL"
)


def given_attribution(t):
    """Attribution of the given models over all rows of all months, against the first training rows."""
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(v)) for c, v in EXACT_FEATURES.items()]).alias("x")
    rows = every_month(t).select("snapshot_date", F.xxhash64(*S.KEYS).alias("_row"), x)
    first = reference(t).orderBy("snapshot_date", "Customer_ID").limit(BACKGROUND).select(x)
    background = np.array([r["x"] for r in first.collect()])
    tables = [
        attribution.mean_absolute(
            attribution.shapley_rows(rows, ["snapshot_date"], scorer, background, np.arange(4), 4), ["snapshot_date"], list(EXACT_FEATURES)
        ).withColumn("model_version", F.lit(version))
        for version, scorer in GIVEN.items()
    ]
    return tables[0].unionByName(tables[1])


query("attribution_exact", "model_version:s snapshot_date:d feature:s mean_abs_shap:f", "SELECT * FROM given_shap")(given_attribution)


# --- drift and monitoring ------------------------------------------------------------------------
def prediction_runs(t):
    return projection.between_dates(t.stored("predictions"), O.RUN_START, None)


def reference_scores(t):
    return projection.between_dates(t.stored("predictions"), *REF_RANGE)


query("psi_scores", "model_version:s snapshot_date:d psi_score:f", "SELECT * FROM psi")(
    lambda t: drift.prediction_psi(reference_scores(t), prediction_runs(t)))
query("csi_features", "feature:s snapshot_date:d csi:f", "SELECT * FROM csi")(
    lambda t: drift.feature_csi(reference(t), every_month(t), O.DRIFT_NUMERIC, O.DRIFT_CATEGORIES))
query("csi_summary", "snapshot_date:d max_csi:f mean_csi:f", "SELECT * FROM csi_sum")(
    lambda t: drift.csi_summary(drift.feature_csi(reference(t), every_month(t), O.DRIFT_NUMERIC, O.DRIFT_CATEGORIES)))
query("ks_numeric", "feature:s snapshot_date:d statistic:f p_value:f", "SELECT * FROM ks")(
    lambda t: drift.ks_numeric(reference(t), every_month(t), O.DRIFT_NUMERIC))
query("chi2_drift", "feature:s snapshot_date:d statistic:f dof:i p_value:f", (
    "SELECT feature, snapshot_date, CASE WHEN isinf(statistic) THEN NULL ELSE statistic END AS statistic, dof, p_value FROM chi"
))(lambda t: drift.chi_square_drift(reference(t), every_month(t), O.DRIFT_CATEGORIES).withColumn(
    "statistic", F.when(F.col("statistic") != F.lit(float("inf")), F.col("statistic"))))
query("min_pvalue", "snapshot_date:d min_csi_pvalue:f", "SELECT * FROM pmin")(
    lambda t: drift.min_pvalue([
        drift.ks_numeric(reference(t), every_month(t), O.DRIFT_NUMERIC),
        drift.chi_square_drift(reference(t), every_month(t), O.DRIFT_CATEGORIES)]))
query("usable_columns", "feature:s snapshot_date:d usable:b", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, snapshot_date, count({c}) > 0 AND (SELECT count({c}) FROM ref) > 0 AS usable FROM cur GROUP BY snapshot_date"
    for c in [*O.DRIFT_NUMERIC, *O.DRIFT_CATEGORIES]
))(lambda t: drift.usable_features(reference(t), every_month(t), [*O.DRIFT_NUMERIC, *O.DRIFT_CATEGORIES]))
_perf_kinds = "snapshot_date:d model_version:s label_available:b auc:f gini:f accuracy:f precision:f recall:f f1:f"
query("matured_performance", _perf_kinds, "SELECT * FROM perf_run")(
    lambda t: monitor.matured_performance(t.stored("predictions"), t.stored("labels")))


def monitoring(t):
    """All monitoring rows, drift from the stored value counts of reference and months."""
    before = cut_lineage(drift.value_counts(reference(t), O.DRIFT_NUMERIC, O.DRIFT_CATEGORIES))
    state = cut_lineage(monitoring_plan.month_state(every_month(t), O.DRIFT_NUMERIC, O.DRIFT_CATEGORIES))
    edges = ranks.fit_edges(reference(t), O.DRIFT_NUMERIC, drift.N_BINS)
    return monitor.monitoring_rows(
        scoring=modelling.scoring_metadata(prediction_runs(t)),
        missing=profile.missing_by_group(every_month(t), S.FEATURE_SOURCES, ["snapshot_date"]),
        psi=drift.prediction_psi(reference_scores(t), prediction_runs(t)),
        csi=drift.csi_summary(drift.csi_from_counts(before, state, edges, O.DRIFT_CATEGORIES)),
        pvalues=drift.min_pvalue([drift.ks_from_counts(before, state), drift.chi_square_from_counts(before, state)]),
        attribution=attribution.top_features_json(given_attribution(t), ["snapshot_date", "model_version"]),
        performance=monitor.matured_performance(prediction_runs(t), t.stored("labels")),
    )


_row_kinds = (
    "snapshot_date:d model_name:s model_version:s n_scored:i pct_missing_attributes:f pct_missing_financials:f pct_missing_clickstream:f "
    "psi_score:f max_csi:f mean_csi:f min_csi_pvalue:f error_rate:f label_available:b auc:f gini:f accuracy:f precision:f recall:f f1:f "
    "performance_alert_level:s performance_alert_reasons:s feature_alert_level:s feature_alert_reasons:s"
)
query("monitoring_rows", _row_kinds, "SELECT * FROM mon")(monitoring)
query("performance_alerts", "snapshot_date:d model_version:s performance_alert_level:s performance_alert_reasons:s", (
    "SELECT *, " + f"{O._LEVELS}[1 + greatest({', '.join(O._perf_rank(m, g, l) for m, (g, l, _) in S.PERFORMANCE_BANDS.items())})] AS performance_alert_level, "
    f"concat_ws('; ', {', '.join(O._perf_reason(m, g, l, x) for m, (g, l, x) in S.PERFORMANCE_BANDS.items())}) AS performance_alert_reasons FROM perf_run"
))(lambda t: monitor.performance_alerts(monitor.matured_performance(t.stored("predictions"), t.stored("labels"))))
query("feature_alerts", "snapshot_date:d model_version:s feature_alert_level:s feature_alert_reasons:s", (
    "SELECT snapshot_date, model_version, feature_alert_level, feature_alert_reasons FROM mon"
))(monitoring)
query("monitoring_history", "snapshot_date:d model_version:s n_scored:i psi_score:f", (
    "SELECT snapshot_date, model_version, n_scored, psi_score FROM mon WHERE snapshot_date BETWEEN DATE '1996-01-01' AND DATE '1998-03-01'"
))(lambda t: monitor.monitoring_history(monitoring(t), ["A", "B"], "1998-03-01", T.TRAIN_DATE))
query("version_agreement", "aligned:b", (
    "SELECT bool_and(coalesce(lo = hi, true)) AS aligned FROM (SELECT min(max_csi) AS lo, max(max_csi) AS hi FROM mon GROUP BY snapshot_date)"
))(lambda t: monitor.version_agreement(monitoring(t)))
query("metric_series", "snapshot_date:d model_version:s metric:s value:f", " UNION ALL ".join(
    f"SELECT snapshot_date, model_version, '{m}' AS metric, {m} AS value FROM mon WHERE label_available AND {m} IS NOT NULL" for m in ("auc", "accuracy", "recall")
))(lambda t: monitor.metric_series(monitoring(t)))
query("alert_series", "snapshot_date:d model_version:s alert:s level:s rank:i", " UNION ALL ".join(
    f"SELECT snapshot_date, model_version, '{a}' AS alert, {a} AS level, list_position({O._LEVELS}, {a}) - 1 AS rank FROM mon"
    for a in ("performance_alert_level", "feature_alert_level")
))(lambda t: monitor.alert_series(monitoring(t)))
query("attribution_history", "snapshot_date:d model_version:s feature:s mean_abs_shap:f", (
    "SELECT snapshot_date, model_version, feature, round(mean_abs_shap, 6) AS mean_abs_shap FROM given_shap "
    "WHERE (snapshot_date, model_version) IN (SELECT (snapshot_date, model_version) FROM mon) "
    "QUALIFY row_number() OVER (PARTITION BY snapshot_date, model_version ORDER BY mean_abs_shap DESC, feature) <= 5"
))(lambda t: monitor.attribution_history(monitoring(t)))
query("top_per_group", "snapshot_date:d Customer_ID:s Annual_Income:f rank:i", (
    "SELECT snapshot_date, Customer_ID, Annual_Income, row_number() OVER (PARTITION BY snapshot_date ORDER BY Annual_Income DESC, Customer_ID) AS rank "
    "FROM fin WHERE Annual_Income IS NOT NULL QUALIFY rank <= 5"
))(lambda t: profile.rank_within(t.financials().where("Annual_Income is not null"), ["snapshot_date"], "Annual_Income", 5, "Customer_ID"))
