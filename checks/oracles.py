"""DuckDB common table expressions behind the oracle queries.

Written from the meaning of each operator in plain SQL (windows, joins, exact
quantiles), not from the Spark plans, so that the two sides are independent.
"""

from __future__ import annotations

import re

from checks import testbed as T
from creditspine import schemas as S


def cols(rules: dict[str, str]) -> str:
    return ", ".join(f"{T.duck(e)} AS {n}" for n, e in rules.items())


def as_int(x: str) -> str:
    return f"CAST(trunc(try_cast({x} AS DOUBLE)) AS INTEGER)"


def number(x: str, dtype: str) -> str:
    return as_int(x) if dtype == "int" else f"try_cast({x} AS DOUBLE)"


def clean(x: str, dtype: str, low=None, high=None) -> str:
    """Strict number as SQL."""
    body = f"replace({x}, '_', '')"
    v = number(body, dtype)
    rng = ""
    if low is not None:
        rng += f" AND {v} >= {low}"
    if high is not None:
        rng += f" AND {v} <= {high}"
    return (
        f"CASE WHEN left({x}, 1) <> '_' AND right({x}, 1) <> '_' "
        f"AND regexp_matches({body}, '^-?\\d+(\\.\\d+)?$'){rng} THEN {v} END"
    )


def lenient(x: str, dtype: str) -> str:
    return number(f"nullif(regexp_extract({x}, '([-+]?\\d*\\.?\\d+)', 1), '')", dtype)


def part_of(x: str, unit: str) -> str:
    return f"try_cast(nullif(regexp_extract({x}, '(\\d+)\\s+{unit}', 1), '') AS INTEGER)"


def clean_occupation(x: str = "Occupation") -> str:
    return f"CASE WHEN NOT regexp_matches({x}, '_{{2,}}') THEN trim({x}) END"


def ratio(n: str, d: str) -> str:
    return f"CAST({n} AS DOUBLE) / nullif(CAST({d} AS DOUBLE), 0)"


def list_count(x: str, separator: str) -> str:
    items = f"[lower(trim(y)) for y in regexp_split_to_array({x}, '{separator}')]"
    return f"CASE WHEN {x} IS NULL THEN 0 ELSE len(list_distinct({items})) END"


SEPARATOR = r",\s*and\s+|\s+and\s+|,\s*"
SEPARATOR_LEGACY = ", |, and "

RATIOS = {
    "log_Annual_Income": "ln(1 + Annual_Income)",
    "debt_to_income": ratio("Outstanding_Debt", "Annual_Income + 1"),
    "emi_to_salary": ratio("Total_EMI_per_month", "Monthly_Inhand_Salary + 1"),
    "investment_rate": ratio("Amount_invested_monthly", "Monthly_Inhand_Salary + 1"),
    "balance_to_debt": ratio("Monthly_Balance + 1", "Outstanding_Debt + 1"),
    "inq_per_loan": ratio("Num_Credit_Inquiries", "Num_of_Loan + 1"),
}
CATEGORY_RANKS = {
    "Credit_Mix_Label": "CASE Credit_Mix WHEN 'Good' THEN 2 WHEN 'Standard' THEN 1 WHEN 'Bad' THEN 0 END",
    "Credit_History_Months": f"{part_of('Credit_History_Age', 'Years')} * 12 + {part_of('Credit_History_Age', 'Months')}",
    "Payment_of_Min_Amount": "CASE WHEN Payment_of_Min_Amount = 'Yes' THEN 1 ELSE 0 END",
    "Spending_Level": "CASE WHEN Payment_Behaviour LIKE 'High%' THEN 1 WHEN Payment_Behaviour LIKE 'Low%' THEN 0 END",
    "Payment_Value": (
        "CASE WHEN contains(Payment_Behaviour, 'Large') THEN 2 WHEN contains(Payment_Behaviour, 'Medium') THEN 1 "
        "WHEN contains(Payment_Behaviour, 'Small') THEN 0 END"
    ),
}


def band(x: str, edges, labels, null_label: str = "NULL") -> str:
    arms = " ".join(f"WHEN {x} < {e} THEN '{l}'" for e, l in zip(edges, labels))
    return f"CASE WHEN {x} IS NULL THEN {null_label} {arms} ELSE '{labels[-1]}' END"


def long(table: str, ids: list[str], columns: list[str], name: str = "feature", value: str = "value",
         cast: str = "DOUBLE") -> str:
    """Unpivot that keeps nulls."""
    pre = "".join(f"{i}, " for i in ids)
    return " UNION ALL ".join(f"SELECT {pre}'{c}' AS {name}, CAST({c} AS {cast}) AS {value} FROM {table}" for c in columns)


def p_chi(stat: str, dof: str) -> str:
    """Chi-square p-value: one minus the lower incomplete gamma series."""
    x, a = f"({stat} / 2.0)", f"({dof} / 2.0)"
    series = f"list_sum([exp(-{x} + ({a} + j) * ln({x}) - lgamma({a} + j + 1)) for j in range(0, 3000)])"
    return f"CASE WHEN isinf({stat}) THEN 0.0 WHEN {stat} <= 0 THEN 1.0 WHEN {stat} > 2500 THEN 0.0 ELSE greatest(0.0, 1 - {series}) END"


def p_ks(d: str, a: str, b: str) -> str:
    lam = f"({d} * {d} * CAST({a} AS DOUBLE) * {b} / ({a} + {b}))"
    series = (
        f"list_sum([(CASE WHEN j % 2 = 1 THEN 2.0 ELSE -2.0 END) * exp(-2.0 * j * j * {lam}) for j in range(1, 101)])"
    )
    return f"CASE WHEN {lam} < 0.04 THEN 1.0 ELSE greatest(0.0, least(1.0, {series})) END"


DECILES = "[" + ", ".join(str(i / 10) for i in range(1, 10)) + "]"
DRIFT_NUMERIC = ["Age", *S.FINANCIALS_COLS, *S.CLICKSTREAM_COLS]
DRIFT_CATEGORIES = ["Occupation", "Age_group"]
RUN_START = "1996-01-01"


def eps(x: str) -> str:
    return f"CASE WHEN coalesce({x}, 0) = 0 THEN 0.0001 ELSE {x} END"


CTES: dict[str, str] = {
    # --- raw ------------------------------------------------------------------
    "ord": f"SELECT {cols(T.ORDER_RULES)} FROM orders",
    "fm": "SELECT c, min(start) AS snap, count(*) AS n, CAST(sum(loan_c) AS BIGINT) AS s FROM ord GROUP BY c",
    "people": f"SELECT p.*, fm.snap, fm.n, fm.s FROM (SELECT {cols(T.PERSON_RULES)} FROM customer) p JOIN fm ON p.c = fm.c",
    "risk": f"SELECT *, {cols(T.RISK_RULES)} FROM ord",
    "months_raw": "SELECT r.*, m.i FROM risk r CROSS JOIN (SELECT unnest(range(0, 11)) AS i) m",
    "amounts0": f"SELECT *, {cols(T.MONTH_RULES)} FROM months_raw",
    "amounts": f"SELECT *, {cols(T.AMOUNT_RULES)}, CAST(start + to_months(CAST(i AS INTEGER)) AS DATE) AS snap FROM amounts0",
    "att_raw": f"SELECT {cols(T.ATTRIBUTE_TEXT)} FROM people",
    "fin_raw": f"SELECT {cols(T.FINANCIAL_TEXT)} FROM people",
    "ev": "SELECT user_id AS c, event_type, CAST(round(value * 100) AS BIGINT) AS v, (day(ts) - 1) % 12 AS m FROM events",
    "panel": "SELECT c, m, " + ", ".join(
        f"count(*) FILTER (WHERE event_type = '{e}') AS n_{t}, "
        f"CAST(sum(v) FILTER (WHERE event_type = '{e}') AS BIGINT) AS v_{t}" for t, e in enumerate(T.EVENT_TYPES)
    ) + " FROM ev GROUP BY c, m",
    "clk_raw": f"SELECT {cols(T.CLICK_TEXT)} FROM (SELECT p.* EXCLUDE (c), p.c, CAST(fm.snap + to_months(CAST(m - 4 AS INTEGER)) AS DATE) AS snap "
               "FROM panel p JOIN fm ON p.c = fm.c)",
    # --- silver -----------------------------------------------------------------
    "led0": (
        "SELECT 'L' || k AS loan_id, 'C' || c AS Customer_ID, start AS loan_start_date, 10 AS tenure, i AS installment_num, i AS mob, "
        "coalesce(loan_c, 0) AS loan_c, coalesce(due_c, 0) AS due_c, coalesce(paid_c, 0) AS paid_c, "
        "coalesce(overdue_c, 0) AS overdue_c, coalesce(balance_c, 0) AS balance_c, snap AS snapshot_date, "
        "CASE WHEN due_c > 0 AND overdue_c IS NOT NULL THEN (overdue_c + due_c - 1) // due_c ELSE 0 END AS installments_missed FROM amounts"
    ),
    "led1": (
        "SELECT *, CASE WHEN installments_missed > 0 THEN CAST(snapshot_date - to_months(CAST(installments_missed AS INTEGER)) AS DATE) END "
        "AS first_missed_date FROM led0"
    ),
    "led": (
        "SELECT *, CASE WHEN overdue_c > 0 THEN date_diff('day', first_missed_date, snapshot_date) ELSE 0 END AS dpd, "
        "loan_c / 100 AS loan_amt, due_c / 100 AS due_amt, paid_c / 100 AS paid_amt, overdue_c / 100 AS overdue_amt, "
        "balance_c / 100 AS balance FROM led1"
    ),
    "att": (
        f"SELECT Customer_ID, CAST(snapshot_date AS DATE) AS snapshot_date, Age, Occupation, "
        f"{band('Age', *S.AGE_BANDS_SILVER)} AS Age_group FROM (SELECT Customer_ID, snapshot_date, "
        f"{clean('Age', 'int', 1, 100)} AS Age, {clean_occupation()} AS Occupation FROM att_raw)"
    ),
    "fin_num": "SELECT Customer_ID, CAST(snapshot_date AS DATE) AS snapshot_date, " + ", ".join(
        f"{clean(c, dtype, low, high)} AS {c}" for c, (dtype, low, high) in S.FINANCIAL_RULES.items()
    ) + f", {list_count('Type_of_Loan', SEPARATOR)} AS num_loan_types, " + ", ".join(
        f"{e} AS {c}" for c, e in CATEGORY_RANKS.items()
    ) + ", Type_of_Loan FROM fin_raw",
    "fin": "SELECT * EXCLUDE (Type_of_Loan), " + ", ".join(f"{e} AS {c}" for c, e in RATIOS.items())
           + ", CAST(Changed_Credit_Limit <> 0 AS INTEGER) AS has_credit_limit_change FROM fin_num",
    "clk": "SELECT Customer_ID, CAST(snapshot_date AS DATE) AS snapshot_date, "
           + ", ".join(f"CAST({c} AS INTEGER) AS {c}" for c in S.CLICKSTREAM_COLS) + " FROM clk_raw",
    # --- gold -----------------------------------------------------------------
    "labels": (
        "SELECT loan_id, Customer_ID, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label, '30dpd_6mob' AS label_def, snapshot_date "
        "FROM led WHERE mob = 6"
    ),
    "features": (
        "SELECT a.*, f.* EXCLUDE (Customer_ID, snapshot_date, " + ", ".join(S.LEAKAGE_COLS) + "), k.* EXCLUDE (Customer_ID, snapshot_date) "
        "FROM att a JOIN fin f USING (Customer_ID, snapshot_date) LEFT JOIN clk k "
        "ON a.Customer_ID = k.Customer_ID AND a.snapshot_date = k.snapshot_date"
    ),
    "back_labels": (
        "SELECT Customer_ID, CAST(snapshot_date - INTERVAL 6 MONTH AS DATE) AS snapshot_date, loan_id, label, label_def FROM labels"
    ),
    "training": "SELECT f.*, l.loan_id, l.label, l.label_def FROM features f JOIN back_labels l USING (Customer_ID, snapshot_date)",
    "detail_training": (
        "SELECT n.*, CASE WHEN r.Credit_Mix <> '_' THEN r.Credit_Mix END AS Credit_Mix, r.Payment_of_Min_Amount AS Min_Text, "
        "CASE WHEN NOT starts_with(r.Payment_Behaviour, '!') THEN r.Payment_Behaviour END AS Payment_Behaviour, "
        "r.Credit_History_Age, l.loan_id, l.label FROM fin_num n JOIN fin_raw r ON n.Customer_ID = r.Customer_ID "
        "JOIN back_labels l ON n.Customer_ID = l.Customer_ID AND n.snapshot_date = l.snapshot_date"
    ),
    "att_training": (
        "SELECT r.Customer_ID, r.Age, CASE WHEN r.Occupation <> '_______' THEN trim(r.Occupation) END AS Occupation, "
        "CAST(r.snapshot_date AS DATE) AS snapshot_date, l.loan_id, l.label FROM att_raw r JOIN back_labels l "
        "ON r.Customer_ID = l.Customer_ID AND CAST(r.snapshot_date AS DATE) = l.snapshot_date"
    ),
    # --- scores -----------------------------------------------------------------
    "preds": " UNION ALL ".join(
        f"SELECT 'C' || c AS Customer_ID, snap AS snapshot_date, 'model_{v}' AS model_name, '{v}' AS model_version, "
        f"{e} AS model_predictions, c FROM people" for v, e in T.SCORES.items()
    ),
    "scored": (
        "SELECT p.*, l.label, CASE WHEN c % 10 < 7 THEN 'train' WHEN c % 10 < 9 THEN 'val' ELSE 'test' END AS split "
        "FROM preds p JOIN back_labels l ON p.Customer_ID = l.Customer_ID AND p.snapshot_date = l.snapshot_date"
    ),
    # --- metrics per (version, split) and per (version, month) --------------------
    "ranks_split": (
        "SELECT model_version, split, label, rank() OVER (PARTITION BY model_version, split ORDER BY model_predictions) "
        "+ (count(*) OVER (PARTITION BY model_version, split, model_predictions) - 1) / 2.0 AS r "
        "FROM scored WHERE model_predictions IS NOT NULL"
    ),
    "auc_split": (
        "SELECT model_version, split, (sum(r) FILTER (WHERE label = 1) - sum(label) * (sum(label) + 1) / 2.0) / "
        "nullif(sum(label) * sum(1 - label), 0) AS auc FROM ranks_split GROUP BY ALL"
    ),
    "conf_split": (
        "SELECT model_version, split, " + ", ".join(
            f"count(*) FILTER (WHERE {cond}) AS {n}" for n, cond in {
                "tp": "model_predictions >= 0.5 AND label = 1", "fp": "model_predictions >= 0.5 AND label = 0",
                "tn": "model_predictions < 0.5 AND label = 0", "fn": "model_predictions < 0.5 AND label = 1",
            }.items()
        ) + " FROM scored GROUP BY ALL"
    ),
    "runs_labels": "SELECT DISTINCT snapshot_date FROM back_labels",
    "ranks_run": (
        "SELECT model_version, snapshot_date, label, rank() OVER (PARTITION BY model_version, snapshot_date ORDER BY model_predictions) "
        "+ (count(*) OVER (PARTITION BY model_version, snapshot_date, model_predictions) - 1) / 2.0 AS r "
        "FROM scored WHERE model_predictions IS NOT NULL"
    ),
    "auc_run": (
        "SELECT model_version, snapshot_date, (sum(r) FILTER (WHERE label = 1) - sum(label) * (sum(label) + 1) / 2.0) / "
        "nullif(sum(label) * sum(1 - label), 0) AS auc FROM ranks_run GROUP BY ALL"
    ),
    "conf_run": (
        "SELECT model_version, snapshot_date, " + ", ".join(
            f"count(*) FILTER (WHERE {cond}) AS {n}" for n, cond in {
                "tp": "model_predictions >= 0.5 AND label = 1", "fp": "model_predictions >= 0.5 AND label = 0",
                "tn": "model_predictions < 0.5 AND label = 0", "fn": "model_predictions < 0.5 AND label = 1",
            }.items()
        ) + " FROM scored GROUP BY ALL"
    ),
    "perf_run": (
        "SELECT r.snapshot_date, r.model_version, b.snapshot_date IS NOT NULL AS label_available, a.auc, 2 * a.auc - 1 AS gini, "
        "coalesce((tp + tn) / nullif(tp + fp + tn + fn, 0), CASE WHEN tp IS NULL THEN NULL ELSE 0 END) AS accuracy, "
        "coalesce(tp / nullif(tp + fp, 0), CASE WHEN tp IS NULL THEN NULL ELSE 0 END) AS precision, "
        "coalesce(tp / nullif(tp + fn, 0), CASE WHEN tp IS NULL THEN NULL ELSE 0 END) AS recall, "
        "coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), CASE WHEN tp IS NULL THEN NULL ELSE 0 END) AS f1 "
        "FROM (SELECT DISTINCT snapshot_date, model_version FROM preds) r LEFT JOIN runs_labels b ON r.snapshot_date = b.snapshot_date "
        "LEFT JOIN auc_run a ON r.snapshot_date = a.snapshot_date AND r.model_version = a.model_version "
        "LEFT JOIN conf_run c ON r.snapshot_date = c.snapshot_date AND r.model_version = c.model_version"
    ),
    # --- drift ------------------------------------------------------------------
    "ref": "SELECT * FROM features WHERE snapshot_date BETWEEN DATE '1995-01-01' AND DATE '1995-10-01'",
    "cur": f"SELECT * FROM features WHERE snapshot_date >= DATE '{RUN_START}'",
    "ref_long": f"SELECT * FROM ({long('ref', [], DRIFT_NUMERIC)}) WHERE value IS NOT NULL",
    "cur_long": f"SELECT * FROM ({long('cur', ['snapshot_date'], DRIFT_NUMERIC)}) WHERE value IS NOT NULL",
    "edges": f"SELECT feature, quantile_cont(value, {DECILES}) AS e FROM ref_long GROUP BY feature",
    "ref_bins": (
        "SELECT l.feature, lpad(CAST(len([y for y in e if y <= value]) AS VARCHAR), 2, '0') AS bin, count(*) AS n "
        "FROM ref_long l JOIN edges USING (feature) GROUP BY ALL UNION ALL "
        f"SELECT feature, coalesce(value, 'Unknown'), count(*) FROM ({long('ref', [], DRIFT_CATEGORIES, cast='VARCHAR')}) GROUP BY ALL"
    ),
    "cur_bins": (
        "SELECT l.feature, snapshot_date, lpad(CAST(len([y for y in e if y <= value]) AS VARCHAR), 2, '0') AS bin, count(*) AS n "
        "FROM cur_long l JOIN edges USING (feature) GROUP BY ALL UNION ALL "
        f"SELECT feature, snapshot_date, coalesce(value, 'Unknown'), count(*) FROM ({long('cur', ['snapshot_date'], DRIFT_CATEGORIES, cast='VARCHAR')}) GROUP BY ALL"
    ),
    "ref_share": "SELECT feature, bin, n / sum(n) OVER (PARTITION BY feature) AS p FROM ref_bins",
    "cur_share": "SELECT feature, snapshot_date, bin, n / sum(n) OVER (PARTITION BY feature, snapshot_date) AS q FROM cur_bins "
                 "QUALIFY NOT bool_and(bin = 'Unknown') OVER (PARTITION BY feature, snapshot_date)",
    "csi_cells": (
        "SELECT coalesce(x.feature, c.feature) AS feature, coalesce(x.snapshot_date, c.snapshot_date) AS snapshot_date, p, q FROM "
        "(SELECT r.feature, d.snapshot_date, r.bin, r.p FROM ref_share r JOIN (SELECT DISTINCT feature, snapshot_date FROM cur_share) d USING (feature)) x "
        "FULL JOIN cur_share c ON x.feature = c.feature AND x.snapshot_date = c.snapshot_date AND x.bin = c.bin"
    ),
    "csi": f"SELECT feature, snapshot_date, sum((({eps('p')}) - ({eps('q')})) * ln(({eps('p')}) / ({eps('q')}))) AS csi FROM csi_cells GROUP BY ALL",
    "ks_values": (
        "SELECT feature, snapshot_date, value, 0 AS a, 1 AS b FROM cur_long UNION ALL "
        "SELECT r.feature, d.snapshot_date, r.value, 1, 0 FROM ref_long r JOIN (SELECT DISTINCT feature, snapshot_date FROM cur_long) d USING (feature)"
    ),
    "ks_cum": (
        "SELECT feature, snapshot_date, sum(a) OVER w AS ca, sum(b) OVER w AS cb, sum(a) OVER t AS na, sum(b) OVER t AS nb FROM ks_values "
        "WINDOW w AS (PARTITION BY feature, snapshot_date ORDER BY value RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
        "t AS (PARTITION BY feature, snapshot_date)"
    ),
    "ks0": "SELECT feature, snapshot_date, max(abs(ca / na - cb / nb)) AS statistic, max(na) AS na, max(nb) AS nb FROM ks_cum GROUP BY ALL",
    "ks": f"SELECT feature, snapshot_date, statistic, {p_ks('statistic', 'na', 'nb')} AS p_value FROM ks0",
    "chi_ref": (
        f"SELECT feature, value AS bin, count(*) / sum(count(*)) OVER (PARTITION BY feature) AS p "
        f"FROM ({long('ref', [], DRIFT_CATEGORIES, cast='VARCHAR')}) WHERE value IS NOT NULL GROUP BY feature, value"
    ),
    "chi_cur": (
        f"SELECT feature, snapshot_date, value AS bin, count(*) AS n "
        f"FROM ({long('cur', ['snapshot_date'], DRIFT_CATEGORIES, cast='VARCHAR')}) WHERE value IS NOT NULL GROUP BY ALL"
    ),
    "chi_tot": "SELECT feature, snapshot_date, sum(n) AS total FROM chi_cur GROUP BY ALL",
    "chi_cells": (
        "SELECT t.feature, t.snapshot_date, r.p * t.total AS expected, coalesce(c.n, 0) AS n FROM chi_tot t JOIN chi_ref r USING (feature) "
        "LEFT JOIN chi_cur c ON c.feature = t.feature AND c.snapshot_date = t.snapshot_date AND c.bin = r.bin UNION ALL "
        "SELECT c.feature, c.snapshot_date, 0.0, c.n FROM chi_cur c ANTI JOIN chi_ref r ON c.feature = r.feature AND c.bin = r.bin"
    ),
    "chi0": (
        "SELECT feature, snapshot_date, sum(CASE WHEN expected = 0 THEN CAST('infinity' AS DOUBLE) ELSE (n - expected) * (n - expected) / expected END) AS statistic, "
        "count(*) - 1 AS dof FROM chi_cells GROUP BY ALL"
    ),
    "chi": f"SELECT feature, snapshot_date, statistic, dof, {p_chi('statistic', 'dof')} AS p_value FROM chi0",
    "score_ref": "SELECT model_version, model_predictions AS v FROM preds WHERE snapshot_date BETWEEN DATE '1995-01-01' AND DATE '1995-10-01' AND model_predictions IS NOT NULL",
    "score_cur": f"SELECT model_version, snapshot_date, model_predictions AS v FROM preds WHERE snapshot_date >= DATE '{RUN_START}' AND model_predictions IS NOT NULL",
    "score_edges": f"SELECT model_version, quantile_cont(v, {DECILES}) AS e FROM score_ref GROUP BY ALL",
    "score_p": (
        "SELECT model_version, bin, n / sum(n) OVER (PARTITION BY model_version) AS p FROM (SELECT s.model_version, "
        "len([y for y in e if y <= v]) AS bin, count(*) AS n FROM score_ref s JOIN score_edges USING (model_version) GROUP BY ALL)"
    ),
    "score_q": (
        "SELECT model_version, snapshot_date, bin, n / sum(n) OVER (PARTITION BY model_version, snapshot_date) AS q FROM (SELECT s.model_version, snapshot_date, "
        "len([y for y in e if y <= v]) AS bin, count(*) AS n FROM score_cur s JOIN score_edges USING (model_version) GROUP BY ALL)"
    ),
    "psi": (
        f"SELECT model_version, snapshot_date, sum((({eps('p')}) - ({eps('q')})) * ln(({eps('p')}) / ({eps('q')}))) AS psi_score FROM ("
        "SELECT coalesce(x.model_version, c.model_version) AS model_version, coalesce(x.snapshot_date, c.snapshot_date) AS snapshot_date, p, q FROM "
        "(SELECT r.model_version, d.snapshot_date, r.bin, r.p FROM score_p r JOIN (SELECT DISTINCT model_version, snapshot_date FROM score_q) d USING (model_version)) x "
        "FULL JOIN score_q c ON x.model_version = c.model_version AND x.snapshot_date = c.snapshot_date AND x.bin = c.bin) GROUP BY ALL"
    ),
    "missing": "SELECT snapshot_date, " + ", ".join(
        f"avg(CASE WHEN {' OR '.join(f'{c} IS NULL' for c in group)} THEN 1.0 ELSE 0.0 END) AS pct_missing_{source}"
        for source, group in S.FEATURE_SOURCES.items()
    ) + " FROM cur GROUP BY snapshot_date",
    "scoring": (
        "SELECT snapshot_date, model_name, model_version, count(*) AS n_scored, "
        "avg(CASE WHEN model_predictions IS NULL THEN 1.0 ELSE 0.0 END) AS error_rate "
        f"FROM preds WHERE snapshot_date >= DATE '{RUN_START}' GROUP BY ALL"
    ),
    "pmin": "SELECT snapshot_date, min(p_value) AS min_csi_pvalue FROM (SELECT snapshot_date, p_value FROM ks UNION ALL SELECT snapshot_date, p_value FROM chi) GROUP BY ALL",
    "csi_sum": "SELECT snapshot_date, max(csi) AS max_csi, avg(csi) AS mean_csi FROM csi GROUP BY ALL",
    "mon0": (
        "SELECT s.snapshot_date, s.model_name, s.model_version, s.n_scored, m.pct_missing_attributes, m.pct_missing_financials, "
        "m.pct_missing_clickstream, p.psi_score, c.max_csi, c.mean_csi, v.min_csi_pvalue, s.error_rate, "
        "f.label_available, f.auc, f.gini, f.accuracy, f.precision, f.recall, f.f1 FROM scoring s "
        "LEFT JOIN missing m USING (snapshot_date) LEFT JOIN psi p ON p.snapshot_date = s.snapshot_date AND p.model_version = s.model_version "
        "LEFT JOIN csi_sum c ON c.snapshot_date = s.snapshot_date LEFT JOIN pmin v ON v.snapshot_date = s.snapshot_date "
        "LEFT JOIN perf_run f ON f.snapshot_date = s.snapshot_date AND f.model_version = s.model_version"
    ),
}


def _perf_reason(m: str, green, low, top) -> str:
    v = f"printf('%.3f', {m})"
    return (
        f"CASE WHEN label_available AND {m} IS NOT NULL THEN CASE WHEN {m} >= {green} THEN '{m} ' || {v} || ' >= {green} [GREEN]' "
        f"WHEN {m} >= {low} THEN '{m} ' || {v} || ' in [{low}, {top}] [YELLOW]' ELSE '{m} ' || {v} || ' < {low} [RED]' END END"
    )


def _perf_rank(m: str, green, low) -> str:
    return f"CASE WHEN label_available AND {m} IS NOT NULL THEN CASE WHEN {m} >= {green} THEN 0 WHEN {m} >= {low} THEN 1 ELSE 2 END ELSE 0 END"


_LEVELS = "['GREEN', 'YELLOW', 'RED']"
_bands = S.PERFORMANCE_BANDS
_psi_text, _p_text = "printf('%.3f', psi_score)", "printf('%.6f', min_csi_pvalue)"
_feature_ranks = [
    "CASE WHEN psi_score IS NULL OR psi_score <= 0.1 THEN 0 WHEN psi_score <= 0.2 THEN 1 ELSE 2 END",
    "CASE WHEN min_csi_pvalue IS NULL OR min_csi_pvalue > 0.05 THEN 0 WHEN min_csi_pvalue > 0.01 THEN 1 ELSE 2 END",
    *[f"CASE WHEN pct_missing_{s} >= 0.5 THEN 2 ELSE 0 END" for s in S.FEATURE_SOURCES],
    "CASE WHEN error_rate > 0 THEN 2 ELSE 0 END",
]
_feature_reasons = [
    f"CASE WHEN psi_score <= 0.1 THEN 'psi ' || {_psi_text} || ' <= 0.1 [GREEN]' WHEN psi_score <= 0.2 THEN 'psi ' || {_psi_text} || ' in (0.1, 0.2] [YELLOW]' "
    f"WHEN psi_score > 0.2 THEN 'psi ' || {_psi_text} || ' > 0.2 [RED]' END",
    f"CASE WHEN min_csi_pvalue > 0.05 THEN 'min_csi_pvalue ' || {_p_text} || ' > 0.05 [GREEN]' WHEN min_csi_pvalue > 0.01 THEN "
    f"'min_csi_pvalue ' || {_p_text} || ' in (0.01, 0.05] [YELLOW]' WHEN min_csi_pvalue <= 0.01 THEN 'min_csi_pvalue ' || {_p_text} || ' <= 0.01 [RED]' END",
    *[
        f"CASE WHEN pct_missing_{s} >= 0.5 THEN 'pct_missing_{s} ' || printf('%.3f', pct_missing_{s}) || ' >= 0.5 [RED]' END"
        for s in S.FEATURE_SOURCES
    ],
    "CASE WHEN error_rate > 0 THEN 'error_rate ' || printf('%.3f', error_rate) || ' > 0 [RED]' END",
]
CTES["mon"] = (
    f"SELECT *, {_LEVELS}[1 + greatest({', '.join(_perf_rank(m, g, l) for m, (g, l, _) in _bands.items())})] AS performance_alert_level, "
    f"concat_ws('; ', {', '.join(_perf_reason(m, g, l, t) for m, (g, l, t) in _bands.items())}) AS performance_alert_reasons, "
    f"{_LEVELS}[1 + greatest({', '.join(_feature_ranks)})] AS feature_alert_level, "
    f"concat_ws('; ', {', '.join(_feature_reasons)}) AS feature_alert_reasons FROM mon0"
)


def with_ctes(body: str) -> str:
    """Prefix a query with the CTEs it needs, in dependency order."""
    order: list[str] = []
    seen: set[str] = set()

    def visit(text: str) -> None:
        for name in CTES:
            if name not in seen and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                seen.add(name)
                visit(CTES[name])
                order.append(name)

    visit(body)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in order) + "\n" + body
