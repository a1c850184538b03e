import itertools
from datetime import date
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditspine.operators import attribution, modelling, monitor, scorers

PERF = "label_available boolean, recall double, accuracy double, auc double"
FEAT = (
    "psi_score double, min_csi_pvalue double, pct_missing_attributes double, pct_missing_financials double, "
    "pct_missing_clickstream double, error_rate double"
)


@pytest.mark.parametrize("row, level, reasons", [
    ((True, 0.80, 0.78, 0.90), "GREEN", "recall 0.800 >= 0.8 [GREEN]; accuracy 0.780 >= 0.78 [GREEN]; auc 0.900 >= 0.9 [GREEN]"),
    ((True, 0.795, 0.9, 0.95), "YELLOW", "recall 0.795 in [0.6, 0.79] [YELLOW]; accuracy 0.900 >= 0.78 [GREEN]; auc 0.950 >= 0.9 [GREEN]"),
    ((True, 0.7, 0.5, None), "RED", "recall 0.700 in [0.6, 0.79] [YELLOW]; accuracy 0.500 < 0.7 [RED]"),
    ((True, 0.0625, 0.9, float("nan")), "RED", "recall 0.062 < 0.6 [RED]; accuracy 0.900 >= 0.78 [GREEN]"),
    ((False, 0.1, 0.1, 0.1), "GREEN", ""),
])
def test_performance_alerts(spark, row, level, reasons):
    r = monitor.performance_alerts(spark.createDataFrame([row], PERF)).first()
    assert (r["performance_alert_level"], r["performance_alert_reasons"]) == (level, reasons)


@pytest.mark.parametrize("row, level, reasons", [
    ((0.1, 0.051, 0.49, 0.0, 0.0, 0.0), "GREEN", "psi 0.100 <= 0.1 [GREEN]; min_csi_pvalue 0.051000 > 0.05 [GREEN]"),
    ((0.2, 0.05, 0.0, 0.0, 0.0, 0.0), "YELLOW", "psi 0.200 in (0.1, 0.2] [YELLOW]; min_csi_pvalue 0.050000 in (0.01, 0.05] [YELLOW]"),
    ((None, 0.01, 0.0, 0.5, 0.0, 0.0), "RED", "min_csi_pvalue 0.010000 <= 0.01 [RED]; pct_missing_financials 0.500 >= 0.5 [RED]"),
    ((0.0, None, 0.0, 0.0, 1.0, 0.25), "RED", "psi 0.000 <= 0.1 [GREEN]; pct_missing_clickstream 1.000 >= 0.5 [RED]; error_rate 0.250 > 0 [RED]"),
])
def test_feature_alerts(spark, row, level, reasons):
    r = monitor.feature_alerts(spark.createDataFrame([row], FEAT)).first()
    assert (r["feature_alert_level"], r["feature_alert_reasons"]) == (level, reasons)


def test_attribution_json_round_trip(spark):
    t = spark.createDataFrame(
        [(date(2024, 1, 1), "v", f"f{i}", i / 7) for i in range(8)],
        "snapshot_date date, model_version string, feature string, mean_abs_shap double")
    rows = monitor.attribution_history(attribution.top_features_json(t, monitor.RUN)).collect()
    assert [(r["feature"], r["mean_abs_shap"]) for r in rows] == [(f"f{i}", round(i / 7, 6)) for i in (7, 6, 5, 4, 3)]


def test_history_and_agreement(spark):
    rows = spark.createDataFrame(
        [(date(2024, m, 1), v, 0.1 * m + (0.5 if v == "b" and m == 3 else 0)) for m in (1, 2, 3) for v in "ab"],
        "snapshot_date date, model_version string, max_csi double")
    history = monitor.monitoring_history(rows, ["a", "b"], "2024-02-15", "2024-01-01")
    assert [str(r["snapshot_date"]) for r in history.collect()] == ["2024-01-01"] * 2 + ["2024-02-01"] * 2
    assert monitor.version_agreement(history).first()["aligned"] is True
    assert monitor.version_agreement(rows).first()["aligned"] is False
    with pytest.raises(ValueError):
        monitor.require_history(monitor.monitoring_history(rows, ["zz"], "2024-02-15"), ["zz"], "2024-02-15")


def test_sampled_attribution_does_not_hang_on_the_layout(spark):
    rows = spark.range(120).select(
        F.col("id").cast("string").alias("k"), F.when(F.col("id") % 4 == 0, "val").otherwise("train").alias("split"),
        (F.col("id") % 7 > 3).cast("int").alias("label"), (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"))
    model = modelling.fit_families(rows, ["a", "b"], [], {"boosted_trees": [{"trees": 1, "depth": 2, "rate": 0.1}]})["boosted_trees"]
    got = []
    for parts in (1, 5):
        base = rows.repartition(parts)
        table = attribution.sampled_attribution(base, rows, model, ["k"], sample=6, background=6)
        got.append({r["feature"]: round(r["mean_abs_shap"], 9) for r in table.collect()})
    assert got[0] == got[1] and got[0]["a"] > 0


def two_models(spark, trees=4, depth=3):
    rows = spark.range(400).select(
        F.col("id").cast("string").alias("k"), (F.col("id") % 2).alias("month"), F.when(F.col("id") % 4 == 0, "val").otherwise("train").alias("split"),
        ((F.col("id") % 7 > 3) != (F.col("id") % 11 == 2)).cast("int").alias("label"), (F.col("id") % 7).cast("double").alias("a"),
        (F.col("id") % 5).cast("double").alias("b"), F.when(F.col("id") % 13 > 0, F.concat(F.lit("c"), F.col("id") % 3)).alias("c"),
        F.concat(F.lit("d"), F.col("id") % 2).alias("d"))
    grids = {"boosted_trees": [{"trees": trees, "depth": depth, "rate": 0.3}], "logistic_regression": [{"C": 1.0}]}
    return rows, modelling.fit_families(rows, ["a", "b"], ["c", "d"], grids)


def test_attribution_equals_brute_force_shapley(spark):
    """All coalitions of four features, each scored by the fitted pipeline itself."""
    rows, models = two_models(spark)
    features = ["a", "b", "c", "d"]
    current, reference = rows.where("id < 12"), rows.where("id between 100 and 106")
    for model in models.values():
        x, z = ([{c: r[c] for c in ("k", *features)} for r in df.collect()] for df in (current, reference))
        mixed = [(f"{i}|{j}|{mask}", *[(p if mask >> n & 1 else q)[c] for n, c in enumerate(features)])
                 for (i, p), (j, q) in itertools.product(enumerate(x), enumerate(z)) for mask in range(16)]
        table = spark.createDataFrame(mixed, "key string, a double, b double, c string, d string")
        scored = {r["key"]: r["score"] for r in modelling.score(table, model).collect()}
        value = np.array([[np.mean([scored[f"{i}|{j}|{mask}"] for j in range(len(z))]) for mask in range(16)] for i in range(len(x))])
        phi = np.zeros((len(x), 4))
        for n in range(4):
            for mask in range(16):
                if not mask >> n & 1:
                    size = bin(mask).count("1")
                    phi[:, n] += factorial(size) * factorial(3 - size) / 24 * (value[:, mask | 1 << n] - value[:, mask])
        got = attribution.sampled_attribution(reference, current, model, ["k"], ["month"]).collect()
        want = {(m, f): np.abs(phi[[int(r["k"]) % 2 == m for r in x], n]).mean() for m in (0, 1) for n, f in enumerate(features)}
        assert {(r["month"], r["feature"]): pytest.approx(r["mean_abs_shap"], abs=1e-9) for r in got} == want
        assert max(want.values()) > 0.01


def test_walks_of_many_features_add_up_to_the_scores():
    """A random forest over more features than all orders are walked for."""
    rng = np.random.default_rng(3)
    trees = []
    for _ in range(5):
        inner = [(int(rng.integers(9)), float(rng.normal()), 2 * i + 1, 2 * i + 2, 0.0) for i in range(7)]
        trees.append(inner + [(-1, 0.0, 0, 0, float(rng.normal())) for _ in range(8)])
    model = scorers.forest(trees, [1.0, 0.5, 0.5, 0.5, 0.5])
    owner = np.array([0, 1, 2, 3, 4, 5, 6, 6, 7])
    x, z = rng.normal(size=(6, 9)), rng.normal(size=(5, 9))
    switched = attribution.walk_orders(np.arange(6), 5, 8, 42)
    assert (switched[:, 0] + switched[:, 1] == 9).all() and (np.sort(switched, axis=-1) == np.arange(1, 9)).all()

    def plain(v):
        total = 0.0
        for nodes, w in zip(trees, [1.0, 0.5, 0.5, 0.5, 0.5]):
            node = nodes[0]
            while node[0] >= 0:
                node = nodes[node[2] if v[node[0]] <= node[1] else node[3]]
            total += w * node[4]
        return 1 / (1 + np.exp(-2 * total))

    flat = switched.reshape(-1, 8)
    walks = model.walks(np.repeat(x, 5, axis=0), np.tile(z, (6, 1)), flat, owner)
    for p in range(30):
        for k in range(9):
            mixed = np.where(flat[p][owner] <= k, x[p // 5], z[p % 5])
            assert walks[p, k] == pytest.approx(plain(mixed), abs=1e-12)
    phi = attribution.contributions(model, x, z, owner, 8, np.arange(6), 42)
    want = [plain(v) - np.mean([plain(u) for u in z]) for v in x]
    assert phi.sum(axis=1) == pytest.approx(want, abs=1e-12)


def test_unseen_categories_are_zeros_and_names_fit(spark):
    rows, models = two_models(spark, trees=1, depth=1)
    model = models["logistic_regression"]
    assert model.names == ["a", "b", "c=c0", "c=c1", "c=c2", "c=Unknown", "d=d0", "d=d1"] or len(model.names) == 8
    odd = rows.limit(1).withColumns({"c": F.lit("new"), "d": F.lit("newer")})
    x = model.pipeline.transform(modelling.prepare_inputs(odd, model.numeric, model.categorical)).first()["features"].toArray()
    assert len(x) == 8 and not x[2:].any()


def test_samples_per_group(spark):
    from creditspine.operators.projection import sample_rows, sample_rows_by

    rows = spark.range(1000).select("id", (F.col("id") % 3).alias("g"))
    got = sample_rows_by(rows, ["id"], ["g"], 40, 7)
    assert {r["g"]: r["count"] for r in got.groupBy("g").count().collect()} == {0: 40, 1: 40, 2: 40}
    one = sample_rows(rows.where("g = 1"), ["id"], 40, 7)
    assert got.where("g = 1").exceptAll(one).count() == 0
