import numpy as np
import pytest
from pyspark.sql import functions as F

from creditspine.operators import drift, metrics, projection, ranks, splits

PROBS = [0.0, 0.05, 0.1, 0.25, 0.5, 0.77, 0.9, 0.97, 1.0]


def test_quantiles_of_small_samples(spark):
    for n in (1, 2, 3, 4, 7, 11, 12, 25):
        v = [float(x) for x in np.random.default_rng(n).integers(0, 12, n)]
        d = spark.createDataFrame([(x,) for x in v] + [(None,)], "x double")
        got = {r["prob"]: r["quantile"] for r in ranks.exact_quantiles(d, ["x"], PROBS).collect()}
        assert got == pytest.approx({p: float(np.quantile(v, p)) for p in PROBS})


def test_quantiles_with_a_hot_value_and_groups(spark):
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.pmod(F.xxhash64("id"), F.lit(100003)) / 7).alias("a"),
        F.when(F.col("id") == 0, None).otherwise(F.col("id") % 4).alias("g"), F.lit(None).cast("int").alias("empty"))
    pdf = df.toPandas()
    got = {(r["g"], r["feature"], r["prob"]): r["quantile"] for r in ranks.exact_quantiles(df, ["a", "empty"], PROBS, ["g"]).collect()}
    want = {(g, "a", p): float(np.quantile(pdf[pdf.g == g].a, p)) for g in range(4) for p in PROBS}
    assert got == pytest.approx(want)


@pytest.mark.parametrize("w", [97, 1000, 1 << 17])
def test_running_totals_equal_a_window(spark, w):
    c = spark.range(5000).select((F.col("id") % 3).alias("k"), F.pmod(F.xxhash64("id"), F.lit(997)).alias("v")).groupBy("k", "v").agg(F.count("*").alias("n"))
    got = {(r["k"], r["v"]): (r["n_before"], r["n_total"]) for r in ranks.running_totals(c, ["k"], "v", ["n"], rows_per_range=w).collect()}
    rows = sorted((r["k"], r["v"], r["n"]) for r in c.collect())
    for k in range(3):
        seen, total = 0, sum(n for kk, _, n in rows if kk == k)
        for kk, v, n in rows:
            if kk == k:
                assert got[k, v] == (seen, total)
                seen += n


def test_many_values_of_two_keys_spread_over_ranges(spark):
    """One key holds nearly all values; no range and no exchange takes it whole."""
    c = spark.range(40_000).select(F.when(F.col("id") < 500, "small").otherwise("large").alias("k"), F.col("id").alias("v"), F.lit(1).cast("long").alias("n"))
    out = ranks.running_totals(c, ["k"], "v", ["n"], rows_per_range=4000)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k#" not in plan and "hashpartitioning(_range#" in plan
    spread = ranks.cut_lineage(c.repartitionByRange(10, "k", "v").withColumn("_range", F.spark_partition_id()))
    assert spread.groupBy("_range").count().agg(F.max("count")).first()[0] < 8000
    assert out.where("k = 'large' and n_before <> v - 500").count() == 0


def test_quantiles_of_very_many_groups(spark):
    df = spark.range(60_000).select((F.col("id") % 15_000).alias("g"), (F.col("id") / 15_000).cast("long").cast("double").alias("x"))
    got = ranks.exact_quantiles(df, ["x"], [0.0, 0.5, 1.0], ["g"]).groupBy("prob", "quantile").count().collect()
    assert {(r["prob"], r["quantile"], r["count"]) for r in got} == {(0.0, 0.0, 15_000), (0.5, 1.5, 15_000), (1.0, 3.0, 15_000)}


@pytest.mark.parametrize("n", [0, 1, 6, 1234, 2999, 3000, 9999])
def test_sample_rows_is_exact_and_repeatable(spark, n):
    df = spark.range(3000)
    a = {r[0] for r in projection.sample_rows(df, ["id"], n, 7).collect()}
    b = {r[0] for r in projection.sample_rows(df.repartition(5), ["id"], n, 7).collect()}
    assert a == b and len(a) == min(n, 3000)


def test_stratified_shares_and_stability(spark):
    df = spark.range(5003).select("id", (F.col("id") % 4 == 0).cast("int").alias("label"))
    out = splits.stratified_split(df, ["id"])
    got = {(r["label"], r["split"]): r["n"] for r in out.groupBy("label", "split").agg(F.count("*").alias("n")).collect()}
    for label in (0, 1):
        n = sum(v for (l, _), v in got.items() if l == label)
        for name, share in zip(splits.SPLIT_NAMES, (0.7, 0.2, 0.1)):
            assert abs(got[label, name] - n * share) <= 1
    again = splits.stratified_split(df.repartition(3, "label"), ["id"])
    assert out.exceptAll(again).count() == 0


def brute_auc(pairs):
    pos, neg = [s for s, l in pairs if l == 1], [s for s, l in pairs if l == 0]
    return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))


def test_auc_with_ties_and_flip(spark):
    rng = np.random.default_rng(3)
    pairs = [(float(rng.integers(0, 20)) / 20, int(rng.random() < 0.3)) for _ in range(400)]
    df = spark.createDataFrame([("a", s, l) for s, l in pairs] + [("one", 0.5, 1)], "g string, score double, label int")
    got = {r["g"]: r["auc"] for r in metrics.auc_by(df, ["g"]).collect()}
    assert got["a"] == pytest.approx(brute_auc(pairs)) and got["one"] is None
    flipped = metrics.auc_by(df.where("g = 'a'").withColumn("score", 1 - F.col("score")), ["g"]).first()["auc"]
    assert flipped == pytest.approx(1 - got["a"])


def test_metrics_zero_division(spark):
    df = spark.createDataFrame([("x", 0.1, 1), ("x", 0.2, 0)], "g string, score double, label int")
    m = metrics.classification_metrics(df, ["g"]).first()
    assert (m["precision"], m["recall"], m["f1"], m["accuracy"]) == (0.0, 0.0, 0.0, 0.5)


def test_time_windows():
    w = splits.time_windows("2024-07-01", 16, 2)
    assert [str(x) for x in (w.train_start, w.train_end, w.oot_start, w.oot_end)] == ["2023-01-01", "2024-04-30", "2024-05-01", "2024-06-30"]
    assert [(str(a), str(b)) for a, b in w.oot_months] == [("2024-05-01", "2024-05-31"), ("2024-06-01", "2024-06-30")]


def test_quantiles_leave_out_nan(spark):
    rows = [(float(x),) for x in range(1, 11)] + [(float("nan"),)] * 3 + [(None,)]
    got = ranks.exact_quantiles(spark.createDataFrame(rows, "x double"), ["x"], [0, 0.25, 0.5, 0.9, 1]).orderBy("prob").collect()
    assert [r["quantile"] for r in got] == pytest.approx([1.0, 3.25, 5.5, 9.1, 10.0])


def test_quantiles_do_not_shuffle_rows(spark):
    """The fitted brackets are broadcast: below the first aggregate nothing is exchanged."""
    bound = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(10_000).selectExpr("cast(id as double) x", "cast(id % 7 as double) y")
        table = spark.createDataFrame([("x", [1.0]), ("y", [2.0])], "feature string, edges array<double>")
        plan = drift.numeric_bins(df, table, ["x", "y"], n_bins=2)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_stratified_split_refuses_a_column_that_is_no_class(spark):
    with pytest.raises(ValueError, match="label values"):
        splits.stratified_split(spark.range(splits.MAX_LABELS + 1).withColumn("label", F.col("id")), ["id"])
