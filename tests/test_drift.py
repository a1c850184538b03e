import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditspine.operators import drift, encode, impute, profile
from creditspine.operators.stats import _upper_gamma_share


def table(spark, n, shift, month):
    return spark.range(n).select(
        F.to_date(F.lit(month)).alias("snapshot_date"), (F.pmod(F.xxhash64("id"), F.lit(1000)) / 10 + shift).alias("a"),
        F.when(F.col("id") % 5 == 0, None).when(F.col("id") % 2 == 0, "x").otherwise("y").alias("c"))


def test_no_drift_against_itself(spark):
    t = table(spark, 2000, 0, "2024-01-01")
    csi = {r["feature"]: r["csi"] for r in drift.feature_csi(t, t, ["a"], ["c"]).collect()}
    assert csi == pytest.approx({"a": 0.0, "c": 0.0}, abs=1e-12)
    ks = drift.ks_numeric(t, t, ["a"]).first()
    assert ks["statistic"] == 0 and ks["p_value"] == 1
    chi = drift.chi_square_drift(t, t, ["c"]).first()
    assert chi["statistic"] == pytest.approx(0) and chi["p_value"] == pytest.approx(1)


def test_drift_is_seen_per_month(spark):
    ref = table(spark, 2000, 0, "2024-01-01")
    cur = table(spark, 500, 0, "2024-02-01").unionByName(table(spark, 500, 40, "2024-03-01"))
    csi = {str(r["snapshot_date"]): r["csi"] for r in drift.feature_csi(ref, cur, ["a"], []).collect()}
    assert csi["2024-02-01"] < 0.1 < 0.2 < csi["2024-03-01"]
    ks = {str(r["snapshot_date"]): r for r in drift.ks_numeric(ref, cur, ["a"]).collect()}
    a = np.sort([r[0] for r in ref.select("a").collect()])
    for month, row in ks.items():
        b = np.sort([r[0] for r in cur.where(F.col("snapshot_date") == month).select("a").collect()])
        x = np.concatenate([a, b])
        d = np.max(np.abs(np.searchsorted(a, x, "right") / len(a) - np.searchsorted(b, x, "right") / len(b)))
        assert row["statistic"] == pytest.approx(d)
    assert ks["2024-03-01"]["p_value"] < 1e-6 < 0.05 < ks["2024-02-01"]["p_value"]


def test_new_category_and_all_null_column(spark):
    ref = spark.createDataFrame([("2024-01-01", "x", None), ("2024-01-01", "y", None)], "snapshot_date string, c string, z double")
    cur = spark.createDataFrame([("2024-02-01", "x", 1.0), ("2024-02-01", "new", 2.0)], "snapshot_date string, c string, z double")
    assert drift.chi_square_drift(ref, cur, ["c"]).first()["p_value"] == 0.0
    assert drift.ks_numeric(ref, cur, ["z"]).count() == 0
    usable = {r["feature"]: r["usable"] for r in drift.usable_features(ref, cur, ["c", "z"]).collect()}
    assert usable == {"c": True, "z": False}


def test_category_without_values_has_no_csi(spark):
    schema = "snapshot_date string, c string, z double"
    ref = spark.createDataFrame([("2024-01-01", "x", 1.0), ("2024-01-01", "y", 2.0)], schema)
    cur = spark.createDataFrame([("2024-02-01", None, 1.0), ("2024-03-01", "x", 2.0), ("2024-03-01", None, 2.0)], schema)
    csi = drift.feature_csi(ref, cur, ["z"], ["c"]).select("feature", "snapshot_date").collect()
    assert {tuple(r) for r in csi} == {("z", "2024-02-01"), ("z", "2024-03-01"), ("c", "2024-03-01")}
    assert drift.feature_csi(cur.where("c is null"), ref, ["z"], ["c"]).where("feature = 'c'").count() == 0


def test_chi_square_tail():
    for x, dof, p in [(3.841459, 1, 0.05), (5.991465, 2, 0.05), (11.344867, 3, 0.01), (18.307038, 10, 0.05)]:
        assert _upper_gamma_share(x, dof) == pytest.approx(p, abs=1e-6)
    assert _upper_gamma_share(0.0, 3) == 1.0 and _upper_gamma_share(math.inf, 3) == 0.0


def test_independence_matches_the_ml_test(spark):
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    from pyspark.ml.stat import ChiSquareTest

    df = spark.range(900).select(
        (F.pmod(F.xxhash64("id"), F.lit(3))).cast("string").alias("c"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10)) < 3).cast("int").alias("label"))
    ours = profile.chi_square_independence(df, ["c"]).first()
    indexed = StringIndexer(inputCol="c", outputCol="i").fit(df).transform(df)
    theirs = ChiSquareTest.test(VectorAssembler(inputCols=["i"], outputCol="f").transform(indexed), "f", "label").first()
    assert ours["p_value"] == pytest.approx(theirs["pValues"][0]) and ours["statistic"] == pytest.approx(theirs["statistics"][0])


def test_empty_bins_of_repeated_edges(spark):
    df = spark.createDataFrame([(0.0,)] * 80 + [(float(i),) for i in range(1, 21)], "v double")
    d = drift.numeric_distribution(df, ["v"]).orderBy("bin").collect()
    assert len(d) == 10 and sum(r["share"] for r in d) == pytest.approx(1.0)


def test_null_gate(spark):
    ok = spark.createDataFrame([(1, "a")], "x int, y string")
    impute.assert_no_nulls(ok)
    with pytest.raises(impute.NullValuesError) as e:
        impute.assert_no_nulls(ok.unionByName(spark.createDataFrame([(None, None), (2, None)], "x int, y string")))
    assert e.value.columns == {"x": 1, "y": 2} and e.value.null_rows == 2


def test_rare_groups_count_nulls_and_vocabulary_is_bounded(spark):
    df = spark.createDataFrame([("a",)] * 90 + [(None,)] * 6 + [("b",)] * 4, "o string")
    common = encode.fit_common_values(df, "o", 0.05)
    out = {r[0] for r in df.select(encode.group_rare("o", common)).distinct().collect()}
    assert common == ["a"] and out == {"a", "Unknown", "Other"}
    with pytest.raises(ValueError):
        encode.fit_vocabulary(spark.range(50).select(F.col("id").cast("string").alias("o")), "o", limit=10)


def test_ks_of_several_runs_matches_a_plain_count(spark):
    rng = np.random.default_rng(3)
    ref = [float(x) for x in rng.integers(0, 40, 300)]
    runs = {"2024-01-01": [float(x) for x in rng.integers(10, 60, 80)], "2024-02-01": [-5.0, -5.0, 100.0], "2024-03-01": [7.0] * 50}
    reference = spark.createDataFrame([(x,) for x in ref] + [(float("nan"),), (None,)], "x double")
    current = spark.createDataFrame([(d, x) for d, xs in runs.items() for x in xs], "snapshot_date string, x double")
    got = {r["snapshot_date"]: r["statistic"] for r in drift.ks_numeric(reference, current, ["x"]).collect()}
    every = np.array(sorted({*ref, *(x for xs in runs.values() for x in xs)}))
    share = lambda xs: (np.array(xs)[None, :] <= every[:, None]).mean(axis=1)
    assert set(got) == set(runs)
    for d, xs in runs.items():
        assert abs(got[d] - np.abs(share(ref) - share(xs)).max()) < 1e-12


def test_states_of_months_add_up(spark):
    """Drift from value counts of parts, added up, is drift of the rows themselves."""
    rows = spark.range(600).select(
        (F.col("id") % 3).alias("snapshot_date"), F.pmod(F.xxhash64("id"), F.lit(50)).cast("double").alias("a"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 7).alias("b"), F.when(F.col("id") % 11 > 0, F.concat(F.lit("c"), F.col("id") % 4)).alias("c"))
    ref, numeric, texts = rows.where("snapshot_date = 0").drop("snapshot_date"), ["a", "b"], ["c"]
    state = drift.add_counts(*[drift.value_counts(rows.where(f"hash(a, b, c) % 2 = {k}"), numeric, texts, ["snapshot_date"]) for k in (-1, 0, 1)])
    assert state.where("value is null and category is null").agg(F.sum("n")).first()[0] == rows.where("b is null").count() + rows.where("c is null").count()
    before = drift.value_counts(ref, numeric, texts)
    edges = drift.fit_edges(ref, numeric, drift.N_BINS)
    pairs = [
        (drift.csi_from_counts(before, state, edges, texts), drift.feature_csi(ref, rows, numeric, texts)),
        (drift.ks_from_counts(before, state), drift.ks_numeric(ref, rows, numeric)),
        (drift.chi_square_from_counts(before, state), drift.chi_square_drift(ref, rows, texts)),
    ]
    for got, want in pairs:
        a, b = (sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(want.columns).collect()) for df in (got, want))
        assert a == b and len(a) >= 3
