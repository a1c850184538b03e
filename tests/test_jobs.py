"""Whole jobs over a small datamart: sources to monitoring summary."""

import pytest
from pyspark.sql import functions as F

from checks.testbed import Testbed
from creditspine.operators import impute
from creditspine.plans import gold, monitoring, scoring, training
from creditspine.plans.monthly import run_datamart
from creditspine.sources import models
from creditspine.sources.snapshots import Datamart, read_history

GRIDS = {
    "logistic_regression": [{"C": 0.1}, {"C": 1.0}],
    "boosted_trees": [{"trees": 3, "depth": 2, "rate": 0.3}],
}


@pytest.fixture(scope="module")
def mart(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("mart")
    bed = Testbed(spark, "/root/testdata/sf0.01")
    sources = {}
    for name in ("ledger", "attributes", "financials", "clickstream"):
        raw = bed.stored(f"raw_{name}")
        if name == "ledger":
            raw = raw.where("loan_start_date <= '1996-06-01'")
        if name == "clickstream":
            raw = raw.select(*[f"fe_{i}" for i in range(1, 21)], "Customer_ID", "snapshot_date")
        sources[name] = str(root / f"{name}.csv")
        raw.write.option("header", True).option("escape", '"').csv(sources[name])
    out = Datamart(str(root / "lake"))
    run_datamart(spark, out, sources, "1995-01-01", "1996-04-01", label_end="1996-10-01")
    gold.run_training_table(spark, out)
    return out


def test_datamart_equals_direct_computation(spark, mart):
    bed = Testbed(spark, "/root/testdata/sf0.01")
    months = F.col("snapshot_date").between("1995-01-01", "1996-04-01")
    want = bed.training().where(months)
    got = read_history(spark, mart.path("gold", "training")).select(*want.columns)
    assert got.count() > 500
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_loan_types_are_written_with_the_financials(spark, mart):
    types = read_history(spark, mart.path("silver", "loan_types"))
    rows = read_history(spark, mart.path("silver", "financials"))
    assert types.count() == rows.count() > 0 and len(types.columns) > 3


def test_null_gate_stops_the_imputed_table(spark, mart):
    with pytest.raises(impute.NullValuesError) as e:
        gold.run_imputed_training(spark, mart)
    assert "Monthly_Inhand_Salary" in e.value.columns and "Age" not in e.value.columns


def test_train_score_monitor(spark, mart, tmp_path):
    bank = str(tmp_path / "bank")
    versions = training.run_training(spark, mart, bank, "1996-01-01", 10, 2, GRIDS)
    assert versions == ["loan_default_logistic_regression_1996_01_01", "loan_default_boosted_trees_1996_01_01"]
    m = models.side_table(spark, bank, versions[0], "metrics")
    rows = {r["split"]: r for r in m.collect()}
    assert set(rows) == {"train", "val", "test", "oot", "oot1", "oot2"}
    assert rows["train"]["recall"] is None and rows["train"]["auc"] > 0.5 and rows["oot"]["recall"] is not None
    assert models.load_model(spark, bank, versions[0]).role == "champion"
    share = models.side_table(spark, bank, versions[1], "score_distribution").agg(F.sum("share")).first()[0]
    assert share == pytest.approx(1.0)

    for v in versions:
        scoring.run_scoring(spark, mart, bank, v, "1996-01-01", "1996-02-01")
        monitoring.run_monitoring(spark, mart, bank, v, "1996-01-01", "1996-02-01")
    # the models share the stored state of the months; a rerun reads it and gives the same rows
    state = read_history(spark, mart.path("gold", "monitoring_state"))
    assert state.select("snapshot_date").distinct().count() == 2
    rows = read_history(spark, mart.path("gold", "monitoring")).where(F.col("model_version") == versions[0]).collect()
    monitoring.run_monitoring(spark, mart, bank, versions[0], "1996-02-01")
    monitoring.run_monitoring(spark, mart, bank, versions[0], "1996-01-01", refresh=True)
    again = read_history(spark, mart.path("gold", "monitoring")).where(F.col("model_version") == versions[0]).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    runs = spark.read.json(mart.path("gold", "scoring_runs"))
    assert runs.count() == 4 and {r["error_rate"] for r in runs.collect()} == {0.0}

    monitoring.run_comparison(spark, mart, bank, versions[0], versions[1], "1996-01-01")
    row = read_history(spark, mart.path("gold", "champion_vs_challenger")).first()
    assert row["ab_test_recommended"] == (row["challenger_auc_uplift"] >= 0.05)

    tables = monitoring.run_summary(spark, mart, versions, "1996-02-01", "1996-01-01")
    history = tables["history"].collect()
    assert len(history) == 4
    for r in history:
        assert r["label_available"] and r["n_scored"] > 0 and r["psi_score"] >= 0 and 0 <= r["min_csi_pvalue"] <= 1
        assert r["max_csi"] >= r["mean_csi"] and r["feature_alert_level"] in ("GREEN", "YELLOW", "RED")
    assert tables["attribution"].groupBy("snapshot_date", "model_version").count().where("count <> 5").count() == 0
    assert tables["agreement"].first()["aligned"] is True
    assert tables["metrics"].count() == 12 and tables["alerts"].count() == 8
