"""The model queries fit the whole grids on every feature column."""

import inspect
from types import SimpleNamespace

import pytest

from checks import queries_models
from checks.registry import QUERIES
from checks.testbed import Testbed
from creditspine import schemas as S
from creditspine.operators import attribution, modelling


@pytest.mark.parametrize("family", sorted(modelling.FAMILIES))
def test_fit_uses_the_whole_grid_and_all_columns(spark, folder, monkeypatch, family):
    seen = {}

    def fit_families(split, numeric, categorical, grids=None):
        seen.update(columns={*numeric, *categorical}, grids=grids)
        return {family: SimpleNamespace(version="")}

    monkeypatch.setattr(modelling, "fit_families", fit_families)
    monkeypatch.setattr(queries_models, "_BANKS", {})
    monkeypatch.setattr(queries_models.models, "save_model", lambda *a: None)
    monkeypatch.setattr(queries_models.models, "load_model", lambda *a: None)
    table = Testbed(spark, folder)
    queries_models.fitted(table, family)
    # a second query loads the saved model
    monkeypatch.setattr(modelling, "fit_families", None)
    queries_models.fitted(table, family)
    assert seen["grids"] in (None, {family: modelling.FAMILIES[family][1]})
    assert seen["columns"] == {*table.training().columns} - {*S.ID_COLS, *S.LABEL_COLS}


def test_sampled_attribution_takes_the_operators_sizes(spark, folder, monkeypatch):
    seen = {}
    signature = inspect.signature(attribution.sampled_attribution)

    def sampled(*args, **more):
        bound = signature.bind(*args, **more)
        bound.apply_defaults()
        seen.update(bound.arguments)

    monkeypatch.setattr(attribution, "sampled_attribution", sampled)
    monkeypatch.setattr(queries_models, "fitted", lambda t, family: (None, t.stored("training").selectExpr("*", "'train' as split")))
    QUERIES["attribution_sampled"].run(Testbed(spark, folder))
    assert (seen["sample"], seen["background"]) == (attribution.SAMPLE_ROWS, attribution.BACKGROUND_ROWS) == (200, 100)


def test_parts_of_a_fit_do_not_grow_with_the_rows(spark):
    cores = spark.sparkContext.defaultParallelism
    rows = 4 * cores * modelling.ROWS_PER_PART
    assert modelling.evened(spark.range(rows).toDF("id")).rdd.getNumPartitions() <= 2 * cores
    assert modelling.evened(spark.range(modelling.ROWS_PER_PART + 1).toDF("id")).rdd.getNumPartitions() == 2
