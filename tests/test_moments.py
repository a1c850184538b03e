"""Pairwise moments, components and exact medians against plain numpy."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel

from creditspine.operators import modelling, moments
from creditspine.operators.medians import ExactMedianImputer

NAMES = ["u", "v", "w", "constant", "empty"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(4000, 3)) @ rng.normal(size=(3, 3)) + [1e7, 0, -3]
    x[rng.random(x.shape) < 0.2] = np.nan
    pdf = pd.DataFrame(x, columns=NAMES[:3])
    pdf["constant"] = 0.1
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) + (None,) for r in pdf.itertuples(index=False)]
    # not-a-number counts as missing, too
    rows += [(float("nan"), 1.0, 2.0, 0.1, None)] * 3
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in NAMES)).repartition(7)


def test_correlation_over_pairwise_complete_rows(table):
    got = {(r[0], r[1]): r[2] for r in moments.correlation_matrix(table, NAMES).collect()}
    want = table.toPandas().astype(float).corr()
    assert len(got) == 10
    for (a, b), value in got.items():
        if {a, b} & {"constant", "empty"}:
            assert value is None
        else:
            assert value == pytest.approx(want.loc[a, b], abs=1e-9)


def test_moments_do_not_depend_on_the_layout(table):
    def shown(df):
        rows = moments.pair_moments(df, NAMES[:3]).collect()
        return {(r["a"], r["b"]): tuple(r)[2:] for r in rows}

    one, many = shown(table.coalesce(1)), shown(table.repartition(31))
    assert one.keys() == many.keys() and len(one) == 6
    for pair in one:
        assert one[pair] == pytest.approx(many[pair], rel=1e-9)
    pdf = table.toPandas().dropna(subset=["u", "w"])
    n, mean_u, mean_w, ss_u, _, ss_uw = one[0, 2]
    assert n == len(pdf) and mean_u == pytest.approx(pdf.u.mean()) and mean_w == pytest.approx(pdf.w.mean())
    assert ss_u == pytest.approx(((pdf.u - pdf.u.mean()) ** 2).sum())
    assert ss_uw == pytest.approx(((pdf.u - pdf.u.mean()) * (pdf.w - pdf.w.mean())).sum())


def test_empty_table_has_no_correlation(table):
    none = table.where("1 = 0")
    assert {r[2] for r in moments.correlation_matrix(none, NAMES[:3]).collect()} <= {None}
    assert moments.pca_variance(none, NAMES[:3]).count() == 0


def test_components_solve_the_eigen_equations(table):
    got = moments.pca_variance(table, NAMES[:4], k=4).collect()
    complete = table.select(*NAMES[:3]).toPandas().dropna()
    values = np.sort(np.linalg.eigvalsh(complete.corr().to_numpy()))[::-1]
    assert [r["explained"] for r in got] == pytest.approx([*(values / values.sum()), 0.0], abs=1e-9)
    assert got[-1]["cumulative"] == pytest.approx(1.0)


def test_median_stage_is_exact_and_survives_saving(spark, tmp_path):
    # an even number of values: the median lies between the two middle ones
    values = [float(i * i) for i in range(20_000)]
    df = spark.createDataFrame([(v, int(v) % 7) for v in values] + [(None, None), (float("nan"), 3)], "x double, y int")
    fitted = Pipeline(stages=[ExactMedianImputer(["x", "y"], ["x_full", "y_full"])]).fit(df)
    fitted.write().overwrite().save(str(tmp_path / "stage"))
    loaded = PipelineModel.load(str(tmp_path / "stage"))
    want = [float(np.median(values)), float(np.median([int(v) % 7 for v in values] + [3]))]
    assert loaded.stages[0].getMedians() == fitted.stages[0].getMedians() == want
    gaps = loaded.transform(df).where("x is null or isnan(x)").select("x_full", "y_full").collect()
    assert sorted(map(tuple, gaps)) == sorted([tuple(want), (want[0], 3.0)])


def test_median_stage_of_a_column_without_values(spark):
    with pytest.raises(ValueError, match="no median"):
        ExactMedianImputer(["x"], ["x_full"]).fit(spark.createDataFrame([(None,)], "x double"))


def test_preprocessor_uses_the_exact_median(spark):
    df = spark.createDataFrame([(float(i), "a" if i % 2 else None) for i in range(10)] + [(None, "b")], "x double, c string")
    inputs = modelling.prepare_inputs(df, ["x"], ["c"])
    stage = modelling.build_preprocessor(["x"], ["c"]).fit(inputs).stages[0]
    assert stage.getMedians() == [4.5]
