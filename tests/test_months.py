"""Monitoring reaches every month from the train date on."""

import pytest

import __spark_entry__ as entry
from checks import oracles as O
from checks.testbed import Testbed

QUERIES = entry.queries()


@pytest.fixture(scope="module")
def months(spark, folder):
    rows = Testbed(spark, folder).stored("features").where(f"snapshot_date >= date '{O.RUN_START}'")
    return {r[0] for r in rows.select("snapshot_date").distinct().collect()}


@pytest.mark.parametrize("name", [
    "attribution_linear", "attribution_sampled_linear", "attribution_exact", "csi_features", "ks_numeric", "missing_by_group", "psi_scores",
])
def test_every_month_is_monitored(spark, folder, months, name):
    assert len(months) > 4
    assert {r[0] for r in QUERIES[name](spark, folder).select("snapshot_date").distinct().collect()} == months
