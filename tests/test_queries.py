"""Every registered query with SQL against that SQL, on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import __spark_entry__ as entry
from pitwise import queries as registry
from check_oracle import compare, connect  # noqa: E402

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = registry.REGISTRY, registry.ORACLES

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    verdict, _, _ = compare(spark, con, name, QUERIES[name], ORACLES[name], SF)
    assert verdict == "ok", verdict


def test_registry_is_consistent():
    assert set(ORACLES) <= set(QUERIES)
    without = set(QUERIES) - set(ORACLES)
    assert without == {"fuzzy_pairs", "train_decision_tree", "train_logistic_regression", "train_linear_svm", "train_random_forest", "train_gradient_boosting"}


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
