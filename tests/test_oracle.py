"""Every query with checking SQL, beside it on the same tables; the others must give rows."""

import os

import pytest

from tarmac.catalog import ORACLES, QUERIES
from tarmac.plans.storage import drop_stages
from tests.oracle import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.fixture(autouse=True)
def clean(spark):
    yield
    drop_stages(spark)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


REGRESSORS = ["lin_reg", "sgd_reg", "sgd_reg_epsilon", "hgb_reg", "mlp_reg"]
CLASSIFIERS = ["log_reg", "sgd_clf", "sgd_clf_hinge", "sgd_clf_huber", "hgb_clf", "mlp_clf", "mlp_clf_logistic"]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - set(REGRESSORS) - set(CLASSIFIERS)))
def test_gives_rows(spark, name):
    df = QUERIES[name](spark, "/root/testdata/sf0.001")
    assert df.limit(1).count() == 1


@pytest.mark.parametrize("name", REGRESSORS)
def test_regressors_beat_the_mean(spark, name):
    rows = {r["model"]: r for r in QUERIES[name](spark, "/root/testdata/sf0.001").collect()}
    base = rows.pop("baseline")
    (model,) = rows.values()
    assert model["rmse"] < 0.8 * base["rmse"]


@pytest.mark.parametrize("name", CLASSIFIERS)
def test_classifiers_beat_the_majority(spark, name):
    rows = {r["model"]: r for r in QUERIES[name](spark, "/root/testdata/sf0.001").collect()}
    base = rows.pop("baseline")
    (model,) = rows.values()
    assert model["accuracy"] > base["accuracy"] + 0.1


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).limit(1).count() == 1
    assert set(e.oracle_sql()) <= set(e.queries())
