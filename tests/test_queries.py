"""Every registered query against its SQL check on the smallest data."""

from unittest.mock import MagicMock

import pytest
from compare import connect, differences

from __spark_entry__ import entry, oracle_sql, queries
from canopy.constants import FORECAST_FOREST, NOWCAST_FOREST
from canopy.operators import models
from canopy.plans import q_models
from canopy.plans.catalog import QUERIES

FOLDER = "/root/testdata/sf0.001"
SLOW = {"compare_models", "season_forecast", "forecast_14", "train_nowcast", "nowcast_coverage", "backtest", "feature_importances"}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SLOW])
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    sql = oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert differences(df, con, sql) == []


@pytest.mark.parametrize("name, wanted", [
    ("forecast_14", [FORECAST_FOREST] * 3 + [NOWCAST_FOREST] * 3), ("backtest", [FORECAST_FOREST]), ("season_forecast", [FORECAST_FOREST])])
def test_recursive_queries_fit_the_forests_of_the_constants(spark, monkeypatch, name, wanted):
    fitted = []

    def fit(df, features, estimator, label="target"):
        fitted.append({p: estimator.getOrDefault(p) for p in FORECAST_FOREST})
        if len(fitted) == len(wanted):
            raise StopIteration

    rows = spark.createDataFrame([], "type_id int")
    monkeypatch.setattr(q_models, "_training", lambda r, forecast: (MagicMock(), rows))
    for part in ("tables", "cut_lineage", "_weather_of_days"):
        monkeypatch.setattr(q_models, part, MagicMock(return_value=(None, None)))
    monkeypatch.setattr(q_models.E, "inference_frame", MagicMock())
    monkeypatch.setattr(models, "train", fit)
    with pytest.raises(StopIteration):
        QUERIES[name](spark, FOLDER)
    assert fitted == wanted


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_check_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())
