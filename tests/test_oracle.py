"""Every registered query with SQL against DuckDB, and the figures measured beforehand."""

import pytest
from compare import connect, differences
from conftest import MEDIUM, SMALL
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from daytally.operators import anomaly, metrics
from daytally.plans import panel as P
from daytally.plans import queries as Q
from daytally.plans.oracle import ORACLE

UNCHECKED = {
    "isolation_anomalies",
    "combined_anomalies",
    "forest_predictions",
    "tweedie_predictions",
    "model_comparison",
    "run_log",
    "horizon_forecast",
}


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_only_random_and_iterative_queries_have_no_sql():
    assert set(Q.QUERIES) - set(ORACLE) == UNCHECKED
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert differences(queries()[name](spark, SMALL), oracle_sql()[name], con) == []


def test_entry_has_the_feature_columns(spark):
    assert len(entry(spark).columns) == 27


def test_measured_figures(spark):
    """Values recorded for sf0.01 before the engine was written (FIXTURES.md)."""
    until = P.sales_long(spark, MEDIUM).filter(F.col("date") <= P.VAL_END)
    rows, units, priced, most = until.agg(
        F.count("*"), F.sum("sales"), F.count("sell_price"), F.max("sales")
    ).first()
    assert (rows, units, priced, most) == (300125, 1468296, 215684, 167)
    val = Q._validation(Q._naive(spark, MEDIUM))
    assert val.count() == 3500
    assert metrics.mean_absolute_error(val).first()["mae"] == pytest.approx(8.619143, abs=1e-6)
    residuals = anomaly.statistical_flag(anomaly.residual_features(val))
    assert residuals.filter("residual_rolling_std IS NOT NULL").count() == 3250
    assert residuals.filter("z_score > 3").count() == 303
    actual, pred, train = Q._score_inputs(spark, MEDIUM)
    score = metrics.wrmsse_score(actual.drop("sell_price"), pred, train)
    assert score == pytest.approx(1.017106, abs=1e-6)
    scales = metrics.series_scales(train).agg(F.count("*"), F.min("scale")).first()
    assert scales[0] == 125 and scales[1] == pytest.approx(160.632253, abs=1e-6)
