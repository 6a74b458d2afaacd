import datetime as dt
import random
import subprocess
import sys

import duckdb
import numpy as np
import pytest
from conftest import rows
from pyspark import cloudpickle
from pyspark.sql import functions as F

from daytally.functions import quantile
from daytally.functions.quantile import exact_quantile
from daytally.operators import anomaly
from daytally.operators.isolation import IsolationForest, grow_tree, mean_path
from daytally.schemas import ROW

START = dt.date(2016, 1, 1)
SCHEMA = "item_id string, store_id string, date date, actual int, predicted double"


def predictions(spark, series):
    made = [
        (item, "s", START + dt.timedelta(i), actual, guess)
        for item, pairs in series.items()
        for i, (actual, guess) in enumerate(pairs)
    ]
    return spark.createDataFrame(made, SCHEMA)


def test_residuals_and_flags_by_hand(spark):
    df = predictions(spark, {"a": [(1, 0.0), (2, 0.0), (1, 0.0), (9, 0.0)]})
    flagged = anomaly.statistical_flag(anomaly.residual_features(df)).orderBy("date").collect()
    assert [r["residual_rolling_mean"] for r in flagged[:3]] == [None, 1.0, 1.5]
    assert [r["residual_rolling_std"] for r in flagged[:2]] == [None, None]
    assert [r["z_score"] for r in flagged[:2]] == [None, None]
    assert flagged[3]["z_score"] == pytest.approx(9 / np.std([1, 2, 1], ddof=1))
    assert [r["anomaly_stat"] for r in flagged] == [0, 0, 0, 1]


def test_divisors_are_floored_but_missing_stays_missing(spark):
    df = predictions(spark, {"a": [(1, -2.0), (1, 0.0), (1, 0.05), (1, 4.0), (1, None)]})
    got = anomaly.residual_features(df).orderBy("date").collect()
    assert [r["residual_pct"] for r in got] == pytest.approx([30.0, 10.0, 9.5, -0.75, None])
    flat = predictions(spark, {"a": [(1, 0.0), (1, 0.0), (1, 0.0)]})
    z = anomaly.statistical_flag(anomaly.residual_features(flat)).orderBy("date").collect()
    assert z[2]["z_score"] == pytest.approx(1 / 0.1)


def test_residuals_of_hot_series(spark):
    rng = random.Random(1)
    df = predictions(spark, {"a": [(rng.randrange(9), rng.random()) for _ in range(90)], "b": [(1, 2.0)]})
    hot = df.filter("item_id = 'a'").select("item_id", "store_id")

    def close(out):
        doubles = {c: F.round(c, 9) for c, t in out.dtypes if t == "double"}
        return rows(out.withColumns(doubles), *out.columns)

    assert close(anomaly.residual_features(df, hot)) == close(anomaly.residual_features(df))


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(3)
    usual = [(int(50 + rng.gauss(0, 3)), 50 + rng.gauss(0, 1)) for _ in range(990)]
    far = [(rng.choice([-1, 1]) * 900 + i, 50.0) for i in range(10)]
    series = {f"n{i}": usual[i * 99 : i * 99 + 99] + [far[i]] for i in range(10)}
    return predictions(spark, series)


def test_planted_outliers_are_isolated(spark, planted):
    found = anomaly.detect(planted)
    far = F.abs("residual") > 500
    assert found.filter(far & (F.col("anomaly_iso") == 1)).count() >= 8
    assert found.filter("anomaly_iso = 1").count() == 10
    assert found.filter("is_anomaly < greatest(anomaly_stat, anomaly_iso)").isEmpty()
    assert found.filter("is_anomaly > anomaly_stat + anomaly_iso").isEmpty()
    assert found.count() == 1000


def test_isolation_scores_do_not_depend_on_partitions(spark, planted):
    residuals = anomaly.residual_features(planted)
    names = anomaly.RESIDUAL_FEATURES
    forest = IsolationForest(trees=20, sample=64)
    one = forest.fit(residuals.coalesce(1), names, ROW).transform(residuals)
    many = forest.fit(residuals.repartition(7), names, ROW).transform(residuals)
    assert rows(one, *ROW, "isolation_score") == rows(many, *ROW, "isolation_score")


def test_each_tree_gets_its_full_sample_from_a_thinned_table(spark):
    """300,000 rows, 8 trees: the pool is far smaller than the table."""
    df = spark.range(300_000).select("id", F.rand(1).alias("a"), F.rand(2).alias("b"))
    forest = IsolationForest(trees=8, sample=256)
    model = forest.fit(df, ["a", "b"], ["id"])
    assert model.arrays["left"].shape == (8, 511)
    roots = model.arrays["threshold"][:, 0]
    assert np.isfinite(roots).all() and len(set(roots)) == 8
    scores = model.transform(df).agg(F.min("isolation_score"), F.max("isolation_score")).first()
    assert 0.3 < scores[0] < scores[1] < 0.9


def test_tiny_tables(spark):
    df = predictions(spark, {"a": [(1, 1.0)]})
    assert anomaly.detect(df).first()["is_anomaly"] == 0
    with pytest.raises(ValueError, match="no rows"):
        anomaly.isolation_flag(anomaly.residual_features(df.limit(0)))


def test_tree_splits_every_distinct_point():
    points = np.arange(8.0)[:, None]
    nodes = grow_tree(points, 0, 1, height=10)
    leaves = nodes[nodes["feature"] < 0]
    assert len(leaves) == 8 and len(nodes) == 15
    assert mean_path(1) == 0 and mean_path(2) == 1
    assert mean_path(256) == pytest.approx(10.244770920116851)


def test_task_functions_do_not_need_the_package(tmp_path):
    code = "import pickle, sys; print(len(pickle.load(sys.stdin.buffer)([[1.0], [2.0]], 0, 1, 3)))"

    def grow(points, *args):
        return grow_tree(np.array(points), *args)

    done = subprocess.run(
        [sys.executable, "-c", code], input=cloudpickle.dumps(grow), cwd=tmp_path, capture_output=True
    )
    assert done.stdout.split()[-1:] == [b"3"], done.stderr


def test_neighbouring_floats_are_split():
    points = np.array([[1.0], [np.nextafter(1.0, 2.0)]])
    for tree in range(50):
        assert len(grow_tree(points, tree, 1, height=4)) == 3


@pytest.mark.parametrize("q", [0.0, 0.01, 0.5, 0.99, 1.0])
def test_exact_quantile_matches_sql(spark, q):
    rng = random.Random(11)
    values = [rng.choice([None, 1.5, 1.5, rng.gauss(0, 1), rng.expovariate(1e-6)]) for _ in range(999)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    con = duckdb.connect()
    con.register("t", df.toArrow())
    expected = con.execute(f"SELECT quantile_cont(x, {q}) FROM t").fetchall()[0][0]
    for bins in (2, 16, 4096):
        assert exact_quantile(df, "x", q, bins) == pytest.approx(expected, rel=1e-12)


def test_quantile_edges(spark):
    assert exact_quantile(spark.createDataFrame([(None,)], "x double"), "x", 0.5) is None
    assert exact_quantile(spark.createDataFrame([(2.0,)] * 5, "x double"), "x", 0.3) == 2.0
    with pytest.raises(ValueError):
        exact_quantile(spark.createDataFrame([(2.0,)], "x double"), "x", 1.5)


def test_quantile_takes_six_passes_on_any_values(spark, monkeypatch):
    """Values over the whole range of doubles, among them the smallest ones and both zeros."""
    rng = random.Random(5)
    values = [rng.choice([-1, 1]) * rng.uniform(1, 2) * 2.0 ** rng.randrange(-1074, 1023) for _ in range(500)]
    values += [0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308] * 3
    df = spark.createDataFrame([(v,) for v in values], "x double")
    passes = []
    counted = quantile.digit_counts
    monkeypatch.setattr(quantile, "digit_counts", lambda *a: passes.append(a) or counted(*a))
    for rank in (0, 1, 250, len(values) // 2, len(values) - 1):
        passes.clear()
        got = exact_quantile(df, "x", rank / (len(values) - 1))
        assert got == pytest.approx(sorted(values)[rank], rel=1e-9)
        assert len(passes) <= 5


@pytest.mark.parametrize("odd", [float("nan"), float("inf"), float("-inf")])
def test_quantile_refuses_values_that_are_not_finite(spark, odd):
    with pytest.raises(ValueError, match="infinite"):
        exact_quantile(spark.createDataFrame([(1.0,), (odd,)], "x double"), "x", 0.5)
