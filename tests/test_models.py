import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from daytally.operators import forecast, models
from daytally.operators.boosting import TweedieBoosting, tweedie_deviance
from daytally.operators.metrics import mean_absolute_error
from daytally.operators.models import BOOSTED, FOREST, Forest
from daytally.schemas import MODEL_FEATURES

START = dt.date(2016, 1, 1)
SCHEMA = (
    "item_id string, store_id string, date date, sell_price double, sales_lag_7 int, "
    "sales_lag_28 int, rolling_mean_7 double, day_of_week bigint, sales int"
)
SMALL_FOREST = Forest(trees=5, max_depth=5)
SMALL_BOOST = TweedieBoosting(rounds=4, learning_rate=0.3, max_depth=4, min_rows=10, cut_every=2)


@pytest.fixture(scope="module")
def data(spark):
    """Sales that follow the weekday and the lag, many of them zero."""
    rng = random.Random(7)
    made = []
    for i in range(1500):
        dow, lag = i % 7, rng.randrange(20)
        sales = max(0, int(lag * (0.2 + 0.1 * dow) + rng.gauss(0, 1) - 1))
        made.append(
            (f"i{i % 5}", "s", START + dt.timedelta(i // 5), rng.uniform(1, 9), lag)
            + (rng.randrange(20), float(lag), dow, sales)
        )
    return spark.createDataFrame(made, SCHEMA).repartition(4, "item_id").cache()


@pytest.fixture(scope="module")
def fitted(data):
    return {BOOSTED: SMALL_BOOST.fit(data), FOREST: SMALL_FOREST.fit(data)}


def test_both_models_beat_the_lag(data, fitted):
    lag = mean_absolute_error(data, "sales", "sales_lag_28").first()["mae"]
    for model in fitted.values():
        assert mean_absolute_error(models.predict(model, data)).first()["mae"] < lag


def test_deviance_falls_with_more_rounds(data, fitted):
    def deviance(model):
        return tweedie_deviance(models.predict(model, data)).first()["deviance"]

    one = TweedieBoosting(rounds=1, learning_rate=0.3, max_depth=4, min_rows=10).fit(data)
    start = data.select(F.col("sales").alias("actual")).withColumn(
        "predicted", F.lit(data.agg(F.avg("sales")).first()[0])
    )
    assert deviance(fitted[BOOSTED]) < deviance(one) < tweedie_deviance(start).first()["deviance"]


def test_one_stump_is_one_newton_step(spark, data):
    """A tree that may not split moves every score by the mean slope over the mean curvature."""
    model = TweedieBoosting(rounds=1, learning_rate=1.0, min_rows=10**6).fit(data)
    mean = data.agg(F.avg("sales")).first()[0]
    got = models.predict(model, data).select("predicted").distinct().collect()
    assert len(got) == 1
    # At the start the slopes sum to zero, so the only step is zero.
    assert got[0]["predicted"] == pytest.approx(mean)


def test_fits_are_repeatable_and_survive_saving(data, fitted, tmp_path):
    again = SMALL_BOOST.fit(data)
    columns = ["item_id", "date", "predicted"]
    first = rows(models.predict(fitted[BOOSTED], data), *columns)
    second = rows(models.predict(again, data), *columns)
    assert [r[2] for r in first] == pytest.approx([r[2] for r in second])
    for name, model in fitted.items():
        path = models.keep_model(model, str(tmp_path / name))
        loaded = models.load_model(path)
        assert rows(models.predict(loaded, data), *columns) == rows(models.predict(model, data), *columns)


def test_target_must_be_usable(data):
    with pytest.raises(ValueError, match="positive mean"):
        SMALL_BOOST.fit(data.withColumn("sales", F.lit(0)))
    with pytest.raises(ValueError, match="non-negative"):
        SMALL_BOOST.fit(data.withColumn("sales", F.col("sales") - 1))


def test_rows_and_columns_can_be_sampled(data):
    model = TweedieBoosting(rounds=2, row_share=0.5, column_share=0.2, min_rows=5).fit(data)
    assert models.predict(model, data).filter("predicted > 0").count() == data.count()


def test_comparison_prefers_mae_then_the_boosted_model(spark, data, fitted):
    predictions = {name: models.predict(model, data) for name, model in fitted.items()}
    scores = models.compare(predictions, data)
    assert scores.columns == ["model", "mae", "wrmsse"] and scores.count() == 2
    tie = spark.createDataFrame([(FOREST, 1.0, 0.1), (BOOSTED, 1.0, 0.9)], scores.schema)
    assert models.best_model(tie).first()["model"] == BOOSTED
    win = spark.createDataFrame([(FOREST, 0.9, 2.0), (BOOSTED, 1.0, 0.9)], scores.schema)
    assert models.best_model(win).first()["model"] == FOREST


def test_run_log_is_appended(spark, tmp_path):
    path = str(tmp_path / "log")
    params = models.model_params({BOOSTED: SMALL_BOOST, FOREST: SMALL_FOREST})
    for run in ("r1", "r2"):
        models.append_log(models.run_log(spark, run, {"top_n_items": 5, **params}, {"mae": 0.5}), path)
    log = spark.read.parquet(path)
    assert rows(log.filter("run_id = 'r2' AND kind = 'metric'"), "key", "value") == [("mae", "0.5")]
    kept = {r["key"] for r in log.filter("run_id = 'r1'").collect()}
    assert {"rf_trees", "lgb_rounds", "lgb_power", "top_n_items"} <= kept


def history_rows(spark, n=40):
    made = []
    for i in range(n):
        day = START + dt.timedelta(i)
        made.append(("full", "s", day, i % 7 + 1, 2.0 if i < 30 else None))
        made.append(("unpriced", "s", day, 1, None))
        if i > n - 10:
            made.append(("short", "s", day, 1, 1.0))
    return spark.createDataFrame(
        made, "item_id string, store_id string, date date, sales smallint, sell_price double"
    )


def test_history_keeps_the_last_days_and_price(spark):
    got = {r["item_id"]: r for r in forecast.series_history(history_rows(spark)).collect()}
    assert got["full"]["history"] == [float(i % 7 + 1) for i in range(12, 40)]
    assert got["full"]["sell_price"] == 2.0 and got["unpriced"]["sell_price"] is None
    assert len(got["short"]["history"]) == 9


def test_first_future_features(spark):
    history = forecast.series_history(history_rows(spark))
    row = forecast.step_features(history, 1).filter("item_id = 'full'").first()
    assert row["date"] == START + dt.timedelta(40)
    assert (row["sales_lag_7"], row["sales_lag_28"]) == (33 % 7 + 1, 12 % 7 + 1)
    assert row["rolling_mean_7"] == pytest.approx(4.0)
    assert row["day_of_week"] == (row["date"].weekday() + 1) % 7


def test_forecast_matches_a_loop_over_days(spark, fitted):
    """Brute force: one model call per day on plain lists."""
    model, horizon = fitted[FOREST], 9
    got = forecast.horizon_forecast(history_rows(spark), model, horizon)
    assert got.count() == 3 * horizon
    assert got.filter("item_id <> 'full' AND predicted IS NOT NULL").isEmpty()
    values = [float(i % 7 + 1) for i in range(12, 40)]
    expected = []
    for step in range(1, horizon + 1):
        day = START + dt.timedelta(39 + step)
        features = (2.0, values[-7], values[-28], sum(values[-7:]) / 7, float((day.weekday() + 1) % 7))
        one = spark.createDataFrame([features], ", ".join(f"{f} double" for f in MODEL_FEATURES))
        values.append(max(0.0, model.transform(one).first()["prediction"]))
        expected.append((day, values[-1]))
    full = got.filter("item_id = 'full'").orderBy("date").collect()
    assert [(r["date"], pytest.approx(r["predicted"])) for r in full] == expected


class HalfWeek:
    """A formula in place of a model, for the loop alone."""

    def transform(self, rows):
        return rows.withColumn("prediction", 0.5 * F.col("sales_lag_7") + 0.5 * F.col("rolling_mean_7"))


@pytest.mark.parametrize("cut_every", [1, 3, 7])
def test_requests_have_their_own_horizon(spark, cut_every):
    sales = history_rows(spark).unionByName(
        history_rows(spark).filter("item_id = 'full'").withColumn("item_id", F.lit("twin"))
    )
    asked = [("full", 2), ("full", 5), ("twin", 9), ("short", 3), ("nowhere", 4), ("unpriced", 0), ("unpriced", None)]
    requests = spark.createDataFrame([(i, "s", h) for i, h in asked], "item_id string, store_id string, horizon int")
    got = forecast.requested_forecast(sales, HalfWeek(), requests, cut_every)
    values = [float(i % 7 + 1) for i in range(12, 40)]
    for _ in range(9):
        values.append(0.5 * values[-7] + 0.5 * sum(values[-7:]) / 7)
    by_item = {}
    for r in got.orderBy("date").collect():
        by_item.setdefault(r["item_id"], []).append((r["date"], r["predicted"]))
    days = [START + dt.timedelta(40 + i) for i in range(9)]
    assert set(by_item) == {"full", "twin", "short"}
    assert [d for d, _ in by_item["full"]] == days[:5] and [d for d, _ in by_item["twin"]] == days
    assert [v for _, v in by_item["full"]] == pytest.approx(values[28:33])
    assert [v for _, v in by_item["twin"]] == pytest.approx(values[28:])
    assert [v for _, v in by_item["short"]] == [None] * 3
    left = forecast.unanswered(sales, requests)
    assert rows(left, "item_id", "horizon") == [("nowhere", 4), ("unpriced", 0), ("unpriced", None)]


def test_no_request_gives_no_row(spark):
    none = spark.createDataFrame([], "item_id string, store_id string, horizon int")
    assert forecast.requested_forecast(history_rows(spark), HalfWeek(), none).isEmpty()


def test_failed_write_leaves_the_version_before(spark, data, fitted, tmp_path, monkeypatch):
    path = str(tmp_path / "kept")
    with pytest.raises(FileNotFoundError, match="no kept model"):
        models.load_model(path)
    models.keep_model(fitted[FOREST], path, data.select(*MODEL_FEATURES))
    assert models.example_rows(path).count() == 5
    assert models.example_rows(path).columns == MODEL_FEATURES

    def broken(*_):
        raise OSError("disk gone")

    # The model is written, its examples are not: no manifest row may point to it.
    with monkeypatch.context() as patched:
        patched.setattr(models.files, "write_table", broken)
        with pytest.raises(OSError, match="disk gone"):
            models.keep_model(fitted[BOOSTED], path, data)
    assert [r["number"] for r in models.versions(spark, path)] == [1]
    columns = ["item_id", "date", "predicted"]
    first = rows(models.predict(fitted[FOREST], data), *columns)
    assert rows(models.predict(models.load_model(path), data), *columns) == first
    models.keep_model(fitted[BOOSTED], path)
    assert [r["number"] for r in models.versions(spark, path)] == [1, 2]
    second = rows(models.predict(fitted[BOOSTED], data), *columns)
    assert rows(models.predict(models.load_model(path), data), *columns) == second
    assert rows(models.predict(models.load_model(path, 1), data), *columns) == first
    with pytest.raises(ValueError, match="no example rows"):
        models.example_rows(path)
