import datetime as dt

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from daytally.operators import metrics, quality, selection

DAY = dt.date(2016, 4, 1)
FEATURES = (
    "item_id string, store_id string, state_id string, date date, sales int, sell_price double, "
    "sales_lag_7 int, sales_lag_28 int, rolling_mean_7 double, day_of_week bigint"
)


def features(spark, *made):
    return spark.createDataFrame(list(made), FEATURES)


def row(item="i", store="CA_1", state="CA", date=DAY, sales=1, price=1.0, lag=None):
    return (item, store, state, date, sales, price, lag, lag, 1.0, 0)


def verdicts(report):
    return {r["name"]: r["passed"] for r in report.collect()}


LOW = quality.Limits(min_rows=1)


def test_good_table_passes_all_checks_in_one_scan(spark):
    df = features(spark, row(), row(date=DAY + dt.timedelta(1), lag=3))
    report = quality.quality_report(df, LOW)
    assert report.columns == ["name", "passed", "detail"]
    assert len(verdicts(report)) == 9 and all(verdicts(report).values())
    assert plan(quality.quality_report(df, LOW)).count("ExistingRDD") == 1
    assert quality.enforce(report) is report


@pytest.mark.parametrize(
    "bad, check",
    [
        (row(item=None), "item_id_no_nulls"),
        (row(store=None), "store_id_no_nulls"),
        (row(date=None), "date_no_nulls"),
        (row(sales=1001), "sales_between_0_and_1000"),
        (row(sales=-1), "sales_between_0_and_1000"),
        (row(price=-0.5), "sell_price_non_negative"),
        (row(date=dt.date(2016, 7, 1)), "date_range_reasonable"),
        (row(date=dt.date(2010, 12, 31)), "date_range_reasonable"),
    ],
)
def test_each_check_fails_alone(spark, bad, check):
    report = quality.quality_report(features(spark, row(), bad), LOW)
    assert [n for n, ok in verdicts(report).items() if not ok] == [check]
    with pytest.raises(ValueError, match=check):
        quality.enforce(report)


def test_early_rows_must_have_no_lag(spark):
    report = quality.quality_report(features(spark, row(lag=1)), LOW)
    assert not verdicts(report)["lag_features_have_nulls_for_early_rows"]


def test_default_row_limit(spark):
    assert not verdicts(quality.quality_report(features(spark, row())))["row_count >= 100000"]


def test_empty_table_fails_without_an_exception(spark):
    report = quality.quality_report(features(spark), LOW)
    failed = {r["name"]: r["detail"] for r in report.filter("not passed").collect()}
    assert failed["sales_between_0_and_1000"] == "None"
    assert failed["date_range_reasonable"] == "None"
    assert failed["row_count >= 1"] == "False"


def test_missing_column_is_reported(spark):
    df = features(spark, row()).drop("sell_price")
    report = quality.quality_report(df, LOW)
    failed = [n for n, ok in verdicts(report).items() if not ok]
    assert failed == ["required_columns_exist", "sell_price_non_negative"]
    assert "sell_price" in report.filter("name = 'required_columns_exist'").first()["detail"]


def test_duplicate_days(spark):
    df = features(spark, row(), row(), row(item="j"))
    assert rows(quality.duplicate_rows(df), "item_id", "count") == [("i", 2)]


def test_top_items_tie_goes_to_the_smaller_name(spark):
    df = features(
        spark, row("b"), row("a"), row("c"), row("c"), row("z", store="CA_2"), row("y", state="TX")
    )
    store = selection.one_store(df)
    assert [tuple(r) for r in selection.top_items(store, 2).collect()] == [("c", 2), ("a", 1)]
    assert {r["item_id"] for r in selection.store_top_items(df, k=2).collect()} == {"a", "c"}
    heavy = features(spark, row("a", sales=1), row("a", sales=1), row("b", sales=9))
    assert selection.top_items(heavy, 1, by="volume").first()["item_id"] == "b"
    with pytest.raises(ValueError, match="by must be"):
        selection.top_items(heavy, 1, by="luck")


def test_top_k_needs_no_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(selection.top_items(features(spark, row()), 3))


def test_date_split_leaves_out_later_and_missing_days(spark):
    days = ["2016-03-27", "2016-03-28", "2016-04-24", "2016-04-25"]
    df = features(spark, *[row(date=dt.date.fromisoformat(d)) for d in days], row(date=None))
    train, val = selection.split_by_date(df)
    assert [str(r["date"]) for r in train.collect()] == days[:1]
    assert sorted(str(r["date"]) for r in val.collect()) == days[1:3]


def test_store_filter_reaches_the_scan(spark, tmp_path):
    features(spark, row()).write.parquet(str(tmp_path / "f"))
    text = plan(selection.one_store(spark.read.parquet(str(tmp_path / "f"))))
    assert "EqualTo(state_id,CA), EqualTo(store_id,CA_1)" in text


def test_complete_rows(spark):
    df = features(spark, row(), row(lag=2), row(lag=2, price=None), row(lag=2, sales=None))
    kept = selection.complete_rows(df)
    assert kept.columns == ["item_id", "store_id", "date", "sell_price", "sales_lag_7"] + [
        "sales_lag_28",
        "rolling_mean_7",
        "day_of_week",
        "sales",
    ]
    assert kept.count() == 1
    with pytest.raises(ValueError, match="sell_price"):
        selection.complete_rows(df.drop("sell_price"))


ACTUAL = "item_id string, store_id string, date date, sales smallint"


def series(spark, values, name="sales", kind="smallint", first=DAY):
    made = [
        (item, "s", first + dt.timedelta(i), v)
        for item, vs in values.items()
        for i, v in enumerate(vs)
    ]
    return spark.createDataFrame(made, f"item_id string, store_id string, date date, {name} {kind}")


def pred(spark, values, first=DAY):
    return series(spark, values, "pred", "double", first)


def test_scale_of_flat_short_and_wide_series(spark):
    train = series(spark, {"flat": [5, 5, 5], "one": [3], "two": [0, 300], "gap": [1, None, 3]})
    scale = {r["item_id"]: r["scale"] for r in metrics.series_scales(train).collect()}
    assert scale == {"flat": 1e-8, "one": 1e-8, "two": 90000.0, "gap": 1e-8}


def test_score_by_hand(spark):
    train = series(spark, {"a": [0, 2, 0], "b": [1, 4]})
    actual = series(spark, {"a": [1, 3], "b": [6, 0]}, first=DAY + dt.timedelta(9))
    guess = pred(spark, {"a": [2.0, 3.0], "b": [3.0, 3.0]}, DAY + dt.timedelta(9))
    expected = 0.4 * (0.5 / 4) ** 0.5 + 0.6 * (9 / 9) ** 0.5
    assert metrics.wrmsse_score(actual, guess, train) == pytest.approx(expected)
    detail = metrics.series_rmsse(actual, guess, train)
    assert detail.agg(F.sum("weight")).first()[0] == pytest.approx(1.0)
    priced = actual.withColumn("sell_price", F.when(F.col("item_id") == "a", 3.0).otherwise(1.0))
    by_revenue = (12 / 18) * (0.5 / 4) ** 0.5 + (6 / 18) * 1.0
    assert metrics.wrmsse_score(priced, guess, train) == pytest.approx(by_revenue)


def test_weight_of_a_series_without_prediction_is_lost(spark):
    train = series(spark, {"a": [0, 2], "b": [0, 2]})
    actual = series(spark, {"a": [1], "b": [1]})
    score = metrics.wrmsse_score(actual, pred(spark, {"a": [3.0]}), train)
    assert score == pytest.approx(0.5 * (4 / 4) ** 0.5)


def test_no_match_and_no_weight_are_errors(spark):
    train, actual = series(spark, {"a": [0, 2]}), series(spark, {"a": [1]})
    with pytest.raises(ValueError, match="share no row"):
        metrics.wrmsse_score(actual, pred(spark, {"a": [1.0]}, DAY + dt.timedelta(5)), train)
    with pytest.raises(ValueError, match="total weight"):
        metrics.wrmsse_score(series(spark, {"a": [0]}), pred(spark, {"a": [1.0]}), train)


def test_metric_inputs_are_checked(spark):
    good, guess = series(spark, {"a": [1]}), pred(spark, {"a": [1.0]})
    for actual, p, train in (
        (good.drop("sales"), guess, good),
        (good, guess.drop("pred"), good),
        (good, guess, good.drop("date")),
    ):
        with pytest.raises(ValueError, match="lacks columns"):
            metrics.wrmsse_score(actual, p, train)


def test_mean_absolute_error(spark):
    df = spark.createDataFrame([(1, 2.5), (4, 3.5)], "actual int, predicted double")
    assert metrics.mean_absolute_error(df).first()["mae"] == pytest.approx(1.0)
