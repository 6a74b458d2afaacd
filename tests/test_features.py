import datetime as dt
import math
import random

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from daytally.functions import series
from daytally.functions.series import fill_both_ways, hot_series, number_rows, with_series_windows
from daytally.operators.features import FEATURES, feature_table
from daytally.operators.metrics import series_scales
from daytally.schemas import PASS_THROUGH

SCHEMA = (
    "item_id string, dept_id string, cat_id string, store_id string, state_id string, day string, "
    "date date, wm_yr_wk int, sales smallint, sell_price double, event_name_1 string, "
    "event_type_1 string, event_name_2 string, event_type_2 string, snap_CA int, snap_TX int, snap_WI int"
)
START = dt.date(2016, 1, 1)


def panel(spark, series):
    """``series``: item -> list of (day offset or None, sales, price)."""
    made = []
    for item, days in series.items():
        for offset, sales, price in days:
            day = None if offset is None else START + dt.timedelta(offset)
            event = "Feast" if offset == 2 else None
            made.append(
                (item, "dep", "cat", "s1", "CA", f"d_{offset}", day, 1, sales, price)
                + (event, None, None, None, 0, 0, 0)
            )
    return spark.createDataFrame(made, SCHEMA)


@pytest.fixture(scope="module")
def uneven(spark):
    """Series with gaps, missing values, one without a date, one row, two rows."""
    rng = random.Random(5)

    def one(n, step):
        offsets = sorted(rng.sample(range(n * step), n))
        return [
            (o, rng.choice([None, rng.randrange(300)]), rng.choice([None, rng.random()]))
            for o in offsets
        ]

    series = {"long": one(400, 3), "dense": one(300, 1), "one": one(1, 1), "two": one(2, 5)}
    series["dense"].append((None, 7, 1.0))
    return panel(spark, series)


def test_columns_and_types(spark, uneven):
    table = feature_table(uneven)
    assert table.columns == [*PASS_THROUGH, *FEATURES]
    types = dict(table.dtypes)
    assert types["sales_lag_7"] == "smallint"
    assert {types[c] for c in ("day_of_week", "month", "year")} == {"bigint"}
    assert types["has_event"] == "int"


def test_first_rows_and_frames(spark):
    days = [(i, i + 1, 2.0) for i in range(30)]
    got = feature_table(panel(spark, {"i": days})).orderBy("date").collect()
    assert got[0]["rolling_mean_7"] is None and got[0]["rolling_std_28"] is None
    assert got[1]["rolling_mean_7"] == 1.0 and got[1]["rolling_std_28"] is None
    assert got[2]["rolling_std_28"] == pytest.approx(math.sqrt(0.5))
    assert got[6]["sales_lag_7"] is None and got[7]["sales_lag_7"] == 1
    assert got[27]["sales_lag_28"] is None and got[28]["sales_lag_28"] == 1
    assert got[9]["rolling_mean_7"] == pytest.approx(sum(range(3, 10)) / 7)
    assert got[1]["price_ratio_28"] == 1.0
    assert [r["has_event"] for r in got[:4]] == [0, 0, 1, 0]


def test_sunday_is_zero(spark):
    table = feature_table(panel(spark, {"i": [((dt.date(2016, 4, 24) - START).days, 1, 1.0)]}))
    row = table.first()
    assert (row["day_of_week"], row["month"], row["year"]) == (0, 4, 2016)


def test_zero_or_missing_prices_give_no_ratio(spark):
    table = feature_table(panel(spark, {"i": [(0, 1, 0.0), (1, 1, 0.0), (2, 1, None)]}))
    assert [r["price_ratio_28"] for r in table.collect()] == [None, None, None]


def test_lag_counts_rows_and_undated_rows_come_last(spark):
    days = [(i * 3, i, 1.0) for i in range(8)] + [(None, 99, 1.0)]
    got = {r["sales"]: r["sales_lag_7"] for r in feature_table(panel(spark, {"i": days})).collect()}
    assert got[7] == 0 and got[99] == 1


def test_later_rows_do_not_change_earlier_features(spark, uneven):
    cut = START + dt.timedelta(200)
    early = F.col("date") <= F.lit(cut)
    assert rows(feature_table(uneven).filter(early), *FEATURES) == rows(
        feature_table(uneven.filter(early)), *FEATURES
    )


def test_one_exchange_and_shared_windows(spark, uneven):
    text = plan(feature_table(uneven))
    assert text.count("Exchange") == 1 and text.count("Window [") == 1


def test_result_does_not_depend_on_partitions(spark, uneven):
    assert rows(feature_table(uneven.repartition(13)), *FEATURES) == rows(
        feature_table(uneven.coalesce(1)), *FEATURES
    )


@pytest.mark.parametrize("chunk", [28, 50, 1000])
def test_hot_series_give_the_same_features(spark, uneven, chunk):
    hot = hot_series(uneven, max_rows=1)
    assert rows(hot, "item_id") == [("dense",), ("long",), ("two",)]
    columns = [*PASS_THROUGH, *FEATURES]

    def close(df):
        return rows(df.withColumns({c: F.round(c, 9) for c, t in df.dtypes if t == "double"}), *columns)

    assert close(feature_table(uneven, hot, chunk)) == close(feature_table(uneven))


def test_no_hot_series_means_no_split(spark, uneven):
    assert hot_series(uneven, max_rows=1000) is None


def test_chunk_shorter_than_a_frame_is_refused(spark, uneven):
    with pytest.raises(ValueError, match="shorter"):
        feature_table(uneven, hot_series(uneven, max_rows=1), chunk=27)


def test_frames_ahead_cross_chunks(spark, uneven):
    def build(w):
        return {"ahead": F.sum("sales").over(w.rowsBetween(1, 5)), "back": F.lag("sales", 3).over(w)}

    plain = with_series_windows(uneven, build, back=3, ahead=5)
    split = with_series_windows(
        uneven, build, back=3, ahead=5, hot=hot_series(uneven, max_rows=1), chunk=5
    )
    columns = ["item_id", "date", "ahead", "back"]
    assert rows(split, *columns) == rows(plain, *columns)


def test_row_numbers_are_consecutive(spark, uneven):
    numbered = number_rows(uneven, ["item_id", "store_id"], "date").orderBy("item_id", "_row")
    per_item = {}
    for r in numbered.collect():
        per_item.setdefault(r["item_id"], []).append((r["_row"], r["date"]))
    for pairs in per_item.values():
        assert [i for i, _ in pairs] == list(range(len(pairs)))
        dates = [d for _, d in pairs if d is not None]
        assert dates == sorted(dates)


def test_fill_stays_in_its_series_also_when_hot(spark):
    holes = {
        "a": [(0, 1, None), (1, 1, 5.0), (40, 1, None), (80, 1, 7.0), (200, 1, None)],
        "b": [(0, 1, None), (100, 1, None)],
        "c": [(0, 1, None), (100, 1, None), (170, 1, 3.0)],
    }
    df = panel(spark, holes)
    plain = fill_both_ways(df, "sell_price")
    got = {}
    for r in plain.orderBy("item_id", "date").collect():
        got.setdefault(r["item_id"], []).append(r["sell_price"])
    assert got == {"a": [5.0, 5.0, 5.0, 7.0, 7.0], "b": [None, None], "c": [3.0, 3.0, 3.0]}
    split = fill_both_ways(df, "sell_price", hot=hot_series(df, max_rows=1))
    assert rows(split, "item_id", "date", "sell_price") == rows(plain, "item_id", "date", "sell_price")


def test_scales_of_hot_series(spark, uneven):
    hot = hot_series(uneven, max_rows=1)
    plain, split = series_scales(uneven), series_scales(uneven, hot)
    assert [(i, round(s, 9)) for i, s in rows(split, "item_id", "scale")] == [
        (i, round(s, 9)) for i, s in rows(plain, "item_id", "scale")
    ]


def test_chunks_of_hot_series_are_dealt_by_their_number(spark, uneven, monkeypatch):
    """Few shuffle partitions do not make the tasks of a large table larger."""
    monkeypatch.setattr(series, "TASK_ROWS", 5)
    split = feature_table(uneven, hot_series(uneven, max_rows=1), 28)
    assert plan(split).count("REPARTITION_BY_NUM") == 2
    columns = ["item_id", "date", "sales_lag_7", "sales_lag_28", "has_event"]
    assert rows(split, *columns) == rows(feature_table(uneven), *columns)
