import datetime as dt

import pytest
from conftest import plan, rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daytally.functions.columns import parse_day
from daytally.operators import quality, reshape
from daytally.schemas import WIDE_IDS
from daytally.sources import files

IDS = ("i1", "dep", "cat", "s1", "CA")
CALENDAR = (
    "d string, date string, wm_yr_wk int, event_name_1 string, event_type_1 string, "
    "event_name_2 string, event_type_2 string, snap_CA int, snap_TX int, snap_WI int"
)


def wide(spark, *cells, days=("d_1", "d_2", "d_3"), extra=False):
    schema = [*WIDE_IDS, *(["id"] if extra else []), *days]
    kinds = {True: T.IntegerType(), False: T.StringType()}
    types = T.StructType([T.StructField(c, kinds[c in days]) for c in schema])
    return spark.createDataFrame(list(cells), types)


def calendar(spark, *days):
    made = [(d, text, week, None, None, None, None, 0, 0, 1) for d, text, week in days]
    return spark.createDataFrame(made, CALENDAR)


def test_null_cells_are_kept_and_other_columns_dropped(spark):
    df = wide(spark, (*IDS, "x", 1, None, 3), ("i2", *IDS[1:], "y", 0, 5, None), extra=True)
    long = reshape.unpivot_days(df)
    assert long.columns == [*WIDE_IDS, "day", "sales"]
    assert dict(long.dtypes)["sales"] == "smallint"
    assert rows(long, "item_id", "day", "sales") == sorted(
        [
            ("i1", "d_1", 1),
            ("i1", "d_2", None),
            ("i1", "d_3", 3),
            ("i2", "d_1", 0),
            ("i2", "d_2", 5),
            ("i2", "d_3", None),
        ],
        key=str,
    )


@pytest.mark.parametrize("days", [("d_7", "d_8", "d_9"), ("d_3", "d_1", "d_20"), ("d_a", "d_01", "d_`")])
def test_day_labels_follow_the_column_names(spark, days):
    long = reshape.unpivot_days(wide(spark, (*IDS, 10, 20, 30), days=days))
    assert rows(long, "day", "sales") == sorted(zip(days, (10, 20, 30)), key=str)


def test_unpivot_then_pivot_gives_the_same_table(spark):
    df = wide(spark, (*IDS, 1, 2, 3), ("i2", *IDS[1:], 4, 5, 6))
    back = reshape.unpivot_days(df).groupBy(*WIDE_IDS).pivot("day").agg(F.first("sales"))
    assert rows(back, *df.columns) == rows(df, *df.columns)


def test_department_is_no_day_column(spark):
    assert reshape.day_columns(wide(spark, (*IDS, 1, 2, 3))) == ["d_1", "d_2", "d_3"]


def test_overflow_fails_or_turns_null(spark):
    df = wide(spark, (*IDS, 70000, 1, 1))
    with pytest.raises(PySparkException, match="CAST_OVERFLOW"):
        reshape.unpivot_days(df).collect()
    lenient = reshape.unpivot_days(df, strict=False)
    assert (("d_1", None)) in rows(lenient, "day", "sales")


def test_bad_date_fails_or_turns_null(spark):
    cal = calendar(spark, ("d_1", "2016-13-01", 1))
    with pytest.raises(PySparkException):
        reshape.parse_calendar(cal).collect()
    assert reshape.parse_calendar(cal, strict=False).first()["date"] is None
    good = spark.range(1).select(parse_day(F.lit("2016-04-24")).alias("x")).first()
    assert good["x"] == dt.date(2016, 4, 24)


def test_days_and_prices_missing_from_the_dimensions_give_nulls(spark):
    long = reshape.unpivot_days(wide(spark, (*IDS, 1, 2, 3)))
    cal = reshape.parse_calendar(calendar(spark, ("d_1", "2016-01-01", 5), ("d_3", "2016-01-03", 6)))
    prices = spark.createDataFrame(
        [("s1", "i1", 5, 2.5)], "store_id string, item_id string, wm_yr_wk int, sell_price double"
    )
    joined = reshape.join_calendar_prices(long, cal, prices)
    assert "d" not in joined.columns
    assert rows(joined, "day", "date", "wm_yr_wk", "sell_price") == sorted(
        [
            ("d_1", dt.date(2016, 1, 1), 5, 2.5),
            ("d_2", None, None, None),
            ("d_3", dt.date(2016, 1, 3), 6, None),
        ],
        key=str,
    )


def test_summary_shows_duplicate_dimension_keys(spark):
    long = reshape.unpivot_days(wide(spark, (*IDS, 1, 2, 3)))
    cal = calendar(spark, ("d_1", "2016-01-01", 5), ("d_1", "2016-01-01", 5))
    prices = spark.createDataFrame(
        [("s1", "i1", 5, 2.5)], "store_id string, item_id string, wm_yr_wk int, sell_price double"
    )
    joined = reshape.join_calendar_prices(long, cal, prices)
    summary = dict(rows(reshape.row_summary(long, joined, cal, prices), "name", "rows"))
    assert summary == {"sales_long_rows": 3, "joined_rows": 4, "calendar_rows": 2, "prices_rows": 1}
    with pytest.raises(ValueError, match="several rows"):
        quality.require_unique_rows(reshape.parse_calendar(joined))


def test_large_calendar_is_not_broadcast(spark):
    cal = calendar(spark, ("d_1", "2016-01-01", 5), ("d_2", "2016-01-02", 5))
    hinted = reshape.broadcast_calendar(cal, max_rows=2)
    assert "ResolvedHint" in hinted._jdf.queryExecution().analyzed().toString()
    assert reshape.broadcast_calendar(cal, max_rows=1) is cal


def test_csv_files_are_read_with_fixed_types(spark, tmp_path):
    (tmp_path / "s.csv").write_text(
        "id,item_id,dept_id,cat_id,store_id,state_id,d_1,d_2\nx,001,dep,cat,s1,CA,3,\n"
    )
    (tmp_path / "c.csv").write_text(
        "date,wm_yr_wk,weekday,d,event_name_1,event_type_1,event_name_2,event_type_2,"
        "snap_CA,snap_TX,snap_WI\n2016-01-01,5,Friday,d_1,,,,,0,1,0\n"
    )
    (tmp_path / "p.csv").write_text("store_id,item_id,wm_yr_wk,sell_price\ns1,001,5,2\n")
    sales = files.read_sales_csv(spark, str(tmp_path / "s.csv"))
    assert dict(sales.dtypes)["d_1"] == "int"
    assert rows(sales, "item_id", "d_1", "d_2") == [("001", 3, None)]
    cal = files.read_calendar_csv(spark, str(tmp_path / "c.csv"))
    assert dict(cal.dtypes)["date"] == "string" and cal.first()["event_name_1"] is None
    prices = files.read_prices_csv(spark, str(tmp_path / "p.csv"))
    assert rows(prices, "item_id", "sell_price") == [("001", 2.0)]


def test_malformed_csv_fails(spark, tmp_path):
    (tmp_path / "p.csv").write_text("store_id,item_id,wm_yr_wk,sell_price\ns1,i1,five,2\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        files.read_prices_csv(spark, str(tmp_path / "p.csv")).collect()


def test_missing_input_is_named(spark, tmp_path):
    for read in (files.read_table, files.read_sales_csv, files.read_predictions_csv):
        with pytest.raises(FileNotFoundError, match="nowhere"):
            read(spark, str(tmp_path / "nowhere"))


def test_long_rows_are_not_shuffled_for_joins_and_features(spark, tmp_path):
    """Two exchanges, both of compact inputs; a bucketed table needs none."""
    from daytally.operators.features import feature_table

    df = wide(spark, (*IDS, 1, 2, 3), ("i2", *IDS[1:], 4, 5, 6))
    cal = reshape.parse_calendar(calendar(spark, *[(f"d_{i}", f"2016-01-0{i}", 5) for i in (1, 2, 3)]))
    prices = spark.createDataFrame(
        [("s1", "i1", 5, 2.5)], "store_id string, item_id string, wm_yr_wk int, sell_price double"
    ).hint("merge")
    long = reshape.join_calendar_prices(reshape.unpivot_days(df, 6), cal, prices, 6)
    text = plan(feature_table(long))
    assert "SortMergeJoin" in text
    assert text.count("Exchange hashpartitioning") == 2
    files.write_bucketed(long, "default.long_rows", str(tmp_path / "long_rows"), 6)
    stored = plan(feature_table(spark.table("default.long_rows")))
    assert "Window" in stored and "Exchange" not in stored
