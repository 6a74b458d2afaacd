"""The panel is dealt among tasks by its filled size."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from daytally.functions.series import by_day
from daytally.plans import panel, queries
from conftest import plan

DAYS = 200


@pytest.fixture(scope="module")
def orders(spark, tmp_path_factory):
    """60 items in 2 stores over 200 days, with a sale on every tenth day."""
    folder = str(tmp_path_factory.mktemp("orders"))
    part = [(i * panel.PARTS_PER_ITEM, "B") for i in range(60)]
    line = [
        (part[i][0], s, 2.0, 5.0, dt.datetime(1999, 1, 1) + dt.timedelta(days=d))
        for i in range(60)
        for s in (1, 2)
        for d in (*range(0, DAYS, 10), DAYS - 1)
    ]
    made = {
        "part": part,
        "supplier": [(1, 1), (2, 2)],
        "nation": [(1, 1), (2, 2)],
        "region": [(1, "AMERICA"), (2, "ASIA")],
        "lineitem": line,
    }
    for name, rows in made.items():
        spark.createDataFrame(rows, panel.COLUMNS[name]).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_tasks_hold_a_bounded_number_of_panel_rows(spark, orders, monkeypatch):
    monkeypatch.setattr(panel, "TASK_ROWS", 1000)
    assert panel.panel_tasks(spark, orders) == pytest.approx(24, abs=2)
    rows = queries._featured(spark, orders)
    sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 120 * DAYS and max(sizes) < 4000


def test_sums_of_order_lines_hold_a_bounded_number_of_rows(spark, orders, monkeypatch):
    """2,520 lines make 63 tasks; no sum runs over a split of the file before them."""
    expected = sorted(map(tuple, panel.daily_units(spark, orders).collect()))
    monkeypatch.setattr(panel, "TASK_ROWS", 40)
    daily = panel.daily_units(spark, orders)
    sizes = [r["count"] for r in daily.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 55 and max(sizes) < 120
    assert sorted(map(tuple, daily.collect())) == expected
    before_shuffle = plan(daily).rpartition("Exchange hashpartitioning(item_id")[2]
    assert "HashAggregate" not in before_shuffle


def test_stored_series_stay_dealt(spark, orders, monkeypatch):
    monkeypatch.setattr(panel, "TASK_ROWS", 1000)
    rows = queries._stored_series(panel.sales_long(spark, orders))
    numbered = rows.withColumn("_n", F.row_number().over(by_day()))
    sizes = [r["count"] for r in numbered.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 120 * DAYS and max(sizes) < 4000


def test_an_empty_panel_needs_one_task(spark, orders, tmp_path):
    for name, columns in panel.COLUMNS.items():
        spark.createDataFrame([], columns).write.parquet(f"{tmp_path}/{name}.parquet")
    assert panel.panel_tasks(spark, str(tmp_path)) == 1
    assert panel.sales_long(spark, str(tmp_path)).isEmpty()


def test_hot_series_read_a_stored_panel(spark, orders):
    """A checkpoint holds whole rows as they are in memory; the stored panel is columns."""
    found = queries.feature_table_hot_series(spark, orders)
    assert any("/panel-" in name for name in found.inputFiles())
    assert found.count() == 120 * DAYS
