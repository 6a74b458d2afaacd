"""Column sets, CSV types and the guard for missing columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

# Names and types that callers and stored tables rely on.
SERIES = ["item_id", "store_id"]
ROW = ["item_id", "store_id", "date"]
WIDE_IDS = ["item_id", "dept_id", "cat_id", "store_id", "state_id"]
DAY_PREFIX = "d_"
DATE_FORMAT = "yyyy-MM-dd"
CALENDAR_TYPES = {
    "d": "string",
    "date": "string",
    "wm_yr_wk": "int",
    "event_name_1": "string",
    "event_type_1": "string",
    "event_name_2": "string",
    "event_type_2": "string",
    "snap_CA": "int",
    "snap_TX": "int",
    "snap_WI": "int",
}
PRICE_TYPES = {"store_id": "string", "item_id": "string", "wm_yr_wk": "int", "sell_price": "double"}
PREDICTION_SCHEMA = "item_id string, store_id string, date date, actual int, predicted double"
PASS_THROUGH = [
    "item_id",
    "dept_id",
    "cat_id",
    "store_id",
    "state_id",
    "day",
    "date",
    "wm_yr_wk",
    "sales",
    "sell_price",
    "event_name_1",
    "event_type_1",
    "event_name_2",
    "event_type_2",
    "snap_CA",
    "snap_TX",
    "snap_WI",
]
MODEL_FEATURES = ["sell_price", "sales_lag_7", "sales_lag_28", "rolling_mean_7", "day_of_week"]
TARGET = "sales"


def missing_columns(df: DataFrame, names: Iterable[str]) -> list[str]:
    have = set(df.columns)
    return [n for n in names if n not in have]


def require_columns(df: DataFrame, names: Iterable[str], what: str) -> None:
    """Raise before any job runs when ``df`` lacks one of ``names``."""
    missing = missing_columns(df, names)
    if missing:
        raise ValueError(f"{what} lacks columns: {missing}")
