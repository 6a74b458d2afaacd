"""Lag, rolling, price, calendar and event features per daily series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from daytally.functions.columns import ratio, weekday_number
from daytally.functions.series import CHUNK_ROWS, with_series_windows
from daytally.schemas import PASS_THROUGH, require_columns

# The windows the feature names stand for.
LAGS = [7, 28]
MEAN_WINDOWS = [7, 28]
STD_WINDOW = 28
PRICE_WINDOW = 28


def lag_columns(w: WindowSpec) -> dict[str, Column]:
    return {f"sales_lag_{n}": F.lag("sales", n).over(w) for n in LAGS}


def rolling_mean_columns(w: WindowSpec) -> dict[str, Column]:
    """Means of the rows before the current one; short frames count, NULLs do not."""
    return {f"rolling_mean_{n}": F.avg("sales").over(w.rowsBetween(-n, -1)) for n in MEAN_WINDOWS}


def rolling_std_column(w: WindowSpec) -> dict[str, Column]:
    frame = w.rowsBetween(-STD_WINDOW, -1)
    return {f"rolling_std_{STD_WINDOW}": F.stddev_samp("sales").over(frame)}


def price_ratio_column(w: WindowSpec) -> dict[str, Column]:
    usual = F.avg("sell_price").over(w.rowsBetween(-PRICE_WINDOW, -1))
    return {f"price_ratio_{PRICE_WINDOW}": ratio(F.col("sell_price"), usual)}


def calendar_columns(day: str = "date") -> dict[str, Column]:
    return {
        "day_of_week": weekday_number(day),
        "month": F.month(day).cast("bigint"),
        "year": F.year(day).cast("bigint"),
    }


def event_column() -> dict[str, Column]:
    named = F.col("event_name_1").isNotNull() | F.col("event_name_2").isNotNull()
    return {"has_event": F.when(named, 1).otherwise(0)}


def feature_table(
    sales_long: DataFrame, hot: DataFrame | None = None, chunk: int = CHUNK_ROWS
) -> DataFrame:
    """The 17 carried columns and the 10 computed ones, in table order."""
    require_columns(sales_long, PASS_THROUGH, "sales_long")

    def windowed(w: WindowSpec) -> dict[str, Column]:
        return {
            **lag_columns(w),
            **rolling_mean_columns(w),
            **rolling_std_column(w),
            **price_ratio_column(w),
        }

    back = max(*LAGS, *MEAN_WINDOWS, STD_WINDOW, PRICE_WINDOW)
    rows = with_series_windows(
        sales_long.select(*PASS_THROUGH), windowed, back=back, hot=hot, chunk=chunk
    )
    rows = rows.withColumns({**calendar_columns(), **event_column()})
    return rows.select(*PASS_THROUGH, *FEATURES)


FEATURES = [
    *(f"sales_lag_{n}" for n in LAGS),
    *(f"rolling_mean_{n}" for n in MEAN_WINDOWS),
    f"rolling_std_{STD_WINDOW}",
    "day_of_week",
    "month",
    "year",
    f"price_ratio_{PRICE_WINDOW}",
    "has_event",
]
