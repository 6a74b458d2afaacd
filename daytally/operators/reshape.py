"""Wide daily sales to long rows, calendar parsing, and the calendar and price joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daytally.functions.columns import narrow_sales, parse_day
from daytally.schemas import DAY_PREFIX, SERIES, WIDE_IDS, require_columns

# A calendar has one row per day; beyond this many rows it is not broadcast.
MAX_CALENDAR_ROWS = 100_000


def day_columns(wide: DataFrame) -> list[str]:
    return [name for name in wide.columns if name.startswith(DAY_PREFIX)]


def _day_label(names: list[str], position: Column) -> Column:
    """Column name at ``position``: computed for d_k, d_k+1, …, else looked up."""
    tail = names[0][len(DAY_PREFIX) :]
    start = int(tail) if tail.isdecimal() else None
    if start is not None and names == [f"{DAY_PREFIX}{start + i}" for i in range(len(names))]:
        return F.concat(F.lit(DAY_PREFIX), (position + start).cast("string"))
    return F.get(F.array(*[F.lit(n) for n in names]), position)


def unpivot_days(wide: DataFrame, partitions: int | None = None, strict: bool = True) -> DataFrame:
    """One row per series and day, NULL cells kept, columns outside the ids and days dropped.

    One array exploded by position avoids an expand over thousands of columns. ``partitions``
    hashes the compact wide rows by series first: the long rows then stay on that partitioning
    through joins and windows on the series, and an unsplittable input file is spread out.
    """
    require_columns(wide, WIDE_IDS, "wide sales")
    days = day_columns(wide)
    if not days:
        raise ValueError(f"wide sales has no column starting with {DAY_PREFIX}")
    if partitions:
        wide = wide.repartition(partitions, *SERIES)
    # One SQL text in place of thousands of Column objects.
    quoted = ", ".join("`" + d.replace("`", "``") + "`" for d in days)
    cells = wide.selectExpr(*WIDE_IDS, f"posexplode(array({quoted})) AS (_at, _units)")
    return cells.select(
        *WIDE_IDS,
        _day_label(days, F.col("_at")).alias("day"),
        narrow_sales("_units", strict).alias("sales"),
    )


def parse_calendar(calendar: DataFrame, strict: bool = True) -> DataFrame:
    return calendar.withColumn("date", parse_day("date", strict))


def broadcast_calendar(calendar: DataFrame, max_rows: int = MAX_CALENDAR_ROWS) -> DataFrame:
    """Broadcast hint behind a count; a larger calendar is left to a shuffled join."""
    small = calendar.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(calendar) if small else calendar


def join_calendar(sales: DataFrame, calendar: DataFrame) -> DataFrame:
    """Left join on the day label; a day the calendar lacks keeps its row with NULLs."""
    require_columns(calendar, ["d", "date", "wm_yr_wk"], "calendar")
    return sales.join(
        broadcast_calendar(calendar), F.col("day") == F.col("d"), "left"
    ).drop("d")


def join_prices(sales: DataFrame, prices: DataFrame, partitions: int | None = None) -> DataFrame:
    """Left join on store, item and week.

    With ``partitions`` equal to the one used in ``unpivot_days``, prices are laid out by series
    as well and the long rows are not shuffled again.
    """
    keys = ["store_id", "item_id", "wm_yr_wk"]
    require_columns(prices, [*keys, "sell_price"], "prices")
    if partitions:
        prices = prices.repartition(partitions, *SERIES)
    return sales.join(prices, keys, "left")


def join_calendar_prices(
    sales: DataFrame, calendar: DataFrame, prices: DataFrame, partitions: int | None = None
) -> DataFrame:
    return join_prices(join_calendar(sales, calendar), prices, partitions)


def row_summary(
    long: DataFrame, joined: DataFrame, calendar: DataFrame, prices: DataFrame
) -> DataFrame:
    """Four row counts; ``joined_rows`` above ``sales_long_rows`` shows duplicate dimension keys."""
    frames = {
        "sales_long_rows": long,
        "joined_rows": joined,
        "calendar_rows": calendar,
        "prices_rows": prices,
    }
    counts = [
        df.select(F.count("*").alias("rows")).select(F.lit(name).alias("name"), "rows")
        for name, df in frames.items()
    ]
    first, *rest = counts
    for part in rest:
        first = first.unionByName(part)
    return first
