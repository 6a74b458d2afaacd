"""Row windows over daily series.

A series holds at most one row per date once ``quality.duplicate_rows`` is empty, so its size is
bounded by the number of days. A series with more rows than one task should take is "hot": its
rows are numbered, cut into chunks of ``chunk`` rows, and each chunk also receives the few rows
before and after it that its frames can reach. The result is exact and no task sees the series.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from daytally.schemas import SERIES
from daytally.session import cut_lineage

MAX_SERIES_ROWS = 200_000
# Keys of about 100 bytes each.
MAX_HOT_SERIES = 500_000
CHUNK_ROWS = 50_000
# Rows of one task, about, where rows are dealt by their number.
TASK_ROWS = 250_000

BuildColumns = Callable[[WindowSpec], dict[str, Column]]


def by_day(keys: list[str] = SERIES, order: str = "date") -> WindowSpec:
    """Rows without a date come last, as in the SQL dialect the results have to match."""
    return Window.partitionBy(*keys).orderBy(F.col(order).asc_nulls_last())


def month_of(order: str) -> Column:
    return F.coalesce(F.trunc(order, "MM"), F.lit("9999-12-01").cast("date"))


def hot_series(
    df: DataFrame, keys: list[str] = SERIES, max_rows: int = MAX_SERIES_ROWS
) -> DataFrame | None:
    """Keys of series above ``max_rows``, or None when there are none.

    One pre-aggregated job over the key columns; run it on a stored table.
    """
    hot = cut_lineage(df.groupBy(*keys).count().filter(F.col("count") > max_rows).select(*keys))
    return None if hot.isEmpty() else hot


def split_hot(df: DataFrame, hot: DataFrame, keys: list[str] = SERIES) -> tuple[DataFrame, DataFrame]:
    """Rows of ordinary series and rows of hot series.

    The key list is broadcast only after its length is checked; a longer one goes through a
    shuffled join.
    """
    hot = hot.select(*keys).distinct()
    if hot.limit(MAX_HOT_SERIES + 1).count() <= MAX_HOT_SERIES:
        hot = F.broadcast(hot)
    return df.join(hot, keys, "left_anti"), df.join(hot, keys, "left_semi")


def with_series_windows(
    df: DataFrame,
    build: BuildColumns,
    back: int,
    ahead: int = 0,
    keys: list[str] = SERIES,
    order: str = "date",
    hot: DataFrame | None = None,
    chunk: int = CHUNK_ROWS,
) -> DataFrame:
    """Add ``build(window)`` columns whose frames reach ``back`` rows back and ``ahead`` ahead.

    All columns share one window spec, so the plan has one exchange and one sort.
    """
    if hot is None:
        return df.withColumns(build(by_day(keys, order)))
    cold_rows, hot_rows = split_hot(df, hot, keys)
    cold = cold_rows.withColumns(build(by_day(keys, order)))
    return cold.unionByName(_chunked(hot_rows, build, back, ahead, keys, order, chunk))


def _chunked(
    df: DataFrame,
    build: BuildColumns,
    back: int,
    ahead: int,
    keys: list[str],
    order: str,
    chunk: int,
) -> DataFrame:
    if chunk < max(back, ahead):
        raise ValueError(f"chunk of {chunk} rows is shorter than a frame of {max(back, ahead)}")
    tasks = -(-df.count() // TASK_ROWS)

    def dealt(rows: DataFrame, *by: str) -> DataFrame:
        """Left to AQE while the usual partitions are enough; larger ones would be sorted on disk."""
        usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return rows.repartition(tasks, *by) if tasks > usual else rows

    own = F.floor(F.col("_row") / chunk)
    reach = F.array_distinct(
        F.array(own, F.floor((F.col("_row") + back) / chunk), F.floor((F.col("_row") - ahead) / chunk))
    )
    copies = number_rows(df, keys, order, lambda rows: dealt(rows, *keys, "_month")).select(
        "*", own.alias("_own"), F.explode(reach).alias("_chunk")
    )
    spec = by_day([*keys, "_chunk"], "_row")
    return dealt(copies, *keys, "_chunk").withColumns(build(spec)).filter("_own = _chunk").drop("_row", "_own", "_chunk")


def number_rows(
    df: DataFrame, keys: list[str], order: str, deal: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> DataFrame:
    """Add ``_row``, the 0-based position in the series, without sorting a whole series.

    Rows are counted per month; running sums of these counts place each month, and rows are
    numbered inside their month only. ``deal`` may spread the rows by ``keys`` and ``_month``.
    """
    month = df.withColumn("_month", month_of(order))
    before = Window.partitionBy(*keys).orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        month.groupBy(*keys, "_month")
        .count()
        .select(*keys, "_month", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    )
    place = F.row_number().over(by_day([*keys, "_month"], order))
    return (
        deal(month)
        .join(starts, [*keys, "_month"])
        .withColumn("_row", F.col("_start") + place - 1)
        .drop("_month", "_start")
        .select(*df.columns, "_row")
    )


def fill_both_ways(
    df: DataFrame,
    column: str,
    keys: list[str] = SERIES,
    order: str = "date",
    hot: DataFrame | None = None,
) -> DataFrame:
    """Last known value per series, then the first later one; all-NULL series stay NULL."""
    if hot is None:
        return df.withColumn(column, _filled(column, by_day(keys, order)))
    cold_rows, hot_rows = split_hot(df, hot, keys)
    cold = cold_rows.withColumn(column, _filled(column, by_day(keys, order)))
    return cold.unionByName(_filled_by_month(hot_rows, column, keys, order))


# Without an earlier value, the next one is the first of the whole series. A frame that starts at
# the current row would find the same and be read anew for every row.
def _filled(column: str, spec: WindowSpec) -> Column:
    last = F.last(column, ignorenulls=True).over(spec.rowsBetween(Window.unboundedPreceding, 0))
    first = F.first(column, ignorenulls=True).over(_whole(spec))
    return F.coalesce(last, first)


def _whole(spec: WindowSpec) -> WindowSpec:
    return spec.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def _filled_by_month(df: DataFrame, column: str, keys: list[str], order: str) -> DataFrame:
    """Fill inside each month, then from the months before, then from the first known month."""
    month = df.withColumn("_month", month_of(order))
    known = F.when(F.col(column).isNotNull(), F.coalesce(F.col(order), F.col("_month")))
    spec = Window.partitionBy(*keys).orderBy("_month")
    past = F.last("_last", ignorenulls=True).over(spec.rowsBetween(Window.unboundedPreceding, -1))
    carried = (
        month.groupBy(*keys, "_month")
        .agg(F.max_by(column, known).alias("_last"), F.min_by(column, known).alias("_first"))
        .withColumns(
            {"_past": past, "_start": F.first("_first", ignorenulls=True).over(_whole(spec))}
        )
        .drop("_last", "_first")
    )
    inner = by_day([*keys, "_month"], order)
    last = F.last(column, ignorenulls=True).over(inner.rowsBetween(Window.unboundedPreceding, 0))
    return (
        month.join(carried, [*keys, "_month"])
        .withColumn(column, F.coalesce(last, F.col("_past"), F.col("_start")))
        .select(*df.columns)
    )
