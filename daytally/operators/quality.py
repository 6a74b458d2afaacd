"""Feature-table checks in one aggregate pass, the report, and the gate."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daytally.schemas import ROW, missing_columns

# Check names and limits.
REQUIRED = [
    "item_id",
    "store_id",
    "date",
    "sales",
    "sell_price",
    "sales_lag_7",
    "sales_lag_28",
    "rolling_mean_7",
    "day_of_week",
]
MIN_ROWS = 100000
MAX_SALES = 1000
FIRST_DATE = "2011-01-01"
LAST_DATE = "2016-06-30"


@dataclass(frozen=True)
class Limits:
    min_rows: int = MIN_ROWS
    max_sales: int = MAX_SALES
    first_date: str = FIRST_DATE
    last_date: str = LAST_DATE

    def __post_init__(self) -> None:
        if date.fromisoformat(self.first_date) > date.fromisoformat(self.last_date):
            raise ValueError("first_date is after last_date")


@dataclass(frozen=True)
class Check:
    """A named predicate over aggregates and the columns it needs."""

    name: str
    needs: tuple[str, ...]
    holds: Column


def table_checks(limits: Limits) -> list[Check]:
    def none(condition: Column) -> Column:
        return F.count_if(condition) == 0

    def within(name: str, low: Column, high: Column) -> Column:
        return (F.min(name) >= low) & (F.max(name) <= high)

    return [
        *(Check(f"{key}_no_nulls", (key,), none(F.col(key).isNull())) for key in ROW),
        Check(
            f"sales_between_0_and_{limits.max_sales}",
            ("sales",),
            within("sales", F.lit(0), F.lit(limits.max_sales)),
        ),
        Check("sell_price_non_negative", ("sell_price",), none(F.col("sell_price") < 0)),
        Check(
            "lag_features_have_nulls_for_early_rows",
            ("sales_lag_7",),
            F.count_if(F.col("sales_lag_7").isNull()) > 0,
        ),
        Check(
            "date_range_reasonable",
            ("date",),
            within(
                "date",
                F.lit(limits.first_date).cast("date"),
                F.lit(limits.last_date).cast("date"),
            ),
        ),
    ]


def quality_report(features: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Rows ``(name, passed, detail)``, one scan in all.

    A check whose columns are absent fails instead of raising; an aggregate over no rows is NULL
    and fails too.
    """
    missing = missing_columns(features, REQUIRED)
    have = set(features.columns)
    rows = Check(f"row_count >= {limits.min_rows}", (), F.count("*") >= limits.min_rows)
    checks = [rows, *table_checks(limits)]

    def verdict(check: Check) -> Column:
        return check.holds if have.issuperset(check.needs) else F.lit(False)

    totals = features.agg(*[verdict(c).alias(f"c{i}") for i, c in enumerate(checks)])

    def entry(name: str, passed: Column, detail: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), passed.alias("passed"), detail.alias("detail"))

    def outcome(i: int) -> tuple[Column, Column]:
        held = F.col(f"c{i}")
        text = F.when(held.isNull(), "None").when(held, "True").otherwise("False")
        return F.coalesce(held, F.lit(False)), text

    entries = [entry(c.name, *outcome(i)) for i, c in enumerate(checks)]
    detail = f"missing: {missing}" if missing else str(REQUIRED)
    entries.insert(1, entry("required_columns_exist", F.lit(not missing), F.lit(detail)))
    return totals.select(F.inline(F.array(*entries)))


def enforce(report: DataFrame) -> DataFrame:
    """Raise with the names of the failed checks; the report has a fixed number of rows."""
    failed = [row["name"] for row in report.filter(~F.col("passed")).collect()]
    if failed:
        raise ValueError(f"checks failed: {failed}")
    return report


def duplicate_rows(sales: DataFrame, keys: list[str] = ROW) -> DataFrame:
    """Keys (item, store, date) held by more than one row; windows need this to be empty."""
    return sales.groupBy(*keys).count().filter("count > 1")


def require_unique_rows(sales: DataFrame, keys: list[str] = ROW) -> None:
    example = duplicate_rows(sales, keys).take(1)
    if example:
        raise ValueError(f"several rows for {example[0].asDict()}")
