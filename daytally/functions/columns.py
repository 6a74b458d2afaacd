"""Scalar column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daytally.schemas import DATE_FORMAT


def parse_day(text: Column | str, strict: bool = True) -> Column:
    """Date from ``yyyy-MM-dd`` text; the strict form fails the job on bad text."""
    parse = F.to_date if strict else F.try_to_date
    return parse(text, DATE_FORMAT)


def narrow_sales(units: Column | str, strict: bool = True) -> Column:
    """Units as SMALLINT; the strict form fails the job on overflow."""
    units = F.col(units) if isinstance(units, str) else units
    return units.cast("smallint") if strict else units.try_cast("smallint")


def weekday_number(day: Column | str) -> Column:
    """Sunday is 0, Saturday is 6."""
    return (F.dayofweek(day) - 1).cast("bigint")


def flag(condition: Column) -> Column:
    """1 when the condition is true, 0 when it is false or NULL."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def at_least(value: Column | str, floor: float) -> Column:
    """Lower bound that leaves NULL as NULL (``greatest`` would replace it)."""
    value = F.col(value) if isinstance(value, str) else value
    return F.when(value < floor, F.lit(floor)).otherwise(value)


def ratio(value: Column, base: Column) -> Column:
    """``value / base``, NULL for a zero or missing base."""
    return value / F.nullif(base, F.lit(0.0))


def rounded(df: DataFrame, digits: int = 6, exact: tuple[str, ...] = ("sell_price",)) -> DataFrame:
    """Round double columns for comparison between engines.

    Columns in ``exact`` are single divisions of whole numbers, equal in both engines to the bit;
    rounding those could only differ, at a tie.
    """
    doubles = [n for n, kind in df.dtypes if kind == "double" and n not in exact]
    return df.withColumns({name: F.round(name, digits) for name in doubles})
