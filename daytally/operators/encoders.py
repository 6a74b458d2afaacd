"""Codes of text categories and scales of real columns, learned once and applied to later rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daytally.operators.sequences import KNOWN_CATEGORIES, KNOWN_REALS, STATIC

CATEGORIES = [*STATIC, *KNOWN_CATEGORIES]
# Code of a value that training did not hold, and of a missing one.
UNSEEN = 0


def category_codes(train: DataFrame, names: list[str] = CATEGORIES) -> DataFrame:
    """Dictionary ``(name, value, code)``: per column the distinct texts in order, coded from 1.

    All columns share one pass. Rows become distinct before the shuffle, so what is ordered is one row
    per distinct value, never the table.
    """
    entries = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in names]))
    values = train.select(entries.alias("e")).select("e.name", "e.value").filter("value IS NOT NULL").distinct()
    ordered = Window.partitionBy("name").orderBy("value")
    return values.withColumn("code", F.row_number().over(ordered).cast("bigint"))


def real_scalers(train: DataFrame, names: list[str] = KNOWN_REALS) -> DataFrame:
    """Rows ``(name, center, scale)`` from one aggregate: mean and population deviation.

    NULLs count for nothing. A constant column gets scale 1, one without any value NULLs.
    """

    def fitted(name: str) -> Column:
        spread = F.stddev_pop(name)
        scale = F.when(spread == 0.0, F.lit(1.0)).otherwise(spread)
        return F.struct(F.lit(name).alias("name"), F.avg(name).alias("center"), scale.alias("scale"))

    rows = train.agg(F.array(*[fitted(n) for n in names]).alias("rows"))
    return rows.select(F.explode("rows").alias("r")).select("r.name", "r.center", "r.scale")


def encode(
    frame: DataFrame,
    codes: DataFrame,
    scalers: DataFrame,
    names: list[str] = CATEGORIES,
    reals: list[str] = KNOWN_REALS,
) -> DataFrame:
    """``frame`` with ``<name>_code`` and ``<name>_scaled``; values training did not hold get code 0.

    Hand in stored dictionaries: each column's part is joined by its own size, so a short one is
    broadcast and a long one (items) is shuffled.
    """
    for name in names:
        part = codes.filter(F.col("name") == name).select(
            F.col("value").alias(name), F.col("code").alias(f"{name}_code")
        )
        frame = frame.join(part, name, "left")
    known = {f"{n}_code": F.coalesce(f"{n}_code", F.lit(UNSEEN).cast("bigint")) for n in names}

    def scaled(name: str) -> Column:
        one = scalers.filter(F.col("name") == name)
        return (F.col(name) - one.select("center").scalar()) / one.select("scale").scalar()

    return frame.withColumns(known | {f"{n}_scaled": scaled(n) for n in reals})
