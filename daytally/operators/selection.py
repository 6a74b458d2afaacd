"""Training subset: store filter, top items, date split, complete rows, prediction frame."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daytally.schemas import MODEL_FEATURES, ROW, TARGET, require_columns

# The defaults of the retail subset and its validation window.
STATE = "CA"
STORE = "CA_1"
TOP_N = 100
TRAIN_END = "2016-03-27"
VAL_START = "2016-03-28"
VAL_END = "2016-04-24"

# Top lists up to this length are broadcast.
MAX_BROADCAST_ITEMS = 100_000


def one_store(df: DataFrame, state: str = STATE, store: str = STORE) -> DataFrame:
    """Plain conjunction on stored columns, so it reaches the scan and prunes partitions."""
    return df.filter((F.col("state_id") == state) & (F.col("store_id") == store))


def top_items(df: DataFrame, k: int = TOP_N, by: str = "rows") -> DataFrame:
    """The ``k`` items with most rows (or most units); equal counts are ordered by item."""
    measures = {"rows": F.count("*"), "volume": F.sum("sales")}
    if by not in measures:
        raise ValueError(f"by must be one of {sorted(measures)}")
    counted = df.groupBy("item_id").agg(measures[by].alias("cnt"))
    return counted.orderBy(F.desc("cnt"), "item_id").limit(k)


def keep_items(df: DataFrame, items: DataFrame, k: int = TOP_N) -> DataFrame:
    """Rows of the listed items; a list of at most ``k`` known rows may be broadcast."""
    listed = items.select("item_id")
    return df.join(F.broadcast(listed) if k <= MAX_BROADCAST_ITEMS else listed, "item_id", "left_semi")


def store_top_items(
    df: DataFrame, state: str = STATE, store: str = STORE, k: int = TOP_N, by: str = "rows"
) -> DataFrame:
    rows = one_store(df, state, store)
    return keep_items(rows, top_items(rows, k, by), k)


def _day(value: str | date) -> Column:
    return F.lit(value).cast("date")


def split_by_date(
    df: DataFrame,
    train_end: str | date = TRAIN_END,
    val_start: str | date = VAL_START,
    val_end: str | date = VAL_END,
) -> tuple[DataFrame, DataFrame]:
    """Rows up to ``train_end`` and rows of the validation window; all others are in neither."""
    day = F.col("date")
    return (
        df.filter(day <= _day(train_end)),
        df.filter((day >= _day(val_start)) & (day <= _day(val_end))),
    )


def complete_rows(
    df: DataFrame, features: list[str] = MODEL_FEATURES, target: str = TARGET
) -> DataFrame:
    """Keys, features and target of the rows where none of the latter is missing."""
    require_columns(df, [*ROW, *features, target], "feature table")
    return df.dropna(subset=[*features, target]).select(*ROW, *features, target)


def prediction_frame(scored: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Keys with actual and predicted, taken from the scored rows themselves."""
    return scored.select(
        *ROW, F.col(TARGET).alias("actual"), F.col(prediction).cast("double").alias("predicted")
    )
