"""MAE and the weighted scaled error of one level of daily series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, WindowSpec
from pyspark.sql import functions as F

from daytally.functions.series import with_series_windows
from daytally.schemas import ROW, SERIES, require_columns

# Fixed value: scale of a series that never changes.
SCALE_FLOOR = 1e-8


def mean_absolute_error(
    df: DataFrame, actual: str = "actual", predicted: str = "predicted"
) -> DataFrame:
    return df.agg(F.avg(F.abs(F.col(actual) - F.col(predicted))).alias("mae"))


def series_scales(train: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Mean squared day-to-day change per series, in double to avoid integer overflow."""
    require_columns(train, [*ROW, "sales"], "train")
    sales = F.col("sales").cast("double")

    def change(w: WindowSpec) -> dict[str, Column]:
        return {"_change": sales - F.lag(sales, 1).over(w)}

    steps = with_series_windows(train.select(*ROW, "sales"), change, back=1, hot=hot)
    scale = F.avg(F.col("_change") * F.col("_change"))
    floored = F.when(scale > 0, scale).otherwise(F.lit(SCALE_FLOOR))
    return steps.groupBy(*SERIES).agg(floored.alias("scale"))


def series_errors(actual: DataFrame, pred: DataFrame) -> DataFrame:
    """Mean squared error per series over matching rows, with their number."""
    require_columns(actual, [*ROW, "sales"], "actual")
    require_columns(pred, [*ROW, "pred"], "pred")
    error = F.col("sales").cast("double") - F.col("pred")
    return (
        actual.select(*ROW, "sales")
        .join(pred.select(*ROW, "pred"), ROW)
        .groupBy(*SERIES)
        .agg(F.avg(error * error).alias("mse"), F.count("*").alias("matched"))
    )


def raw_weights(actual: DataFrame) -> DataFrame:
    """Revenue per series when prices are given, else units, over all actual rows."""
    require_columns(actual, [*ROW, "sales"], "actual")
    units = F.col("sales").cast("double")
    amount = units * F.col("sell_price") if "sell_price" in actual.columns else units
    total = F.coalesce(F.sum(amount), F.lit(0.0))
    return actual.groupBy(*SERIES).agg(total.alias("raw_weight"))


def series_weights(actual: DataFrame) -> DataFrame:
    """Share of each series; the total is a scalar subquery, not a one-task window."""
    raw = raw_weights(actual)
    total = raw.select(F.sum("raw_weight")).scalar()
    return raw.withColumn("weight", F.col("raw_weight") / F.nullif(total, F.lit(0.0)))


def series_rmsse(
    actual: DataFrame, pred: DataFrame, train: DataFrame, hot: DataFrame | None = None
) -> DataFrame:
    """Per series: mse, scale, rmsse and weight, for the series known to all three inputs."""
    return (
        series_errors(actual, pred)
        .join(series_scales(train, hot), SERIES)
        .join(series_weights(actual), SERIES)
        .withColumn("rmsse", F.sqrt(F.col("mse") / F.col("scale")))
        .select(*SERIES, "mse", "scale", "raw_weight", "weight", "rmsse")
    )


def wrmsse(
    actual: DataFrame, pred: DataFrame, train: DataFrame, hot: DataFrame | None = None
) -> DataFrame:
    """One row: score, matched rows over all series, and total raw weight.

    Weights of series without a score stay in the total, so they are lost, not shared out. One
    aggregate over the per-series table gives both sums.
    """
    per_series = (
        raw_weights(actual)
        .join(series_errors(actual, pred), SERIES, "left")
        .join(series_scales(train, hot), SERIES, "left")
    )
    rmsse = F.sqrt(F.col("mse") / F.col("scale"))
    totals = per_series.agg(
        F.coalesce(F.sum(F.col("raw_weight") * rmsse), F.lit(0.0)).alias("_weighted"),
        F.sum("raw_weight").alias("total_weight"),
        F.coalesce(F.sum("matched"), F.lit(0)).alias("matched_rows"),
    )
    score = F.col("_weighted") / F.nullif(F.col("total_weight"), F.lit(0.0))
    return totals.select(score.alias("wrmsse"), "matched_rows", "total_weight")


def require_score(row: Row) -> None:
    """No matching row and no weight are errors, not a score of zero."""
    if not row["matched_rows"]:
        raise ValueError(f"actual and pred share no row on {ROW}")
    if not row["total_weight"] or row["total_weight"] <= 0:
        raise ValueError("the total weight of all series is not positive")


def wrmsse_score(
    actual: DataFrame, pred: DataFrame, train: DataFrame, hot: DataFrame | None = None
) -> float:
    """The score as a number."""
    row = wrmsse(actual, pred, train, hot).first()
    require_score(row)
    return float(row["wrmsse"])
