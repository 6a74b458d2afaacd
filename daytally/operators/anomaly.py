"""Residual features and the statistical, isolation and combined anomaly flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from daytally.functions.columns import at_least, flag
from daytally.functions.series import with_series_windows
from daytally.operators.isolation import IsolationForest
from daytally.schemas import ROW, require_columns

# Fixed values of the residual statistics.
Z_THRESHOLD = 3.0
DIVISOR_FLOOR = 0.1
RESIDUAL_WINDOW = 7
RESIDUAL_FEATURES = [
    "residual",
    "abs_residual",
    "residual_pct",
    "residual_rolling_mean",
    "residual_rolling_std",
]


def residual_features(predictions: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Residual, its size and share, and mean and deviation of the seven rows before."""
    require_columns(predictions, [*ROW, "actual", "predicted"], "predictions")
    residual = F.col("actual").cast("double") - F.col("predicted")
    rows = predictions.withColumn("residual", residual).withColumns(
        {
            "abs_residual": F.abs("residual"),
            "residual_pct": F.col("residual") / at_least("predicted", DIVISOR_FLOOR),
        }
    )

    def rolling(w: WindowSpec) -> dict[str, Column]:
        frame = w.rowsBetween(-RESIDUAL_WINDOW, -1)
        return {
            "residual_rolling_mean": F.avg("residual").over(frame),
            "residual_rolling_std": F.stddev_samp("residual").over(frame),
        }

    return with_series_windows(rows, rolling, back=RESIDUAL_WINDOW, hot=hot)


def statistical_flag(residuals: DataFrame, threshold: float = Z_THRESHOLD) -> DataFrame:
    """Residual size over recent deviation; without a deviation there is no flag."""
    z = F.col("abs_residual") / at_least("residual_rolling_std", DIVISOR_FLOOR)
    return residuals.withColumn("z_score", z).withColumn(
        "anomaly_stat", flag(F.col("z_score") > threshold)
    )


def isolation_flag(residuals: DataFrame, forest: IsolationForest = IsolationForest()) -> DataFrame:
    """Fit and flag on the same rows; missing features count as zero."""
    return forest.fit_flag(residuals, RESIDUAL_FEATURES, key=ROW, flag="anomaly_iso")


def combined_flag(df: DataFrame) -> DataFrame:
    either = (F.col("anomaly_stat") == 1) | (F.col("anomaly_iso") == 1)
    return df.withColumn("is_anomaly", flag(either))


def detect(
    predictions: DataFrame,
    threshold: float = Z_THRESHOLD,
    forest: IsolationForest = IsolationForest(),
    hot: DataFrame | None = None,
) -> DataFrame:
    flagged = statistical_flag(residual_features(predictions, hot), threshold)
    return combined_flag(isolation_flag(flagged, forest))
