"""Registered queries: each builds its frames from the given tables and applies one operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.functions.columns import flag, rounded
from daytally.functions.quantile import exact_quantile
from daytally.functions.series import with_series_windows
from daytally.operators import anomaly, encoders, features, forecast, metrics, models, quality
from daytally.operators import reshape, selection, sequences
from daytally.operators.boosting import TweedieBoosting, tweedie_curvature, tweedie_slope
from daytally.operators.forest import Forest
from daytally.plans import panel as P
from daytally.plans import stages
from daytally.schemas import MODEL_FEATURES, ROW, SERIES, TARGET, WIDE_IDS
from daytally.session import cut_lineage, scratch_path, stored_table
from daytally.sources import files

Query = Callable[[SparkSession, str], DataFrame]

# The library's own settings: 100 unbounded trees, and 1000 rounds of 127 leaves.
FOREST = Forest()
BOOSTING = TweedieBoosting()
HOT_CHUNK = 512


def _featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.feature_table(P.sales_long(spark, sf_dir))


def _subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _featured(spark, sf_dir)
    return selection.store_top_items(rows, P.STATE, P.STORE, P.TOP_ITEMS)


def _split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return selection.split_by_date(df, P.TRAIN_END, P.VAL_START, P.VAL_END)


def _model_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Complete training and validation rows of the subset, stored once for the model jobs."""
    rows = _subset(spark, sf_dir).repartition(spark.sparkContext.defaultParallelism, *ROW)
    train, val = _split(cut_lineage(rows))
    return selection.complete_rows(train), selection.complete_rows(val)


def _stored_series(rows: DataFrame) -> DataFrame:
    """Checkpointed rows, dealt by series among as many tasks as before: AQE would join what its
    compressed size makes look small."""
    stored = cut_lineage(rows)
    return stored.repartition(stored.rdd.getNumPartitions(), *SERIES)


def _naive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.naive_predictions(P.sales_long(spark, sf_dir))


def _validation(df: DataFrame) -> DataFrame:
    return _split(df)[1]


# --- ingest ---


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three raw files written as CSV, read back typed, reshaped and joined."""
    folder = scratch_path(spark, "csv")
    raw = {"sales": P.wide_sales, "calendar": P.calendar, "prices": P.prices}
    at = {name: files.write_csv(build(spark, sf_dir), f"{folder}/{name}") for name, build in raw.items()}
    wide = files.read_sales_csv(spark, at["sales"])
    calendar = reshape.parse_calendar(files.read_calendar_csv(spark, at["calendar"]))
    prices = files.read_prices_csv(spark, at["prices"])
    long = reshape.unpivot_days(wide)
    return rounded(reshape.join_calendar_prices(long, calendar, prices))


def unpivot_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.unpivot_days(P.wide_sales(spark, sf_dir))


def calendar_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.parse_calendar(P.calendar(spark, sf_dir))


def _raw_frames(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    long = P.sales_long(spark, sf_dir).select(*WIDE_IDS, "day", "sales")
    return long, reshape.parse_calendar(P.calendar(spark, sf_dir)), P.prices(spark, sf_dir)


def sales_calendar_price_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reshape.join_calendar_prices(*_raw_frames(spark, sf_dir)))


def ingest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    long, calendar, prices = _raw_frames(spark, sf_dir)
    joined = reshape.join_calendar_prices(long, calendar, prices)
    return reshape.row_summary(long, joined, calendar, prices)


def duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys held by several order lines before they are summed per day."""
    return quality.duplicate_rows(P.sale_lines(spark, sf_dir))


# --- features ---


def _windowed(build) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = P.sales_long(spark, sf_dir).select(*ROW, "sales", "sell_price")
        added = with_series_windows(rows, build, back=max(features.LAGS))
        return rounded(added.select(*ROW, *[c for c in added.columns if c not in rows.columns]))

    return query


def calendar_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.sales_long(spark, sf_dir).select(*ROW)
    return rows.withColumns(features.calendar_columns())


def event_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.sales_long(spark, sf_dir).select(*ROW, "event_name_1", "event_name_2")
    return rows.withColumns(features.event_column())


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_featured(spark, sf_dir))


def feature_table_hot_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table with every series treated as too long for one task."""
    sales_long = stored_table(P.sales_long(spark, sf_dir), "panel")
    hot = sales_long.select(*SERIES).distinct()
    return rounded(features.feature_table(sales_long, hot, HOT_CHUNK))


# --- checks and selection ---


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = quality.Limits(first_date=P.GATE_FIRST, last_date=P.GATE_LAST)
    return quality.quality_report(_featured(spark, sf_dir), limits)


def top_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = selection.one_store(P.sales_long(spark, sf_dir), P.STATE, P.STORE)
    return selection.top_items(rows, P.TOP_ITEMS)


def top_items_by_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = selection.one_store(P.sales_long(spark, sf_dir), P.STATE, P.STORE)
    return selection.top_items(rows, P.TOP_ITEMS, by="volume")


def subset_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _subset(spark, sf_dir).select(*ROW, "sales")


def time_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, val = _split(P.sales_long(spark, sf_dir).select(*ROW, "sales"))
    return train.withColumn("part", F.lit("train")).unionByName(
        val.withColumn("part", F.lit("val"))
    )


def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(selection.complete_rows(_split(_subset(spark, sf_dir))[0]))


# --- metrics on the naive forecast ---


def prediction_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _validation(_featured(spark, sf_dir))
    return selection.prediction_frame(rows, prediction="sales_lag_28")


def mae_naive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.mean_absolute_error(_validation(_naive(spark, sf_dir))))


def _score_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Actual, naive prediction and training rows; training needs both lags but no price."""
    rows = _featured(spark, sf_dir).select(*ROW, "sales", "sell_price", "sales_lag_7", "sales_lag_28")
    train, val = _split(_stored_series(rows))
    pred = val.select(*ROW, F.col("sales_lag_28").cast("double").alias("pred"))
    return val.select(*ROW, "sales", "sell_price"), pred, train.dropna(subset=["sales_lag_7", "sales_lag_28"])


def wrmsse_scales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.series_scales(_score_inputs(spark, sf_dir)[2]))


def wrmsse_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    actual, pred, train = _score_inputs(spark, sf_dir)
    return rounded(metrics.series_rmsse(actual.drop("sell_price"), pred, train))


def wrmsse_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    actual, pred, train = _score_inputs(spark, sf_dir)
    return rounded(metrics.wrmsse(actual.drop("sell_price"), pred, train).select("wrmsse", "matched_rows"))


def wrmsse_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    actual, pred, train = _score_inputs(spark, sf_dir)
    return rounded(metrics.wrmsse(actual, pred, train).select("wrmsse", "matched_rows"))


# --- anomalies on the naive forecast, over the whole history ---


def residual_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(anomaly.residual_features(_naive(spark, sf_dir)))


def zscore_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = anomaly.statistical_flag(anomaly.residual_features(_naive(spark, sf_dir)))
    return rounded(flagged.select(*ROW, "residual", "z_score", "anomaly_stat"))


def contamination_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact quantile that turns scores into flags, here of the residual size."""
    residuals = cut_lineage(anomaly.residual_features(_naive(spark, sf_dir)))
    limit = exact_quantile(residuals, "abs_residual", 1.0 - anomaly.IsolationForest().contamination)
    beyond = F.count_if(F.col("abs_residual") > limit)
    return rounded(residuals.agg(F.lit(limit).alias("cutoff"), beyond.alias("beyond")))


def combined_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both flags combined, the second one from the quantile cutoff of the residual size."""
    flagged = anomaly.statistical_flag(anomaly.residual_features(_naive(spark, sf_dir)))
    flagged = stored_table(flagged.select(*ROW, "abs_residual", "anomaly_stat"), "flags")
    limit = exact_quantile(flagged, "abs_residual", 1.0 - anomaly.IsolationForest().contamination)
    return anomaly.combined_flag(flagged.withColumn("anomaly_iso", flag(F.col("abs_residual") > limit)))


def predictions_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Residual features of predictions that were written as CSV and read back."""
    path = files.write_csv(_naive(spark, sf_dir), scratch_path(spark, "predictions"))
    return rounded(anomaly.residual_features(files.read_predictions_csv(spark, path)))


def isolation_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly.isolation_flag(anomaly.residual_features(_naive(spark, sf_dir)))


def combined_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly.detect(_naive(spark, sf_dir))


# --- models ---


def forest_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, val = _model_rows(spark, sf_dir)
    return models.predict(FOREST.fit(train), val)


def tweedie_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slope and curvature of every training row at the start score, before the first tree."""
    train = _model_rows(spark, sf_dir)[0]
    score = F.log(train.select(F.avg(TARGET)).scalar())
    y = F.col(TARGET).cast("double")
    derived = {"slope": tweedie_slope(y, score), "curvature": tweedie_curvature(y, score)}
    return rounded(train.select(*ROW, TARGET).withColumns(derived))


def tweedie_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, val = _model_rows(spark, sf_dir)
    return models.predict(BOOSTING.fit(train), val)


def _scored(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Training rows, figures of the boosting rounds, and scores of both models."""
    train, val = _model_rows(spark, sf_dir)
    boosted, rounds = BOOSTING.fit_with_rounds(train, val)
    fitted = {models.BOOSTED: boosted, models.FOREST: FOREST.fit(train)}
    predictions = {name: cut_lineage(models.predict(m, val)) for name, m in fitted.items()}
    return train, rounds, models.compare(predictions, train)


def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = cut_lineage(_scored(spark, sf_dir)[2])
    best = models.best_model(scores).select("model", F.lit(True).alias("best"))
    return scores.join(best, "model", "left").withColumn("best", F.coalesce("best", F.lit(False)))


def best_of_naive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of the forecasts by the values 7 and 28 days before, and which is the better one."""
    lags = ["sales_lag_7", "sales_lag_28"]
    train, val = _split(_stored_series(_featured(spark, sf_dir).select(*ROW, "sales", *lags)))
    guesses = {name: selection.prediction_frame(val, prediction=name) for name in lags}
    scores = cut_lineage(models.compare(guesses, train.dropna(subset=lags)))
    best = models.best_model(scores).select("model", F.lit(True).alias("best"))
    scores = scores.join(best, "model", "left").withColumn("best", F.coalesce("best", F.lit(False)))
    return rounded(scores)


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, rounds, scores = _scored(spark, sf_dir)
    rows = scores.collect()
    best = min(rows, key=lambda r: (r["mae"], models.PRIORITY.index(r["model"])))["model"]
    params = {
        "store_id": P.STORE,
        "top_n_items": P.TOP_ITEMS,
        "feature_cols": MODEL_FEATURES,
        "train_end": P.TRAIN_END,
        **models.model_params({models.BOOSTED: BOOSTING, models.FOREST: FOREST}),
        "best_model_by_mae": best,
    }
    values = {"train_rows": train.count(), "n_features": len(MODEL_FEATURES)}
    for row in rows:
        prefix = models.PREFIX[row["model"]]
        values |= {f"{prefix}_val_mae": row["mae"], f"{prefix}_wrmsse": row["wrmsse"]}
    log = models.run_log(spark, "registered", params, values)
    return log.unionByName(models.round_log("registered", models.BOOSTED, rounds))


# --- sequences and forecast ---


def _sequence_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.sequence_frame(_featured(spark, sf_dir))


def sequence_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_sequence_rows(spark, sf_dir))


def price_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = _sequence_rows(spark, sf_dir)
    return rounded(frame.select("series_id", "time_idx", "sell_price", "sell_price_missing"))


def target_scaling(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = sequences.sequence_frame(_featured(spark, sf_dir))
    return rounded(sequences.target_scaling(sequences.before_cutoff(frame)))


def _known_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The whole sequence frame, and its rows before the cutoff."""
    frame = cut_lineage(_sequence_rows(spark, sf_dir))
    return frame, sequences.before_cutoff(frame)


def category_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoders.category_codes(_known_rows(spark, sf_dir)[1])


def real_scalers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(encoders.real_scalers(_known_rows(spark, sf_dir)[1]))


def encoded_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes and scaled values of every row, learned on the rows before the cutoff."""
    frame, known = _known_rows(spark, sf_dir)
    codes = stored_table(encoders.category_codes(known), "codes")
    scalers = stored_table(encoders.real_scalers(known), "scalers")
    encoded = encoders.encode(frame, codes, scalers)
    made = [f"{name}_code" for name in encoders.CATEGORIES]
    made += [f"{name}_scaled" for name in sequences.KNOWN_REALS]
    return rounded(encoded.select("series_id", "time_idx", *made))


def missing_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps of the days with a sale, before the panel is filled."""
    daily = P.daily_units(spark, sf_dir).withColumns(
        {
            "series_id": F.concat(F.col("store_id"), F.lit("_"), F.col("item_id")),
            "time_idx": F.datediff("date", P.first_day(spark, sf_dir)).cast("bigint"),
        }
    )
    return sequences.missing_steps(daily).withColumn("step", F.col("step").cast("bigint"))


def _window_sums(windows: DataFrame) -> DataFrame:
    """Windows described by sizes and integer sums, so that both engines can be compared."""

    def total(values: str) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)

    return windows.select(
        "series_id",
        "encoder_end_idx",
        F.col("encoder_length").cast("bigint").alias("encoder_length"),
        F.size("decoder_time_idx").cast("bigint").alias("decoder_length"),
        F.get("encoder_time_idx", F.lit(0)).alias("first_idx"),
        F.element_at("decoder_time_idx", -1).alias("last_idx"),
        total("encoder_sales").alias("encoder_sales"),
        total("decoder_sales").alias("decoder_sales"),
        F.round(total("encoder_target"), 3).alias("encoder_target"),
        F.round(total("decoder_target"), 3).alias("decoder_target"),
        "target_center",
        "target_scale",
    )


def encoder_decoder_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = stored_table(_sequence_rows(spark, sf_dir).select(*sequences.WINDOW_COLUMNS), "frame")
    frame = P.dealt(spark, sf_dir, frame, sequences.GROUP)
    return rounded(_window_sums(sequences.training_windows(frame)))


def validation_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = cut_lineage(sequences.sequence_frame(_featured(spark, sf_dir)))
    return rounded(_window_sums(sequences.validation_windows(frame)))


def horizon_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model features of the first future day of every series."""
    history = forecast.series_history(P.sales_long(spark, sf_dir))
    return rounded(forecast.step_features(history, 1).select(*ROW, *MODEL_FEATURES))


def _half_model() -> PipelineModel:
    """Half the value a week before, half the mean of the last week."""
    half = "SELECT *, 0.5D * sales_lag_7 + 0.5D * rolling_mean_7 AS prediction FROM __THIS__"
    return PipelineModel([SQLTransformer(statement=half)])


def horizon_recursion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forecast loop with a formula as its model, which reads its own earlier forecasts once
    those are reached."""
    sales_long = P.sales_long(spark, sf_dir)
    return rounded(forecast.horizon_forecast(sales_long, _half_model(), P.HORIZON, cut_every=1))


def requested_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each series over its own horizon, one to four weeks by the number of its days with a sale."""
    weeks = (F.count("*") % P.REQUEST_WEEKS + 1).cast("int")
    requests = P.daily_units(spark, sf_dir).groupBy(*SERIES).agg((weeks * 7).alias("horizon"))
    sales_long = P.sales_long(spark, sf_dir)
    return rounded(forecast.requested_forecast(sales_long, _half_model(), requests, cut_every=1))


def stored_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature table and report written and read back: rows, series, units, and the gate's outcome."""
    store = stages.Store(spark, scratch_path(spark, "stored"))
    rows = store.write_panel(_featured(spark, sf_dir), "feature_table", 0)
    limits = quality.Limits(first_date=P.GATE_FIRST, last_date=P.GATE_LAST)
    report = store.write(quality.quality_report(rows, limits), "quality_report")
    counts = rows.agg(
        F.count("*").alias("rows"),
        F.count_distinct(*SERIES).alias("series"),
        F.sum("sales").alias("units"),
    )
    return counts.withColumn("gate", report.select(F.every("passed")).scalar())


def horizon_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales_long = cut_lineage(P.sales_long(spark, sf_dir))
    train, _ = _split(features.feature_table(sales_long))
    model = FOREST.fit(selection.complete_rows(selection.one_store(train, P.STATE, P.STORE)))
    return forecast.horizon_forecast(sales_long, model, P.HORIZON)


QUERIES: dict[str, Query] = {
    "csv_roundtrip": csv_roundtrip,
    "unpivot_sales": unpivot_sales,
    "calendar_dates": calendar_dates,
    "sales_calendar_price_join": sales_calendar_price_join,
    "ingest_summary": ingest_summary,
    "duplicate_rows": duplicate_rows,
    "lag_features": _windowed(features.lag_columns),
    "rolling_means": _windowed(features.rolling_mean_columns),
    "rolling_std": _windowed(features.rolling_std_column),
    "price_ratio": _windowed(features.price_ratio_column),
    "calendar_parts": calendar_parts,
    "event_flag": event_flag,
    "feature_table": feature_table,
    "feature_table_hot_series": feature_table_hot_series,
    "quality_report": quality_report,
    "top_items": top_items,
    "top_items_by_volume": top_items_by_volume,
    "subset_rows": subset_rows,
    "time_split": time_split,
    "training_rows": training_rows,
    "prediction_frame": prediction_frame,
    "mae_naive": mae_naive,
    "wrmsse_scales": wrmsse_scales,
    "wrmsse_series": wrmsse_series,
    "wrmsse_units": wrmsse_units,
    "wrmsse_revenue": wrmsse_revenue,
    "residual_features": residual_features,
    "zscore_anomalies": zscore_anomalies,
    "contamination_cutoff": contamination_cutoff,
    "combined_flags": combined_flags,
    "predictions_csv": predictions_csv,
    "isolation_anomalies": isolation_anomalies,
    "combined_anomalies": combined_anomalies,
    "forest_predictions": forest_predictions,
    "tweedie_step": tweedie_step,
    "tweedie_predictions": tweedie_predictions,
    "best_of_naive": best_of_naive,
    "model_comparison": model_comparison,
    "run_log": run_log,
    "sequence_frame": sequence_frame,
    "price_fill": price_fill,
    "target_scaling": target_scaling,
    "category_codes": category_codes,
    "real_scalers": real_scalers,
    "encoded_frame": encoded_frame,
    "missing_steps": missing_steps,
    "encoder_decoder_windows": encoder_decoder_windows,
    "validation_windows": validation_windows,
    "horizon_features": horizon_features,
    "horizon_recursion": horizon_recursion,
    "requested_forecasts": requested_forecasts,
    "stored_tables": stored_tables,
    "horizon_forecast": horizon_forecast,
}
