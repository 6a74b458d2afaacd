"""Ingest, features, checks, training, anomalies, sequences, forecast: stages over stored tables."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.functions.series import MAX_SERIES_ROWS, hot_series
from daytally.operators import encoders, models, quality, reshape, selection, sequences
from daytally.operators.anomaly import Z_THRESHOLD, detect
from daytally.operators.boosting import TweedieBoosting
from daytally.operators.features import feature_table
from daytally.operators.forest import Forest
from daytally.operators.forecast import horizon_forecast, requested_forecast
from daytally.operators.isolation import IsolationForest
from daytally.operators.models import BOOSTED, FOREST
from daytally.schemas import MODEL_FEATURES, PASS_THROUGH, SERIES, TARGET
from daytally.sources import files

LAYOUT = ["state_id"]
# Rows of one bucket at most, so that a task's share of a panel stays the same at every size.
BUCKET_ROWS = 4_000_000


@dataclass(frozen=True)
class RawFiles:
    sales: str
    calendar: str
    prices: str


@dataclass(frozen=True)
class Settings:
    """Everything a run may change; the defaults are the retail constants."""

    state: str = selection.STATE
    store: str = selection.STORE
    top_n: int = selection.TOP_N
    train_end: str = selection.TRAIN_END
    val_start: str = selection.VAL_START
    val_end: str = selection.VAL_END
    limits: quality.Limits = quality.Limits()
    forest: Forest = Forest()
    boosting: TweedieBoosting = TweedieBoosting()
    isolation: IsolationForest = IsolationForest()
    z_threshold: float = Z_THRESHOLD
    encoder: int = sequences.ENCODER
    horizon: int = sequences.HORIZON
    stride: int = 1
    max_series_rows: int = MAX_SERIES_ROWS


@dataclass(frozen=True)
class Store:
    """Stored tables below one folder on shared storage.

    Panel tables are kept whole per series. With a catalog ``schema`` they are bucketed by series,
    so no later stage shuffles them; without one they are plain files, foldered by state.
    """

    spark: SparkSession
    root: str
    schema: str | None = None
    partitions: int | None = None

    def buckets(self, rows: int) -> int:
        """Buckets of a panel: the shuffle partitions, or more where the rows need them."""
        least = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return self.partitions or max(least, -(-rows // BUCKET_ROWS))

    def at(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        files.write_table(df, self.at(name))
        return self.read(name)

    def read(self, name: str) -> DataFrame:
        return files.read_table(self.spark, self.at(name))

    def write_panel(self, df: DataFrame, name: str, rows: int) -> DataFrame:
        if self.schema:
            files.write_bucketed(df, f"{self.schema}.{name}", self.at(name), self.buckets(rows))
        else:
            files.write_table(df, self.at(name), LAYOUT)
        return self.read_panel(name)

    def read_panel(self, name: str) -> DataFrame:
        if self.schema:
            return files.read_bucketed(self.spark, f"{self.schema}.{name}", self.at(name))
        return self.read(name)


@dataclass
class Outcome:
    row_counts: dict[str, int] = field(default_factory=dict)
    best_model: str = ""
    predictions: str = ""
    anomalies: str = ""


def require_unique_inputs(wide: DataFrame, calendar: DataFrame, prices: DataFrame) -> None:
    """Raise when the joined rows would hold a series' day twice, before any of them is written.

    That follows from the keys of the three inputs, all much smaller than the joined rows. A day
    without a date is let through once, as two such days could not be told apart.
    """
    quality.require_unique_rows(wide, SERIES)
    quality.require_unique_rows(calendar, ["d"])
    quality.require_unique_rows(calendar.filter("date IS NOT NULL"), ["date"])
    quality.require_unique_rows(prices, ["store_id", "item_id", "wm_yr_wk"])
    names = reshape.day_columns(wide)
    dated = calendar.filter(F.col("d").isin(names) & F.col("date").isNotNull()).count()
    if len(names) - dated > 1:
        raise ValueError(f"several rows without a date: the calendar has {dated} of {len(names)} days")


def ingest(store: Store, raw: RawFiles) -> dict[str, int]:
    """CSV files to three tables; counts come from the stored tables and one count of the input.

    The compact wide rows and the prices are hashed by series once; the long rows, a thousand
    times as many, are never shuffled. Nothing is cached between runs, so changed files are
    always read.
    """
    spark = store.spark
    wide = files.read_sales_csv(spark, raw.sales)
    rows = wide.count() * len(reshape.day_columns(wide))
    n = store.buckets(rows)
    calendar = reshape.parse_calendar(files.read_calendar_csv(spark, raw.calendar))
    calendar = store.write(calendar, "calendar")
    prices = store.write(files.read_prices_csv(spark, raw.prices), "prices")
    require_unique_inputs(wide, calendar, prices)
    long = reshape.unpivot_days(wide, n)
    joined = store.write_panel(reshape.join_calendar_prices(long, calendar, prices, n), "sales_long", rows)
    return {
        "sales_long_rows": rows,
        "joined_rows": joined.count(),
        "calendar_rows": calendar.count(),
        "prices_rows": prices.count(),
    }


def build_features(store: Store, settings: Settings) -> DataFrame:
    sales_long = store.read_panel("sales_long").select(*PASS_THROUGH)
    hot = hot_series(sales_long, max_rows=settings.max_series_rows)
    return store.write_panel(feature_table(sales_long, hot), "feature_table", sales_long.count())


def check_features(store: Store, settings: Settings) -> DataFrame:
    """Report of all checks; a failed one stops the run."""
    report = quality.quality_report(store.read_panel("feature_table"), settings.limits)
    return quality.enforce(store.write(report, "quality_report"))


def train(store: Store, settings: Settings) -> str:
    """Fit both models on the subset, keep the better one, store its validation predictions."""
    features = store.read_panel("feature_table")
    subset = selection.store_top_items(features, settings.state, settings.store, settings.top_n)
    train_part, val_part = selection.split_by_date(
        subset, settings.train_end, settings.val_start, settings.val_end
    )
    train_rows = store.write(selection.complete_rows(train_part), "train_rows")
    val_rows = store.write(selection.complete_rows(val_part), "val_rows")

    learners = {BOOSTED: settings.boosting, FOREST: settings.forest}
    boosted, rounds = settings.boosting.fit_with_rounds(train_rows, val_rows)
    fitted = {BOOSTED: boosted, FOREST: settings.forest.fit(train_rows)}
    scored = {
        name: store.write(models.predict(model, val_rows), f"predictions_{name}")
        for name, model in fitted.items()
    }
    hot = hot_series(train_rows, max_rows=settings.max_series_rows)
    scores = store.write(models.compare(scored, train_rows, hot), "scores")
    best = models.best_model(scores).first()["model"]

    examples = train_rows.select(*MODEL_FEATURES)
    models.keep_model(fitted[FOREST], store.at("models/forest"), examples)
    models.keep_model(fitted[best], store.at("models/best"), examples)
    if best == BOOSTED:
        models.keep_model(fitted[best], store.at("models/registered"), examples)
    predictions = store.write(scored[best], "val_predictions")
    files.write_csv(predictions, store.at("val_predictions_csv"))

    params = {
        "state_id": settings.state,
        "store_id": settings.store,
        "top_n_items": settings.top_n,
        "feature_path": store.at("feature_table"),
        "target_col": TARGET,
        "feature_cols": MODEL_FEATURES,
        "train_end": settings.train_end,
        "val_start": settings.val_start,
        "val_end": settings.val_end,
        **models.model_params(learners),
        "best_model_by_mae": best,
    }
    metrics = {
        "train_rows": train_rows.count(),
        "val_rows": val_rows.count(),
        "n_features": len(MODEL_FEATURES),
    }
    for row in scores.collect():
        prefix = models.PREFIX[row["model"]]
        metrics |= {f"{prefix}_val_mae": row["mae"], f"{prefix}_wrmsse": row["wrmsse"]}
    run_id = uuid.uuid4().hex
    log = models.run_log(store.spark, run_id, params, metrics)
    models.append_log(log.unionByName(models.round_log(run_id, BOOSTED, rounds)), store.at("run_log"))
    return best


def find_anomalies(store: Store, settings: Settings) -> str:
    predictions = store.read("val_predictions")
    hot = hot_series(predictions, max_rows=settings.max_series_rows)
    flagged = detect(predictions, settings.z_threshold, settings.isolation, hot)
    return files.write_csv(store.write(flagged, "anomalies"), store.at("anomalies_csv"))


def build_sequences(store: Store, settings: Settings) -> dict[str, int]:
    """Training and validation windows of the subset, as tables for a sequence model.

    Training windows are kept as chunks, see ``training_windows``.
    Codes and scales are learned before the cutoff, stored, and applied to the rows after it as well.
    """
    features = store.read_panel("feature_table")
    subset = selection.store_top_items(features, settings.state, settings.store, settings.top_n)
    hot = hot_series(subset, max_rows=settings.max_series_rows)
    frame = store.write(sequences.sequence_frame(subset, hot), "sequence_frame")
    sequences.require_dense(frame, hot)
    encoder, horizon = settings.encoder, settings.horizon
    known = sequences.before_cutoff(frame, horizon)
    codes = store.write(encoders.category_codes(known), "category_codes")
    scalers = store.write(encoders.real_scalers(known), "real_scalers")
    store.write(encoders.encode(frame, codes, scalers), "encoded_frame")
    chunks = store.write(sequences.window_chunks(frame, encoder, horizon), "training_chunks")
    ends = sequences.window_index(chunks, settings.stride).select(F.sum(F.size("ends"))).first()[0]
    validation = sequences.validation_windows(frame, encoder, horizon)
    counts = {
        "training_samples": ends or 0,
        "validation_samples": store.write(validation, "validation_windows").count(),
        "n_series": frame.agg(F.count_distinct("series_id")).first()[0],
    }
    params = {
        "state_id": settings.state,
        "store_id": settings.store,
        "top_n_items": settings.top_n,
        "max_encoder_length": encoder,
        "max_prediction_length": horizon,
        "stride": settings.stride,
    }
    log = models.run_log(store.spark, uuid.uuid4().hex, params, counts)
    models.append_log(log, store.at("sequence_log"))
    return counts


def training_windows(store: Store, settings: Settings) -> DataFrame:
    """Training windows, cut out of the stored chunks."""
    return sequences.cut_windows(store.read("training_chunks"), settings.stride)


def forecast_all(store: Store, settings: Settings) -> DataFrame:
    """Future days of every series with the kept model."""
    model = models.load_model(store.at("models/best"))
    sales_long = store.read_panel("sales_long")
    return store.write(horizon_forecast(sales_long, model, settings.horizon), "forecast")


def forecast_requests(store: Store, requests: DataFrame) -> DataFrame:
    """Future days of the requested series, each over its own horizon, with the kept model."""
    model = models.load_model(store.at("models/best"))
    sales_long = store.read_panel("sales_long")
    return store.write(requested_forecast(sales_long, model, requests), "requested_forecast")


def anomalies_from_csv(
    spark: SparkSession, predictions_csv: str, target_csv: str, settings: Settings = Settings()
) -> str:
    """Flag stored CSV predictions on their own, without the stages before."""
    predictions = files.read_predictions_csv(spark, predictions_csv)
    hot = hot_series(predictions, max_rows=settings.max_series_rows)
    flagged = detect(predictions, settings.z_threshold, settings.isolation, hot)
    return files.write_csv(flagged, target_csv)


def run_all(store: Store, raw: RawFiles, settings: Settings = Settings()) -> Outcome:
    outcome = Outcome(row_counts=ingest(store, raw))
    build_features(store, settings)
    check_features(store, settings)
    outcome.best_model = train(store, settings)
    outcome.predictions = store.at("val_predictions")
    outcome.anomalies = find_anomalies(store, settings)
    return outcome
