"""Forest regression, model comparison, the kept model and the run log."""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from daytally.operators.boosting import TweedieBoosting
from daytally.operators.forest import Forest
from daytally.operators.metrics import mean_absolute_error, require_score, wrmsse
from daytally.operators.selection import prediction_frame
from daytally.sources import files

# The names and key prefixes that run logs use, with the boosted model first because it
# wins a tie.
BOOSTED = "lightgbm"
FOREST = "random_forest"
PRIORITY = [BOOSTED, FOREST]
PREFIX = {BOOSTED: "lgb", FOREST: "rf"}
# Fixed value: example rows kept beside a model.
EXAMPLES = 5
MANIFEST = "number int, version string, stages array<string>, examples boolean"


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Keys, actual and predicted of every row."""
    return prediction_frame(model.transform(rows))


def evaluate(
    name: str, predictions: DataFrame, train: DataFrame, hot: DataFrame | None = None
) -> DataFrame:
    """One row ``(model, mae, wrmsse)``; weights are units, as training has no price in them.

    Predictions that match no actual row, and weights that add up to nothing, are errors of their own.
    """
    actual = predictions.withColumnRenamed("actual", "sales")
    pred = predictions.withColumnRenamed("predicted", "pred")
    score = wrmsse(actual.drop("predicted"), pred.drop("actual"), train, hot).first()
    require_score(score)
    scores = mean_absolute_error(predictions).withColumns({"model": F.lit(name), "wrmsse": F.lit(score["wrmsse"])})
    return scores.select("model", "mae", "wrmsse")


def compare(
    predictions: dict[str, DataFrame], train: DataFrame, hot: DataFrame | None = None
) -> DataFrame:
    """Scores of all models, stacked."""
    first, *rest = [evaluate(name, rows, train, hot) for name, rows in predictions.items()]
    for row in rest:
        first = first.unionByName(row)
    return first


def best_model(scores: DataFrame) -> DataFrame:
    """The row with the lowest MAE; on a tie the boosted model wins.

    A missing score is an error: validation rows that match nothing, or weights of zero.
    """
    priority = F.array_position(F.array(*[F.lit(n) for n in PRIORITY]), F.col("model"))
    missing = F.col("mae").isNull() | F.col("wrmsse").isNull()
    said = F.concat(F.lit("no score for model "), F.col("model"))
    mae = F.when(missing, F.raise_error(said).cast("double")).otherwise(F.col("mae"))
    return scores.withColumn("mae", mae).orderBy("mae", priority).limit(1)


def keep_model(model: PipelineModel, path: str, examples: DataFrame | None = None) -> str:
    """Saves a new version of ``model`` below ``path``, with up to five example rows beside it.

    The manifest row is appended last, and readers follow the manifest alone: a write that fails
    midway leaves the version before it in force. Earlier versions stay.
    """
    spark = SparkSession.active()
    number = max((r["number"] for r in versions(spark, path)), default=0) + 1
    name = f"{number:06d}-{uuid.uuid4().hex}"
    folder = _version_folder(path, name)
    model.write().save(f"{folder}/model")
    if examples is not None:
        files.write_table(examples.limit(EXAMPLES).coalesce(1), f"{folder}/examples")
    row = [(number, name, [type(stage).__name__ for stage in model.stages], examples is not None)]
    spark.createDataFrame(row, MANIFEST).coalesce(1).write.mode("append").parquet(_manifest(path))
    return path


def versions(spark: SparkSession, path: str) -> list[Row]:
    """Manifest rows of all complete versions, oldest first; empty where nothing was kept."""
    try:
        rows = files.read_table(spark, _manifest(path), MANIFEST)
    except FileNotFoundError:
        return []
    # One row per kept version.
    return rows.orderBy("number", "version").collect()


def load_model(path: str, number: int | None = None) -> PipelineModel:
    """The newest complete version, or the one of that ``number``."""
    return PipelineModel.load(f"{_version_folder(path, _kept(path, number)['version'])}/model")


def example_rows(path: str, number: int | None = None) -> DataFrame:
    """The rows kept beside a version."""
    row = _kept(path, number)
    if not row["examples"]:
        raise ValueError(f"no example rows beside version {row['number']} of {path}")
    return files.read_table(SparkSession.active(), f"{_version_folder(path, row['version'])}/examples")


def _kept(path: str, number: int | None) -> Row:
    rows = [r for r in versions(SparkSession.active(), path) if number in (None, r["number"])]
    if not rows:
        raise FileNotFoundError(f"missing input: no kept model in {path}")
    return rows[-1]


def _version_folder(path: str, version: str) -> str:
    return f"{path.rstrip('/')}/versions/{version}"


def _manifest(path: str) -> str:
    return f"{path.rstrip('/')}/manifest"


def run_log(
    spark: SparkSession, run_id: str, params: dict[str, object], metrics: dict[str, float]
) -> DataFrame:
    """Long table ``(run_id, kind, key, value)`` of one run, to append to a stored log."""

    def text(value: object) -> str:
        return value if isinstance(value, str) else json.dumps(value)

    rows = [(run_id, "param", k, text(v)) for k, v in params.items()]
    rows += [(run_id, "metric", k, text(v)) for k, v in metrics.items()]
    return spark.createDataFrame(rows, "run_id string, kind string, key string, value string")


def round_log(run_id: str, model: str, rounds: DataFrame) -> DataFrame:
    """Rows of the run log for the validation figure of every boosting round."""
    key = F.format_string(f"{PREFIX[model]}_val_deviance_%04d", "round")
    return rounds.select(
        F.lit(run_id).alias("run_id"),
        F.lit("round").alias("kind"),
        key.alias("key"),
        F.col("valid_deviance").cast("string").alias("value"),
    )


def model_params(settings: dict[str, Forest | TweedieBoosting]) -> dict[str, object]:
    return {f"{PREFIX[m]}_{k}": v for m, s in settings.items() for k, v in asdict(s).items()}


def append_log(log: DataFrame, path: str) -> str:
    log.write.mode("append").parquet(path)
    return path
