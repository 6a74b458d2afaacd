"""Newton boosting of histogram trees under the Tweedie loss with a log link.

Features are binned once. Every round fits one tree to the slopes and curvatures of the rows, leaf by
leaf, always the leaf with the greatest gain next. A table of bounded size, which a training subset
is, is boosted in one task; a larger one stays spread, and each level of a tree is one aggregate. Both
ways grow the same trees. Rows of a validation part have their scores carried along: each round's
figure costs no second scoring.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.operators.histogram import Growing, SparkRows, TaskRows, bin_edges, binned, grow
from daytally.operators.trees import TreeModel, Trees, joined
from daytally.schemas import MODEL_FEATURES, TARGET
from daytally.session import drop_path, scratch_path

# Functions used inside tasks travel with the task, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Loss power, step, leaves, rows per leaf, column share, rounds and seed.
POWER = 1.1
LEARNING_RATE = 0.05
LEAVES = 127
MIN_ROWS = 100
COLUMN_SHARE = 0.8
ROUNDS = 1000
SEED = 42


def tweedie_slope(y: Column, score: Column, power: float = POWER) -> Column:
    """First derivative of the loss by the log-mean ``score``."""
    return F.exp((2 - power) * score) - y * F.exp((1 - power) * score)


def tweedie_curvature(y: Column, score: Column, power: float = POWER) -> Column:
    """Second derivative; positive for a power between 1 and 2 and ``y >= 0``."""
    return (2 - power) * F.exp((2 - power) * score) + (power - 1) * y * F.exp((1 - power) * score)


def tweedie_deviance(
    df: DataFrame, actual: str = "actual", predicted: str = "predicted", power: float = POWER
) -> DataFrame:
    """Mean unit deviance, the part that depends on the prediction."""
    y, mean = F.col(actual), F.col(predicted)
    part = F.pow(mean, 2 - power) / (2 - power) - y * F.pow(mean, 1 - power) / (1 - power)
    return df.agg((2 * F.avg(part)).alias("deviance"))


@dataclass(frozen=True)
class TweedieBoosting:
    """The weighted mean in a leaf is the Newton step of that leaf.

    ``row_share`` below 1 samples rows anew in every round. ``task_rows`` rows at most are boosted
    in one task; above, each level of a tree is a Spark job. ``max_depth`` is unlimited by default.
    """

    rounds: int = ROUNDS
    learning_rate: float = LEARNING_RATE
    power: float = POWER
    leaves: int = LEAVES
    max_depth: int | None = None
    min_rows: int = MIN_ROWS
    column_share: float = COLUMN_SHARE
    row_share: float = 1.0
    max_bins: int = 255
    seed: int = SEED
    cut_every: int = 5
    task_rows: int = 2_000_000

    def fit(self, train: DataFrame, features: list[str] = MODEL_FEATURES, target: str = TARGET) -> PipelineModel:
        return self.fit_with_rounds(train, None, features, target)[0]

    def fit_with_rounds(
        self, train: DataFrame, valid: DataFrame | None, features: list[str] = MODEL_FEATURES, target: str = TARGET
    ) -> tuple[PipelineModel, DataFrame]:
        """The model, and (round, train_deviance, valid_deviance) of every round from 1; the latter
        is null without validation rows."""
        spark = train.sparkSession
        y = F.col(target).cast("double").alias("y")
        edges = bin_edges(train, features, self.max_bins)
        parts = [(train, True), *([(valid, False)] if valid is not None else [])]
        rows = [p.select(binned(edges, features).alias("bins"), y, F.lit(t).alias("learned")) for p, t in parts]
        path = scratch_path(spark, "boosting")
        (rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1])).write.parquet(path)
        stored = spark.read.parquet(path)
        size, mean, least = stored.agg(F.count("*"), F.avg(F.when(F.col("learned"), F.col("y"))), F.min(F.when(F.col("learned"), F.col("y")))).first()
        if mean is None or mean <= 0 or least < 0:
            raise ValueError("the target must be non-negative with a positive mean")
        start = math.log(mean)
        boost = self._in_task if size <= self.task_rows else self._spread
        trees, figures = boost(stored, edges, start)
        drop_path(spark, path)
        model = TreeModel(trees, tuple(features), log_link=True, start=start)
        return PipelineModel([model]), self._figures(spark, figures)

    def _figures(self, spark: SparkSession, figures: list[tuple[float, float | None]]) -> DataFrame:
        rows = [(i, *f) for i, f in enumerate(figures, 1)]
        return spark.createDataFrame(rows, "round int, train_deviance double, valid_deviance double")

    def _columns(self, number: int, width: int) -> np.ndarray:
        """Features that a round may split on."""
        keep = max(1, round(self.column_share * width))
        return np.sort(np.random.default_rng([self.seed, number]).permutation(width)[:keep])

    def _growing(self, columns: np.ndarray) -> Growing:
        return Growing(self.max_bins, columns, self.min_rows, self.max_depth)

    def _in_task(self, stored: DataFrame, edges: list[np.ndarray], start: float) -> tuple[Trees, list]:
        """All rounds in one task, over rows whose number is bounded; nodes and figures come back."""

        def boost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(batches)
            codes = table["bins"].combine_chunks().flatten().to_numpy().reshape(-1, len(edges))
            y, learned = table["y"].to_numpy(), table["learned"].to_numpy()
            for tree, (train, valid) in self._rounds(codes, y, learned, edges, start):
                feature, threshold, left = tree
                yield pa.RecordBatch.from_pydict(
                    {
                        "feature": [feature.tobytes()], "threshold": [threshold.tobytes()], "left": [left.tobytes()],
                        "train": pa.array([train], pa.float64()), "valid": pa.array([valid], pa.float64()),
                    }
                )

        schema = "feature binary, threshold binary, left binary, train double, valid double"
        # In a fixed order, so that the same rows give the same sums.
        ordered = stored.repartition(1).sortWithinPartitions("learned", "bins", "y")
        rows = ordered.mapInArrow(boost, schema).toArrow().to_pylist()
        kinds = {"feature": np.int16, "threshold": np.float64, "left": np.int32}
        trees = [tuple(np.frombuffer(r[name], kind) for name, kind in kinds.items()) for r in rows]
        return joined(trees), [(r["train"], r["valid"]) for r in rows]

    def _rounds(self, codes: np.ndarray, y: np.ndarray, learned: np.ndarray, edges: list[np.ndarray], start: float) -> Iterator[tuple]:
        rows, score, counted = TaskRows(codes, self.max_bins), np.full(len(y), start), np.flatnonzero(learned)
        p = self.power
        for number in range(self.rounds):
            up, down = np.exp((2 - p) * score), y * np.exp((1 - p) * score)
            some = counted
            if self.row_share < 1:
                some = counted[np.random.default_rng([self.seed, number, 1]).random(len(counted)) < self.row_share]
            growing = self._growing(self._columns(number, codes.shape[1]))
            root = rows.start(growing.columns, up - down, (2 - p) * up + (p - 1) * down, some)
            grow(root, rows.ask, self.leaves, growing, eager=False)
            score += rows.steps(growing, self.learning_rate)
            part = 2 * (np.exp((2 - p) * score) / (2 - p) - y * np.exp((1 - p) * score) / (1 - p))
            figures = part[learned].mean(), part[~learned].mean() if len(counted) < len(y) else None
            yield growing.arrays(edges, self.learning_rate), figures

    def _spread(self, stored: DataFrame, edges: list[np.ndarray], start: float) -> tuple[Trees, list]:
        """The driver loops over rounds and levels; rows stay on the executors.

        Scores of earlier rounds are recomputed from the last stored ones, which replace those before.
        """
        spark = stored.sparkSession
        y, score, p = F.col("y"), F.col("score"), self.power
        state = stored.withColumns({"score": F.lit(start), "_id": F.monotonically_increasing_id()})
        trees, figures, path = [], [], None
        for number in range(self.rounds):
            counted = F.col("learned")
            if self.row_share < 1:
                counted = counted & (F.pmod(F.xxhash64("_id", F.lit(number)), F.lit(1 << 20)) < int(self.row_share * (1 << 20)))
            derived = {"slope": tweedie_slope(y, score, p), "curvature": tweedie_curvature(y, score, p), "counted": counted}
            rows, growing = SparkRows(self.max_bins), self._growing(self._columns(number, len(edges)))
            root = rows.start(state.withColumns(derived).select("bins", *derived), growing.columns)
            grow(root, rows.ask, self.leaves, growing, eager=True)
            trees.append(growing.arrays(edges, self.learning_rate))
            state = state.withColumn("score", score + rows.steps(growing, self.learning_rate))
            if (number + 1) % self.cut_every == 0 and number + 1 < self.rounds:
                before, path = path, scratch_path(spark, "scores")
                state.write.parquet(path)
                state = spark.read.parquet(path)
                if before:
                    drop_path(spark, before)
            part = 2 * (F.exp((2 - p) * score) / (2 - p) - y * F.exp((1 - p) * score) / (1 - p))
            figures.append(tuple(state.agg(F.avg(F.when(F.col("learned"), part)), F.avg(F.when(~F.col("learned"), part))).first()))
        if path:
            drop_path(spark, path)
        return joined(trees), figures
