"""Isolation forest (Liu, Ting and Zhou, 2008) grown per tree and scored in Arrow batches."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daytally.functions.quantile import exact_quantile
from daytally.session import stored_table

# Usual forest size, rows per tree, share of outliers and seed.
TREES = 100
SAMPLE = 256
CONTAMINATION = 0.01
SEED = 42

EULER_GAMMA = 0.5772156649015329
NODE_SCHEMA = "tree int, node int, feature int, threshold double, path double"

# Functions used inside tasks travel with the task, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def mean_path(rows: int) -> float:
    """Mean depth of an unsuccessful search among ``rows`` points."""
    if rows <= 1:
        return 0.0
    if rows == 2:
        return 1.0
    return 2.0 * (math.log(rows - 1) + EULER_GAMMA) - 2.0 * (rows - 1) / rows


def grow_tree(points: np.ndarray, tree: int, seed: int, height: int) -> pd.DataFrame:
    """Nodes of one tree; children of node i are 2i+1 and 2i+2, ``feature`` is -1 at a leaf."""
    rng = np.random.default_rng([seed, tree])
    nodes = []
    pending = [(0, 0, points)]
    while pending:
        node, depth, inside = pending.pop()
        spread = np.flatnonzero(inside.max(axis=0) > inside.min(axis=0))
        if depth >= height or spread.size == 0:
            nodes.append((tree, node, -1, 0.0, depth + mean_path(len(inside))))
            continue
        feature = int(rng.choice(spread))
        column = inside[:, feature]
        low, high = column.min(), column.max()
        # Kept below the maximum, which a draw between neighbouring floats could round up to.
        threshold = float(min(rng.uniform(low, high), np.nextafter(high, low)))
        right = column > threshold
        nodes.append((tree, node, feature, threshold, 0.0))
        pending.append((2 * node + 1, depth + 1, inside[~right]))
        pending.append((2 * node + 2, depth + 1, inside[right]))
    return pd.DataFrame(nodes, columns=["tree", "node", "feature", "threshold", "path"])


def _below_share(draw: Column, share: float) -> Column:
    """True for about ``share`` of uniformly spread 64-bit hashes."""
    if share >= 1.0:
        return F.lit(True)
    return draw < F.lit(int(-(2**63) + share * 2**64))


@dataclass(frozen=True)
class IsolationForest:
    trees: int = TREES
    sample: int = SAMPLE
    contamination: float = CONTAMINATION
    seed: int = SEED

    def fit(self, df: DataFrame, features: list[str], key: list[str]) -> IsolationModel:
        """Draw ``sample`` rows per tree without replacement and grow the trees in parallel.

        Draws are hashes of the row key and the tree, so they do not depend on partitioning. Every
        tree draws from all rows; a row is copied only for the trees that draw it.
        """
        n = df.count()
        if n == 0:
            raise ValueError("no rows to fit an isolation forest on")
        size = min(self.sample, n)
        height = max(1, math.ceil(math.log2(size)))
        wanted = size + 8 * math.sqrt(size) + 64
        hashed = F.xxhash64(*key, F.lit(self.seed)).alias("hash")
        points = df.select(hashed, F.array(*_filled(features)).alias("x"))
        share = wanted / n
        hits = F.filter(
            F.sequence(F.lit(0), F.lit(self.trees - 1)),
            lambda tree: _below_share(F.xxhash64("hash", tree), share),
        )
        drawn = points.withColumn("tree", F.explode(hits)).withColumn(
            "draw", F.xxhash64("hash", "tree")
        )
        by_draw = Window.partitionBy("tree").orderBy("draw")
        chosen = drawn.withColumn("place", F.row_number().over(by_draw)).filter(
            F.col("place") <= size
        )
        seed = self.seed

        def grow(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("place")
            return grow_tree(np.stack(pdf["x"].to_numpy()), int(pdf["tree"].iloc[0]), seed, height)

        nodes = chosen.groupBy("tree").applyInPandas(grow, NODE_SCHEMA)
        return IsolationModel.from_nodes(nodes, features, self.trees, size, height)

    def fit_flag(self, df: DataFrame, features: list[str], key: list[str], flag: str) -> DataFrame:
        """Add ``flag``: 1 for rows whose score is beyond the contamination quantile."""
        stored = stored_table(df, "isolation")
        model = self.fit(stored, features, key)
        scored = stored_table(model.transform(stored, "_score"), "isolation-scores")
        limit = exact_quantile(scored, "_score", 1.0 - self.contamination)
        return scored.withColumn(flag, (F.col("_score") > limit).cast("int")).drop("_score")


def _filled(features: list[str]) -> list[Column]:
    return [F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features]


def isolation_scores(
    points: np.ndarray,
    feature: np.ndarray,
    threshold: np.ndarray,
    left: np.ndarray,
    path: np.ndarray,
    steps: int,
    usual_path: float,
) -> np.ndarray:
    """2 to the power of minus the mean path over the usual path; 1 is most isolated.

    The arrays hold one row per tree. A leaf points to itself and has an infinite threshold, so
    every walk takes the same number of steps.
    """
    if usual_path <= 0:
        return np.ones(len(points))
    rows = np.arange(len(points))
    total = np.zeros(len(points))
    for tree in range(len(feature)):
        node = np.zeros(len(points), dtype=np.int64)
        for _ in range(steps):
            right = points[rows, feature[tree][node]] > threshold[tree][node]
            node = left[tree][node] + right
        total += path[tree][node]
    return np.exp2(-total / len(feature) / usual_path)


@dataclass(frozen=True)
class IsolationModel:
    """Trees as arrays; their size depends on the settings, not on the data."""

    features: list[str]
    arrays: dict[str, np.ndarray | int | float]

    @classmethod
    def from_nodes(
        cls, nodes: DataFrame, features: list[str], trees: int, size: int, height: int
    ) -> IsolationModel:
        slots = 2 ** (height + 1) - 1
        feature = np.zeros((trees, slots), dtype=np.int64)
        threshold = np.full((trees, slots), np.inf)
        left = np.tile(np.arange(slots), (trees, 1))
        path = np.zeros((trees, slots))
        rows = nodes.toPandas()
        path[rows["tree"], rows["node"]] = rows["path"]
        inner = rows[rows["feature"] >= 0]
        at = (inner["tree"], inner["node"])
        feature[at] = inner["feature"]
        threshold[at] = inner["threshold"]
        left[at] = 2 * inner["node"] + 1
        return cls(
            features,
            {
                "feature": feature,
                "threshold": threshold,
                "left": left,
                "path": path,
                "steps": height,
                "usual_path": mean_path(size),
            },
        )

    def transform(self, df: DataFrame, column: str = "isolation_score") -> DataFrame:
        arrays = df.sparkSession.sparkContext.broadcast(self.arrays)

        @F.pandas_udf("double")
        def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for batch in batches:
                yield pd.Series(isolation_scores(np.column_stack(batch), **arrays.value))

        return df.withColumn(column, score(*_filled(self.features)))
