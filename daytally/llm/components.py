"""Connected components of a link table.

A table of up to ``TASK_LINKS`` links is worked on in one task. In a larger one every partition
first replaces its links by a star for each of its own components; the stars are then contracted in
joins, round by round. Both ways give the same components.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.session import cut_lineage

TASK_LINKS = 1_000_000  # 16 bytes each
PARTITION_LINKS = 1 << 20


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component) of all nodes in the links but those least ones."""
    names, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    one, other = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(names))
    while len(one):
        # Every root takes the least root that it is linked to; chains of roots are then cut short.
        low, high = np.minimum(root[one], root[other]), np.maximum(root[one], root[other])
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
        apart = root[one] != root[other]
        one, other = one[apart], other[apart]
    moved = np.flatnonzero(root != np.arange(len(names)))
    return names[moved], names[root[moved]]


def _local_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def found() -> pa.RecordBatch:
        a, b = stars(*(np.concatenate([h[i] for h in held]) for i in (0, 1)))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    for batch in batches:
        held.append([batch.column(i).to_numpy() for i in (0, 1)])
        size += batch.num_rows
        if size >= PARTITION_LINKS:
            yield found()
            held, size = [], 0
    if held:
        yield found()


def release(spark: SparkSession) -> None:
    """Collects the driver's garbage. Spark removes the shuffle files and checkpoints of a finished
    round only once the driver has collected what refers to them; until then rounds pile up. Frames
    that Python still holds in cycles count as references, so its garbage goes first."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: links each larger neighbour to the least of the neighbourhood. Small star: links
    the node and its smaller neighbours to the least of them."""
    if large:
        near = edges.union(edges.select("b", "a"))
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    joined = near.join(least, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(joined.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def connected_components(links: DataFrame, task_links: int = TASK_LINKS) -> DataFrame:
    """(node, component) for every node of links (a, b); the component is its least node."""
    edges = cut_lineage(links.where("a <> b").select("a", "b").distinct())
    count = edges.count()
    if count <= min(task_links, PARTITION_LINKS):
        edges = cut_lineage(edges.repartition(1).mapInArrow(_local_stars, "a long, b long"))
    else:
        edges = cut_lineage(edges.mapInArrow(_local_stars, "a long, b long"))
        before = None
        while True:
            edges = cut_lineage(_stars(_stars(edges, True), False))
            now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
            if now == before or not now[0]:
                break
            before = now
            release(links.sparkSession)
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.union(roots)
