"""Nearest neighbours by inner product, along shifted space-filling curves.

Vectors are projected on a few random directions, shifted, and ordered by their place on a Hilbert
curve; several curves have directions and shifts of their own. All rows are range-partitioned and
numbered along each curve. A query's candidates are the rows within a window of its place on any of
the curves; they are scored exactly in blocks of bounded size, and the best of all curves merge.

The window is not fixed: for a bounded sample of queries the true neighbours are found by comparing
with every row, and the window is chosen so that the wanted share of them lies inside.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daytally.llm.order import with_position
from daytally.session import scratch_path


@dataclass(frozen=True)
class Search:
    """``sample`` queries set the window, ``scale_rows`` rows the scale of the projections."""

    k: int = 20
    curves: int = 16
    dimensions: int = 8
    bits: int = 7
    recall: float = 0.95
    sample: int = 256
    scale_rows: int = 4096
    block: int = 4096
    seed: int = 5


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of cell numbers (transpose form of the curve)."""
    x = cells.T.astype(np.uint64).copy()
    n, one = len(x), np.uint64(1)
    q = one << np.uint64(bits - 1)
    while q > one:
        low = q - one
        for i in range(n):
            swap = np.where(x[i] & q, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(x[i] & q, low, swap)
            x[i] ^= swap
        q >>= one
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = one << np.uint64(bits - 1)
    while q > one:
        flip ^= np.where(x[n - 1] & q, q - one, np.uint64(0))
        q >>= one
    x ^= flip
    place = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            place = (place << one) | ((x[i] >> np.uint64(b)) & one)
    return place.astype(np.int64)


def usable(vector: Column) -> Column:
    """Not null, not zero, and all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equally long vectors as doubles."""
    rows = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1) if rows else np.zeros((0, 1))


SCORED = pa.schema([("q", pa.int64()), ("query_id", pa.int64()), ("c", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
SCORED_SQL = "q long, query_id long, c long, vec_id long, score double"


def best_pairs(q: np.ndarray, qid: np.ndarray, qv: np.ndarray, c: np.ndarray, cid: np.ndarray, cv: np.ndarray, k: int) -> pa.RecordBatch:
    """The ``k`` best candidates of each query, never the query's own row; ties to smaller ids.

    A matrix product finds all candidates whose score may reach the ``k``-th best one, given how far
    its rounding can be off. They are scored anew, each in the same way wherever the pair meets.
    """
    out: list[list] = [[], [], [], [], []]
    length = np.sqrt((cv * cv).sum(axis=1)).max(initial=0.0)
    slack = 4 * (qv.shape[1] + 2) * np.finfo(np.float64).eps * np.sqrt((qv * qv).sum(axis=1)) * length
    for at in range(0, len(q), 512):
        part = slice(at, at + 512)
        scores = qv[part] @ cv.T
        scores[q[part][:, None] == c[None, :]] = -np.inf
        n = scores.shape[1]
        edge = -np.partition(-scores, k - 1, axis=1)[:, k - 1] if n > k else np.full(len(scores), -np.inf)
        for i, least in enumerate(edge):
            found = np.flatnonzero((scores[i] >= least - slack[at + i]) & (scores[i] > -np.inf))
            exact_scores = (cv[found] * qv[at + i]).sum(axis=1)
            order = np.lexsort((c[found], cid[found], -exact_scores))[:k]
            found = found[order]
            out[0].append(np.full(len(found), q[at + i]))
            out[1].append(np.full(len(found), qid[at + i]))
            out[2].append(c[found])
            out[3].append(cid[found])
            out[4].append(exact_scores[order])
    none = [np.zeros(0, np.int64)] * 4 + [np.zeros(0)]
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([n, *o])) for n, o in zip(none, out, strict=True)], schema=SCORED)


def ranked(pairs: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id", "c")
    distinct = pairs.groupBy("q", "query_id", "c", "vec_id").agg(F.max("score").alias("score"))
    return distinct.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(vectors: DataFrame, queries: Column, search: Search = Search()) -> DataFrame:
    """query_id, rank, vec_id and score of the nearest found rows of each query row.

    ``vectors`` has vec_id and embedding; ``queries`` is a condition on it. Rows whose vector is
    null, zero, or holds null or non-finite components take no part. Vectors of different lengths have
    no inner product: those of each length are searched among themselves. Rows that share a vec_id
    are rows of their own.
    """
    spark = vectors.sparkSession
    path = scratch_path(spark, "vectors")
    rows = vectors.select(F.monotonically_increasing_id().alias("_row"), F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.coalesce(queries, F.lit(False)).alias("_query"))
    rows.where(usable(F.col("embedding"))).write.parquet(path)
    rows = spark.read.parquet(path)
    counts = rows.groupBy(F.size("embedding").alias("n")).agg(F.count("*").alias("rows")).collect()  # a row per length
    out = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for found in sorted(map(tuple, counts), reverse=True):
        part = _nearest_of_length(rows.where(F.size("embedding") == found[0]), *found, search)
        out = part if len(counts) == 1 else out.union(part)
    return out


def _nearest_of_length(rows: DataFrame, length: int, total: int, search: Search) -> DataFrame:
    spark = rows.sparkSession
    by_hash = F.xxhash64("_row", F.lit(search.seed))
    scale = np.array([r[0] for r in rows.orderBy(by_hash, "_row").limit(search.scale_rows).select("embedding").collect()], np.float64)
    rng = np.random.default_rng(search.seed)
    width = min(search.dimensions, length)
    axes = [np.linalg.qr(rng.normal(size=(length, width)))[0] for _ in range(search.curves)]
    low = [np.quantile(scale @ a, 0.001, axis=0) for a in axes]
    span = [np.maximum(np.quantile(scale @ a, 0.999, axis=0) - lo, 1e-12) for a, lo in zip(axes, low, strict=True)]
    shift = [rng.random(width) for _ in axes]
    cells = 1 << search.bits

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = matrix(batch.column("embedding"))
            for curve, axis in enumerate(axes):
                unit = ((v @ axis - low[curve]) / span[curve] + shift[curve]) / 2
                keys = hilbert(np.clip(unit * cells, 0, cells - 1).astype(np.int64), search.bits)
                yield pa.RecordBatch.from_pydict({"_row": batch.column("_row"), "curve": pa.array(np.full(len(v), curve, np.int32)), "key": pa.array(keys)})

    on_curves = rows.select("_row", "embedding").mapInArrow(places, "_row long, curve int, key long")
    placed = with_position(on_curves, [F.col("curve"), F.col("key"), F.col("_row")], "_all")
    placed = placed.select("_row", "curve", (F.col("_all") - F.col("curve") * total).alias("pos"))
    placed_path = scratch_path(spark, "curves")
    placed.write.parquet(placed_path)
    placed = spark.read.parquet(placed_path)

    window = _window(rows, placed, total, by_hash, search)
    block = int(min(max(window, 256), search.block))
    bin_rows = 4 * block
    # A candidate belongs to one block of a curve. A query goes to every block its window touches.
    # Queries are dealt in bins of places, so that neither side of a group is longer than its bin.
    full = placed.join(rows, "_row")
    blocks = F.sequence(F.expr(f"greatest(pos - {window}, 0) div {block}"), F.expr(f"least(pos + {window}, {total - 1}) div {block}"))
    asks = full.where("_query").withColumn("_block", F.explode(blocks)).withColumn("_bin", F.expr(f"pos div {bin_rows}"))
    first = F.expr(f"greatest((pos div {block}) * {block} - {window}, 0) div {bin_rows}")
    last = F.expr(f"least((pos div {block}) * {block} + {block - 1} + {window}, {total - 1}) div {bin_rows}")
    held = full.withColumn("_block", F.expr(f"pos div {block}")).withColumn("_bin", F.explode(F.sequence(first, last)))
    columns = ["curve", "_block", "_bin", "_row", "vec_id", "embedding"]
    both = asks.select(*columns, F.lit(True).alias("ask")).union(held.select(*columns, F.lit(False)))
    k = search.k

    def score(table: pa.Table) -> pa.Table:
        ask = table.column("ask").to_numpy()
        ids, rows_, v = table.column("vec_id").to_numpy(), table.column("_row").to_numpy(), matrix(table.column("embedding").combine_chunks())
        return pa.Table.from_batches([best_pairs(rows_[ask], ids[ask], v[ask], rows_[~ask], ids[~ask], v[~ask], k)])

    pairs = both.groupBy("curve", "_block", "_bin").applyInArrow(score, SCORED_SQL)
    return ranked(pairs, k).select("query_id", "rank", "vec_id", "score")


def exact(rows: DataFrame, asked: list[tuple[int, int, list]], k: int) -> DataFrame:
    """Best ``k`` pairs of a bounded set of queries (row, id, vector) against all rows, in blocks."""
    q, qid = (np.array([a[i] for a in asked], np.int64) for i in (0, 1))
    qv = np.array([a[2] for a in asked], np.float64)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield best_pairs(q, qid, qv, batch.column("_row").to_numpy(), batch.column("vec_id").to_numpy(), matrix(batch.column("embedding")), k)

    return ranked(rows.select("_row", "vec_id", "embedding").mapInArrow(score, SCORED_SQL), k)


def _window(rows: DataFrame, placed: DataFrame, total: int, by_hash: Column, search: Search) -> int:
    """Half width that covers the wanted share of the sampled queries' true neighbours."""
    asked = [tuple(r) for r in rows.where("_query").orderBy(by_hash, "_row").limit(search.sample).select("_row", "vec_id", "embedding").collect()]
    if not asked:
        return 1
    pairs = [(r["q"], r["c"]) for r in exact(rows, asked, search.k).select("q", "c").collect()]
    if not pairs:
        return 1
    ids = sorted({x for p in pairs for x in p})  # at most sample * (k + 1) rows
    few = rows.sparkSession.createDataFrame([(i,) for i in ids], "_row long")
    place: dict[int, np.ndarray] = {i: np.zeros(search.curves) for i in ids}
    for r in placed.join(F.broadcast(few), "_row").collect():
        place[r["_row"]][r["curve"]] = r["pos"]
    distance = np.sort([np.abs(place[q] - place[c]).min() for q, c in pairs])
    return int(min(total, distance[int(np.ceil(search.recall * len(distance))) - 1] + 1))
