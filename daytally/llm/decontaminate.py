"""Benchmark decontamination by fingerprints of item-sized windows.

Every benchmark item of n words is compared with windows of n words of every document. A window's
fingerprint is the SimHash of its word shingles, weighted by their counts. Fingerprints are cut into
one block more than the radius has bits, so two that differ in no more bits agree in a block
(pigeonhole): the index on (window size, block, value) finds all of them. Candidates within the
radius are then verified by the exact similarity of the shingles as weighted sets: the sum of the
lesser counts over the sum of the greater ones.

Windows that cannot reach the threshold get no fingerprint: two weighted sets of the same size n
have similarity t only if 2nt/(1+t) of n shingles are common, and a running count of the shingles
that occur in any item of the size bounds that from above. The default radius is so wide that a
pair at the threshold lies beyond it with a chance of about one in a hundred thousand.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.llm.text import PIECE, SHINGLE, SIMILARITY, U, grouped, shingle_hashes, signed, texts_of, word_hashes
from daytally.session import cut_lineage

BITS = 64
ITEM_WORDS = 2_000_000  # words of benchmark items that are held by a task at once
MARKS = 22  # bits of the first look-up


@dataclass(frozen=True)
class Match:
    threshold: float = SIMILARITY
    shingle: int = SHINGLE
    radius: int = 23

    def needed(self, shingles: int) -> int:
        return math.ceil(2 * shingles * self.threshold / (1 + self.threshold) - 1e-9)


def simhashes(shingles: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints of the windows of ``n`` shingles from each of ``starts``."""
    first, last = int(starts.min()), int(starts.max()) + n
    part = np.ascontiguousarray(shingles[first:last])
    bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    total = np.zeros((len(part) + 1, BITS), np.int32)
    np.cumsum(bits.astype(np.int32) * 2 - 1, axis=0, out=total[1:])
    at = starts - first
    positive = (total[at + n] - total[at]) > 0
    return np.packbits(positive, axis=1, bitorder="little").view(np.uint64).ravel()


class ItemIndex:
    """Shingles of a bounded part of the benchmark, by item size."""

    def __init__(self, by_size: dict[int, np.ndarray]):
        self.by_size = by_size
        self.all = np.unique(np.concatenate([np.zeros(0, np.uint64), *self.by_size.values()]))
        self.marks = np.zeros(1 << MARKS, bool)
        self.marks[(self.all >> U(64 - MARKS)).astype(np.int64)] = True

    def windows(self, shingles: np.ndarray, match: Match) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(shingles per window, starts, fingerprints) of a document's windows that may match."""
        for n, own in self.by_size.items():
            if n > len(shingles):
                continue
            hits = own[np.minimum(np.searchsorted(own, shingles), len(own) - 1)] == shingles
            total = np.concatenate([[0], np.cumsum(hits)])
            starts = np.flatnonzero(total[n:] - total[:-n] >= match.needed(n))
            if len(starts):
                yield n, starts, simhashes(shingles, starts, n)


def benchmark_items(benchmark: DataFrame, match: Match) -> DataFrame:
    """item_id, n (shingles), words, shingles and fingerprint of every item of five words at least.

    Shorter items have no shingle and match nothing. Items with a null id or text take no part.
    """

    def items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, bounds = shingle_hashes(*word_hashes(texts_of(batch.column("text"))), match.shingle)
            each = [hashes[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            prints = [int(signed(simhashes(s, np.array([0]), len(s)))[0]) if len(s) else 0 for s in each]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), pa.array([len(s) for s in each], pa.int64()), pa.array([signed(s) for s in each], pa.list_(pa.int64())), pa.array(prints, pa.int64())],
                names=["item_id", "n", "shingles", "fingerprint"],
            )

    kind = benchmark.schema["item_id"].dataType.simpleString()
    rows = benchmark.select("item_id", "text").dropna().mapInArrow(items, f"item_id {kind}, n long, shingles array<long>, fingerprint long")
    return rows.where("n > 0")


def by_size(items: list[tuple[int, np.ndarray]]) -> dict[int, np.ndarray]:
    """Sorted distinct shingles of all items of the same size."""
    sizes: dict[int, list] = {}
    for n, shingles in items:
        sizes.setdefault(n, []).append(shingles)
    return {n: np.unique(np.concatenate(s)) for n, s in sizes.items()}


def document_windows(docs: DataFrame, items: dict[int, np.ndarray], match: Match) -> DataFrame:
    """doc_id, n, start, fingerprint and shingles of every window that may match an item."""
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = ItemIndex(shared.value)
        for batch in batches:
            out: dict[str, list] = {"row": [], "n": [], "start": [], "fingerprint": [], "shingles": []}
            texts = texts_of(batch.column("text"))
            for first, last in grouped(texts, PIECE):
                hashes, bounds = shingle_hashes(*word_hashes(texts[first:last]), match.shingle)
                near = np.flatnonzero(held.marks[(hashes >> U(64 - MARKS)).astype(np.int64)])
                near = near[np.isin(hashes[near], held.all)]
                for i in np.unique(np.searchsorted(bounds, near, "right") - 1):
                    own = hashes[bounds[i] : bounds[i + 1]]
                    for n, starts, prints in held.windows(own, match):
                        out["row"] += [first + i] * len(starts)
                        out["n"] += [n] * len(starts)
                        out["start"] += starts.tolist()
                        out["fingerprint"] += signed(prints).tolist()
                        out["shingles"] += [signed(own[s : s + n]) for s in starts]
            ids = batch.column("doc_id").take(pa.array(out.pop("row"), pa.int64()))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True))], names=["doc_id", *out])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(windows, f"doc_id {kind}, n long, start long, fingerprint long, shingles array<long>")


def _blocks(radius: int) -> list[tuple[int, int]]:
    """(first bit, width) of radius + 1 blocks that make up a fingerprint."""
    edges = np.linspace(0, BITS, radius + 2).round().astype(int)
    return [(int(a), int(b - a)) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _with_blocks(df: DataFrame, radius: int) -> DataFrame:
    values = [
        F.struct(F.lit(i).alias("block"), F.shiftright("fingerprint", first).bitwiseAND(F.lit((1 << width) - 1).cast("long")).alias("value"))
        for i, (first, width) in enumerate(_blocks(radius))
    ]
    return df.withColumn("_b", F.explode(F.array(*values))).select("*", "_b.block", "_b.value").drop("_b")


def _weighted_similarity(one: pa.Array, other: pa.Array) -> pa.Array:
    out = []
    for a, b in zip(one, other, strict=True):
        x, nx = np.unique(a.values.to_numpy(), return_counts=True)
        y, ny = np.unique(b.values.to_numpy(), return_counts=True)
        _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
        common = np.minimum(nx[i], ny[j]).sum()
        out.append(common / (nx.sum() + ny.sum() - common))
    return pa.array(out, pa.float64())


def matches(docs: DataFrame, benchmark: DataFrame, match: Match = Match()) -> DataFrame:
    """doc_id, item_id, similarity, start and n_words of the best window of each matching pair.

    Of equally similar windows the first counts. Documents under five words, null and empty texts
    match nothing; a row with a null doc_id is reported under null. The benchmark is worked on in
    parts of bounded size, each against all documents.
    """
    items = cut_lineage(benchmark_items(benchmark, match))
    total = items.agg(F.sum("n")).first()[0] or 0
    parts = -(-total // ITEM_WORDS)
    out = None
    for part in range(max(1, parts)):
        chosen = items.where(F.pmod(F.xxhash64("item_id"), F.lit(max(1, parts))) == part)
        held = [(n, np.array(s, np.int64).view(np.uint64)) for n, s in map(tuple, chosen.select("n", "shingles").collect())]
        found = cut_lineage(document_windows(docs, by_size(held), match).withColumn("_w", F.monotonically_increasing_id()))
        left = _with_blocks(found.select("_w", "n", "fingerprint"), match.radius)
        right = _with_blocks(chosen.select(F.monotonically_increasing_id().alias("_i"), "n", "fingerprint"), match.radius)
        right = right.select("_i", "n", "block", "value", F.col("fingerprint").alias("_f"))
        near = left.join(right, ["n", "block", "value"]).where(F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("_f"))) <= match.radius)
        near = near.select("_w", "_i").distinct()
        own = chosen.select(F.monotonically_increasing_id().alias("_i"), "item_id", F.col("shingles").alias("_s"))
        pairs = near.join(found, "_w").join(own, "_i")
        pairs = pairs.withColumn("similarity", F.arrow_udf(_weighted_similarity, "double")("shingles", "_s"))
        pairs = pairs.where(F.col("similarity") >= match.threshold).select("doc_id", "item_id", "similarity", "start", (F.col("n") + match.shingle - 1).alias("n_words"))
        out = pairs if out is None else out.union(pairs)
    best = F.min(F.struct((-F.col("similarity")).alias("_less"), "start", "n_words")).alias("_b")
    grouped_ = out.groupBy("doc_id", "item_id").agg(best)
    return grouped_.select("doc_id", "item_id", (-F.col("_b._less")).alias("similarity"), "_b.start", "_b.n_words")


def decontaminated(docs: DataFrame, benchmark: DataFrame, match: Match = Match()) -> DataFrame:
    """Documents that match no item. A null doc_id stays only if no row with a null doc_id matches."""
    hit = matches(docs, benchmark, match).select(F.col("doc_id").alias("_hit")).distinct()
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["_hit"]), "left_anti")
