"""All pairs of the windows that share a key, by classes of equal windows.

A passage around the min-hash at ``c`` reaches at most ``width`` - 1 shingles to either side, so of a
window only its core counts: what it holds within that reach. Windows of a key with equal cores are one
class; as a core is at least as wide as a passage, any two texts of a class share one. Classes are
compared pair by pair, in tiles of bounded size: copies cost nothing, different ones are all met.

A pair is first compared by groups of shingles. A word that differs breaks as many shingles in a row as
a shingle has words, except at the ends of a stretch. So the ``width`` - ``common`` shingles that a
passage may lack break few groups, and too many broken ones rule a pair out. The rest is counted.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daytally.llm.text import U, grouped, shingle_hashes, texts_of, word_hashes
from daytally.session import cut_lineage, drop_path, scratch_path

if TYPE_CHECKING:
    from daytally.llm.substrings import Passages

BATCH = 1 << 19  # code points of texts worked on at once
BROADCAST_ROWS = 500_000
CLASS = ["key", "after", "before", "core"]
TILE = 8192  # classes of one side of a tile
SMALL = 64  # classes of a key whose pairs are counted at once, without groups
BLOCK = 128, 512  # classes compared by groups at once
PAIRS = 4096  # pairs counted at once


def _few(df: DataFrame) -> DataFrame:
    """Hint to broadcast a stored table if it has few rows of a few numbers."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def crowded_windows(windows: DataFrame) -> DataFrame:
    """The windows of keys that have three or more; two windows are neighbours anyway."""
    crowded = cut_lineage(windows.groupBy("key").count().where("count > 2").select("key"))
    return windows.join(_few(crowded), "key", "left_semi")


def window_classes(crowded: DataFrame, passages: Passages, tile: int = TILE) -> DataFrame:
    """One row per class of a key: id, least and greatest text, a place ``c`` of it in the least text,
    left and right reach, and the chunk of its key (``chunks`` in all) it is dealt to.

    A key's only class needs no comparison; it is there with 0 chunks."""
    reach = passages.width - 1
    ends = crowded.select("*", F.least(F.expr("c - l"), F.lit(reach)).alias("left"), F.least(F.expr("r - c"), F.lit(reach)).alias("right"))
    least = F.min(F.struct("text", "c", "left", "right")).alias("least")
    classes = cut_lineage(ends.groupBy(*CLASS).agg(least, F.max("text").alias("last")).select(*CLASS, "least.*", "last", F.monotonically_increasing_id().alias("id")))
    many = classes.groupBy("key").count().where("count > 1").select("key", F.ceil(F.col("count") / tile).cast("int").alias("chunks"))
    out = classes.join(_few(cut_lineage(many)), "key", "left").withColumn("chunks", F.coalesce("chunks", F.lit(0)))
    return cut_lineage(out.withColumn("chunk", F.when(F.col("chunks") > 1, F.expr("pmod(xxhash64(after, before, core), chunks)").cast("int")).otherwise(0)))


def cores(docs: DataFrame, classes: DataFrame, first: DataFrame, passages: Passages) -> DataFrame:
    """The classes to compare with ``said``, two bytes of each shingle's hash within reach of ``c``, zeros
    outside the core. ``first`` has the _row in ``docs`` of each text."""
    reach, fields = passages.width - 1, ["id", "key", "chunks", "chunk", "last", "c", "left", "right"]
    wanted = classes.where("chunks > 0").groupBy("text").agg(F.collect_list(F.struct(*fields)).alias("places"))
    wanted = cut_lineage(wanted.join(first.select("text", "_row"), "text"))
    numbered = docs.select(F.monotonically_increasing_id().alias("_row"), F.col("text").alias("_said"))
    rows = numbered.join(_few(wanted.select("_row")), "_row", "left_semi").join(wanted, "_row")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column("_said"))
            for start, end in grouped(texts, BATCH):
                shingles, bounds = shingle_hashes(*word_hashes(texts[start:end]), passages.shingle)
                short = np.maximum((shingles >> U(48)).astype(np.uint16), np.uint16(1))
                places = batch.column("places").slice(start, end - start)
                sizes = pc.list_value_length(places).to_numpy()
                flat = places.flatten()
                named = {name: flat.field(name) for name in fields}
                c, left, right = (named[name].to_numpy().astype(np.int64) for name in ("c", "left", "right"))
                base = np.repeat(bounds[:-1], sizes)
                at = (base + c)[:, None] + np.arange(-reach, reach + 1)
                away = np.arange(-reach, reach + 1)
                inside = (away >= -left[:, None]) & (away <= right[:, None])
                said = np.where(inside, short[np.clip(at, 0, len(short) - 1)], 0).astype(np.uint16)
                numbers = np.repeat(batch.column("text").slice(start, end - start).to_numpy(), sizes)
                values = [pa.array(numbers), *(named[name] for name in fields if name != "c"), pa.array([row.tobytes() for row in said], pa.binary())]
                yield pa.RecordBatch.from_arrays(values, names=["text", *(name for name in fields if name != "c"), "said"])

    kinds = "text long, id long, key long, chunks int, chunk int, last long, left int, right int, said binary"
    return rows.select("_said", "text", "places").mapInArrow(cut, kinds)


class _Search:
    """Pairs of classes in one tile: what part of each core is in a passage, and which texts are linked."""

    def __init__(self, table: pa.Table, passages: Passages):
        self.width, self.common, self.size = passages.width, passages.common, passages.shingle
        self.ids, self.text, self.last = (table.column(n).to_numpy() for n in ("id", "text", "last"))
        self.left, self.right = (table.column(n).to_numpy().astype(np.int64) for n in ("left", "right"))
        self.said = np.frombuffer(b"".join(table.column("said").to_pylist()), np.uint16).reshape(len(self.ids), -1)
        shared = self.text != self.last
        # Shingles of the passages found, away from c; of a class that two texts share, the whole core.
        self.low, self.high = np.where(shared, -self.left, 1), np.where(shared, self.right, -1)
        self.names, self.node = np.unique(self.text, return_inverse=True)
        self.root = np.arange(len(self.names))
        # Of so many groups next to each other around c, as a passage holds at least, so many are whole.
        self.held = max((self.width - 1) // self.size - 1, 0)
        self.whole = self.held - 2 * -(-(self.width - self.common) // self.size)

    def groups(self, rows: np.ndarray, none: int) -> np.ndarray:
        """Hashes of the groups of shingles before c and after it, nearest first; ``none`` if not in the core."""
        said, reach = self.said[rows], self.width - 1
        out = np.full((2, self.held, len(rows)), none, np.uint16)
        for i in range(self.held):
            for side, start in ((0, reach - self.size * (i + 1)), (1, reach + 1 + self.size * i)):
                part = said[:, start : start + self.size]
                value = np.zeros(len(rows), np.uint64)
                for k in range(self.size):
                    value = (value + part[:, k]) * U(0x9E3779B97F4A7C15)
                out[side, i] = np.where((part > 0).all(axis=1), np.maximum((value >> U(48)).astype(np.uint16), 2), none)
        return out

    def likely(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``a`` and ``b``, groups of two sets of classes, of the pairs with enough whole groups."""
        sums = np.zeros((2, self.held + 1, a.shape[2], b.shape[2]), np.uint8)
        for side in (0, 1):
            for i in range(self.held):
                np.add(sums[side, i], a[side, i][:, None] == b[side, i], out=sums[side, i + 1])
        best = sums[0, 0] + sums[1, self.held]
        for i in range(1, self.held + 1):
            np.maximum(best, sums[0, i] + sums[1, self.held - i], out=best)
        return np.nonzero(best >= self.whole)

    def open(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Which pairs may still add a passage or a link: not those of linked texts in which all that the two
        cores have both room for is found, nor two classes of only the same text."""
        alone = (self.text[one] == self.text[other]) & (self.last[one] == self.last[other]) & (self.text[one] == self.last[one])
        low, high = -np.minimum(self.left[one], self.left[other]), np.minimum(self.right[one], self.right[other])
        full = (np.maximum(self.low[one], self.low[other]) <= low) & (np.minimum(self.high[one], self.high[other]) >= high)
        return ~alone & ~(full & (self.root[self.node[one]] == self.root[self.node[other]]))

    def count(self, one: np.ndarray, other: np.ndarray) -> None:
        """Compares the classes ``one`` with ``other``, as many pairs as there are."""
        for first in range(0, len(one), PAIRS):
            p, q = one[first : first + PAIRS], other[first : first + PAIRS]
            kept = self.open(p, q)
            p, q = p[kept], q[kept]
            if not len(p):
                continue
            x = self.said[p]
            same = (x == self.said[q]) & (x > 0)
            enough = np.bitwise_count(np.packbits(same, axis=1)).sum(axis=1, dtype=np.int16) >= self.common
            p, q, same = p[enough], q[enough], same[enough]
            total = np.zeros((len(p), same.shape[1] + 1), np.int16)
            np.cumsum(same, axis=1, out=total[:, 1:])
            starts, reach = np.arange(self.width), self.width - 1
            fits = (starts >= reach - np.minimum(self.left[p], self.left[q])[:, None]) & (starts <= np.minimum(self.right[p], self.right[q])[:, None])
            good = (total[:, self.width :] - total[:, : self.width] >= self.common) & fits
            found = good.any(axis=1)
            p, q, good = p[found], q[found], good[found]
            if not len(p):
                continue
            low, high = good.argmax(axis=1) - reach, reach - good[:, ::-1].argmax(axis=1)
            for rows in (p, q):
                np.minimum.at(self.low, rows, low)
                np.maximum.at(self.high, rows, high)
            self.link(self.node[p], self.node[q])

    def link(self, one: np.ndarray, other: np.ndarray) -> None:
        while len(one):
            a, b = self.root[one], self.root[other]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while (self.root[self.root] != self.root).any():
                self.root = self.root[self.root]
            apart = self.root[one] != self.root[other]
            one, other = one[apart], other[apart]

    def across(self, rows: np.ndarray, others: np.ndarray) -> None:
        """Compares all pairs of ``rows`` with ``others``; all pairs inside, if those are the same."""
        inside = rows is others
        a, b = self.groups(rows, 0), self.groups(others, 1)
        for i in range(0, len(rows), BLOCK[0]):
            for j in range(i // BLOCK[1] * BLOCK[1] if inside else 0, len(others), BLOCK[1]):
                x, y = self.likely(a[:, :, i : i + BLOCK[0]], b[:, :, j : j + BLOCK[1]])
                if inside:
                    x, y = x[x + i < y + j], y[x + i < y + j]
                self.count(rows[x + i], others[y + j])

    def found(self) -> pa.Table:
        """(id, low, high, text, other): the found part of each core, and a text that its text is linked to."""
        kept = np.flatnonzero(self.low <= self.high)
        values = self.ids[kept], self.low[kept].astype(np.int32), self.high[kept].astype(np.int32), self.text[kept], self.names[self.root[self.node[kept]]]
        return pa.Table.from_arrays([pa.array(v) for v in values], names=["id", "low", "high", "text", "other"])


def compared(classes: DataFrame, passages: Passages, tile: int = TILE) -> DataFrame:
    """(id, low, high, text, other) of the classes of ``cores`` by all pairs inside a key.

    Keys of one chunk are dealt to bins of many keys. Each two chunks of a larger key meet in one tile.
    """
    bins = max(1, classes.count() // tile)
    others = F.when(F.col("chunks") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("chunks") - 1))
    dealt = classes.withColumn("_other", F.explode(others)).withColumns(
        {
            "_at": F.when(F.col("chunks") == 1, F.expr(f"pmod(xxhash64(key), {bins})")).otherwise(F.col("key")),
            "_i": F.when(F.col("chunks") == 1, -1).otherwise(F.least("chunk", "_other")),
            "_j": F.when(F.col("chunks") == 1, -1).otherwise(F.greatest("chunk", "_other")),
        }
    )

    def search(table: pa.Table) -> pa.Table:
        table = table.sort_by("key")
        tiled = _Search(table, passages)
        i, j = table.column("_i")[0].as_py(), table.column("_j")[0].as_py()
        if i != j:
            chunk = table.column("chunk").to_numpy()
            tiled.across(np.flatnonzero(chunk == i), np.flatnonzero(chunk == j))
            return tiled.found()
        keys = table.column("key").to_numpy()
        edges = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]])
        sizes = np.diff(edges)
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        for n in range(2, SMALL + 1):
            starts = edges[:-1][sizes == n]
            x, y = np.triu_indices(n, 1)
            waiting.append(((starts[:, None] + x).ravel(), (starts[:, None] + y).ravel()))
        tiled.count(*(np.concatenate(side) for side in zip(*waiting, strict=True)))
        for start, n in zip(edges[:-1][sizes > SMALL], sizes[sizes > SMALL], strict=True):
            rows = np.arange(start, start + n)
            tiled.across(rows, rows)
        return tiled.found()

    columns = ["text", "id", "key", "chunk", "last", "left", "right", "said", "_at", "_i", "_j"]
    return dealt.select(*columns).groupBy("_at", "_i", "_j").applyInArrow(search, "id long, low int, high int, text long, other long")


def class_passages(docs: DataFrame, crowded: DataFrame, first: DataFrame, passages: Passages, tile: int = TILE) -> tuple[DataFrame, DataFrame]:
    """Spans (text, s, e) in passages, and links (a, b) of texts that share one, over all pairs of ``crowded``.

    ``first`` has the _row in ``docs`` of each text.
    """
    spark = docs.sparkSession
    paths = [scratch_path(spark, name) for name in ("crowded", "cores", "members")]
    crowded.write.parquet(paths[0])
    crowded = spark.read.parquet(paths[0])
    classes = window_classes(crowded, passages, tile)
    cores(docs, classes, first, passages).write.parquet(paths[1])
    found = cut_lineage(compared(spark.read.parquet(paths[1]), passages, tile))
    drop_path(spark, paths[1])
    whole = classes.where("text <> last").select("id", F.expr("-left").alias("low"), F.col("right").alias("high"))
    spans = found.select("id", "low", "high").union(whole).groupBy("id").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    named = classes.select(*CLASS, "id", F.col("text").alias("_least")).join(spans, "id").drop("id")
    met = crowded.select(*CLASS, "text", "c").join(named, CLASS)
    met.select("text", F.expr("c + low").alias("s"), F.expr("c + high + 1").alias("e"), "_least").write.parquet(paths[2])
    drop_path(spark, paths[0])
    met = spark.read.parquet(paths[2])
    links = met.select(F.col("_least").alias("a"), F.col("text").alias("b")).union(found.select("other", "text"))
    out = cut_lineage(merged_spans(met.select("text", "s", "e").distinct())), cut_lineage(links.where("a <> b").distinct())
    drop_path(spark, paths[2])
    return out


def merged_spans(spans: DataFrame) -> DataFrame:
    """Union of overlapping spans (text, s, e) of each text."""
    order = Window.partitionBy("text").orderBy("s", "e")
    before = F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.withColumn("_new", F.when(F.col("s") <= before, 0).otherwise(1))
    marked = marked.withColumn("_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy("text", "_run").agg(F.min("s").alias("s"), F.max("e").alias("e")).drop("_run")
