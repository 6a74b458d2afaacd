"""Prefix trie of conversations from sorted sequences and range minima.

Conversations are sorted by their sequences of turns; each has the number of turns in common with
the one before (its LCP). A prefix of ``d`` turns belongs to an interval of the order: it reaches
left and right as far as the LCPs between are not below ``d``. Minima of LCPs over all stretches of
a power of two make up a sparse table, in which every candidate prefix finds its two ends by binary
search, independently of all others. Sums over an interval are differences of running sums, the
least conversation is another range minimum, so a node needs no walk through its subtree.

The order is cut into tiles of bounded size. Nodes that end inside their tile are done there. A node
that reaches over the edge of a tile is a prefix of the tile's last conversation; each tile that it
touches gives one row of sums, and these are added up. A sparse table over the tiles' least LCPs
tells in which tile such a node starts. What the driver holds is three numbers a tile.

A turn is known by 128 bits of a SHA-256 of its role and text: texts stay out of the sort.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daytally.llm.mixing import word_count
from daytally.session import cut_lineage, scratch_path

TURN_BYTES = 16
BROADCAST_ROWS = 1_000_000
NOTHING = hashlib.sha256(b"").hexdigest()


@dataclass(frozen=True)
class Trie:
    """``tile`` conversations, or as many as ``tile_turns`` turns have, are worked on at once; ids of
    equal conversations travel in rows of ``ids``."""

    tile: int = 1 << 16
    tile_turns: int = 1 << 20
    ids: int = 512


class RangeMinimum:
    """Sparse table of the minima of all stretches whose length is a power of two."""

    def __init__(self, values: np.ndarray) -> None:
        self.size = len(values)
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= self.size:
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def least(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Least of the values first … end - 1, of two stretches that cover them."""
        level = np.frexp(end - first)[1] - 1
        out = np.empty(len(first), self.levels[0].dtype)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(self.levels[k][first[at]], self.levels[k][end[at] - (1 << int(k))])
        return out

    def right_end(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The first place after ``at`` whose value is below the depth, or the size."""
        reached = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            ahead = np.minimum(reached + 1, len(self.levels[k]) - 1)
            far = (reached + (1 << k) < self.size) & (self.levels[k][ahead] >= depth)
            reached[far] += 1 << k
        return reached + 1

    def left_end(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The last place up to ``at`` whose value is below the depth, or -1."""
        reached = at + 1
        for k in range(len(self.levels) - 1, -1, -1):
            back = reached - (1 << k)
            far = back >= 0
            far[far] = self.levels[k][back[far]] >= depth[far]
            reached[far] -= 1 << k
        return reached - 1


# --- sequences ---


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id and its turns in order: digest (hex) and words of each."""
    plain = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text"))
    said = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    digest = F.substring(F.sha2(said, 256), 1, 2 * TURN_BYTES)
    turns = plain.select("conv_id", F.struct(place.alias("at"), digest.alias("digest"), word_count(F.col("text")).cast("int").alias("words")).alias("t"))
    return turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))


def with_shared_heads(turns: DataFrame, base: Column, length: Column, longest: int) -> DataFrame:
    """Conversations whose first ``length`` turns (``longest`` at most) are those of conversation
    ``base`` in place of their own: all of its turns if it has fewer, none if there is no such."""
    turns = cut_lineage(turns)
    asked = turns.withColumns({"_base": base, "_length": length.cast("int")})
    heads = turns.select(F.col("conv_id").alias("_base"), F.slice("turns", 1, longest).alias("_head"))
    joined = asked.join(heads, "_base", "left")
    head = F.coalesce(F.slice("_head", F.lit(1), F.col("_length")), F.slice("turns", 1, 0))
    own = F.slice("turns", F.col("_length") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return joined.select("conv_id", F.concat(head, own).alias("turns"))


def sequences(turns: DataFrame) -> DataFrame:
    """conv_id, key (16 bytes a turn) and words, sorted by key and conv_id over all partitions and
    stored, with the number of the partition."""
    key = F.unhex(F.array_join(F.col("turns.digest"), ""))
    rows = turns.select("conv_id", key.alias("key"), F.col("turns.words").alias("words"))
    rows = rows.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    return cut_lineage(rows.withColumn("_part", F.spark_partition_id()))


# --- tiles ---


@dataclass(frozen=True)
class Tile:
    """Conversations that follow each other in the order. ``lcp`` of the first one is not set."""

    part: int
    number: int
    conv: np.ndarray
    keys: list[bytes]
    words: np.ndarray
    length: np.ndarray
    lcp: np.ndarray


def _tile(part: int, number: int, conv: list, keys: list[bytes], words: list) -> Tile:
    length = np.array([len(k) // TURN_BYTES for k in keys], np.int64)
    start = np.cumsum(length) - length
    turns = np.frombuffer(b"".join(keys), np.uint64).reshape(-1, 2)
    lcp = np.zeros(len(keys), np.int64)
    shorter = np.minimum(length[1:], length[:-1])
    same = np.flatnonzero(shorter > 0)
    while len(same):
        d = lcp[same[0] + 1]
        same = same[(turns[start[same + 1] + d] == turns[start[same] + d]).all(axis=1)]
        lcp[same + 1] += 1
        same = same[shorter[same] > d + 1]
    return Tile(part, number, np.array(conv, np.int64), keys, np.array(words, np.int64), length, lcp)


def tiles(batches: Iterator[pa.RecordBatch], trie: Trie) -> Iterator[Tile]:
    """Cuts a partition into tiles, the same ones whatever its batches are."""
    conv, keys, words, number, part = [], [], [], 0, 0
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("_part", "conv_id", "key", "words"))
        for part, one, key, said in zip(*columns, strict=True):
            conv.append(one)
            keys.append(key)
            words.extend(said)
            if len(conv) >= trie.tile or len(words) >= trie.tile_turns:
                yield _tile(part, number, conv, keys, words)
                conv, keys, words, number = [], [], [], number + 1
    if conv:
        yield _tile(part, number, conv, keys, words)


@dataclass(frozen=True)
class Edges:
    """For every tile in order: ``before``, the LCP of its first conversation with the one before
    (-1 for the very first), and the least of that and of all LCPs inside. ``first``: number of the
    first tile of each partition."""

    before: np.ndarray
    least: np.ndarray
    first: dict[int, int]


def tile_edges(rows: DataFrame, trie: Trie) -> Edges:
    """Neighbouring tiles compare their outermost conversations in Spark; numbers come back."""

    def summarize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in tiles(batches, trie):
            inside = int(tile.lcp[1:].min()) if len(tile.lcp) > 1 else int(tile.length[0])
            yield pa.RecordBatch.from_pydict(
                {"_part": pa.array([tile.part], pa.int32()), "tile": pa.array([tile.number], pa.int64()), "first": [tile.keys[0]], "last": [tile.keys[-1]], "inside": pa.array([inside], pa.int64())}
            )

    def common(last: pa.Array, first: pa.Array) -> pa.Array:
        pairs = zip(last.to_pylist(), first.to_pylist(), strict=True)
        return pa.array([-1 if a is None else int(_tile(0, 0, [0, 0], [a, b], []).lcp[1]) for a, b in pairs], pa.int64())

    found = rows.mapInArrow(summarize, "_part int, tile long, first binary, last binary, inside long")
    before = F.lag("last").over(Window.orderBy("_part", "tile"))  # two conversations a tile
    found = found.withColumn("_last", before).select("_part", "tile", "inside", F.arrow_udf(common, "long")("_last", "first").alias("before"))
    numbers = sorted(tuple(r) for r in found.collect())
    edge = np.array([r[3] for r in numbers], np.int64)
    inside = np.array([r[2] for r in numbers], np.int64)
    return Edges(edge, np.minimum(edge, inside), {part: i for i, (part, number, *_) in enumerate(numbers) if number == 0})


NODE = pa.schema(
    [
        ("kind", pa.int8()), ("tile", pa.int64()), ("depth", pa.int64()), ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()), ("parent_tile", pa.int64()),
        ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
        ("at", pa.int64()), ("ids", pa.binary()),
    ]
)
NODE_SQL = "kind tinyint, tile long, depth long, conv_id long, parent_conv_id long, parent_tile long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, at long, ids binary"
WHOLE, PART, IDS = 0, 1, 2


def _rows(kind: int, count: int, **columns: object) -> pa.RecordBatch:
    """Rows of one kind; columns that are not given are null."""
    arrays = [columns.get(f.name) if f.name != "kind" else np.full(count, kind) for f in NODE]
    return pa.RecordBatch.from_arrays([pa.nulls(count, f.type) if a is None else pa.array(a, f.type) for a, f in zip(arrays, NODE, strict=True)], schema=NODE)


def _joined(conv: np.ndarray) -> bytes:
    return ",".join(map(str, conv.tolist())).encode()


def tile_nodes(tile: Tile, number: int, edges: Edges, over: RangeMinimum, trie: Trie) -> Iterator[pa.RecordBatch]:
    """Nodes that start in the tile, and the tile's part of nodes that reach over its edges.

    A part is named by the tile and depth where its node starts: at most one node of each depth
    reaches over the end of a tile.
    """
    size, length, conv = len(tile.conv), tile.length, tile.conv
    before = int(edges.before[number])
    after = int(edges.before[number + 1]) if number + 1 < len(edges.before) else -1
    lcp = tile.lcp.copy()
    lcp[0] = before
    shared, ids = RangeMinimum(lcp), RangeMinimum(conv)
    start = np.cumsum(length) - length
    said = np.concatenate([[0], np.cumsum(tile.words)])
    zero = np.zeros(1, np.int64)
    own = said[start + length] - said[start]
    new = said[start + length] - said[start + np.maximum(lcp, 0)]
    leaf = (np.append(lcp[1:], after) < length).astype(np.int64)
    sum_own, sum_new, sum_leaf = (np.concatenate([zero, np.cumsum(x)]) for x in (own, new, leaf))

    # Prefixes that no conversation before has: one candidate for each node.
    many = length - lcp
    base = np.cumsum(many) - many
    at = np.repeat(np.arange(size), many)
    depth = lcp[at] + 1 + np.arange(len(at)) - base[at]
    end = shared.right_end(at, depth)
    crossing = (end == size) & (depth <= after)
    least = ids.least(at, end)
    above = said[start[at] + np.maximum(depth - 1, 0)] - said[start[at]]
    count = end - at
    saved = sum_own[end] - sum_own[at] - count * above - (sum_new[end] - sum_new[at + 1]) - (own[at] - above)
    leaves = sum_leaf[end] - sum_leaf[at]

    # Parents: the next shorter prefix of the same conversation, or, for the first new prefix, the
    # interval of the LCP, whose left end is searched as well. -1: it starts in an earlier tile.
    parent = np.arange(len(at)) - 1
    firsts = np.flatnonzero(depth == lcp[at] + 1)
    up = lcp[at[firsts]]
    left = shared.left_end(at[firsts], up)
    inside = left >= 0
    parent[firsts] = np.where(inside, base[left] + up - lcp[left] - 1, -1)
    children = np.bincount(parent[parent >= 0], minlength=len(at))
    open_children = np.bincount(up[~inside & (up >= 0)], minlength=before + 1)
    known = (parent >= 0) & ~crossing[parent]
    parent_conv = np.where(known, least[parent], 0)
    # Tiles where the nodes start that reach in from the left, by depth.
    depths = np.arange(before + 1)
    origin = over.left_end(np.full(before + 1, number - 1), depths)
    far = ~known & (depth > 0)
    parent_tile = np.full(len(at), number)
    outside = far & (parent < 0)
    parent_tile[outside] = origin[depth[outside] - 1]

    # Equal conversations stand side by side; only the first of them has the whole as a new prefix.
    stop = np.append(np.flatnonzero(lcp != length), size)
    last = stop[np.searchsorted(stop, at, "right")]
    ends = depth == length[at]
    done = np.flatnonzero(~crossing)
    digest = [hashlib.sha256(_joined(conv[at[i] : last[i]])).hexdigest() if ends[i] else NOTHING for i in done]
    yield _rows(
        WHOLE, len(done), tile=np.full(len(done), number), depth=depth[done], conv_id=least[done], parent_conv_id=pa.array(parent_conv[done], mask=~known[done]),
        parent_tile=pa.array(parent_tile[done], mask=~far[done]), n_convs=count[done], n_children=children[done], n_leaves=leaves[done], saved_tokens=saved[done], ends_sha256=digest,
    )
    more = np.flatnonzero(crossing)
    yield _rows(
        PART, len(more), tile=np.full(len(more), number), depth=depth[more], conv_id=least[more], parent_tile=pa.array(parent_tile[more], mask=~far[more]),
        n_convs=count[more], n_children=children[more], n_leaves=leaves[more], saved_tokens=saved[more],
    )
    if before >= 0:
        upto = shared.right_end(np.zeros(before + 1, np.int64), depths)
        above = said[start[0] + np.maximum(depths - 1, 0)] - said[start[0]]
        yield _rows(
            PART, before + 1, tile=origin, depth=depths, conv_id=ids.least(np.zeros(before + 1, np.int64), upto), n_convs=upto, n_children=open_children,
            n_leaves=sum_leaf[upto], saved_tokens=sum_own[upto] - upto * above - sum_new[upto],
        )
    pieces = [(number, int(depth[i]), int(at[i]), int(last[i])) for i in more if ends[i]]
    if before == length[0]:
        pieces.append((int(origin[before]), before, 0, int(stop[0])))
    for origin_, d, one, other in pieces:
        firsts_ = np.arange(one, other, trie.ids)
        held = [_joined(conv[i : min(i + trie.ids, other)]) for i in firsts_]
        # The order of the pieces of a node: by tile, then by place in the tile.
        yield _rows(IDS, len(held), tile=np.full(len(held), origin_), depth=np.full(len(held), d), at=number * (trie.tile + 1) + firsts_, ids=held)


def _few(df: DataFrame) -> DataFrame:
    """Hint to broadcast a stored table if it has few rows of a few numbers."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _digests(pieces: DataFrame) -> DataFrame:
    """SHA-256 of the ids of each node, in order. The digest of one node takes one task by its
    nature, but the ids pass through it as a stream."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"tile": pa.array([now[0]], pa.int64()), "depth": pa.array([now[1]], pa.int64()), "_sha": [state.hexdigest()]})

        now, state = None, hashlib.sha256()
        for batch in batches:
            for tile, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("tile", "depth", "ids")), strict=True):
                if (tile, depth) != now:
                    if now:
                        yield out()
                    now, state = (tile, depth), hashlib.sha256(ids)
                else:
                    state.update(b"," + ids)
        if now:
            yield out()

    ordered = pieces.select("tile", "depth", "at", "ids").repartition("tile", "depth").sortWithinPartitions("tile", "depth", "at")
    return ordered.mapInArrow(digest, "tile long, depth long, _sha string")


FIELDS = ["n_convs", "n_children", "n_leaves", "saved_tokens"]


def prefix_nodes(turns: DataFrame, trie: Trie = Trie()) -> DataFrame:
    """One row per node of the trie of conversations (conv_id, turns of digest and words).

    conv_id (the smallest member), depth, parent_conv_id (null for the root), n_convs (members),
    n_children, n_leaves, saved_tokens (over the subtree: members but one, times the words of the
    node's last turn) and ends_sha256 (of the members that end at the node). Conversations without
    turns are members of the root only; without any conversation there is no root. The digests of
    one conversation's turns have to fit in a task.
    """
    spark = turns.sparkSession
    rows = sequences(turns)
    edges = spark.sparkContext.broadcast(tile_edges(rows, trie))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = edges.value
        over = RangeMinimum(held.least)
        for tile in tiles(batches, trie):
            yield from tile_nodes(tile, held.first[tile.part] + tile.number, held, over, trie)

    path = scratch_path(spark, "prefixes")
    rows.mapInArrow(search, NODE_SQL).write.parquet(path)
    edges.destroy()
    found = spark.read.schema(NODE_SQL).parquet(path)
    sums = [F.sum(c).alias(c) for c in FIELDS]
    parts = found.where(F.col("kind") == PART).groupBy("tile", "depth").agg(F.min("conv_id").alias("conv_id"), F.max("parent_tile").alias("parent_tile"), *sums)
    parts = parts.join(_digests(found.where(F.col("kind") == IDS)), ["tile", "depth"], "left")
    crossing = cut_lineage(parts.withColumn("ends_sha256", F.coalesce("_sha", F.lit(NOTHING))).drop("_sha"))
    parents = crossing.select(F.col("tile").alias("parent_tile"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("_parent"))
    parents = _few(parents)
    whole = found.where(F.col("kind") == WHOLE)
    out = whole.select("conv_id", "depth", "parent_conv_id", "parent_tile", *FIELDS, "ends_sha256")
    out = out.unionByName(crossing.drop("tile"), allowMissingColumns=True).join(parents, ["parent_tile", "depth"], "left")
    return out.select("conv_id", "depth", F.coalesce("parent_conv_id", "_parent").alias("parent_conv_id"), *FIELDS, "ends_sha256")
