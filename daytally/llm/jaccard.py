"""Set-similarity join of documents on word shingles by chosen paths.

A path is a chain of shingles. At each step a text follows those of its shingles whose hash, seeded
by the path so far, falls below a share of its size, on average ``branching`` of them; texts that
share shingles choose the same ones. Texts with the same path meet in a bucket. Small buckets are
searched by brute force; larger ones are split by the next step. Independent runs repeat this until
the target recall: at the threshold, a pair meets in one run with the probability that a branching
process survives, from which the number of runs follows.

Texts with equal shingle sets are one node from the start, so copies never meet each other. In a
bucket texts are compared by small sketches, and a spanning forest of the near ones connects them to
clusters. Inside a cluster every pair is compared by whole shingle sets, and counts and a forest of
the links are kept, not the pairs. Large buckets and clusters are worked on in tiles of bounded
size, so nothing is dropped.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daytally.llm.components import connected_components, release
from daytally.llm.order import fresh_name
from daytally.llm.text import PIECE, SHINGLE, SIMILARITY, U, grouped, mix, shingle_hashes, signed, texts_of, word_hashes
from daytally.session import cut_lineage, scratch_path

BROADCAST_ROWS = 1_000_000


@dataclass(frozen=True)
class Join:
    threshold: float = SIMILARITY
    shingle: int = SHINGLE
    branching: float = 1.25
    depth: int = 3
    bucket: int = 64
    part: int = 512
    part_tokens: int = 150_000
    recall: float = 0.999
    sketch: int = 64
    sketch_slack: float = 0.25
    seed: int = 3

    def runs(self) -> int:
        """Runs after which a pair at the threshold was missed with 1 - recall at most."""
        overlap = 2 * self.threshold / (1 + self.threshold)
        alive = 1.0
        for _ in range(self.depth):
            alive = 1 - math.exp(-self.branching * overlap * alive)
        return math.ceil(math.log(1 - self.recall) / math.log(1 - alive))


def _paths(tokens: np.ndarray, join: Join, runs: int) -> tuple[np.ndarray, ...]:
    """Step, run, path before and path of all chosen paths of a set of shingles."""
    limit = np.uint32(min(2**32 - 1, int(join.branching / len(tokens) * 2**32)))
    short = (tokens >> U(32)).astype(np.uint32)  # enough to choose by; paths keep all bits
    paths = mix(np.arange(runs, dtype=np.uint64) + U(join.seed * 1_000_003))
    run = np.arange(runs, dtype=np.int16)
    out = []
    for step in range(1, join.depth + 1):
        if not len(paths):
            break
        before, after, own = [], [], []
        # A bounded number of hashes at once, however long the text.
        width = max(1, (1 << 20) // len(tokens))
        for at in range(0, len(paths), width):
            some = paths[at : at + width]
            seeds = (some >> U(32)).astype(np.uint32)[:, None]
            low = (short[None, :] ^ seeds) * (seeds | np.uint32(1)) <= limit
            row, column = np.divmod(np.flatnonzero(low), len(tokens))
            before.append(some[row])
            own.append(run[at + row])
            after.append(mix(tokens[column] * U(3) + some[row]))
        old, paths, run = np.concatenate(before), np.concatenate(after), np.concatenate(own)
        out.append((np.full(len(paths), step, np.int32), run, signed(old), signed(paths)))
    return tuple(np.concatenate(column) for column in zip(*out, strict=True))


def _sketch(tokens: np.ndarray, size: int) -> bytes:
    """One byte each of ``size`` min-hashes."""
    short = (tokens >> U(32)).astype(np.uint32)
    seeds = mix(np.arange(size, dtype=np.uint64) + U(77)).astype(np.uint32)
    best = np.full(size, np.uint32(2**32 - 1))
    for first in range(0, size, 16):
        few = seeds[first : first + 16, None]
        for at in range(0, len(short), 1 << 14):
            found = ((short[None, at : at + (1 << 14)] ^ few) * (few | np.uint32(1))).min(axis=1)
            best[first : first + 16] = np.minimum(best[first : first + 16], found)
    out = (mix(best.astype(np.uint64)) >> U(56)).astype(np.uint8)
    return out.tobytes()


def shingle_sets(texts: list[str], k: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; empty without words."""
    for first, last in grouped(texts, PIECE):
        hashes, bounds = shingle_hashes(*word_hashes(texts[first:last]), k, short=True)
        for i in range(last - first):
            yield np.unique(hashes[bounds[i] : bounds[i + 1]])


def set_number(tokens: np.ndarray) -> int | None:
    """64 bits that name a shingle set; None for none."""
    if not len(tokens):
        return None
    return int(signed(mix(np.add.reduce(mix(tokens + U(5)), keepdims=True) + U(len(tokens))))[0])


def described(docs: DataFrame, join: Join) -> DataFrame:
    """_row, doc_id, set, size, sketch and nodes of every document; set is null without words."""
    runs = join.runs()
    none = (np.zeros(0, np.int32), np.zeros(0, np.int16), np.zeros(0, np.int64), np.zeros(0, np.int64))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                sets, sizes, sketches, nodes = [], [], [], []
                for tokens in shingle_sets(texts_of(part.column("text")), join.shingle):
                    sets.append(set_number(tokens))
                    sizes.append(len(tokens))
                    sketches.append(_sketch(tokens, join.sketch) if len(tokens) else None)
                    nodes.append(_paths(tokens, join, runs) if len(tokens) else none)
                ends = np.cumsum([0, *(len(n[0]) for n in nodes)]).astype(np.int32)
                flat = pa.StructArray.from_arrays([np.concatenate(c) for c in zip(none, *nodes, strict=True)], names=["step", "run", "before", "path"])
                yield pa.RecordBatch.from_arrays(
                    [part.column("_row"), part.column("doc_id"), pa.array(sets, pa.int64()), pa.array(sizes, pa.int32()), pa.array(sketches, pa.binary()), pa.ListArray.from_arrays(ends, flat)],
                    names=["_row", "doc_id", "set", "size", "sketch", "nodes"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"_row long, doc_id {kind}, set long, size int, sketch binary, nodes array<struct<step:int,run:smallint,before:long,path:long>>"
    return docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", "text").mapInArrow(describe, schema)


def spanning(size: int, alike: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a similarity graph on 0 … size-1.

    ``alike(i, others)`` tells which of the others are similar to i. Every node asks once, about
    those not reached yet, so a group of copies takes one question.
    """
    edges, rest = [], np.arange(size)
    while len(rest):
        found, rest = [rest[0]], rest[1:]
        while found and len(rest):
            i = found.pop()
            near = alike(i, rest)
            edges += [(int(i), int(x)) for x in rest[near]]
            found += rest[near].tolist()
            rest = rest[~near]
    return edges


def _bucket_edges(join: Join):
    """Arrow function: a bucket's texts to a spanning forest of the pairs whose sizes and sketches
    allow the threshold."""
    needed = (join.threshold - join.sketch_slack) * join.sketch

    def search(column: pa.Array) -> pa.Array:
        out = []
        flat = column.flatten()
        sets, sizes = flat.field("set").to_numpy(), flat.field("size").to_numpy().astype(np.int64)
        sketches = np.frombuffer(b"".join(flat.field("sketch").to_pylist()), np.uint8).reshape(len(sets), join.sketch)
        ends = np.cumsum([len(x) for x in column])
        for first, last in zip(np.concatenate([[0], ends[:-1]]), ends, strict=True):
            own, size, sketch = sets[first:last], sizes[first:last], sketches[first:last]

            def alike(i: int, others: np.ndarray) -> np.ndarray:
                fits = np.minimum(size[others], size[i]) >= join.threshold * np.maximum(size[others], size[i])
                fits[fits] = (sketch[others[fits]] == sketch[i]).sum(axis=1) >= needed
                return fits

            out.append([{"a": own[i], "b": own[j]} for i, j in spanning(len(own), alike)])
        return pa.array(out, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))

    return F.arrow_udf(search, "array<struct<a:long,b:long>>")


def _meetings(sets: DataFrame, runs: Column, groups: DataFrame | None, join: Join) -> DataFrame:
    """Edges (a, b) of sets that meet in a bucket of the chosen runs with sketches near enough.

    With ``groups`` (node, component) of sets that are connected already, only buckets where several
    groups meet are searched. A bucket gives fewer edges than it has texts.
    """
    nodes = sets.select("set", F.explode("nodes").alias("n")).where(runs).select("set", "n.step", "n.before", "n.path")
    if groups is None:
        nodes = nodes.withColumn("group", F.col("set"))
    else:
        named = groups.select(F.col("node").alias("set"), "component")
        nodes = nodes.join(F.broadcast(named) if named.count() <= BROADCAST_ROWS else named, "set", "left")
        nodes = nodes.withColumn("group", F.coalesce("component", "set")).drop("component")
    sketches = sets.select("set", "size", "sketch")
    search = _bucket_edges(join)
    found, parents = None, None

    def searched(members: DataFrame, *key: str) -> DataFrame:
        lists = members.join(sketches, "set").groupBy(*key).agg(F.collect_list(F.struct("set", "size", "sketch")).alias("_in"))
        return lists.select(F.explode(search("_in")).alias("p")).select("p.a", "p.b")

    for step in range(1, join.depth + 1):
        here = nodes.where(F.col("step") == step)
        # A path has one path before it: its bucket's parent is looked up once, not once a text.
        counted = here.groupBy("path").agg(F.count("*").alias("n"), F.min("before").alias("before"), F.min("group").alias("_lo"), F.max("group").alias("_hi"))
        counted = counted.where("n > 1 and _lo <> _hi").select("path", "before", "n")
        if parents is not None:
            counted = counted.join(parents, "before", "left_semi")
        counted = cut_lineage(counted.select("path", "n"))
        members = here.join(counted, "path").select("path", "set", "n")
        # Edges are few: with them written, the step's shuffle files can go before the next step's come.
        edges = cut_lineage(searched(members.where(F.col("n") <= join.bucket), "path"))
        release(sets.sparkSession)
        found = edges if found is None else found.union(edges)
        parents = counted.where(F.col("n") > join.bucket).select(F.col("path").alias("before"))
    # What is still large: tiles of two parts each, by hash.
    large = members.where(F.col("n") > join.bucket).select("path", "set", F.ceil(F.col("n") / join.part).alias("_parts"))
    return found.union(searched(tiled(large, "set", join.seed), "path", "_i", "_j")).distinct()


def candidate_edges(sets: DataFrame, join: Join) -> DataFrame:
    """Edges (a, b) that connect all sets which met in a bucket with sketches near enough.

    ``sets`` has one row per different set. The first run connects what belongs together in the
    main. As all pairs of a group are compared in the end, the other runs need not look into buckets
    that hold sets of one group only, such as those of a large group of near copies.
    """
    run = F.col("n.run")
    first = cut_lineage(_meetings(sets, run == 0, None, join))
    groups = cut_lineage(connected_components(first))
    release(sets.sparkSession)
    return first.union(_meetings(sets, run > 0, groups, join))


def tiled(rows: DataFrame, key: str, seed: int) -> DataFrame:
    """Deals rows with ``_parts`` parts by the hash of their key, each row to every pair of parts
    (_i, _j) that has its own; ``_own`` is that."""
    dealt = rows.withColumn("_own", F.pmod(F.xxhash64(key, F.lit(seed)), F.col("_parts")))
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)))
    return dealt.withColumns({"_i": F.least("_own", "_other"), "_j": F.greatest("_own", "_other")})


def exact_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(set, tokens) for the rows (_row, set) of ``wanted``, from their whole texts."""
    numbered = docs.select(F.monotonically_increasing_id().alias("_row"), "text")
    few = wanted.count() <= BROADCAST_ROWS
    rows = numbered.join(F.broadcast(wanted) if few else wanted, "_row")

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                sets = [s.tobytes() for s in shingle_sets(texts_of(part.column("text")), k)]
                yield pa.RecordBatch.from_arrays([part.column("set"), pa.array(sets, pa.binary())], names=["set", "tokens"])

    return rows.select("set", "text").mapInArrow(tokens, "set long, tokens binary")


RESULT = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])


def _compare(join: Join):
    """A tile's texts to their numbers of similar documents (a, null, n) and to a spanning forest of
    the similar pairs (a, b, 0), by whole shingle sets. Pairs inside a part count in its own tile."""

    def compare(table: pa.Table) -> pa.Table:
        sets, copies = table.column("set").to_numpy(), table.column("copies").to_numpy()
        part, alone = table.column("_own").to_numpy(), table.column("_i")[0] == table.column("_j")[0]
        tokens = [np.frombuffer(t, np.uint64) for t in table.column("tokens").to_pylist()]
        size = np.array([len(t) for t in tokens])
        names, inverse = np.unique(np.concatenate(tokens), return_inverse=True)
        starts = np.cumsum(size) - size
        held = np.zeros(len(names), np.int32)
        similar = np.zeros((len(sets), len(sets)), bool)
        for i, n in enumerate(size):
            own = inverse[starts[i] : starts[i] + n]
            held[own] = 1
            common = np.add.reduceat(held[inverse], starts)
            held[own] = 0
            similar[i] = (common >= join.threshold * (size + n - common)) & (part != part[i] if not alone else True)
            similar[i, i] = False
        near = similar @ copies
        edges = spanning(len(sets), lambda i, others: similar[i, others])
        some = np.flatnonzero(near)
        a = np.concatenate([sets[some], sets[[i for i, _ in edges]]]) if edges else sets[some]
        b = [None] * len(some) + [int(sets[j]) for _, j in edges]
        n = near[some].tolist() + [0] * len(edges)
        return pa.Table.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())], schema=RESULT)

    return compare


def similar_sets(docs: DataFrame, join: Join = Join()) -> tuple[DataFrame, DataFrame]:
    """(found, members): members give every document's shingle set; found has, for sets that are
    similar to others, the number of similar documents (a, null, n), and enough of the links
    (a, b, 0) to connect all that are linked. ``docs`` is read twice and has to give the same rows in
    the same order each time, as a stored table does.

    Sets that buckets connect make up clusters. A cluster is compared pair by pair on whole sets,
    in tiles of two parts of bounded size; each pair meets in one tile, and no tile gives more rows
    than it has texts, or twice as many.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "jaccard")
    described(docs, join).write.parquet(path)
    rows = spark.read.parquet(path)
    members = rows.select("_row", "doc_id", "set")
    first = rows.where("set is not null").groupBy("set").agg(F.min("_row").alias("_row"), F.count("*").alias("copies"))
    first = cut_lineage(first)
    one_each = rows.drop("set", "doc_id").join(first, "_row")
    edges = cut_lineage(candidate_edges(one_each, join))
    release(spark)
    clusters = cut_lineage(connected_components(edges))
    release(spark)
    used = clusters.join(first, clusters["node"] == first["set"]).select("_row", "set", "copies", "component")
    tokens_path = scratch_path(spark, "jaccard-sets")
    exact_sets(docs, used.select("_row", "set"), join.shingle).write.parquet(tokens_path)
    tokens = spark.read.parquet(tokens_path).withColumn("_size", F.expr("octet_length(tokens) div 8"))
    full = tokens.select("set", "_size").join(used, "set")
    parts = F.greatest(F.ceil(F.sum("_size") / join.part_tokens), F.ceil(F.count("*") / join.part)).alias("_parts")
    placed = full.join(full.groupBy("component").agg(parts), "component").select("component", "set", "copies", "_parts")
    dealt = tiled(placed, "set", join.seed).join(tokens.select("set", "tokens"), "set")
    found = dealt.groupBy("component", "_i", "_j").applyInArrow(_compare(join), "a long, b long, n long")
    found = cut_lineage(found)
    release(spark)
    return found, members


def near_duplicates(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """doc_id, class_id, n_links and n_copies of every row.

    A class is a connected component of links; its id is the least doc_id in it. ``n_links`` is the
    number of other rows whose similarity reaches the threshold, ``n_copies`` of those with an equal
    shingle set. A text under five words has one shingle of all its words. A text without words
    (null, empty, punctuation) has no links and is a class of its own.
    """
    found, members = similar_sets(docs, join)
    copies = members.where("set is not null").groupBy("set").agg(F.count("*").alias("_n"), F.min("doc_id").alias("_least"))
    near = found.where("b is null").groupBy("a").agg(F.sum("n").alias("_near"))
    parts = cut_lineage(connected_components(found.where("b is not null").select("a", "b")))
    per_set = copies.join(parts, copies["set"] == parts["node"], "left").join(near, copies["set"] == near["a"], "left")
    per_set = per_set.select("set", "_n", "_near", "_least", F.coalesce("component", "set").alias("_part"))
    least = per_set.groupBy("_part").agg(F.min("_least").alias("class_id"))
    per_set = per_set.join(least, "_part").select("set", "class_id", "_n", F.coalesce("_near", F.lit(0)).alias("_near"))
    out = members.join(per_set, "set", "left")
    copied = F.coalesce(F.col("_n") - 1, F.lit(0))
    return out.select(
        "doc_id",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        (copied + F.coalesce("_near", F.lit(0))).alias("n_links"),
        copied.alias("n_copies"),
    )


def one_of_each(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """One row of each class: the one whose doc_id is the least, rows without words all stay.

    Of several rows with that doc_id in a class the first read stays.
    """
    found, members = similar_sets(docs, join)
    parts = cut_lineage(connected_components(found.where("b is not null").select("a", "b")))
    found = members.where("set is not null").join(parts, members["set"] == parts["node"], "left")
    key = F.coalesce("component", "set").alias("_part")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("_no"), "doc_id", "_row")).alias("_best")
    kept = found.groupBy(key).agg(best).select("_best._row")
    kept = kept.union(members.where("set is null").select("_row"))
    row = fresh_name(docs, "_row")
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    return numbered.join(kept.withColumnRenamed("_row", row), row, "left_semi").select(*docs.columns)
