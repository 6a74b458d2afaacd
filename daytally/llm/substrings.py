"""Near-duplicate passages of documents by compact windows.

A text is the sequence of its word shingles. For one hash function, all stretches of it that have
their min-hash at the same place form a compact window (first start, place, last end); the windows
are the nodes of the Cartesian tree over the hashes, and only windows at least as wide as a passage
count, about two per passage width. Stretches with equal min-hashes share a window key, so a passage
that two texts have in common gives both of them windows with equal keys, for every hash function.

Windows meet by key, first with their neighbours in two orders: by what follows the min-hash, and by
what stands before it. Whoever agrees with a text over the longest stretch on that side stands next to
it. Anchors of a pair of texts whose intervals overlap are joined to runs, and a run is verified on the
shingles: a passage stands where a stretch of the least width reaches the similarity. Edits that move
what follows them are found by the several shifts of a run.

All other partners of a crowded key are compared in ``daytally.llm.crowds``: windows that are equal as
far as a passage around the min-hash reaches are one class, and all pairs of classes are compared.

Texts with the same words in order are one text from the start.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daytally.llm.components import connected_components, release
from daytally.llm.crowds import class_passages, crowded_windows, merged_spans
from daytally.llm.text import SHINGLE, SIMILARITY, U, grouped, mix, shingle_hashes, signed, stretch_hashes, texts_of, word_hashes
from daytally.session import cut_lineage, drop_path, scratch_path

BATCH = 1 << 19  # code points of texts whose trees grow together
BROADCAST_ROWS = 500_000
ROWS = 256  # pairs unpacked at once


@dataclass(frozen=True)
class Passages:
    words: int = 50
    shingle: int = SHINGLE
    similarity: float = SIMILARITY
    hashes: int = 3
    seed: int = 9

    @property
    def width(self) -> int:
        """Shingles of the shortest passage."""
        return self.words - self.shingle + 1

    @property
    def common(self) -> int:
        """Common shingles by which two stretches of that width reach the similarity."""
        return int(np.ceil(2 * self.width * self.similarity / (1 + self.similarity) - 1e-9))


def compact_windows(hashes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first start, place of the least hash, last end) of all windows of ``width`` at least.

    ``bounds`` are those of the texts in ``hashes`` (32 bits). All Cartesian trees grow by one level
    at a time; equal hashes count in order of their places.
    """
    keyed = (hashes.astype(np.uint64) << U(32)) | np.arange(len(hashes), dtype=np.uint64)
    keyed = np.append(keyed, U(2**64 - 1))
    low, high = bounds[:-1], bounds[1:]
    wide = high - low >= width
    low, high = low[wide], high[wide]
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(low):
        edges = np.empty(2 * len(low), np.int64)
        edges[0::2], edges[1::2] = low, high
        least = np.minimum.reduceat(keyed, edges)[0::2]
        place = (least & U(2**32 - 1)).astype(np.int64)
        out.append((low, place, high - 1))
        low, high = np.concatenate([low, place + 1]), np.concatenate([place, high])
        wide = high - low >= width
        low, high = low[wide], high[wide]
        order = np.argsort(low, kind="stable")
        low, high = low[order], high[order]
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate([none, *(x[i] for x in out)]) for i in range(3))


def text_numbers(shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """64 bits that name the sequence of shingles of each text."""
    place = np.arange(len(shingles)) - np.repeat(bounds[:-1], np.diff(bounds))
    total = np.concatenate([[U(0)], np.cumsum(mix(shingles + mix(place.astype(np.uint64) + U(3))))])
    return signed(mix(total[bounds[1:]] - total[bounds[:-1]] + np.diff(bounds).astype(np.uint64)))


def contexts(shingles: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each shingle a number by which to sort what follows it, and one for what stands before it:
    ten bits each of hashes of 8, 16 and 32 shingles, itself included. Nothing stands beyond a text."""
    out = []
    place = np.arange(len(shingles))
    sizes = np.diff(bounds)
    ends, starts = np.repeat(bounds[1:], sizes), np.repeat(bounds[:-1], sizes)
    for step, inside in ((1, lambda k: place + k < ends), (-1, lambda k: place - k >= starts)):
        value, order = mix(shingles + U(9)), np.zeros(len(shingles), np.int32)
        for k in (1, 2, 4, 8, 16):
            beyond = np.zeros(len(shingles), np.uint64)
            at = np.flatnonzero(inside(k))
            beyond[at] = value[at + step * k]
            value = mix(value * U(3) + beyond)
            if k >= 4:
                order = (order << 10) | (value >> U(54)).astype(np.int32)
        out.append(order)
    return out[0], out[1]


WINDOW_SQL = "array<struct<key:long,c:int,l:int,r:int,after:int,before:int,core:int>>"


def described(docs: DataFrame, passages: Passages) -> DataFrame:
    """_row, doc_id, text (number), n (shingles) and windows of every document that is long enough."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column("text"))
            for first, last in grouped(texts, BATCH):
                shingles, bounds = shingle_hashes(*word_hashes(texts[first:last]), passages.shingle)
                numbers = text_numbers(shingles, bounds)
                after, ahead = contexts(shingles, bounds)
                found = []
                for f in range(passages.hashes):
                    seed = mix(np.array([passages.seed * 1000 + f], np.uint64))[0]
                    low, place, high = compact_windows((mix(shingles ^ seed) >> U(32)).astype(np.uint32), bounds, passages.width)
                    found.append((low, place, high, signed(mix(shingles[place] + seed))))
                low, place, high, key = (np.concatenate(x) for x in zip(*found, strict=True))
                owner = np.searchsorted(bounds, place, "right") - 1
                order = np.argsort(owner, kind="stable")
                base = bounds[owner[order]]
                left, right = np.minimum(place - low, passages.width - 1), np.minimum(high - place, passages.width - 1)
                core = stretch_hashes(shingles, place - left, place + right + 1) + (left * 2 * passages.width + right).astype(np.uint64)
                flat = pa.StructArray.from_arrays(
                    [
                        pa.array(key[order]), *(pa.array((x[order] - base).astype(np.int32)) for x in (place, low, high)),
                        *(pa.array(x[place[order]]) for x in (after, ahead)), pa.array((mix(core[order]) >> U(32)).astype(np.uint32).view(np.int32)),
                    ],
                    names=["key", "c", "l", "r", "after", "before", "core"],
                )
                ends = np.searchsorted(owner[order], np.arange(last - first + 1)).astype(np.int32)
                part = batch.slice(first, last - first)
                rows = pa.RecordBatch.from_arrays(
                    [part.column("_row"), part.column("doc_id"), pa.array(numbers), pa.array(np.diff(bounds).astype(np.int32)), pa.ListArray.from_arrays(ends, flat)],
                    names=["_row", "doc_id", "text", "n", "windows"],
                )
                yield rows.filter(pa.array(np.diff(bounds) >= passages.width))

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", "text")
    return rows.mapInArrow(describe, f"_row long, doc_id {kind}, text long, n int, windows {WINDOW_SQL}")


def _few(df: DataFrame) -> DataFrame:
    """Hint to broadcast a stored table if it has few rows of a few numbers."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def candidate_runs(windows: DataFrame, passages: Passages) -> DataFrame:
    """(a, b, a_from, a_to, b_from, b_to, shifts): stretches of two texts around common keys.

    One exchange brings the windows of a key together, sorted once for each of the two orders. Keys
    of one text give no pair. Partners that are no neighbours are met in ``class_passages``.
    """
    place = F.struct("text", "c", "l", "r")
    by_key = Window.partitionBy("key")
    others = [F.lag(place).over(by_key.orderBy(*order, "text", "c")) for order in (("after", "before"), ("before", "after"))]
    least = F.lit(int(passages.width * passages.similarity))
    met = windows.withColumns({"_p": F.filter(F.array_distinct(F.array(*others)), lambda o: o["text"] != F.col("text"))}).where(F.size("_p") > 0)
    met = met.select(place.alias("x"), F.explode("_p").alias("y"))
    turned = F.col("x.text") > F.col("y.text")
    pairs = met.select(F.when(turned, F.col("y")).otherwise(F.col("x")).alias("p"), F.when(turned, F.col("x")).otherwise(F.col("y")).alias("o"))
    left, right = F.least(F.expr("p.c - p.l"), F.expr("o.c - o.l")), F.least(F.expr("p.r - p.c"), F.expr("o.r - o.c"))
    pairs = pairs.where(left + right + 1 >= least)
    anchors = pairs.select(
        F.col("p.text").alias("a"), F.col("o.text").alias("b"), (F.col("p.c") - left).alias("s"), (F.col("p.c") + right).alias("e"),
        F.col("o.l").alias("bl"), F.col("o.r").alias("br"), F.expr("p.c - o.c").alias("shift"),
    )
    by_pair = Window.partitionBy("a", "b").orderBy("s", "e", "shift")
    before = F.max("e").over(by_pair.rowsBetween(Window.unboundedPreceding, -1))
    marked = anchors.withColumn("_new", F.when(F.col("s") <= before, 0).otherwise(1))
    marked = marked.withColumn("_run", F.sum("_new").over(by_pair.rowsBetween(Window.unboundedPreceding, 0)))
    runs = marked.groupBy("a", "b", "_run").agg(
        F.min("s").alias("a_from"), F.max("e").alias("a_to"), F.min("bl").alias("b_from"), F.max("br").alias("b_to"),
        F.collect_set("shift").alias("shifts"),
    )
    return runs.drop("_run")


def stretches(docs: DataFrame, wanted: DataFrame, passages: Passages) -> DataFrame:
    """(text, lo, hi, shingles) for the stretches of ``wanted`` (_row, text, ranges), from whole texts;
    four bytes of each shingle's hash."""
    numbered = docs.select(F.monotonically_increasing_id().alias("_row"), F.col("text").alias("_said"))
    rows = numbered.join(_few(cut_lineage(wanted)), "_row")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column("_said"))
            numbers = batch.column("text")
            for first, last in grouped(texts, BATCH):
                ranges = batch.column("ranges").slice(first, last - first).to_pylist()
                shingles, bounds = shingle_hashes(*word_hashes(texts[first:last]), passages.shingle)
                out: tuple[list, ...] = ([], [], [], [])
                for i in range(last - first):
                    own = (shingles[bounds[i] : bounds[i + 1]] >> U(32)).astype(np.uint32)
                    for r in ranges[i]:
                        for column, value in zip(out, (numbers[first + i].as_py(), r["lo"], r["hi"], own[r["lo"] : r["hi"] + 1].tobytes()), strict=True):
                            column.append(value)
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["text", "lo", "hi", "shingles"])

    return rows.select("_said", "text", "ranges").mapInArrow(cut, "text long, lo int, hi int, shingles binary")


def alike(a: np.ndarray, b: np.ndarray, shifts: list[int], passages: Passages) -> tuple[list, list]:
    """Stretches of ``a`` and of ``b`` that reach the similarity, as (start, end) of shingles.

    ``shifts`` are places in ``a`` minus places in ``b`` at which they are laid side by side.
    """
    same_a, same_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    for shift in shifts:
        start, end = max(0, shift), min(len(a), len(b) + shift)
        if start < end:
            same = a[start:end] == b[start - shift : end - shift]
            same_a[start:end] |= same
            same_b[start - shift : end - shift] |= same
    return _dense(same_a, passages), _dense(same_b, passages)


def _dense(same: np.ndarray, passages: Passages) -> list[tuple[int, int]]:
    """Union of the stretches of the least width that hold enough common shingles."""
    if len(same) < passages.width:
        return []
    total = np.concatenate([[0], np.cumsum(same)])
    starts = np.flatnonzero(total[passages.width :] - total[: -passages.width] >= passages.common)
    if not len(starts):
        return []
    breaks = np.flatnonzero(np.diff(starts) > passages.width)
    firsts, lasts = starts[np.concatenate([[0], breaks + 1])], starts[np.concatenate([breaks, [len(starts) - 1]])]
    return list(zip(firsts.tolist(), (lasts + passages.width).tolist(), strict=True))


def verified(compared: DataFrame, passages: Passages) -> DataFrame:
    """(a, b, _in_a, _in_b): stretches of both texts that reach the similarity, for the pairs that have any.

    A filter over a function's result would be moved below and run the function twice, in two Python
    processes a core. The function leaves the other pairs out itself, and unpacks ``ROWS`` rows at a time.
    """
    span = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))
    kinds = (pa.int64(), pa.int64(), span, span)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                out: tuple[list, ...] = ([], [], [], [])
                for row in zip(*(column.to_pylist() for column in batch.slice(first, ROWS).columns), strict=True):
                    a, b, x, y, p, q, moved = row
                    left, right = alike(np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32), [m - p + q for m in moved], passages)
                    if left:
                        values = a, b, [{"s": s + p, "e": e + p} for s, e in left], [{"s": s + q, "e": e + q} for s, e in right]
                        for column, value in zip(out, values, strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["a", "b", "_in_a", "_in_b"])

    kind = "array<struct<s:int,e:int>>"
    rows = compared.select("a", "b", "_a", "_b", "a_from", "b_from", "shifts")
    return rows.mapInArrow(verify, f"a long, b long, _in_a {kind}, _in_b {kind}")


def repeated_passages(docs: DataFrame, passages: Passages = Passages()) -> DataFrame:
    """doc_id, start_word, end_word (exclusive), n_words and class_id of every repeated passage.

    A row for each stretch of at least ``words`` words that another document has too, with the given
    similarity of shingles on any stretch of that length; overlapping stretches are one. Copies of a
    text repeat as a whole. Documents that share passages directly or through others form a class,
    named by its least doc_id. Texts under the length (null and empty ones too) have no passages.
    ``docs`` is read twice and has to give the same rows in the same order, as a stored table does.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "windows")
    described(docs, passages).write.parquet(path)
    rows = spark.read.parquet(path)
    members = cut_lineage(rows.select("doc_id", "text", "n", "_row"))
    first = members.groupBy("text").agg(F.min("_row").alias("_row"), F.count("*").alias("_copies"), F.min("doc_id").alias("_least"), F.max("n").alias("n"))
    first = cut_lineage(first)
    # One row of each text is enough. Copies do no harm to the pairs, so they stay where leaving them
    # out would take a shuffle.
    windows = rows.select("_row", "text", "windows")
    if first.count() <= BROADCAST_ROWS:
        windows = windows.join(F.broadcast(first.select("_row")), "_row", "left_semi")
    windows = windows.select("text", F.explode("windows").alias("w")).select("text", "w.*")
    more, linked = class_passages(docs, crowded_windows(windows), first, passages)
    release(spark)
    runs_path = scratch_path(spark, "runs")
    candidate_runs(windows, passages).write.parquet(runs_path)
    drop_path(spark, path)
    release(spark)
    runs = spark.read.parquet(runs_path)
    sides = runs.select(F.col("a").alias("text"), F.col("a_from").alias("lo"), F.col("a_to").alias("hi"))
    sides = sides.union(runs.select("b", "b_from", "b_to")).distinct()
    ranges = sides.groupBy("text").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    parts_path = scratch_path(spark, "stretches")
    stretches(docs, ranges.join(first, "text").select("_row", "text", "ranges"), passages).write.parquet(parts_path)
    # The search's shuffle files are free by now at the latest: its last events are through.
    release(spark)
    parts = spark.read.parquet(parts_path)
    ours = parts.select(F.col("text").alias("a"), F.col("lo").alias("a_from"), F.col("hi").alias("a_to"), F.col("shingles").alias("_a"))
    theirs = parts.select(F.col("text").alias("b"), F.col("lo").alias("b_from"), F.col("hi").alias("b_to"), F.col("shingles").alias("_b"))
    compared = runs.join(ours, ["a", "a_from", "a_to"]).join(theirs, ["b", "b_from", "b_to"])
    checked = cut_lineage(verified(compared, passages))
    drop_path(spark, runs_path)
    drop_path(spark, parts_path)
    found = checked.select(F.col("a").alias("text"), F.explode("_in_a").alias("p")).union(checked.select("b", F.explode("_in_b")))
    whole = first.where("_copies > 1").select("text", F.struct(F.lit(0).alias("s"), F.col("n").alias("e")).alias("p"))
    found = found.union(whole).select("text", "p.s", "p.e").union(more).distinct()
    merged = merged_spans(found)
    classes = cut_lineage(connected_components(checked.select("a", "b").union(linked)))
    named = first.join(classes, first["text"] == classes["node"], "left").select("text", "_least", F.coalesce("component", "text").alias("_part"))
    least = named.groupBy("_part").agg(F.min("_least").alias("class_id"))
    named = named.join(least, "_part").select("text", "class_id")
    extra = passages.shingle - 1
    out = members.drop("n", "_row").join(merged, "text").join(named, "text")
    return out.select("doc_id", F.col("s").alias("start_word"), (F.col("e") + extra).alias("end_word"), (F.col("e") + extra - F.col("s")).alias("n_words"), "class_id")
