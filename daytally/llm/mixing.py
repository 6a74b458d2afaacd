"""Mixing sources to target weights by fixed-length blocks.

The words of a source, its documents in pseudorandom order, form one stream that is packed into
blocks of a fixed length; what is left over makes a shorter last block. A source's target decides how
many words the mix takes: as many whole rounds of all blocks as fit, and of one more round the first
blocks, the last of them cut, so that targets are met to the word. The full blocks of a round come in
the order of a pseudorandom permutation, another one each round, the shorter block at its end.

Slots are spread over the output shards by multinomial draws. Drawing the sources of each shard and
then settling the totals, so that every target is met, is the same as drawing the shard of each slot
source by source, which is what is done: counts of a shard are multinomial given its size, and sizes
differ as draws do. Slots and blocks meet in a join on the block number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daytally.llm.order import fresh_name, with_position
from daytally.llm.text import U, mix, texts_of
from daytally.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
SPACES = (9, 10, 11, 12, 13, 32)


@dataclass(frozen=True)
class Mix:
    """``weights`` repeat over the sources in code point order, null last. The mix has ``share``
    times all words; a source gives at most ``limit`` times its own. ``slot_rows`` slots, about, are
    made in a task."""

    weights: tuple[int, ...] = (3, 1, 2)
    share: float = 1.5
    limit: float = 2.0
    block: int = 128
    shard_blocks: int = 8192
    chunk_rows: int = 20_000
    slot_rows: int = 500_000
    seed: int = 11


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\x09-\\x0D]++")), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, mixture: Mix) -> DataFrame:
    """Adds ``_weight`` and ``target`` to rows of (source, source_size).

    Targets in proportion to the weights stop at the limit, and the excess goes to the others by
    weight until none is above: only sums come to the driver in each round.
    """
    placed = with_position(sources, [F.col("source").isNull(), F.col("source")], "_index")
    weights = F.array(*[F.lit(w) for w in mixture.weights])
    placed = placed.withColumn("_weight", F.element_at(weights, (F.col("_index") % len(mixture.weights) + 1).cast("int")))
    cap = F.col("source_size") * F.lit(mixture.limit)
    level, full = 0.0, -1
    total = placed.agg(F.sum("source_size")).first()[0] or 0
    while True:
        capped = F.col("_weight") * F.lit(level) > cap if level else F.lit(False)
        row = placed.agg(F.count_if(capped), F.sum(F.when(capped, cap)), F.sum(F.when(~capped, F.col("_weight")))).first()
        if row[0] == full or not row[2]:
            break
        full = row[0]
        level = (mixture.share * total - (row[1] or 0.0)) / row[2]
    return placed.withColumn("target", F.least(F.col("_weight") * F.lit(level), cap).cast("double"))


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Image of each index under a pseudorandom permutation of 0 … size-1, chosen by its key.

    A Feistel network permutes the rectangle of the next two factors whose product reaches the
    size; indexes that land outside walk on until they are inside.
    """
    size = size.astype(np.uint64)
    right = np.ceil(np.sqrt(size.astype(np.float64))).astype(np.uint64)
    left = (size + right - U(1)) // right
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        a, b, seed = left[todo], right[todo], key[todo]
        x, y = out[todo] // b, out[todo] % b
        for turn in range(4):
            x = (x + mix(y + seed + U(2 * turn)) % a) % a
            y = (y + mix(x + seed + U(2 * turn + 1)) % b) % b
        out[todo] = x * b + y
        todo = todo[out[todo] >= size[todo]]
    return out.astype(np.int64)


def placed_documents(docs: DataFrame, mixture: Mix) -> tuple[DataFrame, DataFrame]:
    """(documents with their place in their source's stream, sources with targets).

    The running sum over a source's documents goes in two steps: over chunks of documents, then
    inside each, so that no source has to pass one task.
    """
    spark = docs.sparkSession
    sized = docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("doc_id", "text").alias("_said"))
    sized = cut_lineage(sized)
    sources = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), mixture)
    sources = cut_lineage(sources.withColumn("_blocks", F.ceil(F.col("source_size") / mixture.block)))
    chunks = max(1, sized.count() // mixture.chunk_rows)
    # By id and text: however the rows are stored, the stream of a source is the same.
    order = F.xxhash64("_said", F.lit(mixture.seed))
    rows = sized.withColumns({"_order": order, "_chunk": F.pmod(F.xxhash64("_said", F.lit(mixture.seed + 1)), F.lit(chunks))})
    by_chunk = rows.groupBy("source", "_chunk").agg(F.sum("size").alias("_words"))
    before = Window.partitionBy("source").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    firsts = by_chunk.select("source", "_chunk", F.coalesce(F.sum("_words").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("source", "_chunk").orderBy("_order", "doc_id", "_row").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_start", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    same = rows["source"].eqNullSafe(firsts["source"]) & (rows["_chunk"] == firsts["_chunk"])
    rows = rows.join(firsts, same, "left").select(rows["*"], (F.col("_first") + F.col("_start")).alias("_at"))
    rows = rows.join(sources.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")), "left")
    return rows.drop("_source", "_start", "_order", "_chunk", "_said"), sources


def draw_slots(sources: DataFrame, mixture: Mix) -> DataFrame:
    """Slots of the mix: _index (source), shard, slot (of the source), round, block and cut: the words
    that are taken of the block's beginning, null for all of it.

    Every source's slots are dealt to the shards by one multinomial draw of its own.
    """
    block, size = F.lit(mixture.block), F.col("source_size")
    words = F.round("target").cast("long")
    wanted = sources.where("source_size > 0").select("_index", "source_size", "_blocks", words.alias("_words"))
    rest = F.expr("_words % source_size")
    wanted = wanted.withColumns({"_rounds": F.expr("_words div source_size"), "_cut": rest % block, "_some": F.floor(rest / block)})
    take = F.col("_rounds") * F.col("_blocks") + F.col("_some") + (F.col("_cut") > 0).cast("long")
    wanted = wanted.select("_index", "_blocks", F.floor(size / block).alias("_full"), "_cut", take.alias("_take"))
    total = wanted.agg(F.sum("_take")).first()[0] or 0
    shards = max(1, -(-total // mixture.shard_blocks))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for index, take in zip(*(batch.column(c).to_pylist() for c in ("_index", "_take")), strict=True):
                rng = np.random.default_rng([mixture.seed, index])
                counts = rng.multinomial(take, np.full(shards, 1 / shards))
                drawn = np.flatnonzero(counts)
                firsts = np.cumsum(counts) - counts
                yield pa.RecordBatch.from_pydict({"_index": np.full(len(drawn), index), "shard": drawn, "_first": firsts[drawn], "_count": counts[drawn]})

    dealt = wanted.where("_take > 0").repartition("_index").mapInArrow(deal, "_index long, shard long, _first long, _count long")
    # A row per source and shard is dealt out again before it becomes a row per slot, to a number of
    # tasks that follows the slots: the rows are so few that AQE would join them all in one task.
    tasks = max(1, -(-total // mixture.slot_rows))
    dealt = dealt.join(wanted, "_index").repartition(tasks, "shard", "_index")
    slots = dealt.withColumn("slot", F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col("_count") - 1)))
    seed = mixture.seed

    @F.pandas_udf("long")
    def place(slot: pd.Series, blocks: pd.Series, full: pd.Series, index: pd.Series) -> pd.Series:
        j, n, most = slot.to_numpy(), blocks.to_numpy(), full.to_numpy()
        out = j % n
        some = out < most
        key = mix((index.to_numpy()[some] * 1_000_003 + (j // n)[some]).astype(np.uint64) + U(seed))
        out[some] = permuted(out[some], most[some], key)
        return pd.Series(out)

    cut = F.when((F.col("slot") == F.col("_take") - 1) & (F.col("_cut") > 0), F.col("_cut"))
    return slots.select("_index", "shard", "slot", F.expr("slot div _blocks").alias("round"), place("slot", "_blocks", "_full", "_index").alias("block"), cut.alias("cut"))


def unbroadcast(slots: DataFrame) -> DataFrame:
    """Slots, or counts of them, for a join with parts of documents. Their number is not known to Spark
    before they are exploded, and AQE has sent all of them through the driver."""
    return slots.hint("merge")


def pieces(rows: DataFrame, mixture: Mix) -> DataFrame:
    """Parts of documents by block: block, the words [_from, _to) of the document in it, and how many
    words of the block stand before them."""
    first, last = F.expr(f"_at div {mixture.block}"), F.expr(f"(_at + size - 1) div {mixture.block}")
    spread = rows.withColumn("block", F.explode_outer(F.when(F.col("size") > 0, F.sequence(first, last))))
    start = F.col("block") * mixture.block - F.col("_at")
    spread = spread.withColumns({"_from": F.greatest(start, F.lit(0)), "_to": F.least(start + mixture.block, F.col("size"))})
    return spread.withColumn("_before", F.col("_from") - start)


def words_of(first: Column, last: Column, before: Column, cut: Column) -> Column:
    """How many of the words [first, last) a block gives that is cut after ``cut`` words, if it is."""
    return F.least(last - first, F.greatest(F.coalesce(cut, before + last - first) - before, F.lit(0)))


def mix_report(docs: DataFrame, mixture: Mix = Mix()) -> DataFrame:
    """doc_id, size, source_size, target and taken (words the mix takes, repeats counted) per row.

    Null texts have size 0; a null source is one source, the last. Rows that share a doc_id are
    reported each. An empty table gives no rows.
    """
    rows, sources = placed_documents(docs, mixture)
    whole = F.count_if(F.col("cut").isNull()).alias("_times")
    times = draw_slots(sources, mixture).groupBy("_index", "block").agg(whole, F.max("cut").alias("_cut"))
    parts = pieces(rows, mixture).select("_row", "doc_id", "size", "source_size", "target", "_index", "block", "_from", "_to", "_before")
    # Documents without words have no block; a number of their own keeps them from meeting in one task.
    parts = parts.withColumn("block", F.coalesce("block", F.lit(-1) - F.col("_row")))
    found = parts.join(unbroadcast(times), ["_index", "block"], "left")
    part = F.when(F.col("_cut").isNotNull(), words_of(F.col("_from"), F.col("_to"), F.col("_before"), F.col("_cut")))
    words = F.coalesce(F.col("_times") * (F.col("_to") - F.col("_from")), F.lit(0)) + F.coalesce(part, F.lit(0))
    return found.groupBy("_row", "doc_id", "size", "source_size", "target").agg(F.sum(words).alias("taken")).drop("_row")


def word_spans(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word of a text, words being runs of other than white space."""
    from daytally.llm.text import code_points

    space = np.isin(code_points(text), SPACES)
    edge = np.diff((~space).astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def mixed_documents(docs: DataFrame, mixture: Mix = Mix()) -> DataFrame:
    """The mix as documents: per row and round the words taken of it, with the columns of ``docs``.

    Words of neighbouring blocks stay together as they stand in the text, others are joined by a
    line break. ``n_chars``, where there is one, is counted anew. Documents without words, and those
    that the mix takes no word of, are not in it. ``docs`` is read twice and has to give the same rows
    in the same order each time, as a stored table does.
    """
    rows, sources = placed_documents(docs, mixture)
    slots = draw_slots(sources, mixture).select("_index", "block", "round", "cut")
    parts = pieces(rows, mixture).where("block is not null").select("_row", "_index", "block", "_from", "_to", "_before")
    taken = parts.join(unbroadcast(slots), ["_index", "block"])
    taken = taken.withColumn("_to", F.col("_from") + words_of(F.col("_from"), F.col("_to"), F.col("_before"), F.col("cut"))).where("_to > _from")
    spans = taken.groupBy("_row", "round").agg(F.sort_array(F.collect_list(F.struct("_from", "_to"))).alias("_spans"))

    def cut(text: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for whole, ranges in zip(texts_of(text), spans.to_pylist(), strict=True):
            starts, ends = word_spans(whole)
            runs: list[list[int]] = []
            for r in ranges:
                if runs and runs[-1][1] == r["_from"]:
                    runs[-1][1] = r["_to"]
                else:
                    runs.append([r["_from"], r["_to"]])
            out.append("\n".join(whole[starts[a] : ends[b - 1]] for a, b in runs))
        return pa.array(out, pa.string())

    row, found = fresh_name(docs, "_row"), fresh_name(docs, "_spans")
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    joined = numbered.join(spans.select(F.col("_row").alias(row), F.col("_spans").alias(found)), row)
    joined = joined.withColumn("text", F.arrow_udf(cut, "string")("text", found))
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return joined.select(*docs.columns)
