"""Ranked lexical search by deduplicated bags.

Documents are reduced to their bags: how often they hold each term of the items' vocabulary. A score
depends on nothing but the bag and the length factor ``m``, so documents with the same bag and ``m``
are one class. Classes are found by a hash and verified by the bag itself, and each is scored once
against the items that share a term with it. Every task keeps the best classes of each item; as a
class counts by its score and its least doc_id, the ``k`` best documents are members of the ``k``
best classes. Only those classes are expanded to their members, by ascending doc_id.

Items are searched in parts with a vocabulary of bounded size, each part against all documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daytally.llm.text import texts_of
from daytally.session import cut_lineage, scratch_path

PIECE = 1 << 20  # bytes of a text split into terms at once
EXPANDED = 1 << 21  # (term, item) pairs, and (class, item) scores, worked on at once
BROADCAST_ROWS = 1_000_000

# Bytes of terms stay, A-Z in lower case, others become blanks. All bytes of code points beyond
# ASCII belong to terms, so terms can be cut in UTF-8.
FOLDED = bytes(ord(chr(b).lower()) if chr(b).isalnum() else 0x20 for b in range(0x80)) + bytes(range(0x80, 0x100))


@dataclass(frozen=True)
class Ranking:
    """``k`` documents of each item; ``terms`` bounds the terms of the items in one part."""

    k: int = 10
    terms: int = 1 << 20
    seed: int = 13


def term_lists(text: str) -> Iterator[list[bytes]]:
    """Terms of a whole text in lists of bounded size, unless one term is longer."""
    data = text.encode("utf-8", "surrogatepass").translate(FOLDED)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, the distinct terms of every item that has one, and a number ``_part`` to deal it by."""

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted({t for some in term_lists(text) for t in some}) for text in texts_of(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(found, pa.list_(pa.binary()))], names=["item_id", "terms"])

    kind = items.schema["item_id"].dataType.simpleString()
    return items.select("item_id", "text").mapInArrow(distinct, f"item_id {kind}, terms array<binary>").where(F.size("terms") > 0)


def bags(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """doc_id, n (all terms) and bag of every row: pairs of 32-bit numbers (term, times) by term."""
    shared = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            counts, found = [], []
            for text in texts_of(batch.column("text")):
                n, held = 0, Counter()
                for some in term_lists(text):
                    n += len(some)
                    held.update(map(number, some))
                held.pop(None, None)
                counts.append(n)
                found.append(np.array(sorted(held.items()), np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(found, pa.binary())], names=["doc_id", "n", "bag"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(describe, "doc_id long, n long, bag binary")


def _pairs(bag_column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Term, times and number of the row of all pairs of the bags."""
    each = bag_column.to_pylist()
    flat = np.frombuffer(b"".join(each), np.int32).reshape(-1, 2)
    owner = np.repeat(np.arange(len(each)), [len(b) // 8 for b in each])
    return flat[:, 0].astype(np.int64), flat[:, 1].astype(np.int64), owner


def document_counts(rows: DataFrame, size: int) -> np.ndarray:
    """Number of rows whose bag holds each term; every task sends one sum per term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(_pairs(batch.column("bag"))[0], minlength=size)
        term = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(total[term])], names=["term", "n"])

    out = np.zeros(size, np.int64)
    for row in rows.select("bag").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[row["term"]] = row["n"]  # at most the terms of a part
    return out


@dataclass(frozen=True)
class Index:
    """Items by term: those of term t are ``members[starts[t] : starts[t + 1]]``; ``weights`` by term."""

    weights: np.ndarray
    starts: np.ndarray
    members: np.ndarray
    items: int

    def scores(self, bag_column: pa.Array, m: np.ndarray) -> np.ndarray:
        """Score of every class (row) and item (column)."""
        term, times, owner = _pairs(bag_column)
        part = self.weights[term] * ((1_000_000_000 * times) // (1000 * times + 8 * m[owner]))
        many = np.diff(self.starts)[term]
        first = np.repeat(self.starts[term] - (np.cumsum(many) - many), many)
        item = self.members[first + np.arange(many.sum())]
        out = np.zeros((len(m), self.items), np.int64)
        np.add.at(out, (np.repeat(owner, many), item), np.repeat(part, many))
        return out


class Best:
    """The ``k`` best classes of each item so far, by score and least doc_id, null last."""

    def __init__(self, items: int, k: int) -> None:
        self.k, self.edge = k, np.ones(items, np.int64)
        self.rows = [np.zeros(0, np.int64) for _ in range(6)]  # item, score, no doc_id, least, class, m

    def add(self, scores: np.ndarray, least: pa.Array, classes: np.ndarray, m: np.ndarray) -> None:
        row, item = np.nonzero(scores >= self.edge)
        if not len(row):
            return
        no = least.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
        ids = least.fill_null(0).to_numpy()
        new = (item, scores[row, item], no[row], ids[row], classes[row], m[row])
        item, score, no, ids, classes, m = (np.concatenate(x) for x in zip(self.rows, new, strict=True))
        order = np.lexsort((m, classes, ids, no, -score, item))
        place = np.arange(len(order)) - np.searchsorted(item[order], item[order])
        kept, last = order[place < self.k], order[place == self.k - 1]
        self.rows = [x[kept] for x in (item, score, no, ids, classes, m)]
        self.edge[item[last]] = score[last]


def best_classes(classes: DataFrame, index: Index, k: int) -> DataFrame:
    """item, score, least, class and m of the ``k`` best classes of each item."""
    shared = classes.sparkSession.sparkContext.broadcast(index)
    schema = pa.schema([("item", pa.int64()), ("score", pa.int64()), ("least", pa.int64()), ("class", pa.int64()), ("m", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        best = Best(held.items, k)
        step = max(1, EXPANDED // max(len(held.members), held.items))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                some = batch.slice(at, step)
                m = some.column("m").to_numpy()
                best.add(held.scores(some.column("bag"), m), some.column("least"), some.column("class").to_numpy(), m)
        item, score, no, ids, found, m = best.rows
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(score), pa.array(ids, mask=no == 1), pa.array(found), pa.array(m)], schema=schema)

    rows = classes.select("bag", "m", "class", "least").mapInArrow(search, "item long, score long, least long, class long, m long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("least"), "class", "m")
    return rows.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= k).drop("_place")


def _few(df: DataFrame) -> DataFrame:
    """Hint to broadcast a stored table if it has few rows of a few numbers."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _search_part(docs: DataFrame, items: list[tuple[object, list[bytes]]], kind: str, ranking: Ranking) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = sorted({t for _, terms in items for t in terms})
    number = {t: i for i, t in enumerate(vocabulary)}
    path = scratch_path(spark, "bags")
    bags(docs, vocabulary).write.parquet(path)
    rows = spark.read.parquet(path)
    holding = rows.where("n > 0")
    documents, total = holding.agg(F.count("*"), F.sum("n")).first()
    holding = holding.where("octet_length(bag) > 0")
    found = document_counts(holding, len(vocabulary))
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in found], np.int64)
    term = np.array([number[t] for _, terms in items for t in terms], np.int64)
    item = np.repeat(np.arange(len(items)), [len(terms) for _, terms in items])
    by_term = np.argsort(term, kind="stable")
    starts = np.searchsorted(term[by_term], np.arange(len(vocabulary) + 1))
    index = Index(weights, starts, item[by_term], len(items))

    # Rows of the same class have the same bag; the hash only deals them out.
    length = F.expr(f"10L + (90L * n * {documents}L) div {max(total or 0, 1)}L")
    holding = holding.withColumn("m", length).withColumn("class", F.xxhash64("bag", "m"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("_no"), "doc_id"))
    classes = holding.groupBy("class", "m", "bag").agg(least.alias("_l")).withColumn("least", F.col("_l.doc_id"))
    winners = cut_lineage(best_classes(classes, index, ranking.k))

    # Each winning class once, whatever the number of its items; k members of it are enough.
    won = _few(winners.select("class", "m").distinct())
    by_class = Window.partitionBy("class", "m", "bag").orderBy(F.asc_nulls_last("doc_id"))
    members = holding.join(won, ["class", "m"]).withColumn("_place", F.row_number().over(by_class)).where(F.col("_place") <= ranking.k)
    first = F.first("doc_id").over(by_class.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    members = members.withColumn("_first", first).select(F.col("class").alias("_class"), F.col("m").alias("_m"), "_first", "doc_id")
    same = (F.col("class") == F.col("_class")) & (F.col("m") == F.col("_m")) & F.col("least").eqNullSafe(F.col("_first"))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = winners.join(members, same).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ranking.k)
    names = spark.createDataFrame([(i, name) for i, (name, _) in enumerate(items)], f"item long, item_id {kind}")
    return ranked.join(_few(names), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, ranking: Ranking = Ranking()) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` documents with the highest score of each item.

    ``docs`` has an integer doc_id and text, ``items`` item_id and text. Scores above 0 only; equal
    scores by ascending doc_id, null last. Null and empty texts have no terms: such documents match
    nothing and such items give no rows, nor do empty tables. Rows that share an id are documents,
    or items, of their own. ``docs`` is read twice if items come in more than one part.
    """
    kind = items.schema["item_id"].dataType.simpleString()
    stored = cut_lineage(item_terms(items))
    total = stored.agg(F.sum(F.size("terms"))).first()[0] or 0
    parts = max(1, -(-total // ranking.terms))
    out = docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for part in range(parts):
        chosen = stored if parts == 1 else stored.where(F.pmod(F.xxhash64("terms", F.lit(ranking.seed)), F.lit(parts)) == part)
        held = [(r["item_id"], [bytes(t) for t in r["terms"]]) for r in chosen.collect()]
        if held:
            found = _search_part(docs, held, kind, ranking)
            out = found if parts == 1 else out.union(found)
    return out
