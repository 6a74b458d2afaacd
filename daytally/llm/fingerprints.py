"""Document fingerprints by a threshold-scaled sketch.

The fingerprint of a text keeps every hash of its word shingles that lies below a fixed share of the
hash range. The share is the same for all texts, so a sketch grows with its text, the union of two
sketches is the sketch of both texts together, and the part of one sketch found in another estimates
the part of one text that the other holds, however unequal their lengths are.

A text with words but without a hash below the share keeps its least hash. It lies above the share,
so it leaves no trace in a union, and two such texts are alike if their least hashes are equal.

To compare every document with the next one, documents are dealt to ranges of their ids in a single
shuffle of the texts. The first document of each range is known from a pass over the ids and is
added to the end of the range before, so that a range is read in order, row by row.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daytally.llm.text import PIECE, SHINGLE, U, grouped, shingle_hashes, texts_of, word_hashes
from daytally.session import cut_lineage

BATCH = 1 << 19  # code points of texts whose sketches are made together


@dataclass(frozen=True)
class Sketch:
    """One hash of ``scale`` is kept. ``range_chars`` code points make up a range of documents."""

    scale: int = 8
    shingle: int = SHINGLE
    range_chars: int = 1 << 24

    @property
    def limit(self) -> np.uint64:
        """The greatest hash that is kept."""
        return U((1 << 64) // self.scale - 1)


def sketches(texts: list[str], sketch: Sketch) -> Iterator[np.ndarray]:
    """Sorted kept hashes of each text, from all of its shingles."""
    for first, last in grouped(texts, PIECE):
        hashes, bounds = shingle_hashes(*word_hashes(texts[first:last]), sketch.shingle, short=True)
        low = hashes <= sketch.limit
        owner = np.repeat(np.arange(last - first), np.diff(bounds))[low]
        kept = hashes[low]
        ends = np.searchsorted(owner, np.arange(last - first + 1))
        for i in range(last - first):
            own = np.unique(kept[ends[i] : ends[i + 1]])
            if not len(own) and bounds[i] < bounds[i + 1]:
                own = hashes[bounds[i] : bounds[i + 1]].min(keepdims=True)
            yield own


def as_text(hashes: np.ndarray) -> str:
    """A fingerprint: its hashes in ascending order, as base64 of eight bytes each, lowest first."""
    return base64.b64encode(hashes.astype("<u8").tobytes()).decode()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u8")


def merged(one: str, other: str, sketch: Sketch = Sketch()) -> str:
    """Fingerprint of two texts taken together. Least hashes that stand for small texts drop out,
    unless nothing else is left: then the lesser one stands for both."""
    both = np.union1d(from_text(one), from_text(other))
    low = both[both <= sketch.limit]
    return as_text(low if len(low) else both[:1])


def containment(one: np.ndarray, other: np.ndarray) -> float:
    """Share of the first sketch found in the second; 1 if both are empty, 0 if one is."""
    if not len(one) or not len(other):
        return float(len(one) == len(other))
    return len(np.intersect1d(one, other, assume_unique=True)) / len(one)


def resemblance(one: np.ndarray, other: np.ndarray) -> float:
    """Common hashes by those of both sketches; 1 if both are empty."""
    if not len(one) and not len(other):
        return 1.0
    common = len(np.intersect1d(one, other, assume_unique=True))
    return common / (len(one) + len(other) - common)


def estimated_containment(one: Column, other: Column) -> Column:
    """Share of the text with the first fingerprint that the other text holds; null for null."""

    def compare(a: pa.Array, b: pa.Array) -> pa.Array:
        pairs = zip(a.to_pylist(), b.to_pylist(), strict=True)
        return pa.array([None if x is None or y is None else containment(from_text(x), from_text(y)) for x, y in pairs], pa.float64())

    return F.arrow_udf(compare, "double")(one, other)


def fingerprint_column(text: Column, sketch: Sketch = Sketch()) -> Column:
    """Fingerprint of a whole text; null counts as empty, which has the empty fingerprint."""

    def describe(column: pa.Array) -> pa.Array:
        return pa.array([as_text(s) for s in sketches(texts_of(column), sketch)], pa.string())

    return F.arrow_udf(describe, "string")(text)


# Order of documents: by id, null last, equal ids by their text. Rows that agree in both are equal.
ORDER = ["_no", "_id", "_hash", "_row"]


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id and text, with the columns of the order."""
    plain = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return plain.withColumns(
        {
            "_no": F.col("doc_id").isNull(),
            "_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)),
            "_hash": F.xxhash64("text"),
            "_row": F.monotonically_increasing_id(),
        }
    )


def range_starts(keyed: DataFrame, sketch: Sketch) -> list[tuple]:
    """The first key of each range, in order, from a pass over the keys: ranges hold about
    ``range_chars`` code points, or as many as one partition of the keys has if that is more."""
    keys = keyed.select(*ORDER, F.length("text").alias("_n"))
    total = keys.agg(F.sum("_n")).first()[0] or 0
    ranges = max(1, total // sketch.range_chars)
    part = F.spark_partition_id().alias("_part")
    first = keys.repartitionByRange(ranges, *ORDER).groupBy(part).agg(F.min(F.struct(*ORDER)).alias("_first"))
    return sorted(tuple(r["_first"]) for r in first.collect())  # a row per range


def _range_number(starts: list[tuple]):
    """Arrow function: number of the range that a key belongs to."""
    columns = [np.array([s[i] for s in starts]) for i in range(len(ORDER))]

    def number(no: pa.Array, id_: pa.Array, hash_: pa.Array, row: pa.Array) -> pa.Array:
        keys = [no.to_numpy(zero_copy_only=False), id_.to_numpy(), hash_.to_numpy(), row.to_numpy()]
        low, high = np.zeros(len(no), np.int64), np.full(len(no), len(starts), np.int64)
        while (high - low > 1).any():
            middle = (low + high) // 2
            after, same = np.zeros(len(no), bool), np.ones(len(no), bool)
            for key, start in zip(keys, columns, strict=True):
                after |= same & (key > start[middle])
                same &= key == start[middle]
            after |= same
            low, high = np.where(after, middle, low), np.where(after, high, middle)
        return pa.array(low.astype(np.int32), pa.int32())

    return F.arrow_udf(number, "int")


def next_documents(docs: DataFrame, sketch: Sketch) -> DataFrame | None:
    """All documents dealt to ranges and in order inside them. After the last document of a range
    stands the first one of the next range (after the last range: of the first one), marked
    ``_end``. None without documents."""
    keyed = _keyed(docs)
    starts = range_starts(keyed, sketch)
    if not starts:
        return None
    spark = docs.sparkSession
    number = _range_number(starts)
    rows = keyed.withColumns({"_part": number(*ORDER), "_end": F.lit(False)})
    before = [(*start[:3], i - 1 if i else len(starts) - 1) for i, start in enumerate(starts)]
    wanted = spark.createDataFrame(before, "_no boolean, _id long, _hash long, _before int")
    # As many rows as ranges. Of equal rows one is enough.
    ends = keyed.join(F.broadcast(wanted), ["_no", "_id", "_hash"])
    one = Window.partitionBy("_before").orderBy("_row")
    ends = ends.withColumn("_place", F.row_number().over(one)).where("_place = 1")
    ends = cut_lineage(ends.select(*keyed.columns, F.col("_before").alias("_part"), F.lit(True).alias("_end")))
    dealt = rows.unionByName(ends).repartitionById(len(starts), F.col("_part"))
    return dealt.sortWithinPartitions("_part", "_end", *ORDER)


RESULT = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, resemblance_edited double, resemblance_next double"


def edited_text(text: str, following: str) -> str:
    """The text with its last half of code points replaced by the first as many of the other."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprint_documents(docs: DataFrame, sketch: Sketch = Sketch()) -> DataFrame:
    """doc_id, n_chars, edited_sha256, both fingerprints, and how alike they are, for every row.

    The edited text ends in the beginning of the next document, by ascending doc_id (null last, rows
    that share an id by the hash of their text; after the last document the first one; a single
    document follows itself). ``near_edited`` and ``near_next`` estimate which share of the document
    the edited text and the next document hold, the two resemblances common shingles by all. A text
    under five words has one shingle of all its words; a text without words (null, empty, signs) has
    the empty fingerprint. An empty table gives no rows. ``docs`` is read three times and has to
    give the same rows each time, as a stored table does.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    dealt = next_documents(docs, sketch)
    if dealt is None:
        return docs.sparkSession.createDataFrame([], f"doc_id {kind}, {RESULT}")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # the last row, whose next one is in a later batch
        for batch in batches:
            texts = texts_of(batch.column("text"))
            for first, last in grouped(texts, BATCH):
                own = list(sketches(texts[first:last], sketch))
                part = batch.slice(first, last - first)
                rows = held + list(zip(part.column("doc_id").to_pylist(), part.column("_end").to_pylist(), texts[first:last], own, strict=True))
                held = rows[-1:]
                # The end of a range has no next document here: it belongs to another range.
                pairs = [(a, b) for a, b in zip(rows[:-1], rows[1:], strict=True) if not a[1]]
                edited = [edited_text(a[2], b[2]) for a, b in pairs]
                changed = list(sketches(edited, sketch))
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array([a[0] for a, _ in pairs], batch.schema.field("doc_id").type),
                        "n_chars": pa.array([len(a[2]) for a, _ in pairs], pa.int64()),
                        "edited_sha256": pa.array([hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edited], pa.string()),
                        "fingerprint": pa.array([as_text(a[3]) for a, _ in pairs], pa.string()),
                        "edited_fingerprint": pa.array([as_text(c) for c in changed], pa.string()),
                        "near_edited": pa.array([containment(a[3], c) for (a, _), c in zip(pairs, changed, strict=True)], pa.float64()),
                        "near_next": pa.array([containment(a[3], b[3]) for a, b in pairs], pa.float64()),
                        "resemblance_edited": pa.array([resemblance(a[3], c) for (a, _), c in zip(pairs, changed, strict=True)], pa.float64()),
                        "resemblance_next": pa.array([resemblance(a[3], b[3]) for a, b in pairs], pa.float64()),
                    }
                )

    return dealt.select("doc_id", "_end", "text").mapInArrow(describe, f"doc_id {kind}, {RESULT}")
