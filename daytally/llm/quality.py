"""Quality classifier: hashed word and character n-gram vectors, averaged, with a softmax output.

Every feature of a text (its words, pairs of neighbouring words and character n-grams inside
words, case kept) is hashed to a bucket that has a learned vector. The vectors of a text are
averaged and a linear layer with softmax gives the class probabilities. The vectors and the layer
are trained by plain stochastic gradient descent in numpy, on a bounded sample of labelled rows.

A pair of equal neighbours has one feature of its own, so that repetition of any word is seen.
For scoring, each bucket's vector is multiplied with the layer once: a text's score is the mean of
one number per feature.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daytally.llm.text import PIECE, U, code_points, grouped, mix, texts_of

SPACES = (0, 9, 10, 11, 12, 13, 32)
_BLANKS = "".join(map(chr, SPACES))
_BLANK = re.compile(f"[{_BLANKS}]")


@dataclass(frozen=True)
class Settings:
    """``sample`` labelled rows bound the training; each has ``buckets`` distinct features at most."""

    buckets: int = 1 << 17
    dimensions: int = 8
    ngrams: tuple[int, ...] = (3, 4)
    sample: int = 2000
    epochs: int = 12
    rate: float = 4.0
    seed: int = 7


def _text_features(text_list: list[str], settings: Settings, skip: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features, and the number of the text that each one belongs to.

    Features that begin in the first ``skip`` code points are left out; a pair begins with its second
    word here.
    """
    codes = code_points("\0" + "\0".join(text_list) + "\0").astype(np.uint64)
    space = np.isin(codes, SPACES)
    owner = np.repeat(np.arange(len(text_list)), [len(t) + 1 for t in text_list])
    ids, owners = [], []

    def add(hashes: np.ndarray, at: np.ndarray) -> None:
        if skip:
            hashes, at = hashes[at > skip], at[at > skip]
        ids.append((mix(hashes) >> U(40)).astype(np.int64) & (settings.buckets - 1))
        owners.append(owner[at])

    inner = np.cumsum(space)
    for n in settings.ngrams:
        if len(codes) <= n:
            continue
        value = np.full(len(codes) - n + 1, U(n))
        for j in range(n):
            value = value * U(0x100000001B3) + codes[j : len(codes) - n + 1 + j] + U(1)
        at = np.flatnonzero(inner[n - 2 : len(codes) - 1] == inner[: len(codes) - n + 1])
        at = at[at < len(owner)]
        add(value[at], at)
    edge = np.diff(space.astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1) + 1, np.flatnonzero(edge == 1) + 1
    if len(starts):
        value = mix(codes * U(0x9E3779B97F4A7C15) + U(1))
        begun = np.zeros(len(codes), np.int64)
        begun[starts] = starts
        place = np.arange(len(codes)) - np.maximum.accumulate(begun)
        total = np.concatenate([[U(0)], np.cumsum(mix(value + place.astype(np.uint64)))])
        words = total[ends] - total[starts]
        add(words + U(11), starts)
        same = owner[starts[1:]] == owner[starts[:-1]]
        pair = np.where(words[1:] == words[:-1], U(13), words[1:] * U(3) + words[:-1])
        add(pair[same] + U(17), starts[1:][same])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *ids]), np.concatenate([none, *owners])


def pieces(text: str) -> Iterator[tuple[int, int, int]]:
    """(start, end, skip) of the pieces of a long text, cut at white space. A piece begins with the
    last word of the one before, which is skipped but for the pair that it makes with the next word.
    A run of ``PIECE`` code points without white space is cut where it is."""
    at = skip = 0
    while at < len(text):
        end = min(len(text), at + skip + PIECE)
        if end < len(text):
            found = _BLANK.search(text, end, end + PIECE)
            end = found.end() if found else end
        yield at, end, skip
        if end == len(text) or text[end - 1] not in _BLANKS:
            at, skip = end, 0
            continue
        # The blank ends this piece's last word and begins the next one's first new feature.
        from_ = max(at, end - PIECE)
        last = text[from_:end].rstrip(_BLANKS)
        word = max(last.rfind(c) for c in _BLANKS) + 1
        at = from_ + word if 0 < word < len(last) else end - 1
        skip = end - 1 - at


def features(texts: list[str], settings: Settings) -> Iterator[tuple[int, np.ndarray]]:
    """(number of the text, buckets of its features), in bounded pieces; long texts come in parts."""
    for first, last in grouped(texts):
        if last == first + 1 and len(texts[first]) > PIECE:
            for start, end, skip in pieces(texts[first]):
                yield first, _text_features([texts[first][start:end]], settings, skip)[0]
        else:
            ids, owners = _text_features(texts[first:last], settings)
            order = np.argsort(owners, kind="stable")
            bounds = np.searchsorted(owners[order], np.arange(last - first + 1))
            for i in range(last - first):
                yield first + i, ids[order[bounds[i] : bounds[i + 1]]]


def _piece_sums(texts: list[str], table: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the table's numbers over the features of each text, and their count."""
    sums, counts = np.zeros(len(texts)), np.zeros(len(texts))
    for first, last in grouped(texts):
        if last == first + 1 and len(texts[first]) > PIECE:
            for i, ids in features(texts[first:last], settings):
                sums[first + i] += table[ids].sum()
                counts[first + i] += len(ids)
        else:
            ids, owners = _text_features(texts[first:last], settings)
            sums[first:last] = np.bincount(owners, table[ids], last - first)
            counts[first:last] = np.bincount(owners, minlength=last - first)
    return sums, counts


@dataclass(frozen=True)
class QualityModel:
    """``table``: per bucket the difference of the two classes' outputs; ``bias`` likewise."""

    table: np.ndarray
    bias: float
    settings: Settings

    def score(self, texts: list[str]) -> np.ndarray:
        sums, counts = _piece_sums(texts, self.table, self.settings)
        return 1.0 / (1.0 + np.exp(-np.clip(sums / np.maximum(counts, 1) + self.bias, -500, 500)))


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], settings: Settings) -> QualityModel:
    """Softmax over averaged vectors, one row of (buckets, counts, label) per step.

    Without rows of both classes the score is the smoothed share of label 1.
    """
    labels = np.array([label for _, _, label in rows], np.int64)
    prior = (labels.sum() + 1) / (len(labels) + 2)
    bias = np.array([0.0, np.log(prior / (1 - prior))])
    if len(set(labels.tolist())) < 2:
        return QualityModel(np.zeros(settings.buckets), float(bias[1]), settings)
    rng = np.random.default_rng(settings.seed)
    vectors = rng.uniform(-1, 1, (settings.buckets, settings.dimensions)) / settings.dimensions
    layer = np.zeros((settings.dimensions, 2))
    shares = [counts / max(counts.sum(), 1) for _, counts, _ in rows]
    steps = settings.epochs * len(rows)
    done = 0
    for _ in range(settings.epochs):
        for i in rng.permutation(len(rows)):
            rate = settings.rate * (1 - done / steps)
            done += 1
            ids = rows[i][0]
            hidden = shares[i] @ vectors[ids]
            out = hidden @ layer + bias
            wrong = np.exp(out - out.max())
            wrong /= wrong.sum()
            wrong[labels[i]] -= 1
            back = layer @ wrong
            layer -= rate * np.outer(hidden, wrong)
            bias -= 0.1 * rate * wrong
            vectors[ids] -= rate * np.outer(shares[i], back)
    difference = layer[:, 1] - layer[:, 0]
    return QualityModel(vectors @ difference, float(bias[1] - bias[0]), settings)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text leaves 1 by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> QualityModel:
    """Model of ``labels.quality``, from ``settings.sample`` labelled rows in order of their hash.

    Held-out rows, labels other than 0 and 1, and labels without a document are not used. Whole texts
    are learned from. The sampled rows are turned into counted features where they are read and
    train the model in one task; two numbers a bucket at most come back.
    """
    known = labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
    known = known.select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_label")).distinct()
    known = known.withColumn("_order", F.xxhash64("_id", F.lit(settings.seed)))
    drawn = known.orderBy("_order", "_id", "_label").limit(settings.sample)
    # At most settings.sample rows of three numbers.
    rows = docs.select(F.col("doc_id").alias("_id"), "text").join(F.broadcast(drawn), "_id")

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column("text"))
            found: dict[int, list] = {}
            for i, ids in features(texts, settings):
                found.setdefault(i, []).append(np.unique(ids, return_counts=True))
            ids_out, counts_out = [], []
            for i in range(len(texts)):
                parts = found.get(i, [(np.zeros(0, np.int64), np.zeros(0, np.int64))])
                ids, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                ids_out.append(ids.astype(np.int32))
                counts_out.append(np.bincount(where, np.concatenate([p[1] for p in parts]), len(ids)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_order"), batch.column("_id"), batch.column("_label"), pa.array(ids_out, pa.list_(pa.int32())), pa.array(counts_out, pa.list_(pa.int32()))],
                names=["_order", "_id", "_label", "ids", "counts"],
            )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = [
            (ids.values.to_numpy().astype(np.int64), counts.values.to_numpy().astype(np.float64), label.as_py())
            for batch in batches
            for ids, counts, label in zip(batch.column("ids"), batch.column("counts"), batch.column("_label"), strict=True)
        ]
        model = train(sample, settings)
        yield pa.RecordBatch.from_pydict({"table": [model.table.astype(np.float64).tobytes()], "bias": [model.bias]})

    kind = rows.schema["_id"].dataType.simpleString()
    reduced = rows.select("_order", "_id", "_label", "text").mapInArrow(reduce, f"_order long, _id {kind}, _label int, ids array<int>, counts array<int>")
    # Repeated rows of a document have equal features, so any order of them is the same.
    ordered = reduced.repartition(1).sortWithinPartitions("_order", "_id", "_label", F.size("ids"), "ids", "counts")
    found = ordered.select("_label", "ids", "counts").mapInArrow(learn, "table binary, bias double").first()
    if found is None:
        return train([], settings)
    return QualityModel(np.frombuffer(bytes(found["table"]), np.float64), found["bias"], settings)


def score_column(model: QualityModel, text: Column) -> Column:
    """Probability of label 1 of each whole text; null counts as empty, which gets the bias alone."""

    def score(column: pa.Array) -> pa.Array:
        return pa.array(model.score(texts_of(column)), pa.float64())

    return F.arrow_udf(score, "double")(text)


def score_documents(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from a score of 0.5) of every row, repeated ones too."""
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_column(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
