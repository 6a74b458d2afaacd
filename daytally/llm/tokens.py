"""Token counts by a public tokenizer, in Arrow functions that return lengths only.

Texts are cut at boundaries that no token can cross, so the sum of the parts' lengths is the
length of the whole. Parts are encoded in batches of about equal bytes, and a part that occurs
several times in a batch is encoded once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daytally.llm.text import grouped, texts_of

BATCH = 1 << 21  # code points whose parts are counted together
KNOWN = 1 << 18  # parts whose lengths a task remembers
LIMIT = 4096
_loaded: dict = {}

# A single blank between two other characters. U+2581 is the vocabulary's own sign for a blank.
_BOUNDARY = re.compile("(?<=[^ ▁]) (?=[^ ▁])")


class PieceCounter:
    """Lengths by a sentencepiece model, without begin and end tokens."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = map(self.model.id_to_piece, range(self.model.get_piece_size()))
        # A blank starts a piece or fills it; then no piece crosses the boundary above. The part
        # after the boundary gets its blank back as the prefix that the model puts before a text.
        prefixed = self.model.encode("a b", out_type=str) == self.model.encode("a", out_type=str) + self.model.encode("b", out_type=str)
        self.safe = prefixed and all("▁" not in p.lstrip("▁") for p in pieces)
        self.known: dict[str, int] = {}

    def parts(self, text: str) -> list[str]:
        return _BOUNDARY.split(text) if self.safe else [text]

    def lengths(self, parts: list[str]) -> list[int]:
        return [len(ids) for ids in self.model.encode(parts, num_threads=1)]


class FileCounter:
    """Lengths by a tokenizers file; special strings inside texts are handled as its default."""

    safe = False

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        self.known: dict[str, int] = {}

    def parts(self, text: str) -> list[str]:
        return [text]

    def lengths(self, parts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.model.encode_batch(parts, add_special_tokens=False)]


def counter(path: str):
    """The tokenizer in a file, loaded once by each worker process."""
    if path not in _loaded:
        _loaded[path] = (FileCounter if path.endswith(".json") else PieceCounter)(path)
    return _loaded[path]


def count_tokens(texts: list[str], path: str) -> np.ndarray:
    """Number of tokens of each whole text."""
    tokenizer = counter(path)
    counts = np.zeros(len(texts), np.int64)
    for first, last in grouped(texts, BATCH):
        parts = [tokenizer.parts(t) for t in texts[first:last]]
        sizes = np.array([len(p) for p in parts])
        coded = pa.array([x for p in parts for x in p], pa.string()).dictionary_encode()
        words = coded.dictionary.to_pylist()
        known = tokenizer.known
        new = [w for w in words if w not in known]
        fresh = dict(zip(new, tokenizer.lengths(new), strict=True))
        if len(known) + len(fresh) > KNOWN:
            each = np.array([fresh[w] if w in fresh else known[w] for w in words], np.int64)
            known.clear()
        else:
            known.update(fresh)
            each = np.array([known[w] for w in words], np.int64)
        lengths = each[coded.indices.to_numpy()] if len(coded) else np.zeros(0, np.int64)
        counts[first:last] = np.bincount(np.repeat(np.arange(last - first), sizes), lengths, last - first)
    return counts


def token_count(text: Column, path: str) -> Column:
    """Tokens of each text; null counts as empty."""

    def count(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array(count_tokens(texts_of(column), path), pa.int64())

    return F.arrow_udf(count, "long")(text)


def count_documents(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit of every row, repeated ones too."""
    text = F.coalesce(F.col("text"), F.lit(""))
    counted = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), token_count(text, path).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
