"""Ranked lexical search against brute force."""

import collections
import math
import random
import re

import numpy as np
import pytest

from daytally.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
EDGES = [None, "", " \n", "?!", "Ä ä A a", "x" * 70_000, "the " * 40_000, "\x00the\x7fTHE_the", "中文the 😀"]
DOCS = "doc_id long, text string, item_id long, score long, class string, m int, n int, bag string"


def tokens(text):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return TERM.findall((text or "").translate(fold))


def brute(docs, items, k=10):
    held = [(i, collections.Counter(tokens(t))) for i, t in docs]
    held = [(i, tf) for i, tf in held if tf]
    count, total = len(held), sum(sum(tf.values()) for _, tf in held)
    out = []
    for item, text in items:
        scored = []
        terms = set(tokens(text))
        weight = {t: math.floor(1000 * math.log((2 * count + 2) / (2 * sum(t in tf for _, tf in held) + 1))) for t in terms}
        for i, tf in held:
            m = 10 + 90 * sum(tf.values()) * count // total
            score = sum(w * (1_000_000_000 * tf[t] // (1000 * tf[t] + 8 * m)) for t, w in weight.items() if t in tf)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored, key=lambda s: s[:3])[:k], 1)]
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 0, 0, "x", 0, 0, "y") for i, t in rows], DOCS)


def found(spark, docs, items, **settings):
    result = lexical.search(frame(spark, docs).repartition(5), frame(spark, [(0, None)]).limit(0).select("text", "doc_id").unionByName(spark.createDataFrame(items, "doc_id long, text string")).withColumnRenamed("doc_id", "item_id"), lexical.Ranking(**settings))
    assert dict(result.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    return sorted(map(tuple, result.collect()), key=str)


@pytest.mark.parametrize("settings", [{}, {"k": 3}, {"terms": 40}])
def test_ranks_equal_brute_force(spark, settings):
    rng = random.Random(4)
    make = lambda n: " ".join(rng.choice("the The of and rare").lower() + rng.choice(["", "1", "é"]) if rng.random() < 0.8 else f"w{rng.randrange(300)}" for _ in range(n))
    docs = [(i, make(rng.randrange(1, 60))) for i in range(200)]
    copy = docs[7][1]
    # A third of all rows are copies, some of them differ in case and signs only.
    docs += [(1000 - i, copy.upper() if i % 3 and copy.isascii() else f"  {copy}!") for i in range(100)]
    docs += [(2000 + i, t) for i, t in enumerate(EDGES)] + [(5, docs[5][1]), (None, docs[9][1]), (None, "rare rare")]
    items = [(i, make(12)) for i in range(20)] + [(50, copy), (51, None), (52, "..."), (53, "unknownterm"), (54, "THE the ä Ä 中文the")]
    expected = brute(docs, items, settings.get("k", 10))
    assert found(spark, docs, items, **settings) == expected and len(expected) > 50


def test_empty_tables_give_no_rows(spark):
    assert found(spark, [], [(1, "a b")]) == []
    assert found(spark, [(1, "a b")], []) == []
    assert found(spark, [(1, None), (2, "--")], [(1, "a b")]) == []


def test_long_texts_are_cut_between_terms(monkeypatch):
    text = "ab, cd" * 500 + "é" * 300 + " end"
    whole = [t for some in lexical.term_lists(text) for t in some]
    monkeypatch.setattr(lexical, "PIECE", 64)
    pieces = list(lexical.term_lists(text))
    assert len(pieces) > 20 and [t for some in pieces for t in some] == whole == [t.encode() for t in tokens(text)]


def test_classes_are_scored_once(spark):
    """Copies and texts that differ outside the vocabulary only are one class."""
    docs = frame(spark, [(i, "alpha beta zzz" if i % 2 else "beta yyy alpha") for i in range(50)])
    rows = lexical.bags(docs, [b"alpha", b"beta"])
    assert rows.select("bag").distinct().count() == 1
    assert lexical.document_counts(rows, 2).tolist() == [50, 50]


def test_best_keeps_ties_by_least_id():
    import pyarrow as pa

    best = lexical.Best(1, 2)
    for scores, least in (([5, 7], [9, 3]), ([7, 7], [None, 1])):
        best.add(np.array(scores).reshape(-1, 1), pa.array(least, pa.int64()), np.zeros(2, np.int64), np.zeros(2, np.int64))
    assert list(zip(best.rows[1].tolist(), best.rows[3].tolist())) == [(7, 1), (7, 3)]
