"""Fingerprints against brute force over word shingles."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from daytally.llm import fingerprints as fp

DOCS = "doc_id long, text string, fingerprint string, n_chars string, _row int, _part int"
EDGES = [None, "", "!", "one", "a b c d", "É " * 3, "😀中文 x y z", "w" * 200_001, "be " * 50_001]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", 1, 2) for i, t in rows], DOCS)


def shingles(t):
    w = re.findall(r"[^\W_]+", (t or "").lower())
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def expected(rows):
    """doc_id, n_chars, edited text and the next text of every row."""
    texts = [t or "" for _, t in rows]
    out = []
    for i, (doc_id, _) in enumerate(rows):
        own, following = texts[i], texts[(i + 1) % len(rows)]
        half = len(own) // 2
        out.append((doc_id, own, own[: len(own) - half] + following[:half], following))
    return out


def check(spark, rows, sketch=fp.Sketch()):
    shuffled = frame(spark, rows).repartition(4).orderBy(F.xxhash64("text"))
    path = fp.cut_lineage(shuffled)
    result = fp.fingerprint_documents(path, sketch)
    assert [n for n, _ in result.dtypes][:7] == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["n_chars"], r["edited_sha256"]), r) for r in result.collect())
    wanted = sorted(((i is None, i or 0, len(own), hashlib.sha256(edited.encode()).hexdigest()), own, edited, after) for i, own, edited, after in expected(rows))
    assert [g[0] for g in got] == [w[0] for w in wanted]
    return [(g[1], *w[1:]) for g, w in zip(got, wanted)]


@pytest.mark.parametrize("range_chars", [1 << 24, 2000])
def test_whole_sketches_equal_exact_shares(spark, range_chars):
    """With every hash kept the estimates are the exact shares of shingles."""
    rng = random.Random(8)
    make = lambda n: " ".join(f"w{rng.randrange(200)}" for _ in range(n))
    rows = [(i * 3, make(rng.randrange(0, 120))) for i in range(150)] + [(1000 + i, t) for i, t in enumerate(EDGES)]
    rows[20] = (60, rows[19][1])
    for row, own, edited, after in check(spark, rows, fp.Sketch(scale=1, range_chars=range_chars)):
        a, e, n = shingles(own), shingles(edited), shingles(after)
        for name, other in (("edited", e), ("next", n)):
            share = len(a & other) / len(a) if a and other else float(len(a) == len(other))
            alike = len(a & other) / len(a | other) if a | other else 1.0
            assert row[f"near_{name}"] == pytest.approx(share) and row[f"resemblance_{name}"] == pytest.approx(alike)
        assert row["fingerprint"] == fp.as_text(next(fp.sketches([own], fp.Sketch(scale=1))))


def test_estimates_lie_near_the_shares(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(f"w{rng.randrange(5000)}" for _ in range(800))) for i in range(120)]
    found = check(spark, rows)
    assert np.mean([abs(r["near_edited"] - len(shingles(a) & shingles(e)) / len(shingles(a))) for r, a, e, _ in found]) < 0.05
    assert all(r["near_edited"] > r["near_next"] for r, *_ in found)


def test_equal_texts_have_equal_fingerprints_and_a_third_may_be_copies(spark):
    text = "the same words again and again in one row of words"
    rows = [(i, text if i % 3 == 0 else f"{i} other text number {i * 7} of this table {i * i}") for i in range(90)]
    rows = rows[:40] + [(40, text)] * 60 + [r for r in rows[40:] if r[0] > 40] + [(None, "b"), (None, None)][:1]
    prints = {}
    for row, own, *_ in check(spark, rows, fp.Sketch(range_chars=300)):
        prints.setdefault(own, set()).add(row["fingerprint"])
        assert 0 <= row["near_edited"] <= 1 and 0 <= row["near_next"] <= 1
    assert all(len(p) == 1 for p in prints.values())
    assert next(fp.sketches([text], fp.Sketch())).size


def test_single_and_no_documents(spark):
    assert check(spark, [(5, "a b c d e f g")])[0][0]["near_next"] == 1.0
    assert fp.fingerprint_documents(frame(spark, [])).count() == 0


def test_sketches_merge_and_tell_containment_of_unequal_texts():
    rng = random.Random(3)
    long = [f"w{rng.randrange(10_000)}" for _ in range(20_000)]
    part, other = " ".join(long[5000:5400]), " ".join(f"v{i}" for i in range(3000))
    sketch = fp.Sketch()
    a, b, c = fp.sketches([part, " ".join(long), other], sketch)
    assert fp.containment(a, b) == 1.0 and fp.containment(b, a) < 0.05 and fp.containment(a, c) == 0.0
    both = fp.merged(fp.as_text(b), fp.as_text(c))
    assert fp.from_text(both).tolist() == np.union1d(b, c).tolist()
    small = next(s for s in fp.sketches([f"only{i}" for i in range(100)], sketch) if s[0] > sketch.limit)
    assert fp.merged(fp.as_text(small), fp.as_text(c)) == fp.as_text(c)
    assert fp.merged(fp.as_text(small), "") == fp.as_text(small)


def test_columns(spark):
    rows = frame(spark, [(1, "a b c d e f"), (2, None)])
    got = rows.select(fp.fingerprint_column(F.col("text")).alias("f")).select("f", fp.estimated_containment(F.col("f"), F.col("f")).alias("c")).collect()
    assert [r["c"] for r in got] == [1.0, 1.0] and got[1]["f"] == ""
