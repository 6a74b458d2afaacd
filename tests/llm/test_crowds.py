"""All partners of a crowded key are compared, by classes of equal windows."""

import collections
import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from daytally.llm import crowds, substrings
from daytally.llm.text import shingle_hashes, word_hashes

PASSAGES = substrings.Passages()


def near_copies(seed, count, length, repeats=1):
    """Texts with a passage that differs in one word each, ``repeats`` times inside words of their own."""
    rng = random.Random(seed)
    passage = [f"p{rng.randrange(10_000)}" for _ in range(length)]
    texts = []
    for n in range(count):
        body = []
        for k in range(repeats):
            edited = list(passage)
            edited[rng.randrange(length)] = f"e{n}y{k}"
            body += [f"o{rng.randrange(10**6)}" for _ in range(40)] + edited
        texts.append(" ".join(body))
    return texts


def by_all_pairs(spark, docs):
    """Covered shingles of each text, and its links, over all pairs of windows of a key."""
    rows = substrings.described(docs, PASSAGES).collect()
    said = {r["doc_id"]: r["text"] for r in docs.collect()}
    texts = {r["doc_id"]: shingle_hashes(*word_hashes([said[r["doc_id"]]]))[0] for r in rows}
    keys = collections.defaultdict(list)
    for r in rows:
        for w in r["windows"]:
            keys[w["key"]].append((r["doc_id"], w["c"], w["l"], w["r"]))
    covered, links = collections.defaultdict(set), set()
    for windows in keys.values():
        for (a, c, l, r), (b, d, m, s) in itertools.combinations(windows, 2):
            if a == b:
                continue
            left, right = min(c - l, d - m, 45), min(r - c, s - d, 45)
            same = texts[a][c - left : c + right + 1] == texts[b][d - left : d + right + 1]
            for start in range(len(same) - 45):
                if same[start : start + 46].sum() >= PASSAGES.common:
                    covered[a] |= set(range(c - left + start, c - left + start + 46))
                    covered[b] |= set(range(d - left + start, d - left + start + 46))
                    links.add((min(a, b), max(a, b)))
    return covered, links


@pytest.mark.parametrize("repeats", [1, 3])
def test_every_partner_of_a_key_counts(spark, repeats):
    texts = near_copies(1, 60, 60, repeats) + near_copies(2, 30, 50, repeats) + near_copies(1, 6, 60)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    covered, links = by_all_pairs(spark, docs)
    found, classes = collections.defaultdict(set), {}
    for r in substrings.repeated_passages(docs).collect():
        found[r["doc_id"]] |= set(range(r["start_word"], r["end_word"] - 4))
        classes[r["doc_id"]] = r["class_id"]
    assert len(covered) > 60
    assert all(covered[doc] <= found[doc] for doc in covered)
    assert all(classes[a] == classes[b] for a, b in links)


def test_tiles_and_blocks_change_nothing(spark, monkeypatch):
    texts = near_copies(3, 150, 60, 2)
    texts += texts[:5]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)

    def result():
        return sorted(map(tuple, substrings.repeated_passages(docs).collect()))

    expected = result()
    monkeypatch.setattr(crowds.class_passages, "__defaults__", (16,))
    monkeypatch.setattr(crowds, "SMALL", 4)
    monkeypatch.setattr(crowds, "BLOCK", (8, 16))
    monkeypatch.setattr(crowds, "PAIRS", 7)
    assert result() == expected


def test_no_passage_is_ruled_out_by_its_groups():
    """Pairs of cores that differ in one or two words, cut at random: groups rule out no passage."""
    rng = np.random.default_rng(4)
    rows = []
    for n in range(120):
        left, right = sorted(rng.integers(0, 46, 2), reverse=bool(n % 2))
        left, right = (45, right) if left + right < 45 else (left, right)
        said = np.arange(1, 92, dtype=np.uint16)
        for word in rng.integers(0, 95, n % 3):
            if not 41 <= word <= 49:
                said[max(0, word - 4) : word + 1] = 1000 + 7 * n
        said[: 45 - left], said[46 + right :] = 0, 0
        rows.append({"id": n, "text": n, "last": n, "left": int(left), "right": int(right), "said": said.tobytes()})
    search = crowds._Search(pa.Table.from_pylist(rows), PASSAGES)
    at = np.arange(len(rows))
    x, y = search.likely(search.groups(at, 0), search.groups(at, 1))
    likely = set(zip(x.tolist(), y.tolist(), strict=True))
    passages = 0
    for i, j in itertools.combinations(range(len(rows)), 2):
        left, right = min(search.left[i], search.left[j]), min(search.right[i], search.right[j])
        same = (search.said[i] == search.said[j])[45 - left : 46 + right]
        if any(same[k : k + 46].sum() >= PASSAGES.common for k in range(len(same) - 45)):
            passages += 1
            assert (i, j) in likely and (j, i) in likely
    assert passages > 100 and len(likely) < 0.9 * len(rows) ** 2
