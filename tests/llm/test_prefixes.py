"""Prefix trie against brute force."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from daytally.llm import prefixes, queries

TURNS = "conv_id long, turn long, role string, text string, tile int, depth string, key string, words int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y", 2) for r in rows], TURNS)


def brute_nodes(sequences):
    """The contract's rows for {conv_id: [(role, text), ...]}."""
    members: dict = {}
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children: dict = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)

    def below(node):
        own = (len(members[node]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        found = [below(n) for n in children.get(node, [])]
        return sum(f[0] for f in found) or 1, own + sum(f[1] for f in found)

    out = []
    for node, held in members.items():
        leaves, saved = below(node)
        ends = sorted(c for c in held if len(sequences[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(held), len(node), parent, len(held), len(children.get(node, [])), leaves, saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def brute_rebuilt(rows):
    own: dict = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        own.setdefault(c, []).append((role or "", text or ""))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def collected(df):
    assert df.columns[:8] == COLUMNS and [t for _, t in df.dtypes] == ["bigint"] * 7 + ["string"]
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=str)


def made(rng, convs, hot=0):
    rows = []
    for c in range(convs):
        n = rng.choice([0, 1, 2, 3, 3, 4, 9])
        rows += [(c, t, rng.choice(["user", "assistant"]), rng.choice(["a b", "a", "c  d e", "", None])) for t in range(n)]
    for c in range(hot):
        rows += [(1000 + c, t, "user", f"same words {t}") for t in range(5)]
    return rows


@pytest.mark.parametrize("trie", [prefixes.Trie(), prefixes.Trie(tile=7, ids=3), prefixes.Trie(tile=1), prefixes.Trie(tile_turns=4)])
def test_nodes_equal_brute_force(spark, trie):
    rng = random.Random(6)
    rows = made(rng, 150, hot=70)
    # Null turns come first, null roles and texts are empty, repeated rows are turns.
    rows += [(300, None, None, "z"), (300, None, "user", None), (300, 2, "user", "a"), (300, 2, "user", "a"), (None, 0, "user", "a"), (301, 1, "use", "ra"), (302, 1, "user", "a")]
    expected = brute_nodes(brute_rebuilt(rows))
    assert collected(queries.conversation_trie(frame(spark, rows).repartition(6), trie)) == expected


def test_one_long_conversation_and_its_prefixes(spark):
    turns = [("user", f"turn {i}") for i in range(3000)]
    rows = [(20 * c, t, *turns[t]) for c, n in enumerate([3000, 1, 2999, 1500, 3000]) for t in range(n)]
    expected = brute_rebuilt(rows)
    found = queries.conversation_trie(frame(spark, rows), prefixes.Trie(tile=2))
    got = {r["depth"]: r for r in found.collect()}
    assert len(got) == 3001 and all(len(v) for v in expected.values())
    assert [got[d]["n_convs"] for d in (0, 1, 2, 1500, 1501, 2999, 3000)] == [5, 5, 4, 4, 3, 3, 2]
    assert got[3000]["conv_id"] == 0 and got[2999]["n_leaves"] == 1 and got[0]["saved_tokens"] == 2 * (4 + 3 * 1499 + 2 * 1499 + 1)


def test_empty_tables_and_turnless_conversations(spark):
    assert queries.conversation_trie(frame(spark, [])).count() == 0
    assert queries.conversation_trie(frame(spark, [(None, 1, "user", "a")])).count() == 0
    turnless = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4)
    got = collected(queries.conversation_trie(frame(spark, [(turnless, 0, "user", "a")])))
    assert got == [(turnless, 0, None, 1, 0, 1, 0, hashlib.sha256(str(turnless).encode()).hexdigest())]


def test_range_minimum_equals_scanning():
    rng = np.random.default_rng(1)
    for size in (1, 2, 3, 17, 64):
        values = rng.integers(0, 5, size)
        table = prefixes.RangeMinimum(values)
        spans = np.array(list(itertools.combinations(range(size + 1), 2)))
        assert table.least(spans[:, 0], spans[:, 1]).tolist() == [values[a:b].min() for a, b in spans]
        at, depth = np.divmod(np.arange(size * 6), 6)
        assert table.right_end(at, depth).tolist() == [next((j for j in range(a + 1, size) if values[j] < d), size) for a, d in zip(at, depth)]
        assert table.left_end(at, depth).tolist() == [next((j for j in range(a, -1, -1) if values[j] < d), -1) for a, d in zip(at, depth)]


def test_a_hot_conversation_is_read_as_a_stream(spark):
    rows = frame(spark, [(20 * c, 0, "user", "hot") for c in range(3000)])
    found = collected(queries.conversation_trie(rows, prefixes.Trie(tile=64, ids=10)))
    ids = ",".join(str(20 * c) for c in range(3000))
    assert found[-1][3] == 3000 and len(found) == 2
    assert {r[7] for r in found} == {hashlib.sha256(ids.encode()).hexdigest(), prefixes.NOTHING}
