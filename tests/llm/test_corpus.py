"""Corpus operators against brute force, round trips and edge cases."""

import collections
import hashlib
import itertools
import math
import random
import time
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from daytally.llm import chat, components, decontaminate, html_text, jaccard, mixing, neighbours
from daytally.llm import quality, sharding, substrings, text, tokens

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _row string, size string, n int"


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def frame(spark, texts, first=0):
    """Documents with columns whose names clash with those used inside."""
    rows = [(first + i, t, "en", f"s{i % 3}" if i % 5 else None, 0, "x", "y", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


EDGES = [None, "", "  \n ", "!!!", "one", "one", "two words", "a b c d", "a b c d e", "ß Ä é 中文 😀 x", "x" * 200_000, "be " * 30_000]


def reference_words(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def shingles(t, k=5):
    w = reference_words(t)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


# --- words ---


def test_words_do_not_depend_on_neighbours_or_pieces(monkeypatch):
    texts = ["The cat, the CAT", "", "x the y", "cat", "ÉTÉ été"]
    hashes, bounds = text.word_hashes(texts)
    each = [hashes[a:b].tolist() for a, b in itertools.pairwise(bounds)]
    assert [len(e) for e in each] == [4, 0, 3, 1, 2]
    assert each[0][0] == each[0][2] == each[2][1] and each[0][1] == each[0][3] == each[3][0] and len(set(each[4])) == 1
    long = words(random.Random(1), 5000)
    whole = text.word_hashes([long])[0].tolist()
    monkeypatch.setattr(text, "PIECE", 997)
    hashes, _, starts = text.word_hashes(["a", long], spans=True)
    assert hashes[1:].tolist() == whole and [long[i] for i in starts[1:]] == ["w"] * 5000


def test_short_texts_have_one_shingle():
    hashes, bounds = text.shingle_hashes(*text.word_hashes(["a b c", "", "a b c d e f", "b a c", "a b c"]), 5, short=True)
    assert np.diff(bounds).tolist() == [1, 0, 2, 1, 1]
    assert hashes[0] == hashes[-1]


# --- 1 quality ---


def test_quality_learns_and_keeps_held_out_labels_away(spark):
    rng = random.Random(2)
    good = [" ".join(rng.choice(["sun", "rain", "cloud", "wind"]) for _ in range(40)) for _ in range(150)]
    bad = [" ".join(rng.choice(["BUY!!", "WIN!!", "CASH!!"]) for _ in range(40)) for _ in range(150)]
    docs = frame(spark, good + bad + EDGES)
    labels = spark.createDataFrame([(i, int(i < 150), 0) for i in range(300)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    rows = quality.score_documents(docs, quality.fit(docs, labels)).collect()
    assert len(rows) == 300 + len(EDGES)
    assert all((r["score"] >= 0.5) == (r["doc_id"] < 150) == (r["predicted"] == 1) for r in rows if r["doc_id"] < 300)
    assert all(0 <= r["score"] <= 1 for r in rows)
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality.score_documents(docs, quality.fit(docs, flipped)).collect()
    assert {r["doc_id"]: r["score"] for r in rows} == {r["doc_id"]: r["score"] for r in again}


def test_quality_without_labels_and_without_documents(spark):
    docs = frame(spark, ["a b", None])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, none)
    assert [r["score"] for r in quality.score_documents(docs, model).collect()] == [0.5, 0.5]
    assert quality.score_documents(docs.limit(0), model).count() == 0


def test_long_texts_score_as_the_sum_of_their_parts():
    settings = quality.Settings()
    model = quality.QualityModel(np.random.default_rng(0).normal(size=settings.buckets), 0.1, settings)
    t = words(random.Random(3), 60_000)
    assert len(t) > 2 * text.PIECE
    whole = quality._text_features([t], settings)[0]
    assert model.score([t, "b"])[0] == pytest.approx(1 / (1 + math.exp(-(model.table[whole].mean() + 0.1))), abs=1e-3)


def test_pieces_lose_no_feature(monkeypatch):
    settings = quality.Settings()
    rng = random.Random(5)
    t = "".join(rng.choice(["ab", "c", "déf ", "\n", " ", "\t x"]) for _ in range(3000))
    whole = collections.Counter(quality._text_features([t], settings)[0].tolist())
    monkeypatch.setattr(quality, "PIECE", 100)
    found = collections.Counter(i for _, ids in quality.features([t], settings) for i in ids.tolist())
    assert found == whole and len(list(quality.pieces(t))) > 20
    assert all(b - a <= 300 for a, b, _ in quality.pieces("x" * 5000 + " y" * 500))


# --- 2 pages ---

PAGE = (
    "<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var a='</p><p>x';</script></head><body>"
    "<nav><ul><li><a href='/'>Home</a><li>News</ul></nav><div class='ad'>Buy {0}</div>"
    "<article><h1>Head {0}</h1><p>First &amp; <b>bold {0}<p>Second\n  line {0}</p><aside>side</aside>"
    "<div class=cookie-notice>We use cookies</div><section class='comments'><p>reader {0}</p></section><form>f</form></article>"
    "<footer>&copy; {0}</footer>"
)


def test_pages_give_the_article_only(spark):
    pages = [(i, f"https://a.example/{i}", PAGE.format(i)) for i in range(12)]
    pages += [(100, None, None), (101, "", "plain   text"), (102, "https://b.example/", "<body><p>alone</p></body>"), (103, "https://c.example", "<a"), (103, "https://c.example", "<a")]
    df = spark.createDataFrame([(*p, "z", 1) for p in pages], "page_id long, url string, html string, text string, host int")
    rows = html_text.main_texts(df).collect()
    found = {r["page_id"]: r["text"] for r in rows}
    assert len(rows) == len(pages)
    assert all(found[i] == f"Head {i}\nFirst & bold {i}\nSecond line {i}" for i in range(12))
    assert found[100] == "" and found[101] == "plain text" and found[102] == "alone" and found[103] == ""
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    assert html_text.main_texts(df.limit(0)).count() == 0


def test_a_template_without_article_element_is_deduced(spark):
    page = "<html><body><div class='x1'><p>Menu one</p><p>Menu two</p></div><div class='x2'><p>{0}</p><p>Sign up today</p></div></body></html>"
    rng = random.Random(4)
    said = [words(rng, 80) for _ in range(10)]
    df = spark.createDataFrame([(i, "http://h.example/p", page.format(t)) for i, t in enumerate(said)], "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in html_text.main_texts(df).collect()} == dict(enumerate(said))


FOREIGN = (
    "<html><body><div class='k1'><ul><li><a href='/'>Start {0}</a><li><a href='/x'>More {0}</a></ul></div>"
    "<div class='k2'><div class='k3'><h1>Head {0}</h1><p>{1}</p><p>{2}</p>"
    "<div class='k4'><a href='/r'>Also read {0}</a> <a href='/s'>and {0}</a></div><div class='k5'>All rights are ours</div></div>"
    "{3}</div><div class='k6'>Buy {0} now</div></body></html>"
)


def foreign_pages(n):
    rng = random.Random(8)
    for i in range(n):
        one, two = words(rng, 60), words(rng, 50)
        box = f"<div class='k7'>Seen {i}</div>" if i % 4 else ""
        yield i, "http://f.example/p", FOREIGN.format(i, one, two, box), f"Head {i}\n{one}\n{two}"


def test_class_names_need_not_say_anything(spark):
    """Menu, links, notice and advert are told from the article by classes and their slots alone."""
    made = list(foreign_pages(12))
    df = spark.createDataFrame([m[:3] for m in made], "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in html_text.main_texts(df).collect()} == {m[0]: m[3] for m in made}


def host_classes(sources):
    """Classes of a host by brute force: tokens by their counts on every page."""
    pages = [{row[0]: row for row in html_text.page_tokens(s)} for s in sources]
    names = ("token", "path", "above", "kind")
    by_vector = {}
    for token in {t for page in pages for t in page}:
        own = [page[token] for page in pages if token in page]
        if 2 * len(own) < len(pages):
            continue
        row = dict(zip(names, own[0], strict=False), pages=len(own), most=max(r[4] for r in own))
        row |= {"at": sum(r[5] for r in own) / len(own), "chars": sum(r[6] for r in own), "linked": sum(r[7] for r in own)}
        vector = tuple(page[token][4] if token in page else 0 for page in pages)
        by_vector.setdefault(vector, []).append(row)
    return [{"vector": i, "tokens": by_vector[v]} for i, v in enumerate(sorted(by_vector))]


def test_the_template_comes_from_the_classes():
    """With all tokens in one class, pages without the optional part no longer follow the template."""
    rules = html_text.Deduction()
    made = list(foreign_pages(12))
    classes = host_classes([m[2] for m in made])
    template = html_text.deduce(classes, len(made), rules)
    assert [c["root"] for c in template["classes"]] == [True, False]
    assert all(html_text.extract(m[2], template, rules) == m[3] for m in made)
    one = [{"vector": 0, "tokens": [t for c in classes for t in c["tokens"]]}]
    collapsed = html_text.deduce(one, len(made), rules)
    assert sum(html_text.extract(m[2], collapsed, rules) != m[3] for m in made) == sum(m[0] % 4 == 0 for m in made)


def test_invalid_classes_are_left_out():
    def token(path, kind, at, above=0):
        number = path if kind[0] == "<" else html_text.close_of(path)
        return {"token": number, "path": path, "above": above, "kind": kind, "pages": 4, "most": 1, "at": at, "chars": 8, "linked": 0}

    page = {"token": 0, "path": 0, "above": 0, "kind": "", "pages": 4, "most": 1, "at": -1, "chars": 8, "linked": 0}
    root = {"vector": 1, "tokens": [page, token(1, "<body", 0), token(1, ">body", 9)]}
    crossed = {"vector": 2, "tokens": [token(2, "<div", 1, 1), token(3, "<div", 2, 1), token(2, ">div", 3, 1), token(3, ">div", 4, 1)]}
    stray = {"vector": 3, "tokens": [token(5, "<p", 5, 4), token(5, ">p", 6, 4)]}
    sound = {"vector": 4, "tokens": [token(6, "<p", 5, 1), token(6, ">p", 6, 1)]}
    found = html_text.valid_classes([sound, stray, crossed, root])
    assert [c["paths"] for c in found] == [[1], [6]] and found[0]["root"]


@pytest.mark.parametrize("tag", ["div", "p><button><div", "table><tr><td"])
def test_depth_costs_no_more_than_length(spark, tag):
    deep = f"<{tag}>" * 50_000 + "far in" + "</div>" * 10
    started = time.time()
    assert html_text.extract("<body>" + deep, None, html_text.Deduction()) == ("" if "button" in tag else "far in")
    assert len(html_text.page_tokens(deep)) > 10_000
    assert time.time() - started < 20


def test_unclosed_and_broken_markup():
    rules = html_text.Deduction()
    assert html_text.extract("<article><p>a<p>b<ul><li>c<li>d</ul></article>e", None, rules) == "a\nb\nc\nd"
    assert html_text.extract("<article><p title='x>y'>a</p><!-- no <p>z</p> --><p>1 < 2 &lt; 3&nbsp;4", None, rules) == "a\n1 < 2 < 3 4"
    assert html_text.extract("<main><script>never closed <p>x</p>", None, rules) == ""


# --- 3 benchmark ---


def weighted(a, b):
    x, y = collections.Counter(a), collections.Counter(b)
    return sum((x & y).values()) / sum((x | y).values())


def grams(w):
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(5)
    items = [words(rng, rng.randrange(12, 60)) for _ in range(12)] + ["too short item", None, "", "be " * 20]
    texts = []
    for i in range(60):
        body = words(rng, rng.randrange(5, 200)).split()
        if i % 2:
            taken = (items[i % 12]).split()
            for _ in range(i % 5 // 2):
                taken[rng.randrange(len(taken))] = "edit"
            at = rng.randrange(len(body))
            body[at:at] = taken
        texts.append(" ".join(body))
    texts += EDGES
    docs = frame(spark, texts)
    bench = spark.createDataFrame([(i, t, 7) for i, t in enumerate(items)], "item_id long, text string, n int")
    found = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontaminate.matches(docs, bench).collect()}
    wanted = {}
    for (d, t), (i, item) in itertools.product(enumerate(texts), enumerate(items)):
        own, own_item = reference_words(t), reference_words(item)
        if len(own_item) < 5 or len(own) < len(own_item):
            continue
        target, all_grams = grams(own_item), grams(own)
        near = set(target)
        if not near & set(all_grams):
            continue
        n = len(target)
        starts = range(len(all_grams) - n + 1) if len(set(own)) > 1 else [0]
        best = max((weighted(all_grams[s : s + n], target) for s in starts), default=0)
        if best >= 0.8:
            wanted[d, i] = best
    assert found.keys() == wanted.keys() and len(wanted) > 15
    assert all(found[k] == pytest.approx(wanted[k]) for k in wanted)
    clean = {r["doc_id"] for r in decontaminate.decontaminated(docs, bench).collect()}
    assert clean == set(range(len(texts))) - {d for d, _ in wanted}
    assert decontaminate.matches(docs.limit(0), bench).count() == 0 and decontaminate.matches(docs, bench.limit(0)).count() == 0


def test_blocks_find_all_fingerprints_within_the_radius():
    rng = np.random.default_rng(6)
    blocks = decontaminate._blocks(23)
    assert len(blocks) == 24 and sum(w for _, w in blocks) == 64
    for _ in range(300):
        a = int(rng.integers(2**63))
        flipped = sum(1 << int(b) for b in rng.choice(63, 23, replace=False))
        assert any((a ^ (a ^ flipped)) >> first & ((1 << width) - 1) == 0 for first, width in blocks)


# --- 4 passages ---


def test_compact_windows_cover_every_stretch_once():
    rng = np.random.default_rng(7)
    hashes = rng.integers(0, 50, 120).astype(np.uint32)
    bounds = np.array([0, 70, 75, 120])
    low, place, high = substrings.compact_windows(hashes, bounds, 1)
    seen = collections.Counter()
    for l, c, h in zip(low, place, high, strict=True):
        for i, j in itertools.product(range(l, c + 1), range(c, h + 1)):
            assert hashes[c] == hashes[i : j + 1].min()
            seen[i, j] += 1
    assert set(seen.values()) == {1}
    assert len(seen) == sum(n * (n + 1) // 2 for n in np.diff(bounds))


def test_passages_are_found_and_clean_texts_left_alone(spark):
    rng = random.Random(8)
    passage = words(rng, 60, 5000)
    texts = []
    for i in range(40):
        body = words(rng, 120, 5000).split()
        if i < 12:
            body[i * 3 : i * 3] = passage.split()
        elif i < 16:
            edited = passage.split()
            edited[30] = "edit"
            body[40:40] = edited
        texts.append(" ".join(body))
    copy = words(rng, 80, 5000)
    texts += [copy, copy, words(rng, 49, 5000), *EDGES, *EDGES]
    rows = substrings.repeated_passages(frame(spark, texts)).collect()
    spans = collections.defaultdict(list)
    for r in rows:
        spans[r["doc_id"]].append((r["start_word"], r["end_word"]))
        assert r["n_words"] == r["end_word"] - r["start_word"] >= 50
    for i in range(12):
        assert any(s <= i * 3 and e >= i * 3 + 60 for s, e in spans[i])
    assert spans[40] == spans[41] == [(0, 80)]
    long = {i for i, t in enumerate(texts) if t and t.startswith("be be")}
    assert set(spans) - set(range(12, 16)) == set(range(12)) | {40, 41} | long
    assert len({r["class_id"] for r in rows if r["doc_id"] < 12}) == 1
    assert substrings.repeated_passages(frame(spark, texts).limit(0)).count() == 0


def test_a_pair_is_verified_once(spark):
    """The task has one Python function, whose pairs without a stretch are left out inside it."""
    shingles = np.arange(60, dtype=np.uint32)
    other = np.where(shingles % 2, shingles, shingles + 1000).astype(np.uint32)
    pairs = [(1, 2, shingles.tobytes(), shingles.tobytes(), 7, 9, [-2]), (1, 3, shingles.tobytes(), other.tobytes(), 7, 9, [-2])]
    columns = "a long, b long, _a binary, _b binary, a_from int, b_from int, shifts array<int>"
    found = substrings.verified(spark.createDataFrame(pairs * 300, columns), substrings.Passages()).where(F.size("_in_a") > 0)
    rows = found.collect()
    assert len(rows) == 300 and {(r["a"], r["b"]) for r in rows} == {(1, 2)}
    assert [tuple(x) for x in rows[0]["_in_a"]] == [(7, 67)] and [tuple(x) for x in rows[0]["_in_b"]] == [(9, 69)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "ArrowEvalPython" not in plan


def brute_near_passages(texts, width=46, similarity=0.8):
    """Numbers of the texts that hold a stretch of 50 words like one of another text."""
    sets = [[tuple(w[i : i + 5]) for i in range(len(w) - 4)] for w in map(reference_words, texts)]
    names = {s: i for i, s in enumerate({s for t in sets for s in t})}
    coded = [np.array([names[s] for s in t]) for t in sets]
    found = set()
    for i, j in itertools.combinations(range(len(coded)), 2):
        a, b = coded[i], coded[j]
        if len(np.intersect1d(a, b)) < 30:
            continue
        for shift in {int(x) - int(y) for x in range(0, len(a)) for y in np.flatnonzero(b == a[x])}:
            lo, hi = max(0, shift), min(len(a), len(b) + shift)
            if hi - lo < width:
                continue
            same = np.cumsum(np.concatenate([[0], a[lo:hi] == b[lo - shift : hi - shift]]))
            common = (same[width:] - same[:-width]).max()
            if common >= similarity * (2 * width - common):
                found |= {i, j}
    return found


@pytest.mark.parametrize("length", [60, 80, 120])
def test_near_passages_are_found_in_crowded_groups(spark, length):
    """Five passages, sixty copies each that differ in one word, inside documents of their own."""
    rng = random.Random(length)
    texts = []
    for group in range(5):
        passage = [f"p{group}x{rng.randrange(10_000)}" for _ in range(length)]
        for n in range(60):
            edited = list(passage)
            edited[rng.randrange(length)] = f"e{group}y{n}"
            texts.append(" ".join([words(rng, 40, 10**6), *edited, words(rng, 40, 10**6)]))
    near = brute_near_passages(texts)
    found = {r["doc_id"] for r in substrings.repeated_passages(frame(spark, texts)).collect()}
    assert found <= near and len(found) >= 0.9 * len(near)


# --- 5 Jaccard ---


def test_jaccard_join_equals_brute_force(spark):
    rng = random.Random(9)
    texts = []
    for i in range(60):
        base = words(rng, rng.randrange(3, 150), 2000)
        texts.append(base)
        for _ in range(rng.randrange(3)):
            other = base.split()
            for _ in range(rng.randrange(4)):
                other[rng.randrange(len(other))] = "edit"
            texts.append(" ".join(other))
    hub = words(rng, 400, 5000).split()
    texts += [" ".join(hub[:i] + ["e"] + hub[i + 1 :]) for i in range(90)]
    texts += EDGES
    docs = frame(spark, texts)
    join = jaccard.Join(bucket=16, part=24)
    found = {r["doc_id"]: r for r in jaccard.near_duplicates(docs, join).collect()}
    sets = [shingles(t) for t in texts]
    links, parent = collections.Counter(), list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(texts)), 2):
        if sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8:
            links[i] += 1
            links[j] += 1
            a, b = sorted((root(i), root(j)))
            parent[b] = a
    assert {i: r["n_links"] for i, r in found.items()} == {i: links[i] for i in range(len(texts))}
    assert {i: r["class_id"] for i, r in found.items()} == {i: root(i) for i in range(len(texts))}
    kept = sorted(r["doc_id"] for r in jaccard.one_of_each(docs, join).collect())
    assert kept == sorted({root(i) for i in range(len(texts))})
    assert jaccard.one_of_each(docs, join).columns == docs.columns
    assert jaccard.near_duplicates(docs.limit(0), join).count() == 0


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 90), (5, 5)], "a long, b long")
    found = {r["node"]: r["component"] for r in components.connected_components(links).collect()}
    assert found == {r["node"]: r["component"] for r in components.connected_components(links, task_links=0).collect()}
    assert found == {**{i: 0 for i in range(61)}, 90: 90, 100: 90}


# --- 6 neighbours ---


def test_neighbours_reach_the_recall_and_score_exactly(spark):
    rng = np.random.default_rng(10)
    v = rng.normal(size=(1500, 16)).astype(np.float32)
    v[7] = v[8]
    rows = [(i, x.tolist(), 0) for i, x in enumerate(v)]
    rows += [(2000, None, 0), (2010, [0.0] * 16, 0), (2020, [float("nan")] * 16, 0), (2030, [None] * 16, 0), (2040, [float("inf")] * 16, 0), (2050, [1.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = collections.defaultdict(list)
    for r in neighbours.nearest(df, F.col("vec_id") % 10 == 0, neighbours.Search(sample=50)).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    d = v.astype(np.float64)
    hits = 0
    assert set(found) == set(range(0, 1500, 10))
    for q, got in found.items():
        scores = d @ d[q]
        scores[q] = -np.inf
        hits += len({x[1] for x in got} & set(np.lexsort((np.arange(1500), -scores))[:20].tolist()))
        assert [x[0] for x in got] == list(range(1, 21)) and q not in {x[1] for x in got}
        assert all(s == pytest.approx(scores[i], abs=1e-12) for _, i, s in got)
        assert [(-s, i) for _, i, s in got] == sorted((-s, i) for _, i, s in got)
    assert hits / len(found) / 20 >= 0.9
    assert neighbours.nearest(df.limit(0), F.lit(True)).count() == 0
    few = neighbours.nearest(df.where("vec_id < 5"), F.lit(True)).collect()
    assert len(few) == 20


def test_hilbert_visits_neighbouring_cells():
    cells = np.array(list(itertools.product(range(8), repeat=3)))
    order = cells[np.argsort(neighbours.hilbert(cells, 3))]
    assert (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()


# --- 7 shards ---


def test_table_is_balanced_and_stable():
    names = sharding.shard_names(7)
    table = sharding.fill_table(names, 1009)
    counts = np.bincount(table, minlength=7)
    assert counts.max() - counts.min() <= 1
    fewer = sharding.fill_table(names[:-1], 1009)
    moved = (fewer != table) & (table != 6)
    assert moved.mean() < 0.25
    for wrong in (([], 7), (["a", "a"], 7), (["a"], 8)):
        with pytest.raises(ValueError):
            sharding.fill_table(*wrong)


def test_rows_are_placed_by_their_key(spark):
    docs = frame(spark, ["a"] * 50).withColumn("shard", F.lit("old"))
    docs = docs.union(docs).union(docs.withColumn("doc_id", F.lit(None).cast("long")).limit(2))
    table = sharding.fill_table(sharding.shard_names())
    rows = sharding.assign(docs).collect()
    assert len(rows) == 102
    for r in rows:
        key = "" if r["doc_id"] is None else str(r["doc_id"])
        slot = int(hashlib.md5(key.encode()).hexdigest()[:13], 16) % sharding.TABLE
        assert r["slot"] == slot and r["shard"] == table[slot]
    assert sharding.assign(docs.limit(0)).count() == 0


# --- 8 chat ---


def test_templates():
    def show(source, **names):
        return chat.Template(source).render(**names)[0]

    assert show("a{{ 1 + 2 }}b{# no #}") == "a3b"
    assert show("{% for x in xs %}{{ loop.index }}:{{ x.t | upper }}{% if not loop.last %}, {% endif %}{% endfor %}", xs=[{"t": "a"}, {"t": "b"}]) == "1:A, 2:B"
    assert show("{% set y = 'q' ~ 2 %}{% if x == 1 or y in 'zq2' %}yes{% elif x %}{{ x }}{% else %}no{% endif %}", x=0) == "yes"
    assert show("a  {{- ' b ' -}}  c") == "a b c"
    assert chat.Template("{% if 1 < 2 %}a{{ 'b' | upper }}{% else %}{{ x }}{% endif %}c").tree == (chat.Output(chat.Const("aBc")),)
    assert chat.Template("x{% generation %}{{ t }}{% endgeneration %}y").render(t="ab") == ("xaby", [(1, 3)])
    for wrong in ("{% for %}", "{% if a %}", "{{ a", "{{ a.b( }}", "{{ x | open }}", "{% endif %}", "{{ a ? }}", "{% import os %}"):
        if wrong != "{{ a":
            with pytest.raises(chat.TemplateError):
                chat.Template(wrong)
    for unsafe in ("{{ m.__class__ }}", "{{ nothing }}", "{{ m.text.upper }}"):
        with pytest.raises(chat.TemplateError):
            chat.Template(unsafe).render(m={"text": "a"})


def test_conversations_come_back(spark):
    nasty = ["<|im_end|>\n<|im_start|>user\nx", "\\", "<\\|", "<", "\\n", "", None, "a" * 100_000, "<|<|im_end|>", "\\<|"]
    rows = [(1, i, "assistant" if i % 2 else "user", t, "z") for i, t in enumerate(nasty)]
    rows += [(2, None, None, None, "z"), (None, 0, "as\nsis<|tant", "t", "z"), (3, 1, "assistant", "same", "z"), (3, 1, "assistant", "same", "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, loss string")
    made = {r["conv_id"]: r for r in chat.format_conversations(df).collect()}
    assert chat.read_turns(made[1]["text"]) == [("assistant" if i % 2 else "user", t or "") for i, t in enumerate(nasty)]
    assert chat.read_turns(made[None]["text"]) == [("as\nsis<|tant", "t")]
    digests = {r["conv_id"]: r for r in chat.digest_conversations(chat.format_conversations(df)).collect()}
    learned = "".join(t or "" for i, t in enumerate(nasty) if i % 2)
    assert digests[1]["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest() and digests[1]["loss_chars"] == len(learned)
    assert digests[3]["n_turns"] == 2 and digests[3]["loss_chars"] == 8 and digests[2]["loss_chars"] == 0
    assert chat.format_conversations(df.limit(0)).count() == 0


# --- 9 mix ---


def expected_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    free, left, target = set(order), 1.5 * sum(sizes.values()), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 2 * sizes[s]}
        if not over:
            return target | {s: weight[s] * level for s in free}
        target |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(2.0 * sizes[s] for s in over)
        free -= over
    return target


def test_mix_meets_targets(spark):
    rng = random.Random(11)
    texts = [words(rng, rng.randrange(0, 900)) for _ in range(120)] + EDGES[:-2]
    docs = frame(spark, texts)
    docs = docs.union(docs.limit(5))
    mixture = mixing.Mix(block=16, shard_blocks=64, chunk_rows=30)
    rows = mixing.mix_report(docs, mixture).collect()
    assert len(rows) == docs.count()
    source = {r["doc_id"]: (r["source"], r["text"]) for r in docs.collect()}
    sizes, taken = collections.Counter(), collections.Counter()
    for r in rows:
        name, t = source[r["doc_id"]]
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) and 0 <= r["taken"] <= 2 * r["size"]
        sizes[name] += r["size"]
        taken[name] += r["taken"]
    wanted = expected_targets(sizes)
    for r in rows:
        name = source[r["doc_id"]][0]
        assert r["source_size"] == sizes[name] and r["target"] == pytest.approx(wanted[name])
    assert all(abs(taken[s] - wanted[s]) <= 0.5 for s in sizes)
    again = mixing.mix_report(docs, mixture).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    assert mixing.mix_report(docs.limit(0), mixture).count() == 0


def test_slots_of_the_mix_do_not_pass_the_driver_or_one_task(spark):
    rng = random.Random(5)
    docs = frame(spark, [words(rng, rng.randrange(1, 300)) for _ in range(60)] + [None, "", " "])
    mixture = mixing.Mix(block=16, shard_blocks=64, slot_rows=100)
    for build in (mixing.mix_report, mixing.mixed_documents):
        mixed = build(docs, mixture)
        mixed.collect()
        ran = mixed._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        joins = [line for line in ran.splitlines() if "Join" in line and "block#" in line]
        assert joins and all("SortMergeJoin" in line for line in joins)
    slots = mixing.draw_slots(mixing.placed_documents(docs, mixture)[1], mixture)
    assert slots.rdd.getNumPartitions() == -(-slots.count() // 100) > 3


def test_small_sources_meet_their_targets_to_the_word(spark):
    """Sources of 10, 20 and 150 words, all at their limit, in blocks of 128."""
    rows = [(i, words(random.Random(i), n), "en", s, 0, "x", "y", 1) for i, (s, n) in enumerate([("a", 10), ("b", 20), ("c", 100), ("c", 50), ("d", 3000)])]
    docs = spark.createDataFrame(rows, DOCS)
    taken, targets = collections.Counter(), {}
    for r in mixing.mix_report(docs).collect():
        taken[rows[r["doc_id"]][3]] += r["taken"]
        targets[rows[r["doc_id"]][3]] = r["target"]
        assert r["taken"] <= 2 * r["size"]
    assert (targets["a"], targets["b"], targets["c"]) == (20.0, 40.0, 300.0)
    assert all(abs(taken[s] - targets[s]) <= 0.5 for s in targets)


def test_mix_does_not_depend_on_the_layout(spark):
    rng = random.Random(21)
    docs = frame(spark, [words(rng, rng.randrange(0, 200)) for _ in range(300)])
    mixture = mixing.Mix(block=16, shard_blocks=64, chunk_rows=50)
    layouts = [components.cut_lineage(docs.repartition(n).orderBy(F.xxhash64("doc_id", F.lit(n)))) for n in (2, 7)]
    one, other = (sorted(map(tuple, mixing.mix_report(d, mixture).collect())) for d in layouts)
    assert one == other


def test_mixed_documents_are_what_was_taken(spark):
    rng = random.Random(12)
    docs = frame(spark, [words(rng, rng.randrange(1, 300)) for _ in range(60)] + [None, ""])
    mixture = mixing.Mix(block=16)
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix_report(docs, mixture).collect()}
    got = collections.Counter()
    out = mixing.mixed_documents(docs, mixture)
    assert out.columns == docs.columns
    for r in out.collect():
        got[r["doc_id"]] += len(r["text"].split())
        assert r["n_chars"] == len(r["text"])
    assert got == {k: v for k, v in taken.items() if v}


def test_equal_vectors_at_the_edge_go_to_the_smaller_id():
    """Matrix products of equal vectors may differ in the last bit; ranks must not."""
    rng = np.random.default_rng(9)
    for n in range(100):
        one = rng.normal(size=64)
        c = np.vstack([np.tile(one, (25, 1)), rng.normal(size=(int(rng.integers(0, 40)), 64))])
        place = rng.permutation(len(c))
        ids = np.arange(len(c))
        q = np.vstack([one + 0.01 * rng.normal(size=64) for _ in range(int(rng.integers(1, 5)))])
        found = neighbours.best_pairs(-1 - np.arange(len(q)), np.zeros(len(q), np.int64), q, ids[place], ids[place], c[place], 20)
        for i in range(len(q)):
            scores = np.array([math.fsum(a * b for a, b in zip(q[i], v)) for v in c]).round(9)
            expected = sorted(ids, key=lambda j: (-scores[j], j))[:20]
            assert [x for a, x in zip(found.column(0).to_pylist(), found.column(3).to_pylist()) if a == -1 - i] == expected, n


def test_vectors_of_each_length_are_searched_among_themselves(spark):
    rows = [(i, [float(i + 1), 1.0]) for i in range(5)] + [(10 + i, [1.0, 2.0, float(i)]) for i in range(3)]
    got = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.lit(True)).collect()
    assert collections.Counter(r["query_id"] for r in got) == {**dict.fromkeys(range(5), 4), **dict.fromkeys(range(10, 13), 2)}
    assert all((r["query_id"] < 10) == (r["vec_id"] < 10) for r in got)


def test_permutations_visit_every_index():
    for n in (1, 2, 3, 10, 97, 1000):
        for key in (1, 2**60):
            image = mixing.permuted(np.arange(n), np.full(n, n), np.full(n, key, np.uint64))
            assert sorted(image.tolist()) == list(range(n))


# --- 10 tokens ---


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json", "word_bpe_49k.json"])
def test_token_counts_equal_whole_texts(spark, name):
    public = pytest.importorskip("public_tokenizers")
    path = public.path(name)
    texts = [*EDGES, " a", "a ", "a  b", "\n a\t b", "▁ x ▁y", "a ▁", "<s> x </s>", "<|endoftext|>a", "a" + " " * 40 + "b c", "　a \xa0 b"]
    rows = {r["doc_id"]: r for r in tokens.count_documents(frame(spark, texts), path, 100).collect()}
    model = tokens.counter(path).model
    for i, t in enumerate(texts):
        t = t or ""
        n = len(model.encode(t)) if name.endswith(".model") else len(model.encode(t, add_special_tokens=False).ids)
        assert rows[i]["n_tokens"] == n and rows[i]["n_bytes"] == len(t.encode()) and rows[i]["over_limit"] == (n > 100)


# --- pipeline ---


def test_pipeline_runs_on_given_tables(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    out = corpus_pipeline.run(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert set(docs.columns) < set(out.columns)
    rows = out.collect()
    assert rows and {r["doc_id"] for r in rows} <= {r["doc_id"] for r in docs.collect()}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "n-gram Jaccard join", "benchmark decontamination", "mixing sources", "sharding"]
