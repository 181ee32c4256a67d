"""Jaccard join, decontamination, lattice near-duplicates and components against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.llm import base, decontamination, graph, jaccard, lattice


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s or "")


def least(ids, links):
    """Component names by brute force."""
    name = {i: i for i in ids}
    for _ in ids:
        changed = False
        for a, b in links:
            m = min(name[a], name[b])
            changed |= name[a] != m or name[b] != m
            name[a] = name[b] = m
        if not changed:
            break
    return name


def corpus(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=40)
    texts = [None, "", "  \n", "One", "one", "Two words", "a b c d", "A  B\nC d", "a b c d e", "p q r\x85s t u"]
    for _ in range(12):
        own = rng.choices(vocabulary, k=rng.randint(5, 120))
        texts.append(" ".join(own))
        for share in (0.0, 0.01, 0.03, 0.08):
            texts.append(" ".join(x if rng.random() > share else rng.choice(vocabulary) for x in own))
    texts += [" ".join(passage + rng.choices(vocabulary, k=rng.randint(3, 40))) for _ in range(15)]
    return texts


@pytest.mark.parametrize(("chunk", "spread"), [(4, False), (1024, False), (4, True)])
def test_jaccard_join(spark, monkeypatch, chunk, spread):
    if spread:
        monkeypatch.setattr(base.spread_join, "__kwdefaults__", {"most": 0, "each": 3})
        monkeypatch.setattr(base.with_sums, "__kwdefaults__", {"each": 3})
        monkeypatch.setattr(jaccard, "BROADCAST_IDS", 0)
    texts = corpus()
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    n = len(texts)
    links = [(a, b) for a in range(n) for b in range(a + 1, n) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = least(range(n), links)
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, component_id string, n int").repartition(3)
    got = jaccard.join(d, chunk=chunk).collect()
    assert len(got) == n and any(want[i] != i for i in range(n))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {i: (len(sets[i]), want[i]) for i in range(n)}


@pytest.mark.parametrize("chunk", [4, 1024])
def test_jaccard_counts_all_links(spark, chunk):
    rng = random.Random(8)
    base_words = [f"w{i}" for i in range(60)]
    texts = [" ".join(base_words[:at] + ["x" + str(k)] * (k > 0) + base_words[at:]) for k in range(14) for at in [rng.randint(0, 59)]]
    texts += [texts[0], texts[3], texts[3], "", None, "alone in this one table here"]
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in [(t or "").split() for t in texts]]
    want = [sum(i != j and bool(a) and 100 * len(a & b) >= 75 * len(a | b) for j, b in enumerate(sets)) for i, a in enumerate(sets)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert {r["doc_id"]: r["n_links"] for r in jaccard.join(d, chunk=chunk).collect()} == dict(enumerate(want)) and max(want) > 10


def test_jaccard_nulls_repeats_and_empties(spark):
    rows = [(5, "a b c d e f g"), (5, "a b c d e f g"), (None, "a b c d e f g"), (None, None), (None, "z y"), (7, "a b c d e f g")]
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == sorted([(5, 3, 5), (5, 3, 5), (None, 3, 5), (7, 3, 5), (None, 0, None), (None, 1, None)], key=str)
    assert jaccard.join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_jaccard_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BROADCAST_IDS", 0)
    d = spark.createDataFrame([(i, "a b c d e f g h i j " + ("k" if i % 2 else "l")) for i in range(6)], "doc_id long, text string")
    assert {r["component_id"] for r in jaccard.join(d).collect()} == {0}


def brute_hits(texts, items, window=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    parts = [(i, tuple(w[k : k + min(window, len(w))])) for i, t in items if (w := split(t)) for k in range(len(w) - min(window, len(w)) + 1)]
    for t in texts:
        w, hit, found = split(t), set(), set()
        for i, p in parts:
            for k in range(len(w) - len(p) + 1):
                if tuple(w[k : k + len(p)]) == p:
                    hit |= set(range(k, k + len(p)))
                    found.add(i)
        yield len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize(("block", "each"), [(3, 500_000), (3, 2), (10_000, 0)])
def test_decontamination(spark, monkeypatch, block, each):
    monkeypatch.setattr(base.with_sums, "__kwdefaults__", {"each": each})
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(12)] + ["Été", "漢字"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 4, 9, 10, 11, 25])))) for i in range(1, 14)] + [(20, None), (21, "..."), (22, "UNIQUE thing, here"), (23, "unique THING here"), (2, "repeated id")]
    texts = [None, "", "no hit at all?", "a unique thing here, and unique thing here"] + [" ".join(rng.choices(vocabulary, k=rng.randint(0, 60))) for _ in range(40)]
    texts += [f"{rng.choice(vocabulary)} {items[k][1]} x {items[k + 1][1]}" for k in range(10)] + [texts[5]]
    d = spark.createDataFrame([(i, t, 0, "q") for i, t in enumerate(texts)], "doc_id long, text string, n_words int, hits string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in decontamination.digests(decontamination.find(d, b, block=block)).collect()}
    want = dict(enumerate(brute_hits(texts, items)))
    assert got == want and any(x[4] for x in want.values())


def test_decontamination_of_empty_tables(spark):
    d, b = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert [(r["n_words"], r["n_hit"], r["contaminated"]) for r in decontamination.digests(decontamination.find(d, b)).collect()] == [(2, 0, False)]
    assert decontamination.find(d.limit(0), b).count() == 0


@pytest.mark.parametrize(("chunk", "blocks", "spread"), [(5, None, False), (1024, None, False), (1024, 2, True), (7, 3, False)])
def test_near_vectors(spark, monkeypatch, chunk, blocks, spread):
    if spread:  # joins by shuffle, hot keys dealt to several tasks
        monkeypatch.setattr(base.spread_join, "__kwdefaults__", {"most": 0, "each": 3})
        monkeypatch.setattr(base.with_sums, "__kwdefaults__", {"each": 3})
    rng = np.random.RandomState(4)
    base_ = rng.randn(40, 16)
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(base_)]
    for k in range(40, 120):
        i = rng.randint(0, 12)
        rows.append((k, (base_[i] + rng.randn(16) * rng.choice([0.0, 0.05, 0.2, 0.35])).tolist(), i % 3 if rng.rand() > 0.1 else None))
    rows += [(200, None, 1), (201, [0.0] * 16, 1), (202, [float("nan")] * 16, 1), (203, [None, 1.0], 1), (204, [], 1), (205, rows[0][1], 0), (206, rows[0][1][:3], 0), (207, [x * 3 for x in rows[0][1][:3]], 0)]
    ok = {i: np.array(v) / np.linalg.norm(v) for i, v, label in rows if label is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}
    label = {r[0]: r[2] for r in rows}
    links = [(a, b) for a in ok for b in ok if a < b and label[a] == label[b] and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] >= 0.93]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in lattice.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("kept", F.lit(1)).withColumn("class", F.lit(2)), chunk=chunk, blocks=blocks).collect()}
    assert len(got) == len(rows)
    found, total = sum(n for n, _ in got.values()) / 2, len(links)
    assert total > 100 and 0.97 * total <= found <= total
    if found == total:
        name = least([r[0] for r in rows], links)
        assert {i: c for i, (_, c) in got.items()} == name


def test_lattice_points_are_nearest():
    """Against all points of E8 within reach, found by brute force around the origin's cell."""
    rng = np.random.RandomState(0)
    x = rng.rand(200, 8) * 2 - 1
    got = lattice.lattice_points(x, 0)[:, 0] / 2
    grid = np.array(np.meshgrid(*[[-1, 0, 1]] * 8)).reshape(8, -1).T.astype(float)
    points = np.concatenate([grid[grid.sum(1) % 2 == 0], (h := np.array(np.meshgrid(*[[-1.5, -0.5, 0.5, 1.5]] * 8)).reshape(8, -1).T)[h.sum(1) % 2 == 0]])
    best = np.array([((points - v) ** 2).sum(1).min() for v in x])
    assert np.allclose(((got - x) ** 2).sum(1), best)


def test_recall_at_the_threshold():
    rng = np.random.RandomState(1)
    x = rng.randn(1500, 64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    y = rng.randn(1500, 64)
    y -= (x * y).sum(1)[:, None] * x
    y = 0.93 * x + np.sqrt(1 - 0.93**2) * y / np.linalg.norm(y, axis=1)[:, None]
    for blocks, recall in ((1, 0.985), (2, 0.98), (3, 0.97)):
        a, b = (lattice.cells(v, np.zeros(1500, np.int64), lattice.TABLES[blocks - 1], blocks) for v in (x, y))
        met = ((a == b[:, :, :1]) | (b == a[:, :, :1])).any(axis=(1, 2))
        assert met.mean() > recall, (blocks, met.mean())


@pytest.mark.parametrize("dealt", [1, 8])
def test_components(spark, dealt):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(0, 40)]
    star = [(100, i) for i in range(101, 160)]
    loose = [(rng.randint(200, 300), rng.randint(200, 300)) for _ in range(60)]
    links = chain + star + loose + [(None, 5), (7, 7)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(links, "a long, b long"), dealt).collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    nodes = {x for ab in real for x in ab}
    assert got == least(nodes, real)
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_without_keeps_rows_that_have_no_id(spark, monkeypatch):
    d = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (2, "d")], "doc_id long, __dropped string")
    gone = spark.createDataFrame([(2,), (None,)], "id long")
    for bound in (1_000_000, 0):
        monkeypatch.setattr(base, "BROADCAST_IDS", bound)
        assert sorted(r[1] for r in base.without(d.withColumnRenamed("__dropped", "x"), gone).collect()) == ["a", "c"]


def test_dealt_bytes_follow_the_text_not_the_buckets():
    """A step's rows and bytes stay within its n-grams' however many buckets there are, and counts come back from them."""
    rng = np.random.RandomState(5)
    sizes = rng.randint(1, 900, 800)
    doc = np.repeat(np.arange(800), sizes)
    grams = rng.randint(0, 2**63 - 1, len(doc)).astype(np.uint64) * np.uint64(2)
    for buckets in (1, 64, 256, 4096, 32_768, 262_144):
        rows = list(jaccard.dealt(grams, doc, buckets))
        assert len({b for b, _, _ in rows}) == len(rows) <= min(buckets, len(grams))
        assert sum(len(h) + len(c) - 2 for _, h, c in rows) <= 8 * len(grams)
        total, seen = np.zeros(800, np.int64), 0
        for b, h, c in rows:
            docs, n = jaccard.unpaired(c)
            assert (np.diff(docs) > 0).all() and n.sum() * 4 == len(h)
            total[docs] += n
            seen += len(h) // 4
        assert seen == len(grams) and (total == sizes).all()
    assert list(jaccard.dealt(grams[:0], doc[:0], 7)) == []
    assert [x.tolist() for x in jaccard.unpaired(jaccard.pairs(np.array([3, 70_000]), np.array([1, 2])))] == [[3, 70_000], [1, 2]]


@pytest.mark.parametrize("many", [1, 50_000])
def test_jaccard_bound_with_any_number_of_buckets(spark, monkeypatch, many):
    monkeypatch.setattr(jaccard, "buckets", lambda *_: many)
    texts = corpus(6)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3).withColumn("key", F.col("doc_id"))
    got = {r["doc_id"]: (r["n"], r["shared"]) for r in jaccard.incidence(docs, 5).collect()}
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    assert got == {i: (len(s), sum(any(g in o for j, o in enumerate(sets) if j != i) for g in s)) for i, s in enumerate(sets)}
