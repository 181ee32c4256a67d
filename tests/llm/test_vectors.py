"""Nearest neighbours and whitening against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.llm import base, neighbours, whitening

SCHEMA = "vec_id long, embedding array<float>, score string, x int"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], "s", 1) for i, v in rows], SCHEMA).repartition(parts)


def brute(rows, every=20, k=20):
    """query_id to its (score, vec_id) list, by the contract."""
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    out = {}
    for at, (i, q) in enumerate(ok):
        if i is None or i % every:
            continue
        near = [(-math.fsum((x * q).tolist()), j is None, j or 0) for n, (j, x) in enumerate(ok) if n != at and len(x) == len(q)]
        out.setdefault(i, []).append([(-s, None if none else j) for s, none, j in sorted(near)[:k]])
    return out


def answered(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    return out


@pytest.mark.parametrize("shuffled", [False, True])
def test_nearest_cases(spark, monkeypatch, shuffled):
    if shuffled:
        monkeypatch.setattr(neighbours, "BROADCAST_LISTS", 0)
        monkeypatch.setattr(base.spread_join, "__kwdefaults__", {"most": 0, "each": 3})
    rng = np.random.RandomState(4)
    rows = [(i, rng.randn(6) * rng.lognormal(0, 1)) for i in range(90)]
    same = rng.randn(6)
    rows += [(i, same) for i in range(90, 150)]  # ties, more than the answers
    rows += [(200 + i, rng.randn(3)) for i in range(0, 25)]  # another length
    rows += [(300, None), (320, []), (340, [0.0] * 6), (360, [1.0, None, 1, 1, 1, 1]), (380, [math.nan] * 6), (400, [math.inf] * 6), (None, rng.randn(6) * 3), (420, [1.0, 2, 3, 4, 5])]
    rows = [(i, None if v is None else list(v)) for i, v in rows]
    got, want = answered(neighbours.nearest(frame(spark, rows))), brute(rows)
    assert set(got) == {q for q, v in want.items() if v[0]}
    for q, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, len(found) + 1))
        assert [(s, v) for _, s, v in found] == want[q][0], q


def test_nearest_of_repeated_and_empty(spark):
    rows = [(0, [1.0, 0.0])] * 3 + [(20, [0.5, 0.5])] + [(1, [0.0, 1.0])]
    got = neighbours.nearest(frame(spark, rows)).orderBy("query_id", "rank").collect()
    of = [[(r["vec_id"], r["score"]) for r in got if r["query_id"] == q] for q in (0, 20)]
    assert sorted(of[0]) == sorted([(0, 1.0), (0, 1.0), (20, 0.5), (1, 0.0)] * 3)
    assert of[1] == [(0, 0.5), (0, 0.5), (0, 0.5), (1, 0.5)]
    empty = neighbours.nearest(frame(spark, []))
    assert empty.collect() == [] and empty.columns == ["query_id", "rank", "vec_id", "score"]


@pytest.mark.parametrize("kind", ["sphere", "norms", "copies"])
def test_recall_of_descent_and_search(spark, kind):
    """Blocks far smaller than the table, so that the graph comes from NN-descent: recall against brute force."""
    rng = np.random.RandomState(8)
    n, dim = 3000, 16
    x = rng.randn(n, dim)
    x /= np.linalg.norm(x, axis=1)[:, None]
    if kind == "norms":
        x *= rng.lognormal(0, 0.5, n)[:, None]
    if kind == "copies":  # a third are near copies of one vector
        x[: n // 3] = x[0] + rng.randn(n // 3, dim) * 0.02
    x = x.astype(np.float32)
    rows = [(int(i), x[i].tolist()) for i in range(n)]
    got = answered(neighbours.nearest(frame(spark, rows), tables=3, block=128))
    a = x.astype(float)
    hit = 0
    for q in range(0, n, 20):
        s = a @ a[q]
        s[q] = -np.inf
        hit += len({v for _, _, v in got[q]} & set(np.argsort(-s)[:20].tolist()))
        assert len(got[q]) == 20
    assert hit / len(got) / 20 >= 0.9


def test_descent_improves_the_graph(spark):
    rng = np.random.RandomState(3)
    x = rng.randn(1500, 12).astype(np.float32)
    index = neighbours.build(frame(spark, [(int(i), x[i].tolist()) for i in range(1500)]), tables=3, block=64, degree=10, settled=0.02)
    nodes = index.nodes
    first = neighbours._first_graph(nodes, 1500, 10, 3, 64)
    names = {r["class"]: x_ for r in index.vectors.collect() for x_ in [neighbours.exact(bytes(r["packed"]))]}
    keys = list(names)
    a = np.array([names[k] for k in keys])
    d = ((a[:, None] - a[None]) ** 2).sum(-1) if len(a) <= 2000 else None
    norms = np.sqrt(np.maximum((a * a).sum(1).max() - (a * a).sum(1), 0))
    d = d + (norms[:, None] - norms[None]) ** 2
    true = {k: {keys[j] for j in np.argsort(d[i])[1:11]} for i, k in enumerate(keys)}
    recall = lambda rows: np.mean([len(set(r["near"]) & true[r["class"]]) / 10 for r in rows])
    before, after = recall(first.select("class", "near").collect()), recall(index.graph.collect())
    assert before < 0.6 and after > 0.9, (before, after)


def whole(rows):
    keep = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dim = max((len(v) for _, v in keep), default=0)
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in list(v) + [0.0] * (dim - len(v))] for _, v in keep]
    return [i for i, _ in keep], x


@pytest.mark.parametrize(("dim", "decay"), [(5, 0.5), (64, 1.0), (80, None), (70, 0.6)])
def test_whitening(spark, dim, decay):
    """Fewer dimensions than components; no gap (the basis is expanded); 34 strong directions (power passes suffice); a spectrum that sinks into the entries' rounding."""
    rng = np.random.RandomState(dim)
    turn = np.linalg.qr(rng.randn(dim, dim))[0]
    values = np.where(np.arange(dim) < 34, 40 - np.arange(dim) / 2, 0) if decay is None else 40 * decay ** np.arange(dim) * (1 if decay < 1 else np.linspace(1, 0.5, dim))
    v = (rng.randn(400, dim) * values) @ turn.T + 3
    rows = [(int(i), v[i].tolist()) for i in range(400)] + [(500, None), (501, [math.nan] * dim), (502, [None] * dim), (None, v[0].tolist()), (7, v[3].tolist()), (503, v[1][: dim - 2].tolist())]
    ids, x = whole(rows)
    n, x = len(x), np.array(x)
    s = x.sum(axis=0)
    c = x - s / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1][:32], u[:, ::-1][:, :32]
    got = whitening.whiten(frame(spark, rows)).toPandas()
    k = min(32, dim)
    assert len(got) == n * k and set(got.n) == {n} and got.identity_error.nunique() == 1 and got.identity_error[0] <= 1e-8
    deviation = sorted(((n * x - s) ** 2).sum(axis=1).tolist())
    assert sorted(got[got.component == 1].deviation) == deviation
    shares = got.drop_duplicates("component").sort_values("component").explained.to_numpy()
    assert np.allclose(shares, e / np.trace(c.T @ c / n), rtol=1e-9)
    one = got[got.vec_id == 11].sort_values("component").whitened.to_numpy()
    want = (c[ids.index(11)] @ u) / np.sqrt(e)
    assert np.allclose(np.abs(one), np.abs(want), atol=1e-6)
    found = whitening.fit(whitening.entries(frame(spark, rows)))
    assert found.expanded == (dim in (64, 70)) and found.passes <= 5


def test_whitening_of_few_and_far_entries(spark):
    same = frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])
    assert whitening.whiten(same).collect() == []
    assert whitening.whiten(frame(spark, [])).collect() == [] and whitening.whiten(frame(spark, [(1, []), (2, None)])).collect() == []
    flat = whitening.whiten(frame(spark, [(i, [float(i), 5.0, 2.0 * i]) for i in range(6)])).toPandas()  # one direction only
    assert set(flat.component) == {1} and abs(flat.explained[0] - 1) < 1e-12 and flat.identity_error[0] < 1e-9
    far = whitening.whiten(frame(spark, [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 3.0])])).toPandas()
    x = [[(1 << 34) * 64 + 1_000_000, 1_000_000], [-(1 << 34) * 64 + 1_000_000, 1_000_064], [1_000_000, 1_000_192]]
    s = [sum(r[j] for r in x) for j in (0, 1)]
    want = {i + 1: sum((3 * r[j] - s[j]) ** 2 for j in (0, 1)) for i, r in enumerate(x)}
    assert {r.vec_id: None if math.isnan(r.deviation) else int(r.deviation) for r in far.itertuples()} == {i: d if d < 1 << 63 else None for i, d in want.items()}


def test_partial_sums_go_up_a_tree(spark):
    rows = frame(spark, [(i, [float(i), -float(i)]) for i in range(300)], parts=70)
    x = whitening.entries(rows)
    assert whitening._added(x, (2, 2), lambda a: (a - 1_000_000).T.astype(float) @ (a - 1_000_000), 2)[0, 0] == sum((64 * i) ** 2 for i in range(300))
    assert x.select(F.size("x")).distinct().collect()[0][0] == 2
