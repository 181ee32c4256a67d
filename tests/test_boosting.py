"""Leaf-wise boosting against one split at a time, and tree attribution against enumeration of subsets."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skein.operators import attribution, boosting, evaluation, models

SCHEMA = "k long, a double, b double, c string, y int, score string"
FEW = boosting.Settings(trees=4, rate=0.3, leaves=6, least_rows=15, row_share=1.0, column_share=1.0, bins=16)


def rows(n=900, seed=2, noise=0.3):
    """A label that needs unknown values, sets of text values and an interaction."""
    rng = np.random.RandomState(seed)
    out = []
    for i in range(n):
        a = None if rng.rand() < 0.25 else float(rng.randint(0, 40))
        b, c = float(rng.randn()), [None, *"pqrstuv"][rng.randint(0, 8)]
        z = (1.5 if a is None else -1.0 if a > 20 else 0.2) + (1.2 if c in ("p", "s", "v") else -0.8) * (1 if b > 0 else -0.5)
        out.append((i, a, math.nan if rng.rand() < 0.02 else b, c, int(z + noise * rng.randn() > 0), "s"))
    return out


def one_by_one(codes, y, text, s, start):
    """Margins of boosting in which the best split of all leaves is made alone, with plain loops."""
    margin = np.full(len(y), start)
    for _ in range(s.trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)

        def best(rows):
            found = None
            G, H = g[rows].sum(), h[rows].sum()
            for f in range(len(codes)):
                x, lam = codes[f][rows], s.penalty + (10.0 if f in text else 0)
                present = sorted(set(x.tolist()))
                if f in text:
                    key = {v: g[rows][x == v].sum() / (h[rows][x == v].sum() + 10.0) for v in present}
                    order = sorted(present, key=lambda v: (key[v], v))
                    tables = [set(order[: k + 1]) for k in range(len(order) - 1)]
                else:
                    known = [v for v in present if v]
                    cuts = [{v for v in known if v <= t} for t in known]
                    tables = [c | u for c in cuts for u in (({0}, set()) if 0 in present else (set(),))]
                for t in tables:
                    left = np.isin(x, list(t))
                    if min(left.sum(), (~left).sum()) < s.least_rows:
                        continue
                    gl, hl = g[rows][left].sum(), h[rows][left].sum()
                    gain = gl**2 / (hl + lam) + (G - gl) ** 2 / (H - hl + lam) - G**2 / (H + s.penalty)
                    if gain > 1e-9 and (found is None or gain > found[0] + 1e-9):
                        found = (gain, rows[left], rows[~left])
            return found

        leaves = [np.arange(len(y))]
        while len(leaves) < s.leaves:
            options = [(b, i) for i, leaf in enumerate(leaves) if (b := best(leaf))]
            if not options:
                break
            b, i = max(options, key=lambda o: o[0][0])
            leaves[i : i + 1] = [b[1], b[2]]
        for leaf in leaves:
            margin[leaf] += -g[leaf].sum() / (h[leaf].sum() + s.penalty) * s.rate
    return margin


def arrays(data):
    return [pa.array([r[1] for r in data], pa.float64()), pa.array([r[2] for r in data], pa.float64()), pa.array([r[3] for r in data], pa.string())]


def test_trees_are_those_of_single_splits(spark):
    data = rows()
    model = boosting.fit(spark.createDataFrame(data, SCHEMA).repartition(3), ["a", "b"], ["c"], "y", FEW)
    codes, y = model.encode(arrays(data)), np.array([r[4] for r in data])
    assert all((t.left < 0).sum() <= 6 for t in model.trees) and len(model.trees) == 4
    want = one_by_one(codes, y, {2}, FEW, math.log(y.mean() / (1 - y.mean())))
    assert np.allclose(model.margins(codes), want, atol=1e-6)
    # covers are the rows of the draw
    for t in model.trees:
        assert t.cover[0] == len(data) and all(t.cover[i] == t.cover[t.left[i]] + t.cover[t.right[i]] for i in np.flatnonzero(t.left >= 0))


def test_fit_does_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(boosting, "WRITTEN", 2)
    data = rows(700)
    s = boosting.Settings(trees=5, leaves=8, least_rows=10, seed=3)
    a, b = (boosting.fit(spark.createDataFrame(data[::step], SCHEMA).repartition(parts), ["a", "b"], ["c"], "y", s) for step, parts in ((1, 1), (-1, 5)))
    monkeypatch.setattr(boosting, "WRITTEN", 100)
    c = boosting.fit(spark.createDataFrame(data, SCHEMA), ["a", "b"], ["c"], "y", s)
    codes = a.encode(arrays(data))
    for other in (b, c):
        assert [t.left.tolist() for t in a.trees] == [t.left.tolist() for t in other.trees]
        assert np.array_equal(a.margins(codes), other.margins(codes))


def test_unknown_values_learn_their_side(spark):
    data = [(i, None if i % 3 == 0 else float(i % 7), 1.0, "p", int(i % 3 == 0), "s") for i in range(300)]
    model = boosting.fit(spark.createDataFrame(data, SCHEMA), ["a", "b"], ["c"], "y", boosting.Settings(trees=30, leaves=3, least_rows=20, rate=0.3, row_share=1.0, column_share=1.0))
    p = [r[0] for r in boosting.score(model, spark.createDataFrame(data, SCHEMA), "p").orderBy("k").select("p").collect()]
    assert all((x > 0.95) == (i % 3 == 0) and (x < 0.05) == (i % 3 != 0) for i, x in enumerate(p))


def test_beats_level_wise_trees(spark):
    train, test = spark.createDataFrame(rows(4000, 5, 1.0), SCHEMA), spark.createDataFrame(rows(3000, 6, 1.0), SCHEMA)
    model = boosting.fit(train, ["a", "b"], ["c"], "y", boosting.Settings(trees=40, leaves=15, least_rows=30, rate=0.1))
    auc = lambda df: evaluation.curve_metrics(df, "p", "y").first()["roc_auc"]
    clean = lambda df: df.drop("score").withColumn("b", F.when(~F.isnan("b"), F.col("b")))
    old = models.fit_trees(clean(train), ["a", "b"], ["c"], "y", trees=20)
    assert auc(boosting.score(model, test, "p")) >= auc(models.score(old, clean(test), "p")) - 0.002


def test_saved_model_and_scoring_of_new_values(spark, tmp_path):
    data = rows(600)
    df = spark.createDataFrame(data, SCHEMA)
    model = boosting.fit(df, ["a", "b"], ["c"], "y", FEW)
    boosting.save(model, spark, str(tmp_path / "m"))
    boosting.save(model, spark, str(tmp_path / "m"))
    new = spark.createDataFrame([(1, 1e9, -1e9, "never seen", 0, "s"), (2, None, None, None, None, None), (3, -1.0, 0.0, "p", 1, "s")], SCHEMA)
    one, two = ([tuple(r) for r in boosting.score(m, new, "p", margin="m").orderBy("k").collect()] for m in (model, boosting.load(spark, str(tmp_path / "m"))))
    assert one == two and len(one) == 3 and all(0 < r[-2] < 1 and abs(r[-2] - 1 / (1 + math.exp(-r[-1]))) < 1e-12 for r in one)
    assert boosting.score(model, new, "p").columns == [*new.columns, "p"]
    assert boosting.score(model, df.limit(0), "p").count() == 0


def test_fits_without_much(spark):
    df = spark.createDataFrame(rows(50), SCHEMA)
    assert boosting.fit(df.limit(0), ["a"], ["c"], "y", FEW).start == 0.0
    for y in (0, 1):
        model = boosting.fit(df.withColumn("y", F.lit(y)), ["a"], ["c"], "y", FEW)
        assert not model.trees and (model.start > 4) == bool(y) and math.isfinite(model.start)
    none = boosting.fit(df.withColumn("a", F.lit(None).cast("double")).withColumn("c", F.lit(None).cast("string")), ["a"], ["c"], "y", FEW)
    assert all(len(t.left) == 1 for t in none.trees)
    unlabelled = df.unionByName(df.withColumn("y", F.lit(None).cast("int")))
    assert boosting.fit(unlabelled, ["a", "b"], ["c"], "y", FEW).start == boosting.fit(df, ["a", "b"], ["c"], "y", FEW).start


# attribution


def random_tree(rng, columns, depth):
    left, right, column, table, value, cover = [], [], [], [], [], []

    def add(d, n):
        i = len(left)
        for x, v in ((left, -1), (right, -1), (column, 0), (table, np.zeros(256, bool)), (value, 0.0), (cover, float(n))):
            x.append(v)
        if d and n > 3 and rng.rand() < 0.9:
            column[i], table[i] = rng.randint(columns), rng.rand(256) < 0.5
            part = int(rng.randint(1, n)) if rng.rand() < 0.9 else 0  # sometimes a side that no training row took
            left[i] = add(d - 1, part)
            right[i] = add(d - 1, n - part)
        else:
            value[i] = rng.randn()
        return i

    add(depth, 400)
    return boosting.Tree(*(np.array(x) for x in (column, left, right)), np.stack(table), np.array(value), np.array(cover))


def expected(tree, x, known, node=0):
    """The tree's value with the columns outside ``known`` averaged by cover."""
    if tree.left[node] < 0:
        return tree.value[node]
    a, b = int(tree.left[node]), int(tree.right[node])
    if tree.column[node] in known:
        return expected(tree, x, known, a if tree.goes_left[node][x[tree.column[node]]] else b)
    return sum(expected(tree, x, known, k) * (tree.cover[k] / tree.cover[node] if tree.cover[node] else 0.0) for k in (a, b))


@pytest.mark.parametrize(("columns", "depth", "wide"), [(3, 5, 12), (6, 6, 12), (5, 4, 2), (1, 3, 12)])
def test_parts_equal_the_enumeration_of_subsets(monkeypatch, columns, depth, wide):
    monkeypatch.setattr(attribution, "WIDE", wide)
    rng = np.random.RandomState(columns * 10 + depth)
    trees = [random_tree(rng, columns, depth) for _ in range(6)]
    codes = rng.randint(0, 256, (columns, 25)).astype(np.uint8)
    got = attribution.parts([attribution.Paths(t) for t in trees], codes, columns)
    for r in range(25):
        x = codes[:, r]
        for i in range(columns):
            rest, want = [c for c in range(columns) if c != i], 0.0
            for k in range(columns):
                w = math.factorial(k) * math.factorial(columns - k - 1) / math.factorial(columns)
                for some in itertools.combinations(rest, k):
                    want += w * sum(expected(t, x, {*some, i}) - expected(t, x, set(some)) for t in trees)
            assert abs(got[i, r] - want) < 1e-9
        total = sum(t.value[t.places(x[:, None])][0] for t in trees)
        assert abs(got[:, r].sum() + sum(attribution.Paths(t).mean() for t in trees) - total) < 1e-9


def test_contributions_add_up_and_make_reasons(spark):
    data = rows(800)
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    model = boosting.fit(df, ["a", "b"], ["c"], "y", boosting.Settings(trees=12, leaves=10, least_rows=10))
    found = attribution.contributions(model, boosting.score(model, df, "p", margin="m"), mean="mean")
    assert found.columns == [*df.columns, "p", "m", "contributions", "mean"]
    for r in found.collect():
        assert abs(r["mean"] + sum(x["part"] for x in r["contributions"]) - r["m"]) < 1e-9
        assert [x["feature"] for x in r["contributions"]] == ["a", "b", "c"] and r["contributions"][2]["text"] == r["c"] and r["contributions"][0]["value"] == r["a"]
    said = {r["k"]: r["why"] for r in found.select("k", models.top_reasons(n=3, unknown={"a": "unknown yet"}, text=True).alias("why")).collect()}
    assert "a = unknown yet (+" in next(said[r[0]] for r in data if r[1] is None)
    assert f"c = {data[0][3] or 'n/a'} (" in said[0]
    shares = models.mean_contribution(found, {"a": "numbers", "b": "numbers"})
    assert abs(sum(r["share"] for r in shares.collect()) - 1) < 1e-12 and {r["feature_group"] for r in shares.collect()} == {"numbers", "c"}
    assert attribution.contributions(model, df.limit(0)).count() == 0


def test_equal_rows_are_one_of_a_block(spark):
    """Repeated rows are held once with their number, and the sums of many repeats are exact."""
    rows = [(float(i % 5), "ab"[i % 2], i % 3 % 2) for i in range(30)] * 40
    df = spark.createDataFrame(rows, "x double, g string, y int")
    data = df.select(*boosting.features(df, ["x"], ["g"]), F.col("y").alias("__y")).withColumn("__draw", F.lit(1).cast("long"))
    model = boosting.Model(["x"], ["g"], [np.arange(4.0)], [["a", "b"]], 0.0)
    times = [np.frombuffer(r["times"], np.int64) for r in boosting._blocks(data, model).collect()]
    assert sum(map(len, times)) == len(set(rows)) and sum(int(t.sum()) for t in times) == len(rows)
    w = np.array([(1 << 60) + 1, -(1 << 60) + 2, 3, -5, (1 << 61) - 1], np.int64)
    assert boosting._summed(np.array([0, 0, 1, 1, 2]), w, 3).tolist() == [3, -2, (1 << 61) - 1]


def test_one_task_grows_the_trees_of_passes(spark, monkeypatch):
    """Few different rows are held by one task; the trees are those that passes over all tasks' blocks give, also of repeated rows."""
    data = rows(500) + rows(200) * 3
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    s = boosting.Settings(trees=3, leaves=8, least_rows=10, seed=5)
    held = boosting.fit(df, ["a", "b"], ["c"], "y", s)
    monkeypatch.setattr(boosting, "HELD", 0)
    passes = boosting.fit(df, ["a", "b"], ["c"], "y", s)
    assert len(held.trees) == len(passes.trees) == 3 and any(len(t.left) > 1 for t in held.trees)
    for a, b in zip(held.trees, passes.trees, strict=True):
        assert all(np.array_equal(getattr(a, c), getattr(b, c)) for c in boosting.Tree.__dataclass_fields__)


def test_draws_of_repeated_rows_are_binomial():
    draw = np.random.RandomState(3).randint(0, 1 << 62, 20000).astype(np.uint64)
    for times in (1, 2, 7, 300, (1 << 20) + 5):
        t = boosting._drawn(draw, np.full(20000, times), 9, 0.8)
        assert t.min() >= 0 and t.max() <= times
        sd = math.sqrt(times * 0.16)
        assert abs(t.mean() - 0.8 * times) < 5 * sd / math.sqrt(20000) and abs(t.std() / sd - 1) < 0.03
    assert np.array_equal(boosting._drawn(draw, np.full(20000, 3), 9, 1.0), np.full(20000, 3))


def test_counted_parts_add_up_to_those_of_all_rows(spark):
    """Rows equal in all codes are one row with their number; shares are those of all rows."""
    df = spark.createDataFrame(rows(300) * 4, SCHEMA).repartition(3)
    model = boosting.fit(df, ["a"], ["c"], "y", boosting.Settings(trees=5, leaves=6, least_rows=10))
    few = attribution.counted(model, df).collect()
    assert sum(r["rows"] for r in few) == 1200 and len(few) == df.select("a", "c").distinct().count()
    one, all_ = ({r["feature_group"]: r["share"] for r in models.mean_contribution(x, {"a": "numbers"}, rows=k).collect()} for x, k in ((attribution.counted(model, df), "rows"), (attribution.contributions(model, df), None)))
    assert one.keys() == all_.keys() == {"numbers", "c"} and all(abs(one[k] - all_[k]) < 1e-12 for k in one)
    assert attribution.counted(model, df.limit(0)).count() == 0


def test_parts_found_once_are_those_of_each_row(spark):
    """With ``once``, rows get the parts of their combination of codes; columns, values and means are the same."""
    df = spark.createDataFrame(rows(300) * 2, SCHEMA).repartition(3)
    model = boosting.fit(df, ["a", "b"], ["c"], "y", boosting.Settings(trees=5, leaves=6, least_rows=10))
    one, each = (attribution.contributions(model, df, mean="mean", once=k) for k in (True, False))
    assert one.columns == each.columns
    shown = lambda x: sorted(map(repr, x.drop("b").collect()))
    assert shown(one) == shown(each) and one.count() == 600
    assert attribution.contributions(model, df.limit(0), once=True).count() == 0
