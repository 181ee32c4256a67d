"""The plans: scans read only the columns and rows they need, and nothing runs Python or a range join."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from skein.operators import evaluation, models, temporal

def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plan") / "e")
    spark.range(100).selectExpr("id % 5 AS k", "id AS t", "id % 7 AS v", "id AS i", "'x' AS unused").write.parquet(path)
    return spark.read.parquet(path)


def test_filters_and_columns_reach_the_scan(events):
    text = plan(events.filter("t > 50").groupBy("k").agg(F.sum("v")))
    assert "PushedFilters: [IsNotNull(t), GreaterThan(t,50)]" in text and "unused" not in text.split("ReadSchema")[1].split("\n")[0]


@pytest.mark.parametrize("build", ["asof", "trailing", "pending"])
def test_temporal_operators_are_windows(events, build):
    q = events.selectExpr("k", "t AS q", "i AS id")
    df = {
        "asof": lambda: temporal.asof_latest(q, events, "k", "q", "t", "i", ["v"]), "trailing": lambda: temporal.trailing_stats(q, events, "k", "q", "t", "v"), "pending": lambda: temporal.pending_count(q, events, "k", "q", "t", "v"),
    }[build]()
    text = plan(df)
    assert "Window" in text and not re.search("NestedLoop|Cartesian|Python|Arrow|Pandas", text) and "unused" not in text


def test_models_are_saved_and_read(spark, tmp_path):
    df = spark.createDataFrame([(float(i % 9) if i % 5 else None, "ab"[i % 2], int(i % 9 > 4)) for i in range(120)], "x double, g string, y int")
    fitted = models.fit_logistic(df, ["x"], ["g"], "y")
    models.save(fitted, str(tmp_path / "m"))
    again = models.load(spark, str(tmp_path / "m"))
    pick = lambda m: [round(r["p"], 9) for r in models.score(m, df, "p").collect()]
    assert again[1] == fitted[1] and pick(again) == pick(fitted)


def test_reasons(spark):
    df = spark.createDataFrame([(3.0, None, 1.0), (0.0, 5.0, 0.0)], "a double, b double, c double")
    parts = models.contributions(df, {"a": 1.0, "b": 0.5, "c": 2.0}, {"a": 1.0, "b": 1.0, "c": 0.0})
    got = [r["r"] for r in parts.select(models.top_reasons(n=3, unknown={"b": "unknown"}).alias("r")).collect()]
    assert got == ["a = 3.0 (+2.000); c = 1.0 (+2.000); b = unknown (+0.000)", "b = 5.0 (+2.000); a = 0.0 (-1.000); c = 0.0 (+0.000)"]


@pytest.mark.parametrize("few", [3, 4096])
def test_medians(spark, monkeypatch, few):
    import random
    import statistics

    monkeypatch.setattr(models, "FEW", few)
    monkeypatch.setattr(models, "BUCKETS", 7)
    rng = random.Random(2)
    rows = [(rng.gauss(0, 9), float(rng.randint(0, 3)), None, rng.choice([None, 1e9, -2.5, 0.125]), 7) for _ in range(301)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e int")
    want = [statistics.median(v) if (v := [r[i] for r in rows if r[i] is not None]) else 0.0 for i in range(5)]
    assert list(models.medians(df, ["a", "b", "c", "d", "e"]).values()) == want and models.medians(df, []) == {}
    assert models.medians(df.limit(0), ["a"]) == {"a": 0.0}


def test_linear_parts_are_the_score(spark):
    df = spark.createDataFrame([(float(i % 9), float(i % 4), "ab"[i % 2], int(i % 9 > 4)) for i in range(200)], "x double, z double, g string, y int")
    fitted = models.fit_logistic(df, ["x", "z"], [], "y")
    weights, means = models.linear_parts(fitted, ["x", "z"])
    rows = models.score(fitted, df, "p").collect()
    import math

    line = [math.log(r["p"] / (1 - r["p"])) - sum(weights[c] * (r[c] - means[c]) for c in ("x", "z")) for r in rows]
    assert max(line) - min(line) < 1e-6 and abs(means["x"] - sum(r["x"] for r in rows) / len(rows)) < 1e-9


def test_small_helpers(spark, tmp_path):
    from skein.functions import scalars as S
    from skein.operators import leakage, metrics
    from skein.sources import files, schemas

    assert models.suspicious(0.95) and not models.suspicious(0.92) and not models.suspicious(None)
    assert leakage.forbidden_columns(["a", "dep_delay", "status"]) == ["dep_delay", "status"]
    d = spark.createDataFrame([("A", "US-FL", "2024-03-09"), ("Z", "CA-ON", None), (None, None, "1999-12-31")], "code string, region string, day string").withColumn("day", F.col("day").cast("date"))
    got = [tuple(r) for r in d.select(metrics.reason("code"), S.state_code("region"), S.month_label("day")).collect()]
    assert got == [("Carrier", "FL", "Mar 2024"), (None, "CA-ON", None), (None, None, "Dec 1999")]
    months = spark.createDataFrame([(m,) for m in (1, 2, 3, 4, 5, None)], "m int")
    assert {k: [r["m"] for r in v.collect()] for k, v in models.time_split(months, "m").items()} == {"history": [2], "fit": [3], "validation": [4], "test": [5]}
    header = [f.name for f in schemas.AIRPORTS]
    raw = ["type" if c == "airport_type" else c for c in header]
    line = lambda **v: ",".join(str(v.get(c, "")) for c in raw)
    (tmp_path / "a.csv").write_text("\n".join([",".join(raw), line(iata_code="PBI", ident="KPBI", type="medium_airport", iso_country="US"), line(iata_code="PBI", ident="APBI", type="large_airport", iso_country="CA"), line(iata_code="toolong", ident="X"), line(iata_code="", ident="Y")]) + "\n")
    a = files.read_airports(spark, str(tmp_path / "a.csv"))
    assert a.columns == header and a.count() == 2
    from skein.operators.rows import keep_first

    assert [r["ident"] for r in keep_first(a, ["iata_code"], files.airport_rank(a)).collect()] == ["KPBI"]
    (tmp_path / "z.csv").write_text("airport_code,timezone,more\nPBI,America/New_York,1\n")
    assert [tuple(r) for r in files.read_zones(spark, str(tmp_path / "z.csv")).collect()] == [("PBI", "America/New_York")]


def newton(x, y, penalty):
    """Weights and intercept of a penalised logistic regression by Newton's steps, the intercept free."""
    import numpy as np

    a = np.column_stack([x, np.ones(len(x))])
    w, free = np.zeros(a.shape[1]), np.append(np.full(x.shape[1], penalty), 0.0)
    for _ in range(60):
        p = 1 / (1 + np.exp(-a @ w))
        w = w - np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(free), a.T @ (p - y) + free * w)
    return w


@pytest.mark.parametrize("weighted", [False, True])
def test_logistic_scores_against_newton(spark, weighted):
    """Median imputation, indicators, scaling, all levels one-hot and the penalty, by another solver."""
    import numpy as np

    rng = np.random.RandomState(1)
    rows = []
    for i in range(500):
        x, z, g = rng.randn() * 3 + 1, (None if rng.rand() < 0.2 else float(rng.randint(0, 9))), "pqr"[rng.randint(0, 3)]
        rows.append((i, float(x), z, g, int(0.6 * x + (0 if z is None else z / 4) - 2 + (g == "p") + rng.randn() > 0)))
    df = spark.createDataFrame(rows, "i int, x double, z double, g string, y int").repartition(3)
    got = {r["i"]: r["s"] for r in models.score(models.fit_logistic(df, ["x", "z"], ["g"], "y", c=0.5, weighted=weighted), df, "s").collect()}
    x = np.array([r[1] for r in rows])
    z = np.array([np.nan if r[2] is None else r[2] for r in rows])
    missing, z = np.isnan(z), np.where(np.isnan(z), np.nanmedian(z), z)
    num = np.column_stack([x, z, np.zeros(500), missing])
    spread = num.std(axis=0, ddof=1)
    num = np.where(spread > 0, (num - num.mean(axis=0)) / np.where(spread > 0, spread, 1), 0.0)
    a, y = np.column_stack([num, *[[r[3] == g for r in rows] for g in "pqr"]]).astype(float), np.array([r[4] for r in rows], float)
    if weighted:  # each class counts half: rows repeat by weight, so fit on weights by scaling the sums
        w = np.where(y == 1, 500 / (2 * y.sum()), 500 / (2 * (500 - y.sum())))
    else:
        w = np.ones(500)
    design, v = np.column_stack([a, np.ones(500)]), np.zeros(a.shape[1] + 1)
    free = np.append(np.full(a.shape[1], w.sum() / (0.5 * 500)), 0.0)
    for _ in range(60):
        p = 1 / (1 + np.exp(-design @ v))
        v = v - np.linalg.solve((design * (w * p * (1 - p))[:, None]).T @ design + np.diag(free), design.T @ (w * (p - y)) + free * v)
    want = 1 / (1 + np.exp(-design @ v))
    assert max(abs(got[i] - want[i]) for i in range(500)) < 1e-4


def test_platt_slope_against_newton(spark):
    import numpy as np

    rng = np.random.RandomState(2)
    p = np.clip(rng.beta(2, 5, 800), 0, 1)
    y = (rng.rand(800) < p**1.3).astype(int)
    found = evaluation.platt(spark.createDataFrame([(float(a), int(b)) for a, b in zip(p, y, strict=True)], "p double, y int"), "p", "y")
    q = np.clip(p, 1e-6, 1 - 1e-6)
    slope, intercept = newton(np.log(q / (1 - q))[:, None], y, 0.0)
    assert abs(found["slope"] - slope) < 1e-4 and abs(found["intercept"] - intercept) < 1e-4


def test_fits_pass_over_written_rows(spark, monkeypatch):
    """No fit is given a plan that joins the driver tables again in each of its passes."""
    import __spark_entry__ as entry
    from skein.operators import boosting

    class Given(Exception):
        pass

    def stop(train, *_, **__):
        raise Given(train)

    for module, name in ((models, "fit_logistic"), (models, "fit_trees"), (boosting, "fit")):
        monkeypatch.setattr(module, name, stop)
    for q in ("logistic_scores", "model_reasons", "gbt_scores", "tree_importance", "boosted_scores", "boosted_reasons", "boosted_importance"):
        with pytest.raises(Given) as e:
            entry.queries()[q](spark, entry.SMOKE)
        files = e.value.args[0].inputFiles()
        assert files and all("model-rows-" in f for f in files), q


def test_repeated_rows_add_no_rows_to_the_fit_of_gbt_scores(spark, tmp_path, monkeypatch):
    """Tables three times as long with shifted order keys give the trees as many weighted rows, each three times as heavy."""
    import __spark_entry__ as entry

    class Given(Exception):
        pass

    def stop(df, *_):
        raise Given(df)

    monkeypatch.setattr(models, "materialize", stop)
    for name in ("lineitem", "orders", "customer", "supplier"):
        df = spark.read.parquet(f"{entry.SMOKE}/{name}.parquet")
        key = {"lineitem": "l_orderkey", "orders": "o_orderkey"}.get(name)
        if key:
            df = df.withColumn("__i", F.explode(F.sequence(F.lit(0), F.lit(2)))).withColumn(key, F.col(key) + F.col("__i") * 10_000_000).drop("__i")
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    found = []
    for d in (entry.SMOKE, str(tmp_path)):
        with pytest.raises(Given) as e:
            entry.queries()["gbt_scores"](spark, d)
        found.append(e.value.args[0].agg(F.count("*"), F.sum("__n")).first())
    assert found[0][0] == found[1][0] and found[0][1] * 3 == found[1][1] > 0


def test_boosted_queries_fit_all_trees(spark, monkeypatch):
    """The registered fits have the original's settings, not fewer trees."""
    import __spark_entry__ as entry
    from skein.operators import boosting

    class Given(Exception):
        pass

    def stop(train, numeric, text, label, settings=boosting.Settings()):
        raise Given(settings)

    monkeypatch.setattr(boosting, "fit", stop)
    for q in ("boosted_scores", "boosted_reasons", "boosted_importance"):
        with pytest.raises(Given) as e:
            entry.queries()[q](spark, entry.SMOKE)
        s = e.value.args[0]
        assert (s.trees, s.leaves, s.rate, s.least_rows, s.row_share, s.column_share, s.penalty) == (500, 63, 0.05, 200, 0.8, 0.8, 1.0), q


def test_volumes_share_exchanges(spark):
    """Counts by a list of columns and by a longer list that begins with it take one exchange."""
    from skein.operators.rows import volumes

    df = spark.createDataFrame([(1, 2, 3, 4)] * 3 + [(1, 2, 4, 4)], "o int, d int, h int, x int")
    out = volumes(df, by_hour=["o", "d", "h"], by_end=["x", "d"], by_day=["o", "d"])
    assert out.columns == ["o", "d", "h", "x", "by_hour", "by_end", "by_day"]
    assert len(re.findall(r"Exchange hashpartitioning", out._jdf.queryExecution().executedPlan().toString())) == 2
    assert sorted(tuple(r)[4:] for r in out.collect()) == [(1, 4, 4), (3, 4, 4), (3, 4, 4), (3, 4, 4)]


def test_ablation_finds_medians_once(spark, monkeypatch):
    """The medians of all lists' columns are found together."""
    calls, found = [], models.medians
    monkeypatch.setattr(models, "medians", lambda df, numeric: calls.append(numeric) or found(df, numeric))
    rows = [(float(i % 7), float(i % 5) if i % 4 else None, "ab"[i % 2], int(i % 7 > 3)) for i in range(80)]
    df = spark.createDataFrame(rows, "a double, b double, g string, y int")
    assert models.ablation(df, df, {"one": ["a"], "two": ["b", "a"]}, ["g"], "y", trees=2, depth=2).count() == 4
    assert calls == [["a", "b"]]


def tree_rows(spark):
    rows = [(i % 11, float(i % 5) if i % 4 else None, float(i * 7919 % 3000), "abc"[i * 31 % 3]) for i in range(600)]
    return spark.createDataFrame([(*r, int((r[0] > 4) ^ (r[3] == "b") ^ (r[1] is None) ^ (i % 13 == 0))) for i, r in enumerate(rows)], "a int, b double, wide double, g string, y int")


def test_grouped_trees_are_those_of_all_rows(spark):
    """Columns of few values: the same splits, shares and scores from a row for each group, unknown and unseen values included."""
    df = tree_rows(spark)
    several = df.unionByName(df).unionByName(df.filter("a > 7"))
    one, all_ = (models.fit_trees(several, ["a", "b"], ["g"], "y", trees=6, depth=4, grouped=k) for k in (True, False))
    shares = [dict(models.gain_importance(m, ["a", "b"], ["g"])) for m in (one, all_)]
    assert all(abs(shares[0][c] - shares[1][c]) < 1e-9 for c in ("a", "b", "g")) and min(shares[0].values()) > 0
    asked = df.select("a", "b", "g", "y").unionByName(spark.createDataFrame([(-5, 2.4, "a", 0), (99, 9.0, "z", 0)], "a int, b double, g string, y int"))
    scores = [models.score(m, asked, "p").orderBy("a", "b", "g", "y").collect() for m in (one, all_)]
    assert all(abs(x["p"] - z["p"]) < 1e-9 for x, z in zip(*scores, strict=True))


def test_bin_edges(spark):
    """A bin for each of few values; quantiles of all rows elsewhere, with a frequent value alone in its bin."""
    from bisect import bisect_right

    df = tree_rows(spark).withColumn("heavy", F.when(F.col("wide") < 1500, 0.0).otherwise(F.col("wide"))).withColumn("same", F.lit(3.0))
    a, wide, heavy, same = models.bin_edges(df, ["a", "wide", "heavy", "same"], 16)
    assert a == [x + 0.5 for x in range(10)]
    values = [[r[0] for r in df.select(c).collect()] for c in ("wide", "heavy", "same")]
    sizes = [[sum(bisect_right(e, x) == k for x in v) for k in range(len(e) + 1)] for e, v in zip((wide, heavy, same), values, strict=True)]
    assert len(sizes[0]) == 16 and max(sizes[0]) - min(sizes[0]) <= 4
    assert sizes[1][0] == values[1].count(0.0) and sizes[2] == [600, 0]


def test_tree_importance_fits_on_groups(spark, monkeypatch):
    """The trees see a row for each combination of bins, and all of the model rows by weight."""
    import __spark_entry__ as entry
    from skein.plans import registry

    given, found = [], models.materialize
    monkeypatch.setattr(models, "materialize", lambda df, tag: given.append(found(df, tag)) or given[-1])
    assert entry.queries()["tree_importance"](spark, entry.SMOKE).count() == 4
    (rows,) = given
    weighed = rows.agg(F.sum("__n")).first()[0]
    assert rows.count() == rows.drop("__n").distinct().count() and weighed == registry._model_rows(spark, entry.SMOKE).count()


def test_legs_are_shuffled_narrow_and_never_to_customers(spark):
    """Where no table is small, orders meet customers before the lines, and the lines carry no key or time that is used up."""
    import __spark_entry__ as entry
    from skein.plans import registry

    key, old = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(key, "-1")
    try:
        text = plan(registry._model_rows(spark, entry.SMOKE))
    finally:
        spark.conf.set(key, old)
    below = {k: re.search(rf"Exchange hashpartitioning\({k}#.*\n(.*)", text)[1] for k in ("o_custkey", "l_orderkey")}
    assert "l_orderkey" not in below["o_custkey"]
    assert "price" in below["l_orderkey"] and not any(c in below["l_orderkey"] for c in ("l_partkey", "l_suppkey", "l_shipdate"))
