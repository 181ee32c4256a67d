"""Deduplication, lookups, history, quality, evaluation and staging on literal rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skein.operators import evaluation, features, history, metrics, models, quality, rows, staging


def test_latest_load_wins_and_null_is_latest(spark):
    df = spark.createDataFrame([(1, 5, "a", "x"), (1, None, "a", "y"), (2, 3, "a", "x"), (2, 3, "b", "y")], "k int, loaded int, src string, v string")
    assert {r["k"]: r["v"] for r in rows.keep_latest(df, ["k"], "loaded", "src").collect()} == {1: "y", 2: "y"}


def test_fallback_lookup(spark):
    c = spark.createDataFrame([("AAA",), ("BBB",), ("CCC",), (None,)], "code string")
    a = spark.createDataFrame([("AAA", "first")], "k string, name string")
    b = spark.createDataFrame([("KAAA", "no"), ("KBBB", "second")], "k string, name string")
    got = {r["code"]: (r["name"], r["matched_by"]) for r in rows.fallback_lookup(c, "code", a, "k", b, "k", "K", ["name"]).collect()}
    assert got == {"AAA": ("first", "code"), "BBB": ("second", "fallback"), "CCC": (None, None), None: (None, None)}


def test_upsert_rejects_repeats(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert sorted(tuple(r) for r in rows.upsert(old, new, ["k"]).collect()) == [(1, "a"), (2, "c"), (3, "d")]
    with pytest.raises(ValueError):
        rows.upsert(old, new.union(new), ["k"])


def test_rotation_of_unknown_vehicles(spark):
    df = spark.createDataFrame([(1, "t", 60, 120), (2, "t", 150, 200), (3, "t", 180, 240), (4, None, 10, 20)], "id int, v string, dep int, arr int").withColumn("day", F.lit(1))
    got = {r["id"]: (r["leg_of_day"], r["legs_today"], r["turnaround"]) for r in rows.rotation(df, "v", "day", "dep", "arr", "id").collect()}
    assert got == {1: (1, 3, None), 2: (2, 3, 30), 3: (3, 3, None), 4: (None, None, None)}


def test_status_order(spark):
    df = spark.createDataFrame([(True, True, 1), (False, True, 1), (False, False, 1), (False, False, 0), (False, False, None)], "is_cancelled boolean, is_diverted boolean, is_delayed int")
    assert [r[0] for r in df.select(metrics.status()).collect()] == ["Cancelled", "Diverted", "Delayed 15+ min", "On time", "On time"]


def test_smoothed_rate_of_unseen_groups(spark):
    h = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1), (None, 1)], "g string, y int")
    t = spark.createDataFrame([("a",), ("z",), (None,)], "g string")
    got = {r["g"]: (round(r["rate"], 6), round(r["rate_lift"], 6)) for r in history.smoothed_rate(h, t, ["g"], "y").collect()}
    assert got["z"] == got[None] == (0.75, 1.0)
    assert got["a"] == (round((1 + 50 * 0.75) / 52, 6), round((1 + 50 * 0.75) / 52 / 0.75, 6))


def test_median_interpolates(spark):
    h = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("a", 10), ("b", None)], "g string, v int")
    t = spark.createDataFrame([("a",), ("b",), ("c",)], "g string")
    assert {r["g"]: r["median"] for r in history.group_median(h, t, ["g"], "v").collect()} == {"a": 2.5, "b": None, "c": None}


def test_previous_month(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, 0), ("b", 1, 1), ("a", 2, 0), ("c", 2, 1)], "g string, m int, y int")
    got = {(r["g"], r["m"]): r["prev_rate"] for r in history.previous_month(df, ["g"], "m", "y").collect()}
    assert got["a", 1] is None and abs(got["c", 2] - 2 / 3) < 1e-9 and abs(got["a", 2] - (1 + 50 * 2 / 3) / 52) < 1e-9


def test_quality_report_and_gate(spark):
    df = spark.createDataFrame([(1, "AAA", "2400"), (1, "aa", "2500"), (2, None, None)], "k int, code string, t string")
    found = quality.report(quality.row_checks(df, [quality.not_null("code"), quality.matches("code", quality.IATA, "iata"), quality.matches("t", quality.HHMM, "hhmm")]), quality.unique(df, ["k"], "unique", quality.WARN))
    got = {r["check_name"]: (r["unexpected_count"], r["passed"]) for r in found.collect()}
    assert got == {"code_not_null": (1, False), "iata": (1, False), "hhmm": (1, False), "unique": (2, False)}
    with pytest.raises(ValueError):
        quality.gate(found)
    assert quality.gate(found.filter("check_name = 'unique'")) == ["unique"]


def test_curves_with_ties(spark):
    pts = [(0.9, 1), (0.8, 1), (0.8, 0), (0.5, 1), (0.4, 0), (0.4, 0)]
    r = evaluation.curve_metrics(spark.createDataFrame(pts, "s double, y int"), "s", "y").first()
    pairs = [(1.0 if a > b else 0.5 if a == b else 0.0) for a, y in pts if y for b, z in pts if not z]
    assert abs(r["roc_auc"] - sum(pairs) / len(pairs)) < 1e-12
    assert abs(r["average_precision"] - (1 / 3 * 1 + 1 / 3 * 2 / 3 + 1 / 3 * 3 / 4)) < 1e-12
    assert evaluation.curve_metrics(spark.createDataFrame([(0.1, 1)], "s double, y int"), "s", "y").first()["roc_auc"] is None


@pytest.mark.parametrize("n", [12, 17, 30])
def test_rank_bins_are_quantiles_of_ranks(spark, n):
    import pandas as pd

    df = spark.createDataFrame([(i, float(i % 5), i % 2) for i in range(n)], "id int, s double, y int")
    got = {r["decile"]: r["rows"] for r in evaluation.calibration(df, "s", "y", ["id"]).collect()}
    want = (pd.qcut(pd.Series(range(n)).rank(method="first"), 10, labels=False) + 1).value_counts().to_dict()
    assert got == want


def test_top_share_takes_ties_in_order(spark):
    df = spark.createDataFrame([(i, 0.5) for i in range(10)] + [(10, 0.9), (11, None)], "id int, s double")
    got = {r["id"] for r in evaluation.top_share(df, "s", 0.25, ["id"]).filter("flagged = 1").collect()}
    assert got == {10, 0, 1}


@pytest.mark.parametrize("few", [0, 20, 4096])
def test_keys_at_ranks(spark, monkeypatch, few):
    monkeypatch.setattr(evaluation, "FEW", few)
    rows = [(None if i % 11 == 0 else i * 7 % 5, None if i % 13 == 0 else float(i * 13 % 17), f"k{i * 31 % 500:03}") for i in range(500)]
    df = spark.createDataFrame(rows, "a int, b double, id string")
    last = lambda v: tuple((x is None, x) if x is not None else (True, 0) for x in v)
    want, ranks = sorted(rows, key=last), [1, 2, 99, 250, 455, 480, 500]
    assert [tuple(k) for k in evaluation.keys_at(df, ["a", "b", "id"], ranks)] == [want[r - 1] for r in ranks]
    cut = want[249]
    assert df.filter(evaluation.after(["a", "b", "id"], cut)).count() == 250


def test_top_share_reaches_null_scores(spark):
    df = spark.createDataFrame([(1, 0.5), (2, None), (3, None)], "id int, s double")
    assert {r["id"] for r in evaluation.top_share(df, "s", 0.67, ["id"]).filter("flagged = 1").collect()} == {1, 2}
    assert evaluation.top_share(df, "s", 0.0, ["id"]).filter("flagged = 1").count() == 0


def test_threshold_zero_means_above_zero(spark):
    df = spark.createDataFrame([(1, 0), (1, 5), (0, 3), (0, None)], "y int, k int")
    got = {r["threshold"]: (r["tp"], r["fp"], r["fn"], r["tn"]) for r in evaluation.threshold_sweep(df, "y", "k", [0, 5]).collect()}
    assert got == {0: (1, 1, 1, 1), 5: (1, 0, 1, 2)}
    assert evaluation.best_threshold(evaluation.threshold_sweep(df, "y", "k", [0, 5])).first()["threshold"] == 5


def test_bootstrap_agrees_between_runs(spark):
    df = spark.createDataFrame([(i % 6, i % 2, float(i % 7), float(i % 5)) for i in range(60)], "d int, y int, a double, b double")
    x, y = (sorted(tuple(r) for r in evaluation.day_bootstrap(df, "d", "y", "a", "b", reps=5).collect()) for _ in range(2))
    assert len(x) == 5 and x == y


def test_logistic_beats_chance_and_scores_unseen_levels(spark):
    df = spark.createDataFrame([(float(i % 10) if i % 7 else None, "u" if i % 3 else "v", int(i % 10 > 4)) for i in range(300)], "x double, g string, y int")
    fitted = models.fit_logistic(df, ["x"], ["g"], "y")
    new = df.limit(200).withColumn("g", F.when(F.rand(1) > 0.5, F.col("g")).otherwise("w"))
    assert evaluation.curve_metrics(models.score(fitted, new, "p"), "p", "y").first()["roc_auc"] > 0.8


def raw(spark):
    base = {"year": 2024, "month": 1, "day_of_month": 10, "day_of_week": 3, "dest": "LAX", "cancellation_code": "", "crs_elapsed_time": 360.0, "distance": 2475.0, "arr_del15": 0.0, "source_file": "f"}
    base |= dict.fromkeys(staging.CAUSES)
    legs = [
        ("AA", "1", "N1", "JFK", "0800", "1100", 5.0, 20.0, 0.0, 0.0, 1), ("AA", "1", "N1", "JFK", "0800", "1100", 6.0, 21.0, 0.0, 0.0, 2), ("AA", "2", "N1", "JFK", "2400", "0300", None, None, 1.0, 0.0, 1), ("AA", "3", "", "JFK", "2300", "0200", 0.0, 0.0, 0.0, 0.0, 1),
    ]
    names = ["reporting_airline", "flight_number", "tail_number", "origin", "crs_dep_time", "crs_arr_time", "dep_delay", "arr_delay", "cancelled", "diverted", "loaded_at"]
    data = [base | dict(zip(names, x, strict=True)) | {"flight_date": dt.date(2024, 1, 10)} for x in legs]
    kinds = {"flight_date": "date", "loaded_at": "int"} | dict.fromkeys(["year", "month", "day_of_month", "day_of_week"], "int") | dict.fromkeys(["crs_elapsed_time", "distance", "arr_del15", "dep_delay", "arr_delay", "cancelled", "diverted", *staging.CAUSES], "double")
    return spark.createDataFrame([tuple(r[k] for k in data[0]) for r in data], ", ".join(f"{k} {kinds.get(k, 'string')}" for k in data[0]))


def test_staging_to_features(spark):
    staged = staging.stage(raw(spark))
    by = {r["flight_number"]: r for r in staged.collect()}
    assert len(by) == 3 and by["1"]["dep_delay"] == 6 and by["2"]["crs_dep_time"] == "2359" and by["3"]["tail_number"] is None
    zones = spark.createDataFrame([("JFK", "America/New_York"), ("LAX", "America/Los_Angeles")], "airport_code string, timezone string")
    rich = {r["flight_number"]: r for r in staging.enrich(staged, zones).collect()}
    assert rich["1"]["sched_dep_utc"] == dt.datetime(2024, 1, 10, 13) and rich["1"]["actual_arr_utc"] == dt.datetime(2024, 1, 10, 19, 21)
    assert rich["2"]["status"] == "Cancelled" and rich["2"]["leg_of_day"] == 2 and rich["3"]["leg_of_day"] is None
    assert rich["3"]["arr_date"] == dt.date(2024, 1, 11)
    enriched = staging.enrich(staged, zones)
    narrow, known = staging.fact(enriched), staging.model_rows(enriched)
    assert narrow.columns == staging.FACT and narrow.count() == staged.count()
    assert known.columns == staging.MODEL_ROWS and known.count() == enriched.filter("NOT is_cancelled AND NOT is_diverted").count() and not {"dep_delay", "arr_delay", "status"} & set(known.columns)
    legs = staging.legs(staging.enrich(staged, zones))
    assert features.build(legs).count() == 2
    assert all(v == 0 for v in features.invariants(legs).first())


def test_declared_suite(spark):
    t = spark.createDataFrame([(1, "a", 5), (1, "b", None), (2, None, 9)], "id int, kind string, ref int")
    known = spark.createDataFrame([(5,)], "k int")
    got = {r["check_name"]: (r["severity"], r["unexpected_count"], r["passed"]) for r in quality.suite({"t": t, "known": known}, {"t": {"id": ["unique", "not_null"], "kind": [("in", ["a"]), ("warn", "not_null")], "ref": [("in_table", "known", "k")]}}).collect()}
    assert got == {"t.id unique": ("error", 2, False), "t.id not_null": ("error", 0, True), "t.kind in": ("error", 1, False), "t.kind not_null": ("warn", 1, False), "t.ref in_table": ("error", 1, False)}


def test_planted_faults_are_counted(spark):
    """One fault of each kind, and none in what the builder makes."""
    from skein.operators import features, leakage

    rows = [(k, 1, 1, k % 3, (k + 1) % 3, 1000 + 90 * k, 1060 + 90 * k, 1000 + 90 * k + d, 1060 + 90 * k + d, d, d, True) for k, d in enumerate([0, 10, 40, 0, 25, 5])]
    legs = spark.createDataFrame(rows, "key long, vehicle long, carrier long, origin long, dest long, sched_dep long, sched_arr long, actual_dep long, actual_arr long, dep_delay long, arr_delay long, completed boolean")
    built = features.inbound(features.with_cutoff(legs))
    strict = ["inb_prev_dep_ts", "inb_prev_arr_ts", "ac_latest_dep_ts", "ac_latest_arr_ts"]
    assert leakage.events_after_cutoff(built, "key", "cutoff", strict).count() == 0 and leakage.inbound_known_too_early(built, legs).count() == 0
    assert set(leakage.key_counters(built, legs).first()) == {0}
    assert leakage.differences(features.congestion(built, features.with_cutoff(legs)), leakage.naive(features.with_cutoff(legs), features.with_cutoff(legs)), "key").first().asDict() == {"sampled": 6, "values_compared": 21, "mismatches": 0}
    of = lambda c, v, k=5: built.withColumn(c, F.when(F.col("key") == k, F.lit(v)).otherwise(F.col(c)).cast(dict(built.dtypes)[c]))
    for c in strict:
        assert [r["key"] for r in leakage.events_after_cutoff(of(c, 99_999), "key", "cutoff", strict).collect()] == [5]
    for c, v, counter in (("inb_prev_dep_delay", 7, "prev_dep_value"), ("prev_leg_key", 5, "own_leg_used"), ("ac_latest_dep_key", 5, "latest_dep_not_before"), ("ac_latest_arr_key", 5, "latest_arr_not_before"), ("inb_prev_arr_delay", 7, "prev_arr_known"), ("vehicle", 9, "prev_other_vehicle")):
        assert leakage.key_counters(of(c, v, 5), legs).first()[counter] >= 1, counter
    assert leakage.inbound_known_too_early(of("inb_prev_dep_delay", 7), legs).count() == 1
    assert leakage.differences(of("inb_known_delay_min", 77), built, "key", ["inb_known_delay_min"]).first()["mismatches"] == 1
    bad = legs.withColumns({"actual_dep": F.when(F.col("key") == 2, F.lit(None)).when(F.col("key") == 3, F.lit(0)).otherwise(F.col("actual_dep")), "sched_dep": F.when(F.col("key") == 4, F.lit(None)).otherwise(F.col("sched_dep"))})
    assert features.invariants(bad).first().asDict() == {"dep_time_delay_mismatch": 1, "arr_time_delay_mismatch": 0, "departed_before_cutoff": 1, "arrived_before_cutoff": 0, "no_time": 1}


@pytest.mark.parametrize("few", [4096, 20])
@pytest.mark.parametrize("kind", ["bigint", "string", "binary", "decimal(38,2)", "double"])
def test_ranks_by_values_as_they_are(spark, monkeypatch, few, kind):
    """Ties settled by ids above 2^53, text, bytes, decimals, and doubles with NaN: as a sort would."""
    from decimal import Decimal

    monkeypatch.setattr(evaluation, "FEW", few)
    make = {"bigint": lambda i: 2**60 + i, "string": lambda i: f"{'é' if i % 3 else 'Z'}{i:05d}", "binary": lambda i: bytes([i % 251, i // 251]), "decimal(38,2)": lambda i: Decimal(f"1{i + 10**25:029d}.{i % 100:02d}"), "double": lambda i: float("nan") if i % 50 == 0 else i / 7}[kind]
    values = [make(i) for i in range(600)] + [None] * 9
    df = spark.createDataFrame([(0.5, v) for v in values], f"s double, id {kind}").repartition(5)
    order = sorted(values, key=lambda v: (v is None, v != v, 0 if v is None or v != v else v.encode() if kind == "string" else v))
    ranks = [1, 2, 300, 301, 588, 600, 601, 609]
    got = [k[1] for k in evaluation.keys_at(df, ["s", "id"], ranks)]
    assert [str(v) for v in got] == [str(order[r - 1]) for r in ranks]
    flagged = evaluation.top_share(df, "s", 0.2, ["id"]).filter("flagged = 1").select("id").collect()
    assert sorted(str(r[0]) for r in flagged) == sorted(str(v) for v in order[: round(0.2 * 609)])


@pytest.mark.parametrize(("whole", "buckets", "few"), [(10**6, 1024, 4096), (50, 4, 3), (50, 1024, 10), (0, 2, 1)])
def test_medians_of_hot_groups(spark, whole, buckets, few):
    """Half of all rows in one group, heavy tails, ties, nulls and NaN; any size of groups goes either way."""
    import random
    from statistics import median

    rng = random.Random(4)
    rows = [("hot", 1, rng.lognormvariate(0, 6), None) for _ in range(801)] + [("ties", 1, float(rng.randint(0, 2)), 1.0) for _ in range(300)] + [("wide", 2, rng.choice([-1e308, 1e308, 0.0]), 2.0) for _ in range(120)]
    rows += [(f"g{i % 60}", None if i % 7 == 0 else i % 3, rng.gauss(0, 1), float(i)) for i in range(600)] + [("none", 1, None, None), ("none", 1, float("nan"), None), (None, 1, 5.0, 5.0), ("two", 1, 1.0, 9.0), ("two", 1, 2.0, None)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, m int, v double, w double").repartition(6)
    got = {(r["g"], r["m"]): (r["a"], r["b"]) for r in history.medians_by(df, ["g", "m"], {"a": "v", "b": "w"}, whole=whole, buckets=buckets, few=few).collect()}
    want = {}
    for g, m, v, w in rows:
        if g is not None and m is not None:
            own = want.setdefault((g, m), ([], []))
            for x, y in zip((v, w), own, strict=True):
                if x is not None and x == x:
                    y.append(x)
    assert set(got) == set(want)
    for k, (v, w) in want.items():
        for x, y in zip(got[k], (v, w), strict=True):
            assert (x is None) == (not y) and (x is None or x == pytest.approx(median(sorted(y)) if abs(y[0]) < 1e307 else sorted(y)[(len(y) - 1) // 2] / 2 + sorted(y)[len(y) // 2] / 2, rel=1e-12))


@pytest.mark.parametrize(("ranges", "slab"), [(256, 20_000), (5, 7), (1, 3)])
def test_resampled_curves(spark, monkeypatch, ranges, slab):
    """Areas of repeated rows counted one by one, with ties, nulls, days without weight and one-class resamples."""
    import random

    monkeypatch.setattr(evaluation, "SLAB", slab)
    rng = random.Random(7)
    rows = [(f"d{i % 9}" if i % 50 else None, None if i % 41 == 0 else int(rng.random() < 0.4), rng.choice([None, float("nan"), -0.0, 0.0, 0.25, rng.random()]), rng.randint(0, 5)) for i in range(400)]
    df = spark.createDataFrame(rows, "day string, y int, a double, b int").repartition(4)
    draws = {f"d{k}": [(k * 3 + r) % 3 for r in range(4)] + [0] for k in range(8)}
    got = {(r["which"], r["rep"]): r for r in evaluation.resampled(df, "day", "y", {"a": "a", "b": "b"}, draws, ranges=ranges).collect()}
    assert len(got) == 10
    for w, column in (("a", 2), ("b", 3)):
        for rep in range(5):
            own = [(r[column] + 0.0, r[1]) for r in rows if r[0] in draws and r[1] is not None and r[column] is not None and r[column] == r[column] for _ in range(draws[r[0]][rep])]
            pos, neg = [s for s, y in own if y], [s for s, y in own if not y]
            r = got[w, rep]
            assert (r["rows"], r["positives"]) == (len(own), len(pos))
            if not pos or not neg:
                assert r["roc_auc"] is None
                continue
            assert r["roc_auc"] == pytest.approx(sum((p > n) + (p == n) / 2 for p in pos for n in neg) / len(pos) / len(neg), abs=1e-12)
            above = lambda s: [y for x, y in own if x >= s]
            assert r["average_precision"] == pytest.approx(sum(sum(above(s)) / len(above(s)) for s in pos) / len(pos), abs=1e-12)
