"""Point-in-time operators against plain loops."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from skein.operators import temporal

times = st.integers(0, 400)
events = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), times), st.integers(-40, 40)), max_size=25)
asked = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), times)), min_size=1, max_size=12)
few = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@pytest.fixture(autouse=True)
def slice_length():
    kept = temporal.SLICE
    yield
    temporal.SLICE = kept


def frames(spark, ev, qs):
    e = spark.createDataFrame([(k, t, i, v) for i, (k, t, v) in enumerate(ev)], "k string, t long, i long, v long")
    q = spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate(qs)], "id long, k string, q long")
    return e, q


@few
@given(ev=events, qs=asked)
def test_asof(spark, ev, qs):
    e, q = frames(spark, ev, qs)
    got = {r["id"]: (r["last_t"], r["last_i"], r["last_v"]) for r in temporal.asof_latest(q, e, "k", "q", "t", "i", ["v"], lookback=60, slice_minutes=50).collect()}
    for i, (k, t) in enumerate(qs):
        hit = [(et, n, v) for n, (ek, et, v) in enumerate(ev) if k is not None and ek == k and t is not None and et is not None and t - 60 <= et < t]
        assert got[i] == (max(hit) if hit else (None, None, None))


@pytest.mark.parametrize("span", [60, 97, 1440])
@few
@given(ev=events, qs=asked)
def test_trailing(spark, span, ev, qs):
    temporal.SLICE = span  # put back by the fixture
    e, q = frames(spark, ev, qs)
    got = {r["id"]: r for r in temporal.trailing_stats(q, e, "k", "q", "t", "v", width=60).collect()}
    for i, (k, t) in enumerate(qs):
        hit = [(et, v) for ek, et, v in ev if k is not None and ek == k and t is not None and et is not None and t - 60 <= et < t]
        assert got[i]["recent_count"] == len(hit)
        assert got[i]["recent_last"] == max((x for x, _ in hit), default=None)
        assert got[i]["recent_mean"] is None if not hit else abs(got[i]["recent_mean"] - sum(v for _, v in hit) / len(hit)) < 1e-9


@pytest.mark.parametrize("span", [60, 97, 1440])
@few
@given(ev=events, qs=asked)
def test_pending(spark, span, ev, qs):
    temporal.SLICE = span
    e, q = frames(spark, ev, qs)
    e = e.selectExpr("k", "t AS s", "CASE WHEN v > -20 THEN t + v END AS a")
    got = {r["id"]: r for r in temporal.pending_share(q, e, "k", "q", "s", "a", width=60).collect()}
    for i, (k, t) in enumerate(qs):
        due = [(s, s + v if v > -20 else None) for ek, s, v in ev if k is not None and ek == k and t is not None and s is not None and t - 60 <= s < t]
        open_ = [a for _, a in due if a is None or a >= t]
        assert (got[i]["scheduled"], got[i]["pending"]) == (len(due), len(open_))


def test_boundaries(spark):
    e = spark.createDataFrame([("a", 100, 1, 5), ("a", 100, 2, 6), ("a", 40, 3, 7)], "k string, t long, i long, v long")
    q = spark.createDataFrame([(0, "a", 100), (1, "a", 101), (2, "a", 160), (3, "a", 161)], "id long, k string, q long")
    got = {r["id"]: r["last_i"] for r in temporal.asof_latest(q, e, "k", "q", "t", "i", ["v"], lookback=60).collect()}
    assert got == {0: 3, 1: 2, 2: 2, 3: None}


def test_three_hours_need_all(spark):
    h = spark.createDataFrame([("p", m, float(m), 1) for m in (0, 60, 120, 240)] + [("p", 60, 9.0, 0)], "p string, h long, v double, l int")
    got = {r["h"]: r["sum_hours"] for r in temporal.full_hours_sum(h, "p", "h", "v", "l").collect()}
    assert got == {0: None, 60: None, 120: 129.0, 240: None}


def test_a_window_over_all_events_runs_in_slices(spark):
    """One key holds everything: slices are the window's partitions, and events at their edges are seen on both sides."""
    e = spark.range(0, 6000).selectExpr("id AS t", "CAST(id % 7 AS BIGINT) AS v")
    q = spark.createDataFrame([(t,) for t in (1439, 1440, 1441, 1500, 1559, 1560, 1561, 2880, 5999, 6100, 6119, 6120)], "q long")
    found = temporal.trailing_stats(q, e, None, "q", "t", "v", width=120)
    assert {r["q"]: (r["recent_count"], r["recent_last"]) for r in found.collect()} == {t: (len(range(max(t - 120, 0), min(t, 6000))), min(t, 6000) - 1 if t < 6120 else None) for t in [r["q"] for r in q.collect()]}
    assert "hashpartitioning(__k" in (plan := found._jdf.queryExecution().executedPlan().toString()) and "__slice" in plan.split("Window")[1]
