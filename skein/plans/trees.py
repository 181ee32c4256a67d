"""Registered queries of boosted trees: fitted ones, and stated ones whose parts SQL recomputes from all subsets."""

from __future__ import annotations

from itertools import combinations
from math import factorial

import numpy as np
from pyspark.sql import functions as F

from ..operators import attribution, boosting, evaluation, models
from ..steps import materialize
from .analogs import FLIGHTS
from .registry import _CATEGORICAL, _NUMERIC, _TIES, _fit_rows, _model_rows, query

#: Stated trees: (column, upper edge or text values, whether unknown goes left, left, right), leaves as (value, rows).
_TREES = [
    ("qty", 20.0, True, ("disc", 0.03, False, (-0.5, 120), (0.25, 180)), ("carrier_name", ["c1", "c3", "c8", "c20"], False, (0.75, 90), (-0.125, 310))),
    ("carrier_name", ["c2", "c3", "c4", "c5", "c6", "c7"], True, ("qty", 30.0, False, ("qty", 10.0, True, (1.0, 40), (0.5, 130)), (-0.25, 60)), ("disc", 0.05, True, (0.0, 250), (0.375, 220))),
]
_COLUMNS = {"qty": [10.0, 20.0, 30.0], "disc": [0.03, 0.05], "carrier_name": [f"c{i}" for i in range(25)]}


def _rows_of(tree) -> int:
    return tree[1] if len(tree) == 2 else _rows_of(tree[3]) + _rows_of(tree[4])


def _stated() -> boosting.Model:
    model = boosting.Model(["qty", "disc"], ["carrier_name"], [np.array(_COLUMNS[c]) for c in ("qty", "disc")], [_COLUMNS["carrier_name"]], -1.0)
    for stated in _TREES:
        nodes: list[list] = []

        def add(t, nodes=nodes) -> int:
            i = len(nodes)
            nodes.append([0, -1, -1, np.zeros(boosting.CODES, bool), t[0] if len(t) == 2 else 0.0, float(_rows_of(t))])
            if len(t) > 2:
                column, test, unknown, left, right = t
                codes = range(1, _COLUMNS[column].index(test) + 2) if isinstance(test, float) else [_COLUMNS[column].index(v) + 1 for v in test]
                nodes[i][3][[*codes, *([0] if unknown else [])]] = True
                nodes[i][0] = model.columns.index(column)
                nodes[i][1], nodes[i][2] = add(left), add(right)
            return i

        add(stated)
        model.trees.append(boosting.Tree(*(np.array(x) if k != 3 else np.stack(x) for k, x in enumerate(zip(*nodes, strict=True)))))
    return model


def _sql_value(tree, known: frozenset) -> str:
    """SQL of a tree's value where the columns outside ``known`` are averaged by rows."""
    if len(tree) == 2:
        return f"{tree[0]}::DOUBLE"
    column, test, unknown, left, right = tree
    a, b = _sql_value(left, known), _sql_value(right, known)
    if column not in known:
        return f"({_rows_of(left)} * {a} + {_rows_of(right)} * {b}) / {_rows_of(tree)}"
    passes = f"{column} <= {test}" if isinstance(test, float) else f"{column} IN ({', '.join(repr(v) for v in test)})"
    return f"CASE WHEN coalesce({passes}, {unknown}) THEN {a} ELSE {b} END"


def _sql_part(column: str) -> str:
    """SQL of a column's Shapley part: the sum over all subsets of the others."""
    rest, n, out = [c for c in _COLUMNS if c != column], len(_COLUMNS), []
    for k in range(n):
        for some in combinations(rest, k):
            weight = factorial(k) * factorial(n - k - 1) / factorial(n)
            out += [f"{weight!r} * (({_sql_value(t, frozenset({*some, column}))}) - ({_sql_value(t, frozenset(some))}))" for t in _TREES]
    return " + ".join(out)


_X = f"{FLIGHTS}, x AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 3 <> 0 THEN l_quantity END AS qty, l_discount AS disc, 'c' || carrier AS carrier_name FROM f WHERE NOT is_cancelled AND NOT is_diverted)"


@query(f"WITH {_X} SELECT l_orderkey, l_linenumber, {', '.join(f'round({_sql_part(c)}, 9) AS part_{c}' for c in _COLUMNS)}, round(-1 + {' + '.join(_sql_value(t, frozenset(_COLUMNS)) for t in _TREES)}, 9) AS margin FROM x")
def tree_parts(spark, d):
    """Exact parts of stated trees with a repeated column, sets of text values and unknown values, for every row."""
    model, x = _stated(), _model_rows(spark, d)
    found = attribution.contributions(model, boosting.score(model, x.drop("score"), "p", margin="margin"))
    parts = [F.round(F.col("contributions")[i]["part"], 9).alias(f"part_{c}") for i, c in enumerate(model.columns)]
    return found.select("l_orderkey", "l_linenumber", *parts, F.round("margin", 9).alias("margin"))


@query(f"WITH {_X}, p AS (SELECT {', '.join(f'abs({_sql_part(c)}) AS {c}' for c in _COLUMNS)} FROM x), u AS (SELECT 'load' AS feature_group, sum(qty) AS a FROM p UNION ALL SELECT 'price', sum(disc) FROM p UNION ALL SELECT 'carrier', sum(carrier_name) FROM p) SELECT feature_group, round(a / (SELECT sum(a) FROM u), 9) AS share FROM u")
def tree_group_shares(spark, d):
    """Each feature group's share of the mean absolute parts, over all rows."""
    found = attribution.contributions(_stated(), _model_rows(spark, d))
    return models.mean_contribution(found, {"qty": "load", "disc": "price", "carrier_name": "carrier"}).select("feature_group", F.round("share", 9).alias("share"))


def _fitted(x):
    return boosting.fit(x.filter("year < 1999"), _NUMERIC, _CATEGORICAL, "y")  # the original's settings: all 500 trees


@query()
def boosted_scores(spark, d):
    """Leaf-wise trees fitted on the earlier years, scoring the later ones."""
    x = _fit_rows(spark, d)
    return boosting.score(_fitted(x), x.filter("year >= 1999"), "score").select("l_orderkey", "l_linenumber", "y", F.round("score", 6).alias("score"))


@query()
def boosted_reasons(spark, d):
    """The riskiest fifth of the later years by fitted trees, with the parts that move each score most, in words."""
    x = _fit_rows(spark, d)
    model = _fitted(x)
    scored = materialize(boosting.score(model, x.filter("year >= 1999"), "score", margin="margin"), "scored-rows")  # the cut is found in several passes
    flagged = evaluation.top_share(scored, "score", 0.2, [c for c in _TIES if c in scored.columns]).filter("flagged = 1")
    found = attribution.contributions(model, flagged, mean="mean", once=True)
    rest = F.col("margin") - F.col("mean") - F.aggregate("contributions", F.lit(0.0), lambda a, p: a + p["part"])
    return found.select("l_orderkey", "l_linenumber", F.round("score", 6).alias("score"), models.top_reasons(unknown={"qty": "unknown"}, text=True).alias("reasons"), (F.abs(rest) < 1e-9).alias("adds_up"))


@query()
def boosted_importance(spark, d):
    """Mean absolute part of each column over all rows of the later years, largest first by share."""
    x = _fit_rows(spark, d)
    found = attribution.counted(_fitted(x), x.filter("year >= 1999"))
    return models.mean_contribution(found, {"qty": "load", "price": "price", "disc": "price"}, rows="rows").select("feature_group", F.round("share", 6).alias("share"))
