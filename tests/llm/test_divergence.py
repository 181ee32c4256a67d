"""The source divergence audit against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from skein.llm import base, divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, value long"


def brute(rows, least, ranks):
    count, docs, groups = Counter(), Counter(), set()
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        for t in terms:
            count[lang, source, t] += 1
        for t in set(terms):
            docs[lang, t] += 1
    kept = defaultdict(list)
    for (lang, t), n in docs.items():
        if n >= least:
            kept[lang].append(t)
    share = lambda c, n, v: 1 + 1_000_000_000 * (c + 5) // (n + 5 * v)
    p, q, out = {}, {}, set()
    for lang, s in groups:
        v = kept[lang]
        total = sum(count[lang, s, t] for t in v)
        all_of = {t: sum(count[lang, o, t] for l, o in groups if l == lang) for t in v}
        p[lang, s] = {t: share(count[lang, s, t], total, len(v)) for t in v}
        q[lang] = {t: share(all_of[t], sum(all_of.values()), len(v)) for t in v}
    for lang, s in groups:
        pairs = [(-sum(abs(p[lang, s][t] - p[lang, o][t]) for t in kept[lang]), o.encode()) for l, o in groups if l == lang and o != s]
        terms = [(q[lang][t] - p[lang, s][t], t.encode()) for t in kept[lang] if count[lang, s, t] and p[lang, s][t] > q[lang][t]]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:ranks])):
            out |= {(lang, s, part, t.decode(), -f, i + 1) for i, (f, t) in enumerate(found)}
    return out


def corpus(seed=5):
    rng = random.Random(seed)
    terms = [f"w{'abcdefghij'[i % 10]}{'klmnop'[i // 10]}" for i in range(60)] + ["ÉTÉ", "été", "I", "naïve", "日本", "𝒳y"]
    rows = []
    for i in range(150):
        lang, source = rng.choice(["en", "en", "en", "fr", None]), rng.choice(["hot", "hot", "hot", "b", "c", None, "é", "ω"])
        own = rng.sample(terms, 25) if rng.random() < 0.5 else terms
        rows.append((i, rng.choice([" ", ", ", "1"]).join(rng.choice(own) for _ in range(rng.randint(0, 60))), lang, source, "t", 1))
    rows += [(200, None, "en", "no text", "t", 1), (201, "", "de", "x", "t", 1), (202, "rare words here", "de", "y", "t", 1), (203, "only", "it", "single", "t", 1)]
    rows += [rows[0]] * 3 + [(None, "wak " * 30_000, "en", "long", None, None)]
    return rows


@pytest.mark.parametrize(("least", "spread"), [(30, False), (3, False), (3, True), (1000, False)])
def test_audit(spark, monkeypatch, least, spread):
    if spread:
        monkeypatch.setattr(base.spread_join, "__kwdefaults__", {"most": 0, "each": 7})
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = divergence.audit(df, least=least, ranks=9)
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == brute(rows, least, 9)


def test_audit_of_nothing(spark):
    got = divergence.audit(spark.createDataFrame([], SCHEMA))
    assert got.collect() == [] and got.columns == ["lang", "source", "part", "item", "value", "rank"]


def test_share_of_large_counts(spark):
    """Totals at which a product by a thousand million does not fit a long."""
    cases = [(0, 0, 1), (5, 10, 3), (4 * 10**12, 9 * 10**12, 10**8), (8 * 10**15 // 9, 10**15, 10**9), (0, 9 * 10**14, 7), (3, 0, 0)]
    df = spark.createDataFrame(cases, "c long, n long, v long")
    got = [r[0] for r in df.select(divergence.share(df.c, df.n, df.v)).collect()]
    assert got == [1 + 10**9 * (c + 5) // (n + 5 * v) if n + 5 * v else None for c, n, v in cases]
