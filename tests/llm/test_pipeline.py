"""The pipeline against brute-force versions of its stages on a small fixture."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from skein.llm import queries

LANGS = {"en": "the of and to in that it was for with this are be from which have they".split(), "de": "der die das und zu den mit für nicht über schön wäre straße auch".split()}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    say = lambda lang, n: " ".join(rng.choice(LANGS[lang]) + str(rng.randint(0, 99)) * (rng.random() < 0.5) for _ in range(n))
    rows = [(i, say(lang := rng.choice(list(LANGS)), rng.randint(20, 60)), lang, f"s{i % 3}") for i in range(60)]
    item = " ".join(f"item{k}" for k in range(14))
    rows += [(100, rows[3][1], "en", "s0"), (101, rows[4][1] + " more", "en", "s1"), (102, "12345 67890 !!!", "en", "s1"), (103, None, "en", None), (104, "", "de", "s2")]
    rows += [(105, f"{say('en', 10)} {item} {say('en', 5)}", "en", "s0"), (106, f"{say('en', 10)} {' '.join(item.split()[:9])}", "en", "s0"), (107, f"{say('en', 12)} password=hunter2hunter2", "en", "s2"), (None, say("en", 15), "en", "s2")]
    d = tmp_path_factory.mktemp("sf")
    spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return str(d), rows


def shingles(t):
    w = re.sub("[A-Z]", lambda m: m[0].lower(), t or "").split()
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_stages(spark, folder):
    d, rows = folder
    docs, kept = spark.read.parquet(f"{d}/documents.parquet"), {r[0]: r[1] for r in rows}
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "jaccard_join", "decontamination", "secret_scan", "mixing"]
    # language: texts without letters go
    want = {i: t for i, t in kept.items() if i is None or re.search("[a-z]", t or "")}
    for i, a in list(want.items()):
        for j, b in list(want.items()):  # each later copy's or near copy's first document stays
            if None not in (i, j) and j > i and shingles(a) and 100 * len(shingles(a) & shingles(b)) >= 75 * len(shingles(a) | shingles(b)):
                want.pop(j, None)
    want = {i: t for i, t in want.items() if " ".join(f"item{k}" for k in range(10)) not in (t or "")}
    got = docs
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, got, d)
        assert out.columns == columns, name
        out.write.parquet(f"{d}/{name}")
        got = spark.read.parquet(f"{d}/{name}")
    texts = {r["doc_id"]: r["text"] for r in got.collect()}
    assert set(texts) == set(want) and 106 in texts and None in texts and not {100, 101, 102, 103, 104, 105} & set(texts)
    assert texts[107] == want[107].replace("password=hunter2hunter2", "[secret]")
    assert all(texts[i] == want[i] for i in texts if i != 107)
    assert all(r["n_chars"] == len(r["text"]) for r in got.collect())


def test_run_mixes_what_is_left(spark, folder):
    d, _ = folder
    out = corpus_pipeline.run(spark, d).collect()
    assert {"doc_id", "taken", "target"} <= set(out[0].asDict())
    taken, target, largest = Counter(), {}, Counter()
    for r in out:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
        assert r["taken"] <= 3 * r["size"]
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in target)
    assert math.isclose(sum(target.values()), sum(r["size"] for r in out))


def test_each_row_has_its_own_decision(spark, folder, tmp_path):
    d, _ = folder
    rng = random.Random(4)
    say = lambda n: " ".join(rng.choice(LANGS["en"]) + str(rng.randint(0, 99)) for _ in range(n))
    a, b, c, e, f = (say(40) for _ in range(5))
    bad = f"{say(8)} {' '.join(f'item{k}' for k in range(14))}"
    rows = [(None, bad), (None, "12345 !!!"), (None, a), (None, a), (None, f"{a} more")]  # no ids: contaminated, rejected, copies and a near copy
    rows += [(1, b)] * 3 + [(2, c), (3, c), (3, e), (4, e), (5, bad), (5, f), (6, ""), (6, "")]  # repeats; copies and contamination beside other texts of the id
    docs = spark.createDataFrame([(*r, "en", "s", len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = docs
    for name, stage in corpus_pipeline.STAGES[1:3]:
        stage(spark, got, d).write.parquet(f"{tmp_path}/{name}")
        got = spark.read.parquet(f"{tmp_path}/{name}")
    left = sorted((str(r["doc_id"]), r["text"]) for r in got.collect())
    assert ("None", a) in left or ("None", f"{a} more") in left
    assert [x for x in left if not x[1].startswith(a)] == sorted([("None", "12345 !!!"), ("1", b), ("2", c), ("3", e), ("5", f), ("6", ""), ("6", "")])
    assert len([x for x in left if x[1].startswith(a)]) == 1 and got.columns == docs.columns
    kept = corpus_pipeline.language_id(spark, docs, d).collect()
    assert not any(r["text"] in ("12345 !!!", "") for r in kept) and len(kept) == len(rows) - 3


def test_stages_with_clashing_columns_nulls_and_repeats(spark, folder, tmp_path):
    d, rows = folder
    more = {c: f"'{c}'" for c in ("key", "id", "first_key", "kept", "hits", "items", "size", "p", "bucket", "spans", "dropped", "count", "digest", "component", "target", "language", "gain", "host", "mark", "row", "of", "whole")}
    docs = spark.read.parquet(f"{d}/documents.parquet").selectExpr("*", *[f"{v} AS {k}" for k, v in more.items()], "CAST(NULL AS array<string>) AS tags")
    docs = docs.unionByName(docs.filter("doc_id IN (0, 1)")).unionByName(docs.filter("doc_id = 2").withColumns({c: F.lit(None).cast(t) for c, t in docs.dtypes if c != "text"}))
    got, counts = docs, []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, got, d).write.parquet(f"{tmp_path}/{name}")
        got = spark.read.parquet(f"{tmp_path}/{name}")
        counts.append(got.count())
        assert name == "mixing" or got.columns == docs.columns
    assert counts[0] > counts[1] > counts[2] == counts[3] == counts[4] > 0


def test_empty_documents(spark, folder, tmp_path):
    d, _ = folder
    spark.read.parquet(f"{d}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{d}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_every_operator_is_registered():
    names = queries.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(queries.oracle_sql()) <= set(names)
