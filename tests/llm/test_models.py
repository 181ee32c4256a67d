"""Language-model scores, language ID and mixing: brute force, held-out accuracy and invariants."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from skein.llm import base, language, lm, mixing, queries
from skein.llm.base import tokenizer_file


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s or "")


def test_word_scores(spark):
    rng = random.Random(3)
    pool = ["the", "of", "water", "Été", "漢字かな", "x" * 3000, "unsmoothed", "q\x85w", "😀"] + [f"word{i}" for i in range(60)]
    texts = [None, "", " ", "Water of the"] + [" ".join(rng.choices(pool, k=rng.randint(1, 60))) for _ in range(60)]
    ids = [*range(len(texts) - 2), None, 3]
    d = spark.createDataFrame([(i, t, "z", 0.5) for i, t in zip(ids, texts, strict=True)], "doc_id long, text string, held string, score double").repartition(3)
    path = queries.PIECES
    got = lm.score(d, path).collect()
    tokens = [[*re.findall(r"[^\x20\x09-\x0D]+", lower(t)), None] for t in texts]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i in ids]
    c = Counter(w for ws, h in zip(tokens, held, strict=True) if not h for w in ws)
    N, V = sum(c.values()), len(c)
    want = sorted((str(i), h, len(ws), sum(c[w] > 0 for w in ws), N, round(sum(math.log10((c[w] + 1) / (N + V + 1)) for w in ws), 6)) for i, h, ws in zip(ids, held, tokens, strict=True))
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    empty = [r["score"] for r in got if r["n_tokens"] == 1]
    assert len(empty) == 3 and max(empty) - min(empty) < 1e-9
    assert lm.score(d.limit(0), path).count() == 0


def plain_lattice(path):
    """Weights by piece, for a recursion over all segmentations."""
    import sentencepiece

    v, model = lm.Vocabulary.of(path), sentencepiece.SentencePieceProcessor(model_file=tokenizer_file(path))
    known = {model.id_to_piece(i): i for i in np.flatnonzero(np.isfinite(v.first)).tolist() if not model.is_byte(i)}
    return v, model, known


def test_forward_sums_all_segmentations():
    v, _, known = plain_lattice(path := queries.PIECES)

    def brute(word, memo):
        if not word:
            return 0.0
        if word not in memo:
            ways = [(v.first[known[word[:n]]], n) for n in range(1, len(word) + 1) if word[:n] in known]
            if word[0] not in known:
                ways.append((sum(v.first[v.bytes[b]] for b in word[0].encode()), 1))
            memo[word] = np.logaddexp.reduce([s + brute(word[n:], memo) for s, n in ways])
        return memo[word]

    own = ["the", "unsmoothed", "naïve", "漢字", "😀x", "aaaaaaaa", "x", "unsmoothed", "\u0378q"]
    got = lm.Lattice(lm.Vocabulary.of(path), v.first).likelihoods(own)
    assert np.allclose(got, [brute(lm.MARK + w, {}) for w in own], atol=1e-9)


def test_expected_counts_fill_the_words():
    v, model, _ = plain_lattice(queries.PIECES)
    into = np.zeros(v.size)
    own, times = ["unsmoothed", "the", "\u0378ab"], np.array([2, 5, 3])
    lm.Lattice(v, v.first).expect(own, times, into)
    size = [1 / len("\u0378".encode()) if model.is_byte(i) else len(model.id_to_piece(i)) for i in range(v.size)]
    assert abs(into @ np.array(size) - sum(n * len(lm.MARK + w) for w, n in zip(own, times.tolist(), strict=True))) < 1e-6


def test_weights_follow_the_existing_scores(spark):
    """The order of the vocabulary's scores is kept; the fitted steepness is the best one on a fine grid; the refit differs."""
    first = lm.Vocabulary.of(queries.PIECES).first
    rng = random.Random(1)
    rows = [(w, rng.randint(0, 9)) for w in "the water was not here because nobody understood international agreements zqxj".split()]
    table = spark.createDataFrame([(w.encode(), c) for w, c in rows], "word binary, c long")
    weights, end = lm.train(table, queries.PIECES, 5)
    free = np.isfinite(first)
    order = np.argsort(first[free], kind="stable")
    assert (np.diff(weights[free][order]) >= -1e-12).all() and abs(np.exp(weights[free]).sum() + math.exp(end) - 1) < 1e-9
    total = lambda w: sum(c * x for (_, c), x in zip(rows, lm.Lattice(lm.Vocabulary.of(queries.PIECES), w).likelihoods([w for w, _ in rows]), strict=True))
    share = np.log(1 - math.exp(end))
    best = max(total(lm.tempered(first, a / 50)) for a in range(20, 96))
    assert total(weights - share) > best - 0.02 * abs(best)
    refit, _ = lm.train(table, queries.PIECES, 5, rounds=2)
    assert total(refit) > total(weights)
    assert math.isfinite(lm.train(table.limit(0), queries.PIECES, 0)[1])


def test_scores_end_to_end(spark):
    """The query's score is the sum of the words' likelihoods under the weights of the training documents, and the end's."""
    rng = random.Random(4)
    pool = "the of water agreement understanding naïve 漢字 q".split()
    d = spark.createDataFrame([(i, " ".join(rng.choices(pool, k=rng.randint(0, 12)))) for i in range(40)], "doc_id long, text string").repartition(3)
    rows = d.collect()
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    c = Counter(w for i, t in rows if not held[i] for w in t.split())
    table = spark.createDataFrame([(w.encode(), c[w]) for w in pool], "word binary, c long")
    for rounds in (0, 2):
        weights, end = lm.train(table, queries.PIECES, sum(not h for h in held.values()), rounds)
        value = dict(zip(pool, lm.Lattice(lm.Vocabulary.of(queries.PIECES), weights).likelihoods(pool), strict=True))
        got = {r["doc_id"]: r["score"] for r in lm.score(d, queries.PIECES, rounds=rounds).collect()}
        assert all(abs(got[i] - (sum(value[w] for w in t.split()) + end) / math.log(10)) < 1e-6 for i, t in rows)


def test_held_out_scores_are_near_the_base(spark, tmp_path):
    """The query's scores: a whole word's discounted share beside its segmentations, summed by hand; near base_score on held-out rows, and no more than 1 in all."""
    rng = random.Random(6)
    pool = ["".join(rng.choices("abdefilmnorstu", k=rng.randint(2, 9))) for _ in range(300)]
    often = [1 / (k + 1) for k in range(300)]
    rows = [(i, " ".join(rng.choices(pool, often, k=rng.randint(0, 60))) + (f" odd{i}" if i % 3 else "")) for i in range(300)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in queries.op7_lm_scores(spark, str(tmp_path)).collect()}
    held = [got[i] for i, _ in rows if got[i]["held_out"]]
    base, score = sum(r["base_score"] for r in held), sum(r["score"] for r in held)
    assert len(held) > 20 and score > 1.2 * base  # 1.6 and more without whole words

    c = Counter(w for i, t in rows if not got[i]["held_out"] for w in t.split())
    ends, times = 300 - len(held), Counter(c.values())
    discount, every = min(max(times[1] / (times[1] + 2 * times[2]), 0.1), 0.9), sum(c.values()) + ends + 0.2
    names = sorted({w for _, t in rows for w in t.split()})
    types = spark.createDataFrame([(w.encode(), 1) for w in c], "word binary, c long")
    pieces = np.exp(lm.Lattice(lm.Vocabulary.of(queries.PIECES), lm.train(types, queries.PIECES, 0, 2)[0]).likelihoods(names))
    p = {w: max(c[w] - discount, 0) / every + (discount * len(c) + 0.1) / every * x for w, x in zip(names, pieces.tolist(), strict=True)}
    end = (ends + 0.1) / every
    assert sum(p.values()) + end <= 1 + 1e-9
    assert all(abs(got[i]["score"] - (sum(math.log10(p[w]) for w in t.split()) + math.log10(end))) < 1e-6 for i, t in rows)


def test_scores_without_training_words(spark):
    """All rows held out, or empty: scores are finite."""
    out = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]
    for rows in ([(i, "some words") for i in out], [(1, None), (2, "")]):
        d = spark.createDataFrame(rows, "doc_id long, text string")
        assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in lm.score(d, queries.PIECES, rounds=2, whole=True).collect())


LANGS = {"en": "the of and to in that it was for with this are be from which have they".split(), "fr": "le la les de des et que qui dans pour une avec été même où ça".split(), "de": "der die das und zu den mit für nicht über schön wäre straße auch".split()}


def sentences(n, seed):
    rng = random.Random(seed)
    for i in range(n):
        lang = rng.choice(list(LANGS))
        yield i, " ".join(rng.choices(LANGS[lang], k=rng.randint(4, 40))), lang


def test_languages_on_held_out_texts(spark):
    train = spark.createDataFrame(list(sentences(300, 1)), "doc_id long, text string, lang string")
    test = spark.createDataFrame([(i, t, x, f"host{i % 4}") for i, t, x in sentences(200, 2)] + [(900, None, None, "host1"), (901, "", "en", None), (902, "123 !!! 456", "en", "host1"), (903, "the of and to", None, None), (903, "the of and to", None, None)], "doc_id long, text string, truth string, host string")
    model = language.train(train)
    got = defaultdict(list)
    for r in language.identify(test, model, "doc_id", "text", host_col="host").collect():
        got[r["id"]].append(r)
    truth = {r["doc_id"]: r["truth"] for r in test.collect() if r["doc_id"] < 900}
    assert np.mean([got[i][0]["language"] == x for i, x in truth.items()]) > 0.97 and all(got[i][0]["kept"] for i in truth)
    assert all(got[i][0]["language"] is None and not got[i][0]["kept"] for i in (900, 901, 902))
    assert len(got[903]) == 2 and all(r["language"] == "en" and r["kept"] for r in got[903])


def test_evidence_beside_the_text_decides_short_texts(spark):
    model = language.train(spark.createDataFrame(list(sentences(300, 1)), "doc_id long, text string, lang string"))
    page = '<html lang="{}"><body><p>{}</p></body></html>'
    rows = [(1, "http://a.example.com/fr/1", page.format("fr", "a x")), (2, "http://a.example.de/2", page.format("de", "a x")), (3, None, page.format("xx", "the of and that with this")), (4, "bad url", None)]
    got = {r["id"]: r["language"] for r in language.identify(spark.createDataFrame(rows, "page_id long, url string, html string"), model, "page_id", "html", url_col="url", markup=True).collect()}
    assert got == {1: "fr", 2: "de", 3: "en", 4: None}


def brute_cells(text):
    """Hashed trigrams of a text, byte by byte."""
    raw = [b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalpha() else 32 for b in (text or "").encode()]
    for a, b, c in zip(raw, raw[1:], raw[2:], strict=False):
        if not (b == 32 and (a == 32 or c == 32)):
            yield (((a << 16) | (b << 8) | c) * 2654435769 % 2**32) >> (32 - language.BITS)


def brute_languages(rows, model):
    """Posterior of (id, host, domain, declared, spoken by the suffix, text) rows, by the definition."""
    k = len(model.languages)
    gain = [[sum(float(g[c]) for c in cells) / max(1, len(cells)) for g in model.gain] for cells in [list(brute_cells(r[5])) for r in rows]]
    size = [len(list(brute_cells(r[5]))) for r in rows]
    best = [int(np.argmax(g)) if n else None for g, n in zip(gain, size, strict=True)]
    for i, (id_, host, domain, declared, spoken, _) in enumerate(rows):
        if not size[i]:
            yield id_, None, 0.0, False
            continue
        others = [j for j in range(len(rows)) if j != i and best[j] is not None]
        share = lambda js, x: sum(best[j] == x for j in js)
        prior = [(share(others, x) + 1) / (len(others) + k) for x in range(k)]
        for own, weight in ((domain, language.DOMAIN_WEIGHT), (host, language.HOST_WEIGHT)):
            if own is not None:
                js = [j for j in others if (rows[j][2] if weight == language.DOMAIN_WEIGHT else rows[j][1]) == own]
                prior = [(share(js, x) + weight * prior[x]) / (len(js) + weight) for x in range(k)]
        post = [min(size[i], language.EVIDENCE) * gain[i][x] + math.log(prior[x]) for x in range(k)]
        for claim, right in (({declared} & set(model.languages), language.DECLARED), (set(spoken) & set(model.languages), language.SUFFIX)):
            if claim:
                post = [p + math.log(right / len(claim) if x in claim else (1 - right) / max(1, k - len(claim))) for p, x in zip(post, model.languages, strict=True)]
        top = max(post)
        x = post.index(top)
        yield id_, model.languages[x], 1 / sum(math.exp(p - top) for p in post), gain[i][x] >= 0


@pytest.mark.parametrize("spread", [False, True])
def test_posterior_against_brute_force(spark, monkeypatch, spread):
    if spread:  # hosts by shuffle, hot ones dealt to several tasks
        monkeypatch.setattr(language, "BROADCAST_COUNTS", 0)
        monkeypatch.setattr(base.spread_join, "__kwdefaults__", {"most": 0, "each": 3})
    model = language.train(spark.createDataFrame(list(sentences(300, 1)), "doc_id long, text string, lang string"))
    rng = random.Random(8)
    say = dict((x, lambda n, x=x: " ".join(rng.choices(LANGS[x], k=n))) for x in LANGS)  # noqa: C402
    rows, kept = [], []
    for i in range(120):
        site = rng.choice(["hot", "hot", "a", "b", "c"])
        host, domain, path, spoken = {"hot": ("hot.shop.fr", "shop.fr", "", ["fr"]), "a": ("a.mix.ch", "mix.ch", "/de/x", ["de"]), "b": ("b.mix.ch", "mix.ch", "/id/x", ["de", "fr", "it"]), "c": ("c.example.com", "example.com", "", [])}[site]
        lang = rng.choice(["fr", "fr", "de", "en"]) if site == "hot" else rng.choice(list(LANGS))
        text = rng.choice([say[lang](rng.randint(1, 30)), "q", "a x", None, "123 !"])
        said = rng.choice([None, None, "en-US", "FR", "de_AT", "xx", "tlh-x"])
        rows.append((i, host, domain, {None: None, "en-US": "en", "FR": "fr", "de_AT": "de"}.get(said), spoken, text))
        kept.append((i, f"https://{host}{path or '/p'}", said, text, 1.0, "zz"))
    d = spark.createDataFrame(kept, "doc_id long, url string, lang string, text string, gain double, host string").repartition(4)
    got = {r["id"]: (r["id"], r["language"], round(r["probability"], 6), r["kept"]) for r in language.identify(d, model, "doc_id", "text", declared_col="lang", url_col="url").collect()}
    want = {x[0]: (x[0], x[1], round(x[2], 6), x[3]) for x in brute_languages(rows, model)}
    assert got == want and len({x[1] for x in want.values()}) == 4


def test_each_kind_of_evidence_decides(spark):
    model = language.train(spark.createDataFrame(list(sentences(300, 1)), "doc_id long, text string, lang string"))
    fill = [(100 + i, f"http://{h}/p{i}", f"<p>{' '.join(LANGS[x] * 2)}</p>") for h, x in (("only-de.example.org", "de"), ("only-fr.example.net", "fr")) for i in range(30)]
    one = "<p>a x</p>"  # says nothing by itself
    rows = [*fill, (1, "http://only-de.example.org/q", one), (2, "http://only-fr.example.net/q", one), (3, "http://x.example.at/q", one), (4, "http://y.example.com/fr/q", one), (5, "http://z.example.com/q", f"<html lang='de-CH'>{one}"), (6, "http://z.example.com/q", "<p>the of and that with this have they</p>"), (7, "http://www.example.br/us/q", "<p>the of and that with this have they</p>")]
    d = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["id"]: r["language"] for r in language.identify(d, model, "page_id", "html", url_col="url", markup=True).collect()}
    assert {i: got[i] for i in range(1, 8)} == {1: "de", 2: "fr", 3: "de", 4: "fr", 5: "de", 6: "en", 7: "en"}


def test_any_number_of_languages(spark):
    rng = random.Random(3)
    stems = {f"l{i:03}": ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=5)) for _ in range(12)] for i in range(70)}
    say = lambda x, n: " ".join(rng.choices(stems[x], k=n))
    rows = [(k, say(x, 40), x) for k, x in enumerate(x for x in stems for _ in range(4))]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(model.languages) == 70 > language.MOST
    test = [(k, say(x, 20), x) for k, x in enumerate(stems)] + [(900, None, "x"), (5, say("l005", 20), "l005")]
    got = language.identify(spark.createDataFrame(test, "doc_id long, text string, truth string"), model, "doc_id", "text").collect()
    assert len(got) == len(test) and all(r["language"] == (None if r["id"] == 900 else f"l{r['id']:03}") for r in got)


def test_labels_go_by_their_primary_subtag(spark):
    d = spark.createDataFrame([(i, "the of and to", x) for i, x in enumerate(["en", "EN-us", "en_GB", " En ", "english!", "", None])], "doc_id long, text string, lang string")
    assert language.train(d).languages == ["en", "english!"]


def test_very_long_and_repeated_texts(spark):
    model = language.train(spark.createDataFrame(list(sentences(300, 1)), "doc_id long, text string, lang string"))
    long = " ".join(LANGS["de"] * 60_000)
    d = spark.createDataFrame([(1, long, "x", 0), (2, "the of and", "x", 0), (2, "the of and", "x", 0), (None, None, None, None)], "doc_id long, text string, language string, n int")
    assert sorted((str(r["id"]), r["language"], r["kept"]) for r in language.identify(d, model, "doc_id", "text").collect()) == [("1", "de", True), ("2", "en", True), ("2", "en", True), ("None", None, False)]


def test_language_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = language.train(none)
    assert model.languages == []
    some = spark.createDataFrame([(1, "abc", "en")], "doc_id long, text string, lang string")
    assert [(r["language"], r["kept"]) for r in language.identify(some, model, "doc_id", "text").collect()] == [(None, True)]
    assert language.identify(none, language.train(some), "doc_id", "text").count() == 0


def brute_targets(size, weights=(5, 2, 1), most=3):
    """Shares by weight, capped, the excess dealt again until none is above."""
    w = {s: weights[i % 3] for i, s in enumerate(sorted(size, key=lambda s: (s is None, (s or "").encode())))}
    target, open_, left = dict.fromkeys(size, 0.0), set(size), float(sum(size.values()))
    while left > 1e-9 and open_:
        total = sum(w[s] for s in open_)
        over = 0.0
        for s in list(open_):
            target[s] += left * w[s] / total
        for s in list(open_):
            if target[s] >= most * size[s]:
                over += target[s] - most * size[s]
                target[s] = most * size[s]
                open_.discard(s)
        left = over
    return target


@pytest.mark.parametrize("per_task", [2, 100_000])
def test_mixing(spark, monkeypatch, per_task):
    monkeypatch.setattr(mixing, "PER_TASK", per_task)
    rng = random.Random(7)
    names = ["b", "a", None, "ä", "Z", "big"]
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 3, 10, 50])), "big" if i % 3 == 0 else rng.choice(names), 1) for i in range(600)] + [(600, None, "a", 1), (None, "x y", "b", 1), (5, "x y", "b", 1), (5, "x y", "b", 1)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    of, size = {}, Counter()
    for i, t, s, _ in rows:
        of[i] = s
        size[s] += len((t or "").split())
    want = brute_targets(dict(size))
    got = mixing.mix(d.repartition(5), bucket_docs=20, fan_in=4).collect()
    assert len(got) == len(rows)
    taken = Counter()
    for r in got:
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3 and r["source_size"] == size[r["source"]]
        assert abs(r["target"] - want[r["source"]]) < 1e-6
        assert r["copies"] in (math.floor(r["target"] / r["source_size"]), math.ceil(r["target"] / r["source_size"] - 1e-9)) or r["size"] == 0
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 50 for s in want)
    key = lambda rs: sorted(map(str, rs))
    assert key(got) == key(mixing.mix(d.repartition(2), bucket_docs=20, fan_in=4).collect())


def test_rounding_keeps_expected_copies(spark):
    d = spark.createDataFrame([(i, "w " * (1 + i % 4), "s" if i % 2 else "t") for i in range(60)], "doc_id long, text string, source string")
    runs = [mixing.mix(d, seed=k).collect() for k in range(3)]
    assert len({tuple(sorted((r["doc_id"], r["copies"]) for r in x)) for x in runs}) > 1


def test_mixing_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(none).count() == 0
    blank = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id long, text string, source string")
    assert [(r["target"], r["taken"]) for r in mixing.mix(blank).collect()] == [(0.0, 0), (0.0, 0)]
