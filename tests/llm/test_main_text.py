"""Main text: labelled pages, a brute-force version over the standard library's parser, and what the ratios decide."""

from __future__ import annotations

import random
from html.parser import HTMLParser

import pytest

from skein.llm import main_text as m

NAV = "<nav><ul><li><a href=/>Home</a></li><li><a href=/b>Shop, now.</a></li></ul></nav>"
P = "This is a paragraph of the article, with some words and marks, as one writes them. It goes on."
FOUR = f"<p>{P}</p>" * 4


def page(inner, wrap):
    return f"<html><body>{NAV}<div class=cookie-notice>We use cookies, and more.</div>{wrap.format(FOUR + inner + FOUR)}<footer>(c) 2024, all rights.</footer></body></html>"


KEPT = [
    ("<table><tr><td>1</td><td>22</td></tr></table>", ["1", "22"]), ("<ol><li>A</li><li>B</li></ol>", ["A", "B"]), ("<div class='share-price'>12.30</div>", ["12.30"]), ("<div id=related-work><p>Earlier work.</p></div>", ["Earlier work."]),
    ("<section class='search-results'>Found it</section>", ["Found it"]), ("<p>As <math><mi>x</mi><mo>=</mo><mn>2</mn></math> shows</p>", ["As x=2 shows"]), ("<h2>Next</h2><blockquote><p>Quoted.</p></blockquote>", ["Next", "Quoted."]),
]


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<div id=c7 class='post layout'>{}</div>", "<main><div><article>{}</article></div></main>", "<form id=f>{}</form>"])
@pytest.mark.parametrize(("inner", "want"), KEPT)
def test_all_of_the_content_stays(inner, want, wrap):
    assert m.main_text(page(inner, wrap)).split("\n") == [P] * 4 + want + [P] * 4


@pytest.mark.parametrize("inner", ["<div class=ad>Buy this, now! Really, do.</div>", "<aside><p>Other, longer stories.</p></aside>", "<section id=comments>" + "<p>Great post, really; I liked it, very much indeed, yes.</p>" * 30 + "</section>", "<form><p>Your mail, please.</p></form>", "<div style='display:none'><p>Hidden, text.</p></div>"])
@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<div>{}</div>"])
def test_side_matter_goes(inner, wrap):
    assert m.main_text(page(inner, wrap)).split("\n") == [P] * 8


def test_linked_items_stay_in_a_declared_article():
    links = "<ul><li><a href=1>one</a></li><li><a href=2>two</a></li></ul>"
    assert m.main_text(page(links, "<article>{}</article>")).split("\n") == [P] * 4 + ["one", "two"] + [P] * 4
    assert m.main_text(page(links, "<div>{}</div>")).split("\n") == [P] * 8


def test_names_weigh_and_do_not_decide():
    assert m.main_text(f"<body>{NAV}<div id=comments-off class=post>{FOUR}</div></body>").split("\n") == [P] * 4
    assert m.main_text(f"<body>{NAV}<div class=widget>{FOUR}</div></body>").split("\n") == [P] * 4
    assert m.main_text(f"<body>{NAV}<div class=widget>{FOUR}</div><div class=text>{FOUR}</div></body>").split("\n") == [P] * 4


def test_empty_articles_and_pages_of_side_matter():
    ad = f"<div class=ad>{P}</div>"
    assert m.main_text(f"<body>{NAV}{ad}<article></article></body>") == ""
    assert m.main_text(f"<body>{NAV}{ad}<article><h1>T</h1></article></body>") == "T"
    assert m.main_text(f"<body>{NAV}<div class=ad>Buy, now.</div><footer>End, of it.</footer></body>") == ""


def test_very_long_deep_and_repeated_pages(spark):
    long = f"<article>{'<p>' + P + '</p>'} " * 1 + f"<p>{P}</p>" * 20_000 + "</article>"
    deep = "<div>" * 5_000 + P + "</div>" * 5_000 + f"<div>{P}</div>" * 3
    rows = [(1, "u", long, 9, "x"), (2, None, deep, 9, "x"), (2, None, deep, 9, "x"), (None, "u", None, None, None), (4, "u", "", 1, "x")]
    d = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int, text string")
    got = sorted(m.extract(d).collect(), key=str)
    assert [r["text"].count(P) for r in got if r["page_id"] == 1] == [20_001] and [r["text"].count(P) for r in got if r["page_id"] == 2] == [4, 4]
    assert all(r["n_chars"] == len(r["text"]) for r in got) and sorted(r["n_chars"] for r in got)[:2] == [0, 0]
    assert m.extract(d.limit(0)).count() == 0


class Tree(HTMLParser):
    """Leaves of well-formed pages as (chain of (number, tag, names), text, characters in links)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.chain, self.leaves, self.made, self.text, self.links, self.link = [], [], 0, "", 0, False

    def flush(self):
        if t := " ".join(self.text.split()):
            self.leaves.append((list(self.chain), t, self.links))
        self.text, self.links = "", 0

    def handle_starttag(self, tag, attrs):
        if tag in ("a", "b"):
            self.link |= tag == "a"
            return
        self.flush()
        self.made += 1
        self.chain.append((self.made, tag, dict(attrs)))

    def handle_endtag(self, tag):
        if tag in ("a", "b"):
            self.link &= tag != "a"
            return
        self.flush()
        self.chain.pop()

    def handle_data(self, data):
        self.text += data
        self.links += len(data) * self.link


WEIGHTS = {"nav": 0.0, "footer": 0.0, "form": 0.02, "ad": 0.002, "share-price": 0.6}


def brute(page):
    """Scores and selection from their definitions, path by path and pair by pair."""
    t = Tree()
    t.feed(page)
    weigh = lambda chain: [WEIGHTS.get(tag, 1.0) * WEIGHTS.get(a.get("class"), 1.0) for _, tag, a in chain]
    product = lambda xs: product(xs[1:]) * xs[0] if xs else 1.0
    name = lambda chain: "/".join(tag + "." + a.get("class", "") for _, tag, a in chain)
    names = [name(c) for c, _, _ in t.leaves]
    marks = lambda s: sum(c in ".,;:!?" for c in s)
    declared = any(" " + tag == " article" for c, _, _ in t.leaves for _, tag, _ in c)
    score, weight = {}, {}
    for p in set(names):
        own = [i for i, x in enumerate(names) if x == p]
        mean = lambda f, q: sum(f(t.leaves[i][1]) for i in range(len(names)) if names[i] == q) / names.count(q)
        beside = [(names[i], names[j]) for i, j in zip(range(len(names)), range(1, len(names)), strict=False) if names[i] != names[j] and p in (names[i], names[j])]
        smoothed = {}
        for f in (len, marks):
            num, den = mean(f, p), 1.0
            for a, b in beside:
                q = b if a == p else a
                x, y = p.split("/"), q.split("/")
                same = 0
                while same < min(len(x), len(y)) and x[same] == y[same]:
                    same += 1
                w = 0.5 ** (len(x) + len(y) - 2 * same) / len(own)
                num, den = num + w * mean(f, q), den + w
            smoothed[f] = num / den
        chain = t.leaves[own[0]][0]
        weight[p] = product(weigh(chain))
        share = sum(t.leaves[i][2] for i in own) / sum(len(t.leaves[i][1]) for i in own)
        outside = declared and "article." not in p
        score[p] = (smoothed[len] * (1 + smoothed[marks])) ** 0.5 * weight[p] * (1 - share) * (0.002 if outside else 1.0)
    main = [p for p in score if "article." in p]
    top = max((weight[p] for p in main or score), default=0)
    side = {p for p in score if weight[p] < 0.1 * top or weight[p] == 0}
    best = max((s for p, s in score.items() if p not in side), default=0)
    content = {p for p, s in score.items() if s > 0 and p not in side and s >= 0.1 * best}
    chars = lambda node: sum(len(s) for (c, s, _), p in zip(t.leaves, names, strict=True) if p in content and any(x[0] == node for x in c))
    root, at, left = None, 0, sum(len(s) for (_, s, _), p in zip(t.leaves, names, strict=True) if p in content)
    while True:
        kids = {c[i][0]: c[i] for (c, _, _), p in zip(t.leaves, names, strict=True) if p in content for i in range(len(c)) if (c[i - 1][0] if i else 0) == at}
        if not kids:
            break
        node = max(kids, key=lambda k: (chars(k), -k))
        if chars(node) < 0.8 * left or kids[node][1] not in ("html", "body", "div", "section", "article", "form", "table", "tr", "td"):
            break
        if kids[node][1] == "article" or not declared:
            root = node
        at, left = node, chars(node)
    out = []
    for (c, s, _), p in zip(t.leaves, names, strict=True):
        ids = [x[0] for x in c]
        if root in ids:
            keep = product(weigh(c[ids.index(root) + 1 :])) >= 0.1 and (declared or score[p] > 0)
        else:
            keep = declared and p in main and p not in side
        out += [s] if p in content or keep else []
    return score, "\n".join(out)


def well_formed(rng):
    def text(n):
        return " ".join(rng.choice(["word", "other", "longer,", "end.", "so;"]) for _ in range(n))

    def element(depth):
        tag = rng.choice(["p", "p", "p", "div", "section", "blockquote", "h2", "ul"] if depth else ["div", "section", "p"])
        c = rng.choice(["", "", "", " class=ad", " class=share-price", " class=x"])
        if tag == "p" or tag == "h2" or depth > 3:
            return f"<{tag}{c}>{text(rng.choice([1, 3, 20, 60]))}</{tag}>"
        if tag == "ul":
            return f"<ul{c}>{''.join('<li>' + (f'<a href=x>{text(2)}</a>' if rng.random() < 0.5 else text(3)) + '</li>' for _ in range(3))}</ul>"
        return f"<{tag}{c}>{''.join(element(depth + 1) for _ in range(rng.randint(1, 4)))}</{tag}>"

    inner = "".join(element(0) for _ in range(rng.randint(1, 4)))
    wrap = rng.choice(["{}", "<article>{}</article>", "<div>{}</div>", "<form>{}</form>", f"<div><p>{text(30)}</p></div><article>{{}}</article>"])
    return f"<html><body><nav><p>{text(5)}</p></nav>{wrap.format(inner)}<footer>{text(4)}</footer></body></html>"


def test_against_brute_force():
    rng = random.Random(6)
    cut = 0
    for _ in range(400):
        html = well_formed(rng)
        found, declared = m.leaves(html)
        score, want = brute(html)
        mine = {"/".join(x.name if "." in x.name else x.name + "." for x in p): s for p, s in m.path_scores(found, declared).items()}
        assert mine.keys() == score.keys() and all(abs(mine[p] - s) < 1e-9 * max(1, s) for p, s in score.items()), html
        top = max((s for s in score.values()), default=0)
        if top < 1:  # all side matter: another rule
            continue
        assert m.main_text(html) == want, html
        cut += m.main_text(html) != "\n".join(x.text for x in m.select(found, declared, {p: float(s > 0) for p, s in m.path_scores(found, declared).items()}))
    assert cut > 20  # without the ratios, results differ


def test_ratios_decide_without_names_or_declarations():
    side = "".join(f"<div><span>{w}</span></div>" for w in ("Log in", "Basket", "Terms", "Press"))
    html = f"<body><table><tr><td class=a>{side}</td><td class=b><div><p>{P * 3}</p><p>{P * 3}</p><ul><li>Short</li></ul></div></td></tr></table></body>"
    assert m.main_text(html).split("\n") == [P * 3, P * 3, "Short"]
    found, declared = m.leaves(html)
    flat = m.select(found, declared, dict.fromkeys((x.path for x in found), 1.0))
    assert "Basket" in [x.text for x in flat]
