"""Wrapper induction: alignment against brute force, what the wrapper decides, names, depth and length."""

import itertools
import random
import re

import pytest

from tidewire.llm import wrapper_induction as wi

PAGES = "page_id bigint, url string, html string"


def texts_of(spark, rows):
    return dict(wi.extract_main_text(spark.createDataFrame(rows, PAGES)).select("page_id", "text").collect())


class Tree:
    def __init__(self, key, children):
        self.key, self.children = key, children


def random_tree(rng, depth):
    return Tree(rng.choice("ab"), [random_tree(rng, depth - 1) for _ in range(rng.randint(0, 3))] if depth else [])


def plain_size(x, y):
    """Every order-keeping choice of pairs of children is tried."""
    if x.key != y.key:
        return 0
    best = 0
    for n in range(1, min(len(x.children), len(y.children)) + 1):
        for a in itertools.combinations(x.children, n):
            for b in itertools.combinations(y.children, n):
                worth = [plain_size(p, q) for p, q in zip(a, b)]
                best = max(best, sum(worth) if all(worth) else 0)
    return 1 + best


def test_alignment_against_brute_force():
    rng = random.Random(1)
    for _ in range(300):
        x, y = random_tree(rng, 3), random_tree(rng, 3)
        assert wi.matched_size(x, y) == plain_size(x, y)
        pairs = wi.match(x.children, y.children)
        assert pairs == sorted(pairs) and len({i for i, _ in pairs}) == len({j for _, j in pairs}) == len(pairs)
        worth = [plain_size(x.children[i], y.children[j]) for i, j in pairs]
        assert all(worth) and 1 + sum(worth) == plain_size(Tree("a", x.children), Tree("a", y.children))


def anonymous(html):
    """The page with every telling element and class name taken away."""
    for tag, name in (("nav", "x1"), ("article", "x2"), ("footer", "x3")):
        html = re.sub(rf"<{tag}\b[^>]*>", f"<div class={name}>", html).replace(f"</{tag}>", "</div>")
    return html.replace('class="ad"', 'class="x4"')


def test_wrapper_decides_without_names(spark):
    """On pages without any telling name, the wrapper finds what the names say; without it nothing is left out."""
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url", "html").collect()]
    want = texts_of(spark, rows)
    got = texts_of(spark, [(i, u, anonymous(h)) for i, u, h in rows])
    assert sum(got[i] == want[i] for i in want) >= 0.99 * len(want)
    assert all(wi.extract(anonymous(h), None) != want[i] for i, _, h in rows)


def test_line_common_to_all_pages_goes(spark):
    body = lambda i: "".join(f"<p>Paragraph {k} of page {i} with words of its own.</p>" for k in range(25))
    rows = [(i, "http://h.example/", f"<body><article>{body(i)}<p>All rights stay with us</p></article></body>") for i in range(60)]
    got = texts_of(spark, rows)
    assert all("All rights" not in got[i] and got[i].count("\n") == 24 for i in got)


def test_deep_and_long_pages(spark):
    deep = "<div>" * 5000 + "<p>Deep text</p>" + "</div>" * 5000
    uneven = lambda i: "".join(f"<div class={'ab'[(k * (i + 3)) % 2]}><h2>t</h2>" for k in range(1500)) + f"<p>Bottom {i}</p>"
    wide = "".join(f"<h2>Title {k}</h2><p>Paragraph {k} here</p>" for k in range(3000))
    rows = [(0, "http://a.example/", deep), (1, "http://a.example/1", deep.replace("Deep", "Other")), (2, "http://b.example/", f"<article>{wide}</article>"), (3, "http://b.example/", f"<article><p>x</p>{wide}</article>")]
    rows += [(10 + i, "http://c.example/", uneven(i)) for i in range(3)]
    got = texts_of(spark, rows)
    assert got[0] == "Deep text" and got[1] == "Other text"
    assert all(f"Bottom {i}" in got[10 + i] for i in range(3))
    assert got[2].split("\n")[:2] == ["Title 0", "Paragraph 0 here"] or "Title" not in got[2]
    assert wi.extract(f"<article>{wide}</article>", None).count("\n") == 5999


@pytest.mark.parametrize("body, want", [
    ('<article><p>Before.</p><section class="discussion"><h2>Discussion</h2><p>The results that we see agree with what was found before.</p><p>A second paragraph of the discussion of the same length.</p></section></article>',
     "Before.\nDiscussion\nThe results that we see agree with what was found before.\nA second paragraph of the discussion of the same length."),
    ('<article><p>Before.</p><div class="discussion"><div class="post"><b>A</b> I think that this is a fine article, thanks a lot for it!</div><div class="post"><b>B</b> No, that is not so at all, and here is why I think so.</div></div></article>', "Before."),
    ('<article><p>Text.</p><section class="related-work"><p>Others did it.</p></section><div class="search-strategy"><p>We searched.</p></div></article>', "Text.\nOthers did it.\nWe searched."),
    ('<article><p>Text.</p><ul class="related"><li><a href=a>One more</a><li><a href=b>Two more</a></ul></article>', "Text."),
    ("<article><p>Area <math><mi>a</mi><mo>=</mo><mi>b</mi></math> is known.</p></article>", "Area a=b is known."),
    ('<div class="has-sidebar"><div class="no-menu"><p>All of the text.</p></div></div>', "All of the text."),
    ('<div class="cookieBanner">We bake</div><article><p>Text <span class="ad">buy <p>After it.</p></article><p class="share-buttons">Tell</p>', "Text\nAfter it."),
    ("<article><p>One<svg><svg><text>no</text></svg><text>nor this</text></svg> two.</article>", "One two."),
    ('<form action="x"><div><p>A page that its maker wraps into one form, as some do.</p></div></form>', "A page that its maker wraps into one form, as some do."),
])
def test_names_break_ties_only(body, want):
    html = f"<html><body>{body}</body></html>"
    wrapper = wi.Slot.load(wi.page_wrapper(html).dump())
    if "<form" in body:  # only many pages can tell
        wi.merge(wrapper, wi.page_wrapper(html.replace("some", "others")), [100])
    assert wi.extract(html, wrapper) == want


def test_article_under_a_misleading_name(spark):
    """What nearly all varying text of a host stands in is its article, whatever it is called."""
    rows = [(i, "http://h.example/", f"<body><div class=topbar><p>Hello there</p></div><div class=widget><h1>Story {i}</h1><p>{' '.join(f'word{k * i}' for k in range(40))}</p></div><p>Visit {i}</p></body>") for i in range(1, 9)]
    got = texts_of(spark, rows)
    assert all(got[i].startswith(f"Story {i}\nword0 word{i} ") and "Hello" not in got[i] for i in got)


def test_merging_in_rounds(spark, monkeypatch):
    """The wrapper of a host seen in very many tasks holds what one task would have found."""
    html = lambda i: f"<body><div class=top{'abc'[i % 3]}><p>Welcome to layout</p></div><div class=body><p>Text {i} varies from page to page.</p></div></body>"
    parts = spark.createDataFrame([("h", wi.json.dumps(wi.page_wrapper(html(i)).dump())) for i in range(100)] + [("g", wi.json.dumps(wi.page_wrapper("<p>x").dump()))], "host string, wrapper string")
    monkeypatch.setattr(wi, "FAN_IN", 3)
    got = {r.host: wi.Slot.load(wi.json.loads(r.wrapper)) for r in wi.merged(parts).collect()}
    assert set(got) == {"h", "g"} and got["h"].pages == 100
    assert {s.key: s.pages for s in got["h"].nodes() if s.tag == "div"} == {"div.topa": 34, "div.topb": 33, "div.topc": 33, "div.body": 100}
