import itertools
import random

import numpy as np
import pytest

from conftest import rows
from tributary.llm import html

NONE = np.zeros(5)


def text(source, weights=NONE):
    return html.main_text(source, weights)


@pytest.mark.parametrize(
    "source, expected",
    [
        ("", ""),
        ("<article><h1>A &amp; B</h1><p>x\n  y&nbsp;z<br>w</p></article>", "A & B x y z w"),
        ("<nav><ul><li><a href=x>Home</a></li></ul></nav><article><p>One.</p><p>Two.</article><footer>f</footer>", "One. Two."),
        ("<article><p>a<b>b</b>c <i>d</i></p><div class='ad'>Buy!</div><p>e</p></article>", "abc d e"),
        ("<main><p>Text.</p><section class=comments><article>First!</article></section></main>", "Text."),
        ("<article><script>var t='</p><p>no';</script><style>p{}</style><!-- <p>no</p> --><p>yes</p></article>", "yes"),
        ("<header><h1>Site</h1></header><div class='post-content'><p>Body.</p></div><aside>More</aside>", "Body."),
        ("<article><header><h1>Title</h1></header><p>Body.</p><footer>By me</footer></article>", "Title Body."),
        ("<article><p>Body.</p><form><label>Mail</label><input><button>Go</button></form></article>", "Body."),
        ("<div id=cookie-notice>We use cookies.</div><article>5 &lt; 6 &#x41;</article>", "5 < 6 A"),
        ("<article><p>open <b>bold <p>next</article><nav>n</nav>", "open bold next"),
        ("<article><p>a < b and c</p></article>", "a < b and c"),
        ("<article><p>end</p></article><!-- never closed <p>no", "end"),
        ("<article><p title='a>b'>q</p><p class=\"x", "q"),
        ("<ARTICLE><P>Upper</P></ARTICLE><FOOTER>no</FOOTER>", "Upper"),
        ("<nav>only menu</nav>", ""),
        ("</div></p><article>stray ends</div></article>", "stray ends"),
    ],
)
def test_what_is_content(source, expected):
    assert text(source) == expected


def cost(gain, edges, side):
    """What a labelling costs: the gain given up by each wrong side and the edges cut."""
    own = sum(max(g, 0) if not s else max(-g, 0) for g, s in zip(gain, side))
    return own + sum(w for a, b, w in edges if side[a] != side[b])


@pytest.mark.parametrize("solve", [html.minimum_cut, html.max_flow_side])
def test_cut_is_minimal(solve):
    rng = random.Random(12)
    for _ in range(300):
        n = rng.randrange(1, 9)
        gain = [rng.choice([0.0, rng.uniform(-3, 3), rng.uniform(-0.3, 0.3)]) for _ in range(n)]
        edges = [(a, b, rng.uniform(0, 2)) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.5]
        least = min(cost(gain, edges, side) for side in itertools.product([True, False], repeat=n))
        assert cost(gain, edges, solve(gain, edges)) == pytest.approx(least)


def test_a_weak_block_follows_its_neighbours():
    page = "<div><p>" + "</p><p>".join(["A long sentence with many words in it, as articles have."] * 3 + ["Ok"] + ["Another sentence of the same kind."] * 3) + "</p></div>"
    weights = np.array([-4.0, 1.0, 1.0, 0.5, -3.5])
    assert "Ok" in text(page, weights).split()
    assert html.labels(html.Page("<p>Ok</p>"), weights) == [False]


def test_training_separates_links_from_prose():
    rng = np.random.default_rng(13)
    x = np.stack([rng.random(400), rng.random(400) * 6, rng.integers(0, 2, 400), rng.random(400) * 4, np.ones(400)], axis=1)
    y = (x[:, 0] < 0.5).astype(float)
    w = html.train(x, y)
    assert (((x @ w) > 0) == (y > 0)).mean() > 0.95
    assert (html.train(x, np.ones(400)) == 0).all() and (html.train(x[:0], y[:0]) == 0).all()


def test_table(spark):
    good = "<nav><a href=x>Menu</a></nav><article><p>Body text here.</p></article>"
    data = [(1, "u", good, "x"), (1, "u", good, "x"), (None, None, good, "y"), (2, "v", None, "z"), (3, "w", "", "z"), (4, "w", "<article>" + "<p>long text.</p>" * 3000 + "</article>", "z")]
    df = spark.createDataFrame(data, "page_id long, url string, html string, text string")
    got = rows(html.extract(df, html.fit(df)))
    body = "Body text here."
    assert got == sorted([(1, "u", body), (1, "u", body), (None, None, body), (2, "v", ""), (3, "w", ""), (4, "w", " ".join(["long text."] * 3000))], key=repr)
    assert rows(html.extract(df.limit(0), html.fit(df.limit(0)))) == []


#: Prose counts for about 2.8, a link list for -3.
PROSE = np.array([-9.0, 1.0, 1.0, 0.0, -2.5])
LONG = "A long sentence with many words in it, as the articles of a page have them."
MENU = "<ul><li><a href=x>Home</a></li><li><a href=y>About</a></li></ul>"


@pytest.mark.parametrize(
    "source, expected",
    [
        (f"<div class='layout has-sidebar'>{MENU}<p>{LONG}</p><p>{LONG}</p></div>", f"{LONG} {LONG}"),
        (f"<div class='page sidebar'><article><p>{LONG}</p><p>Ok</p></article></div>", f"{LONG} Ok"),
        (f"<article class='post share-enabled'><p>{LONG}</p><p>Ok</p></article>", f"{LONG} Ok"),
        (f"<form id=aspnetForm><article><p>{LONG}</p></article><nav>{MENU}</nav></form>", LONG),
        (f"<div class='wrap no-comments'><div class='entry-content'><p>Ok</p></div><div class='widget'>{MENU}</div></div>", "Ok"),
        (f"<article><p>{LONG}</p></article><div class=comments><article><p>First!</p></article></div>", LONG),
        (f"<article><p>{LONG}</p><aside><article>{LONG}</article></aside></article><div class=ad>Buy!</div>", LONG),
    ],
)
def test_a_listed_word_on_a_wrapper_loses_no_text(source, expected):
    assert text(source, PROSE) == expected


def test_text_and_edges_outvote_cues():
    page = html.Page(f"<article><p>{LONG}</p><div class=notice-shown>{LONG}</div><p>{LONG}</p></article><div class=notice-shown>Sale</div>")
    assert [b[3] > 0 for b in page.blocks] == [True, False, True, False]
    assert html.labels(page, PROSE) == [True, True, True, False]
    inside = html.Page(f"<article><p>{LONG}</p>{MENU}<p>{LONG}</p></article>")
    strict = PROSE * [2, 1, 1, 1, 1]
    assert html.labels(inside, NONE) == [True] * 4
    assert all(abs(b[3]) < html.LIMIT + 2 * html.BESIDE + html.INSIDE for b in inside.blocks + page.blocks)
    assert html.labels(html.Page(f"<div class=text>{MENU}</div>"), strict) == [False, False]


@pytest.mark.parametrize(
    "source, expected",
    [
        ("<html><head><title>T</title><body><article><p>Body.</article>", "Body."),
        ("<!doctype html><head><meta charset=utf-8><title>T</title><style>p{}</style><article><p>Body.<p>More.</article>", "Body. More."),
        ("<head><title>T</title><script>var t='<body>';</script><noscript><img></noscript><main>Body.<header>H</header>", "Body. H"),
        ("<head><title>T</title></head><body><header>Site</header><article>Body.</article>", "Body."),
        ("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be even.</p></article>", "Let x=2 be even."),
        ("<article><math><semantics><mi>y</mi><annotation encoding=tex>\\y</annotation></semantics></math> holds.</article>", "y holds."),
        ("<article>A <video src=v><p>No video: <a href=v>file</a>.</p></video> B</article>", "A No video: file. B"),
        ("<article><object data=o><p>A map.</p></object><canvas>A chart.</canvas><audio>A song.</audio></article>", "A map. A chart. A song."),
        ("<article>Before <object data=o> after.</article>", "Before after."),
        ("<article>a<svg><title>s</title><text>t</text></svg>b<template>c</template><iframe>d</iframe></article>", "ab"),
    ],
)
def test_omitted_end_tags_and_fallback_text(source, expected):
    assert text(source) == expected


def test_more_blocks_than_the_sample_holds(spark, monkeypatch):
    monkeypatch.setattr(html, "BLOCKS", 400)
    links = "".join(f"<li><a href=x>Go to another page {k}</a></li>" for k in range(30))
    prose = "".join(f"<p>{LONG} {k}</p>" for k in range(30))
    many = [(f"<nav><ul>{links}</ul></nav><article><h1>Page {k}</h1>{prose}</article>",) for k in range(40)]
    weights = html.fit(spark.createDataFrame(many, "html string"))
    assert weights[0] < -1
    assert text(f"<div><ul>{links}</ul></div><div>{prose}</div>", weights).startswith(LONG)
    assert (html.fit(spark.createDataFrame(many, "html string").repartition(3)) == weights).all()


#: Prose as it comes out of training on real pages, at the limit of what text may weigh.
STRONG = np.array([-9.0, 2.0, 2.0, 0.0, -2.5])


@pytest.mark.parametrize(
    "boilerplate",
    [
        f"<div class='comments'><p>{LONG}</p></div>", f"<section class='comment'><p>{LONG}</p><p>{LONG}</p></section>",
        f"<div class='ad'>{LONG}</div>", f"<p class='ad'>{LONG}</p>", f"<div class='cookie-notice'><p>{LONG}</p></div>",
        f"<div class='site-footer'><p>{LONG}</p><p>{LONG}</p></div>", f"<div id=user-comments><article><p>{LONG}</p></article></div>",
        f"<ul class='comment-list user-comments'><li>{LONG}</li><li>{LONG}</li></ul>", f"<div class='footer-wrapper'>{LONG}</div>",
        f"<div class=notice>{LONG}</div>", f"<div class='comments'>{'<p>' + LONG + '</p>' * 1}{('<p>' + LONG + '</p>') * 20}</div>",
        f"<aside>{LONG}</aside>", f"<div role=complementary><p>{LONG}</p></div>",
    ],
)
@pytest.mark.parametrize("weights", [PROSE, STRONG])
def test_prose_in_boilerplate_is_dropped(boilerplate, weights):
    """Inside the article and behind it, whatever the text says."""
    assert text(f"<article><p>{LONG}</p>{boilerplate}<p>{LONG}</p></article>", weights) == f"{LONG} {LONG}"
    assert text(f"<div class=page><article><p>{LONG}</p></article>{boilerplate}</div>", weights) == LONG


@pytest.mark.parametrize("name", ["layout has-sidebar", "page-with-sidebar", "ad-free-story", "share-enabled", "no-comments", "entry-header", "comments-open"])
def test_names_that_only_mention_boilerplate(name):
    assert text(f"<div class='{name}'><p>{LONG}</p><p>{LONG}</p></div>", PROSE) == f"{LONG} {LONG}"
    assert text(f"<article class='{name}'><p>{LONG}</p></article>", PROSE) == LONG


def test_a_page_without_article_in_a_listed_wrapper():
    assert text(f"<body><div class='widget'><p>{LONG}</p><p>{LONG}</p></div><div class='ad'>{LONG}</div></body>", STRONG) == f"{LONG} {LONG}"


def test_stray_tags_and_deep_nesting_take_linear_time():
    import time

    deep = "<div>" * 20_000 + "</section>" * 40_000 + f"<p>{LONG}</p>" + "<div><p>x</p>" * 2_000
    start = time.process_time()
    page = html.Page(deep)
    list(html.edges_of(page))
    assert time.process_time() - start < 2 and len(page.blocks) == 2_001
