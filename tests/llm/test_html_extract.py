import html
import random
import re
import time
from itertools import product

import pyarrow.parquet as pq
import pytest

from tests.llm.cases import multiset, rows_of
from tidewatch.llm.html_extract import PageReader, extracted, labels, main_text, minimum_cut
from tidewatch.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
SENTENCE = "This is a sentence of the article that says something, and it goes on for a while."


def test_cut_is_minimal():
    rng = random.Random(2)
    for _ in range(2000):
        size = rng.randint(1, 8)
        scores = [rng.randint(-6, 6) for _ in range(size)]
        edges = [
            (rng.randrange(size), rng.randrange(size), rng.randint(0, 4))
            for _ in range(rng.randint(0, 14))
        ]

        def cost(label, scores=scores, edges=edges):
            ends = sum(abs(s) for s, kept in zip(scores, label, strict=True) if (s > 0) != bool(kept) and s)
            return ends + sum(w for a, b, w in edges if label[a] != label[b])

        best = min(map(cost, product([False, True], repeat=size)))
        assert cost(minimum_cut(scores, edges)) == best


def article_of(page):
    inside = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", inside)
    blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in blocks]
    return "\n".join(b for b in blocks if b)


def test_query_against_the_articles(spark):
    pages = pq.read_table(f"{SF_DIR}/pages.parquet").to_pylist()
    got = rows_of(QUERIES["op5_html_extraction"](spark, SF_DIR))
    want = [(p["page_id"], p["url"], t := article_of(p["html"]), len(t)) for p in pages]
    assert multiset(got) == multiset(want)


@pytest.mark.parametrize(
    "boilerplate",
    [
        '<nav><ul><li><a href="/">Home</a><li>News</ul></nav>',
        f"<header><p>{SENTENCE}</p></header>",
        f"<footer><p>{SENTENCE}</p></footer>",
        f"<aside><p>{SENTENCE}</p></aside>",
        f'<div class="sidebar-left"><p>{SENTENCE}</p></div>',
        f'<div id="cookieNotice"><p>{SENTENCE}</p></div>',
        f'<div class="ad">{SENTENCE}</div>',
        f'<section class="comments"><h2>Comments</h2><p>{SENTENCE}</p></section>',
        f"<form><label>{SENTENCE}</label><textarea>x</textarea><button>Send</button></form>",
        "<script>var a = '<p>no</p>';</script><style>p{}</style><!-- <p>no</p> -->",
        f'<div style="display: none"><p>{SENTENCE}</p></div>',
    ],
)
def test_boilerplate_goes_wherever_it_stands(boilerplate):
    article = f"<h1>Title &amp; more</h1><p>{SENTENCE}<p>Short.<p>{SENTENCE}<br>Line"
    want = f"Title & more\n{SENTENCE}\nShort.\n{SENTENCE} Line"
    for page in (
        f"<html><head><title>T</title></head><body>{boilerplate}<article>{article}</article></body>",
        f"<body><article>{article}</article>{boilerplate}",
        f'<div class="with-sidebar"><main>{article}</main></div>{boilerplate}',
    ):
        assert main_text(page) == want
    if not boilerplate.startswith("<header"):
        assert main_text(f"<article>{article}</p>{boilerplate}</article>") == want


def test_odd_pages(spark):
    schema = "page_id long, url string, html string, text string, n_chars string, id string"
    long = "<article>" + f"<p>{SENTENCE}</p>\n" * 3000 + "</article>"
    pages = [
        (1, "u", None),
        (1, "u", None),
        (2, None, ""),
        (None, "v", "<p"),
        (3, "w", "<p>&nbsp; </p><article>"),
        (4, "x", long),
        (5, "y", f"{SENTENCE} {SENTENCE} no markup"),
        (6, "z", "</p></div></article>" + "<div>" * 300 + "<li>"),
        (7, "t", f"<article><table><tr><td>a&lt;b<td>{SENTENCE}</table></article>"),
    ]
    df = spark.createDataFrame([(*p, "old", "7", "i") for p in pages], schema)
    got = rows_of(extracted(df))
    assert extracted(df).columns == ["page_id", "url", "text", "n_chars"]
    found = {r[0]: r[2] for r in got}
    assert len(got) == len(pages) and all(r[3] == len(r[2]) for r in got)
    assert found[1] == found[2] == found[3] == ""
    assert found[4] == "\n".join([SENTENCE] * 3000)
    assert found[5] == f"{SENTENCE} {SENTENCE} no markup"
    assert found[7] == f"a<b\n{SENTENCE}"
    assert extracted(df.limit(0)).collect() == []


ARTICLE = f"<h1>Title</h1><p>{SENTENCE}</p><p>{SENTENCE}</p>"
LONG_TEXT = " ".join([SENTENCE] * 8)


@pytest.mark.parametrize(
    "start",
    [
        '<article class="post comments-open">',
        '<article class="post tags-news" id="login">',
        '<main class="content with-sidebar">',
        '<main id="search" class="widget">',
        '<div class="article has-sidebar">',
        '<div class="content sidebar">',
        '<div id="content" class="noSidebar hidden-footer">',
        '<article><header class="entry-header">',
    ],
)
def test_names_beside_the_main_text_lose_nothing(start):
    tags = re.findall(r"<(\w+)", start)
    end = "".join(f"</{tag}>" for tag in reversed(tags))
    want = f"Title\n{SENTENCE}\n{SENTENCE}"
    assert main_text(f"<body>{start}{ARTICLE}{end}<footer><p>{SENTENCE}</p></footer>") == want


@pytest.mark.parametrize(
    "part",
    [
        f'<section id="legal-background"><h2>Law</h2><p>{SENTENCE}</p></section>',
        f'<div class="related-work"><h2>Law</h2><p>{SENTENCE}</p></div>',
        f'<h2 id="search">Law</h2><p>{SENTENCE}</p>',
        f'<h2><span id="Legal">Law</span></h2><p>{SENTENCE}</p>',
    ],
)
def test_parts_of_an_article_stay_whatever_their_names(part):
    want = f"Title\n{SENTENCE}\n{SENTENCE}\nLaw\n{SENTENCE}"
    assert main_text(f"<body><article>{ARTICLE}{part}</article>") == want


@pytest.mark.parametrize("name", ["notice", "widget", "legal", "sidebar"])
def test_long_text_outweighs_a_name(name):
    for page in ("<body><article>{}{}</article>", "<body>{}{}"):
        part = f'<div class="{name}"><p>{LONG_TEXT}</p><p>{LONG_TEXT}</p></div>'
        assert main_text(page.format(ARTICLE, part)).count(LONG_TEXT) == 2


@pytest.mark.parametrize(
    "part",
    [
        f'<article class="comment even" id="comment-12"><p>{SENTENCE}</p></article>',
        f'<article class="reply"><p>{SENTENCE}</p></article>',
        f'<div class="post-comments"><p>{SENTENCE}</p></div>',
        f'<div class="site-footer"><p>{SENTENCE}</p></div>',
        f'<ul class="related-posts"><li><a href="/">{SENTENCE}</a></li></ul>',
        f'<div class="main-menu"><a href="/">{SENTENCE}</a></div>',
    ],
)
def test_named_boilerplate_goes(part):
    want = f"Title\n{SENTENCE}\n{SENTENCE}"
    assert main_text(f"<body><article>{ARTICLE}</article>{part}") == want
    assert main_text(f"<body><article>{ARTICLE}{part}</article>") == want


@pytest.mark.parametrize(
    "head",
    [
        "<html><head><title>T</title><body>",
        "<html><head><title>T</title>",
        "<head><meta charset=utf-8><link rel=x><style>p{}</style><script>var a;</script><body>",
        "<head><noscript><style>p{}</style></noscript><title>T</title>\n<body>",
        "<head><noscript><img src=x></noscript><title>T</title></head><body>",
        "<head><template><p>no</p></template><title>T</title><body>",
        "<html><body><head><title>T</title>",
        "<HTML><HEAD><TITLE>T</TITLE><BODY>",
    ],
)
def test_head_may_be_left_open(head):
    assert main_text(f"{head}<article>{ARTICLE}</article>") == f"Title\n{SENTENCE}\n{SENTENCE}"
    assert main_text(f"{head}{ARTICLE}") == f"Title\n{SENTENCE}\n{SENTENCE}"


def test_text_ends_an_open_head():
    assert main_text(f"<head><title>T</title>{SENTENCE}<p>{SENTENCE}") == f"{SENTENCE}\n{SENTENCE}"
    assert main_text(f"<head><title>T</title></head><p>{SENTENCE}") == SENTENCE


def test_formulas_and_fallback_texts_stay_in_an_article():
    formula = (
        "<math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn><mspace/></mrow>"
        '<annotation encoding="application/x-tex">x=2</annotation></semantics></math>'
    )
    page = "<article><h1>Title</h1><p>We have {} here. {}</p>{}</article>"
    assert main_text(page.format(formula, SENTENCE, "")) == f"Title\nWe have x=2 here. {SENTENCE}"
    for tag in ("noscript", "object"):
        part = f"<{tag}><p>{SENTENCE}</p></{tag}>"
        want = f"Title\nWe have it here. {SENTENCE}\n{SENTENCE}"
        assert main_text(page.format("it", SENTENCE, part)) == want
        want = f"Title\n{SENTENCE}\n{SENTENCE}"
        assert main_text(f"<{tag}>Please enable it.</{tag}><article>{ARTICLE}</article>") == want


COMMENT = " ".join([SENTENCE] * 9)
STORY = f"<h1>Title</h1><p>{SENTENCE}</p><p>{LONG_TEXT}</p><p>{SENTENCE}</p>"
TOLD = f"Title\n{SENTENCE}\n{LONG_TEXT}\n{SENTENCE}"


@pytest.mark.parametrize(
    "start",
    [
        '<div class="comments">',
        '<section id="comments">',
        '<ol class="comment-list"><li>',
        '<section id="comments"><article>',
        '<div class="sidebar">',
        '<div class="cookie-notice">',
        '<div class="ad">',
        '<div class="newsletter-signup">',
        '<div class="sponsored">',
    ],
)
@pytest.mark.parametrize("times", [1, 3])
def test_long_comments_adverts_and_notices_go(start, times):
    end = "".join(f"</{tag}>" for tag in reversed(re.findall(r"<(\w+)", start)))
    part = start + f"<p>{COMMENT}</p>" * times + end
    if times == 1 or "omment" in start:  # comments go however much of the page they are
        assert main_text(f"<body><article>{ARTICLE}{part}</article>") == f"Title\n{SENTENCE}\n{SENTENCE}"
    assert main_text(f"<body><article>{STORY}{part}</article>") == TOLD
    assert main_text(f"<body><article>{STORY}</article>{part}") == TOLD
    assert main_text(f"<body>{part}<article>{STORY}</article>") == TOLD


def test_list_of_links_in_an_article_stays():
    items = "".join(f'<li><a href="/{n}">Page {n}</a>' for n in range(5))
    told = "\n".join(["Links", *(f"Page {n}" for n in range(5))])
    assert main_text(f"<body><nav><ul>{items}</ul></nav><article><h1>Links</h1><ul>{items}</ul></article>") == told
    assert main_text(f"<article><h1>Links</h1><ul>{items}</ul><p>{SENTENCE}</article>") == f"{told}\n{SENTENCE}"
    assert main_text(f"<article><ul>{items}</ul>{ARTICLE}</article>").startswith("Title")


def test_cut_decides_blocks_of_either_sign():
    rng = random.Random(5)
    changed = {True: 0, False: 0}
    parts = ["<p>One.</p>", "<h2>Two</h2>", f"<p>{SENTENCE}</p>", f'<div class="legal"><p>{COMMENT}</p></div>']
    parts += ['<div><a href="/">Three</a></div>', "<ul><li>Four<li>Five</ul>", f"<p>{LONG_TEXT}</p>"]
    for _ in range(300):
        body = "".join(rng.choices(parts, k=4))
        page = PageReader().read(f"<div>{body}</div>" if rng.random() < 0.5 else f"<main>{body}</main>")
        scores, edges = labels(page)
        label = minimum_cut(scores, edges)
        if len(scores) <= 11:

            def cost(kept, scores=scores, edges=edges):
                ends = sum(abs(s) for s, k in zip(scores, kept, strict=True) if s and (s > 0) != bool(k))
                return ends + sum(w for a, b, w in edges if kept[a] != kept[b])

            assert cost(label) == min(map(cost, product([False, True], repeat=len(scores))))
        for value, kept in zip(scores[: len(page.blocks)], label, strict=False):
            changed[kept] += (value > 0) != kept
    assert changed[True] > 0 and changed[False] > 0


@pytest.mark.parametrize("tag", ["div", "span", "li><ul", "table><tr><td", "p><b"])
def test_deep_pages_take_time_by_their_length(tag):
    begun = time.process_time()
    deep = f"<{tag}>" * 50_000
    assert main_text(f"<body>{deep}</body><p></p>") == ""
    assert time.process_time() - begun < 6
    inside = f"{f'<{tag}>' * 5_000}<article>{ARTICLE}"
    assert main_text(inside) == f"Title\n{SENTENCE}\n{SENTENCE}"
