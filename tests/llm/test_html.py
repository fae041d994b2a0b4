"""Main text of pages, and the suffix ranks."""

import html
import re
import time

import numpy as np
import pytest
from conftest import SF
from edge_rows import edge, nothing  # noqa: F401

from arenamart.llm import html_extract as h


def text_of(page):
    return h.extract_chunk([page])[0]


def test_pages(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = h.op10_html(spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"<(?:/?p|/?h1|br)>", article)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


@pytest.mark.parametrize(("page", "text"), [
    (None, ""),
    ("", ""),
    ("plain  text", "plain text"),
    ("<p>a<p>b<br>c", "a\nb\nc"),
    ("<article><p>x &amp; y&nbsp;&lt;z&gt; &eacute;&#233;</article><p>out", "x & y <z> éé"),
    ("<nav>n</nav><header>h</header><article><header><h1>T</h1><p>by</p></header><p>b</p><footer>f</footer></article><footer>f", "T\nb"),
    ('<main><p>m</p><div class="share-bar">s</div><aside>a</aside><form>f</form><section id="comments"><p>c</p></section><p>n</main>', "m\nn"),
    ("<body><script>var t='<article>no</article>';</script><style>p{}</style><p>yes<!-- <p>no --></p><script>open", "yes"),
    ('<article><p title="a>b">q</p><p class="advert">ad<p>r</article>', "q\nr"),
    ("<article><ul><li>one<li>two</ul><table><tr><td>3</td><td>4</td></table></article>", "one\ntwo\n3\n4"),
    ('<div class="article-body"><p>kept</p></div><div class="cookie-notice">no</div>', "kept"),
    ("<article><div><p>a</div></p>b</article>c", "a\nb"),
    ("< 3 and <<b>x</b>", "< 3 and <x"),
    ("<title>t</title><p hidden>h</p><p role='navigation'>r</p><p>v", "v"),
])
def test_markup(page, text):
    assert text_of(page) == text


def test_repeated_runs_go_and_unique_runs_stay():
    menu = "<div>Home News Sport Weather Travel Culture Science Shop</div>"
    legal = "<div>All rights of this site are kept by its owners since long ago</div>"
    pages = [f"{menu}<p>unique words of page {i} stand here and only here {i * 7}</p>{legal}" for i in range(6)]
    assert h.extract_chunk(pages) == [f"unique words of page {i} stand here and only here {i * 7}" for i in range(6)]
    # equal pages are one page, so nothing repeats on distinct pages
    assert h.extract_chunk(pages[:1] * 6) == [text_of(pages[0])] * 6
    # passages that many articles share stay
    shared = "the same long passage that stands in many of the articles of this host"
    articles = [f"<article><p>own {i}</p><p>{shared}</p></article>" if i % 2 else f"<article><p>other {i}</p></article>" for i in range(30)]
    assert h.extract_chunk(articles)[1] == f"own 1\n{shared}"
    everywhere = [f"<article><p>own {i}</p><p>{shared}</p></article>" for i in range(30)]
    assert h.extract_chunk(everywhere)[1] == "own 1"


def test_ranks_are_those_of_prefixes():
    tokens = np.random.default_rng(2).integers(0, 3, 400)
    rank = h.run_ranks(tokens)
    keys = [tuple(tokens[i : i + h.RUN]) for i in range(len(tokens))]
    for i in range(0, 400, 7):
        for j in range(400):
            assert (rank[i] == rank[j]) == (keys[i] == keys[j])
            assert (rank[i] < rank[j]) == (keys[i] < keys[j])


def test_edges(spark, monkeypatch):
    monkeypatch.setattr(h, "CHUNK_BYTES", 60)
    rows = [(i % 3 if i else None, f"http://h{i % 2}.com/{i}", f"<p>text of {i // 2}") for i in range(12)]
    rows += [(None, None, None), (1, "", ""), (1, "http://h0.com/", "<p>" + "long " * 100_000)]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id bigint, url string, html string, host string, chunk int")
    got = h.extract(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    want = [(p, u, text_of(x)) for p, u, x in rows]
    assert sorted(((r.page_id, r.url, r.text) for r in got.collect()), key=str) == sorted(want, key=str)
    assert h.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize("attributes", [
    'style="overflow:hidden"', 'data-hidden="false"', "href='/hidden-gems'", 'data-id="menu"', 'href="/p?id=3&share=1"', "href=/p?id=ad&class=ad",
    'title="a class=ad hidden"', 'x-role="banner"', 'data-x = "id=menu" data-class=ad',
])
def test_only_whole_attributes_are_hints(attributes):
    assert text_of(f"<div {attributes}><article><p>a <a {attributes}>b</a> c</article></div>") == "a b c"


@pytest.mark.parametrize("attributes", ['data-x="1" hidden', "CLASS = ad", "alt='x>y'id='menu'", 'role="banner"', "aria-hidden=true", "hidden/"])
def test_hints_are_found_behind_other_attributes(attributes):
    assert text_of(f"<article><p>a <span {attributes}>b</span> c</article>") == "a c"


@pytest.mark.parametrize(("page", "text"), [
    ('<main class="content has-sidebar"><p>m</main>', "m"),
    ('<article class="post comments-open"><p>a</article>', "a"),
    ('<div class="no-header"><p>d</div>', "d"),
    ('<div id="ad-free"><p>d</div>', "d"),
    ('<article class="sidebar" id="comments" hidden><p>a</article>', "a"),
    ('<div class="sidebar"><p>x<div class="ad">y</div><article><p>a</article><p>z</div>', "a"),
    ('<form><input><div class="menu"><p>x</div><article><p>a</article></form>', "a"),
    ('<main><form><p>f</form><p>m <span class="adBox">x<div>y</div></span>n</main>', "m\nn"),
    ('<div class="sidebar"><aside><article>no</article></aside><p>x</div><p>b', "b"),
    ('<article><p>a</p><div class="ads"><p>x', "a"),
    ('<div class="menu">' * 3000 + "<p>x" + "</div>" * 3000 + "b", "b"),
])
def test_hints_never_drop_an_article(page, text):
    assert text_of(page) == text


@pytest.mark.parametrize(("page", "text"), [
    ('<article><p>a <svg class="i"/>b</p><p>c <svg><path d="M0"/>x</svg>d</article>', "a b\nc d"),
    ("<article><p>a <SVG />b</article>", "a b"),
    ("<article><p>a<iframe src=x>b<p>c</article>", "ab\nc"),
    ("<p>a<noscript>b<template>c<svg>d", "abcd"),
    ("<p>a<noscript>x</noscript><iframe>x</iframe><template><p>x</template>b", "ab"),
    ("<p>a<svg>" * 20_000 + "b", "\n".join(["a"] * 19_999 + ["ab"])),
    ("<p>a<textarea>x", "a"),
    ("<p>a<!-- x", "a"),
])
def test_only_raw_text_runs_to_the_end(page, text):
    assert text_of(page) == text


def test_repeats_count_over_the_whole_host(spark, monkeypatch):
    rare = "<div>a notice of the house that stands on three of the pages only</div>"
    all_over = "<p>every article of this host carries these very same ten words</p>"
    shared = "<p>these words stand in two thirds of all articles of it</p>"
    pages = [f"<p>own words of the page number {i} here and {i * 7} there</p>{rare if i in (3, 30, 55) else ''}" for i in range(60)]
    pages += pages[:1] * 40 + ["<p>nothing else is on this page but these words</p>"] * 2
    some = [f"<article><p>own {i}</p>{all_over if i else ''}{shared if i % 3 else ''}</article>" for i in range(60)] * 2
    rows = [(i, "http://plain.org/", x) for i, x in enumerate(pages)] + [(1000 + i, "http://some.org/", x) for i, x in enumerate(some)]
    want = {i: x for host in ("plain", "some") for i, x in zip([r[0] for r in rows if host in r[1]], h.extract_chunk([r[2] for r in rows if host in r[1]]), strict=True)}
    assert want[3] == "own words of the page number 3 here and 21 there" and want[1001] == "own 1\nthese words stand in two thirds of all articles of it"
    monkeypatch.setattr(h, "CHUNK_BYTES", 500)
    got = h.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == want and len(got) == len(rows)


@pytest.mark.parametrize(("page", "text"), [
    ("<p title=it's>Hello, it's fine</p><p>Second</p>", "Hello, it's fine\nSecond"),
    ('<p class=a">Text "quoted" more</p>', 'Text "quoted" more'),
    ("<p>a<a href=x?y='b>c</a>", "ac"),
    ('a <b x="1>2', "a 2"),
    ('<p>a<a x="b>c" d', 'ac" d'),
    ("x <a <!-- y", "x <a"),
])
def test_quotes_open_a_value_only_behind_an_equals_sign(page, text):
    assert text_of(page) == text


@pytest.mark.parametrize("comments", [
    '<section class="comments"><article class="comment"><p>c</article></section>',
    '<ol class="comment-list"><li><article><p>c</article></ol>',
    '<div class="comment-content"><p>c</div><div class="userComments">c</div>',
    '<article id="comment"><p>c</article>',
])
def test_reader_comments_go_with_their_articles(comments):
    assert text_of(f"<article><p>m</p>{comments}</article>") == "m"
    assert text_of(f"<article><p>m</p></article>{comments}") == "m"
    if "section" in comments:
        assert text_of(f"<div><p>m</p></div>{comments}") == "m"


def test_articles_in_articles_are_parts():
    assert text_of('<article><p>a</p><article><p>b</p></article><div class="related"><article>r</article></div></article>') == "a\nb"


@pytest.mark.parametrize("part", [
    "<p>It's 5 <b class='x>bold</b> here</p>", "<a ", "<script", "</", "<font><p>x</p>", '<a x="b>c" ', "<a x='", '<div class="ad"><p>x', "<header><h1>",
])
def test_broken_pages_take_linear_time(part):
    def seconds(size):
        page, start = part * (size // len(part)), time.process_time()
        text_of(page)
        return time.process_time() - start

    assert seconds(1_000_000) < 6


def test_chunks_of_many_pages_take_linear_time():
    rnd = np.random.default_rng(1)
    blocks = [[(" ".join(f"w{x}" for x in rnd.integers(0, 5000, 250)), False)] for _ in range(1500)]
    runs = np.unique(np.concatenate(h.run_hashes([h.stream_of(b) for b in blocks])))
    start = time.process_time()
    assert set(h.main_texts(blocks, (runs, runs[:3]))) == {""}
    assert time.process_time() - start < 10


def test_suffixes_are_sorted_and_share_prefixes():
    rnd = np.random.default_rng(3)
    for trial in range(60):
        tokens = rnd.integers(0, 2 + trial % 4, rnd.integers(0, 60))
        order, shared = h.suffixes(tokens)
        plain = tokens.tolist()
        assert order.tolist() == sorted(range(len(plain)), key=lambda i: plain[i:])
        for k in range(1, len(plain)):
            left, right = plain[order[k - 1] :], plain[order[k] :]
            assert shared[k] == next((i for i, (a, b) in enumerate(zip(left, right, strict=False)) if a != b), min(len(left), len(right)))


def test_covered_tokens_against_brute_force():
    rnd = np.random.default_rng(5)
    passages = [rnd.integers(0, 9, rnd.integers(5, 14)).astype(str).tolist() for _ in range(6)]
    for _ in range(30):
        streams = [sum((passages[k] for k in rnd.integers(0, 6, rnd.integers(0, 5))), []) for _ in range(8)]
        distinct = {tuple(s) for s in streams}

        def holds(run, least, distinct=distinct):
            return sum(any(s[i : i + h.RUN] == run for i in range(len(s))) for s in distinct) >= least

        body, everywhere, n = h.covered(streams)
        assert n == len(distinct)
        for masks, least in ((body, h.BODY_LEAST), (everywhere, max(h.ARTICLE_LEAST, h.ARTICLE_SHARE * n))):
            for s, mask in zip(streams, masks, strict=True):
                want = np.zeros(len(s), bool)
                for i in range(len(s) - h.RUN + 1):
                    if holds(tuple(s[i : i + h.RUN]), least):
                        want[i : i + h.RUN] = True
                assert mask.tolist() == want.tolist()
