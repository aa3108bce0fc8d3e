import time
import tracemalloc
from itertools import product

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tidemark.llm.html_blocks import blocks
from tidemark.llm.html_extract import extract, least_cut, main_text
from tidemark.llm.queries import importable

ARTICLE = "<p>The council met on Tuesday to agree on a plan for the harbour, which had waited for years.</p>"
MORE = "<p>Work is to begin in spring.<br>It will take two years, and cost less than feared at first.</p>"
TEXT = (
    "The council met on Tuesday to agree on a plan for the harbour, which had waited for years.\n"
    "Work is to begin in spring. It will take two years, and cost less than feared at first."
)


@pytest.mark.parametrize(
    "page",
    [
        f"<article>{ARTICLE}{MORE}</article>",
        f"<html><head><title>Not this</title><style>p{{}}</style></head><body>{ARTICLE}{MORE}",
        f"<nav><ul><li><a href=/>Home</a><li><a href=/x>News</a></ul></nav><main>{ARTICLE}{MORE}</main>",
        f"<div id=header><p>The best paper in town, every day of the year.</p></div><div>{ARTICLE}{MORE}</div>",
        f"<header><p>The best paper in town, every day of the year.</p></header><div>{ARTICLE}{MORE}</div>",
        f"<div>{ARTICLE}{MORE}</div><aside><p>Other stories of the day that you might like to read.</p></aside>",
        f"<div>{ARTICLE}{MORE}</div><div class='sidebar-right'><p>Other stories of the day, all about the town.</p></div>",
        f"<div>{ARTICLE}{MORE}</div><section id=comments><article><p>I for one like it a lot, and so do many others.</p></article></section>",
        f"<div class=cookie-banner><p>We use cookies to make this page better for you. Do you agree?</p></div>{ARTICLE}{MORE}",
        f"<div role=alert><p>There is a storm warning for the whole of the coast today.</p></div>{ARTICLE}{MORE}",
        f"{ARTICLE}<form><p>Write to us, and say what you think of it all.</p><input></form>{MORE}",
        f"{ARTICLE}<script>if (a < b) document.write('<p>x</p>')</script><!-- <p>no</p> -->{MORE}",
        f"{ARTICLE}<div class=ad>Buy the new boat today. It is cheap, and it floats.</div>{MORE}",
        f"{ARTICLE}<div class='adsbygoogle'>Buy the new boat today. It is cheap, and it floats.</div>{MORE}",
        f"<div class='page modal-open has-sidebar'><div class=entry>{ARTICLE}<label>Name</label>{MORE}</div></div>",
        f"{ARTICLE}<p style='display: none'>Hidden words that nobody sees on the page.</p>{MORE}",
        f"{ARTICLE}{MORE}<footer><p>&copy; The paper. All rights reserved, as ever.</p></footer>",
        f"<p>{ARTICLE[3:-4]}{MORE[:-4]}<div class='share'><a href=1>Post</a><a href=2>Mail</a></div><!-- open",
    ],
)
def test_pages(page):
    assert main_text(page) == TEXT


def test_text_of_blocks():
    page = "<p>One&nbsp;&amp; <b>two</b>\n three&lt;p&gt; &#233;&#x4e2d; a < b</p><p></p><td>x &unknown; &amp"
    assert [block.text() for block in blocks(page)[0]] == ["One & two three<p> é中 a < b", "x &unknown; &"]


def test_short_paragraphs_stay_with_their_neighbours():
    page = f"<div>{ARTICLE}<p>Not all agree.</p>{MORE}<p>So be it.</p>{ARTICLE}</div>"
    assert main_text(page).split("\n")[1::2] == ["Not all agree.", "So be it."]


def test_nothing_to_extract():
    for page in (None, "", " ", "<html></html>", "<script>x", "<!--", "<", "<p", "<nav>A menu of things.</nav>"):
        assert main_text(page) in ("", "<")


def test_many_blocks():
    page = f"<div>{ARTICLE * 5000}</div>"
    assert main_text(page).count("\n") == 4999
    mixed = (ARTICLE + "<div class=ad>Buy it today.</div>") * 3000
    assert main_text(mixed).count("\n") == 2999


@given(st.text(alphabet=st.sampled_from(list("<>/!-&;=\"' apdivnr\n")), max_size=80))
def test_any_text_can_be_parsed(page):
    main_text(page)


@given(
    st.lists(st.integers(-6, 6), min_size=1, max_size=7),
    st.lists(st.tuples(st.integers(0, 6), st.integers(0, 6), st.integers(1, 4)), max_size=12),
)
def test_cut_is_least(odds, edges):
    edges = [(a, b, c) for a, b, c in edges if a < b < len(odds)]

    def cost(kept):
        own = sum(max(0, -o if k else o) for o, k in zip(odds, kept, strict=True))
        return own + sum(c for a, b, c in edges if kept[a] != kept[b])

    found = least_cut([float(o) for o in odds], [(a, b, float(c)) for a, b, c in edges])
    assert cost(found) == min(cost(kept) for kept in product([False, True], repeat=len(odds)))


def test_table(spark, sf_dir):
    importable(spark)
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = {r.page_id: r.text for r in extract(pages).collect()}
    for row in pages.collect():
        assert found[row.page_id] == main_text(row.html) != ""


def test_odd_rows(spark):
    importable(spark)
    rows = [(1, None, "u", "a"), (1, "", "u", "b"), (None, ARTICLE, None, "c"), (2, ARTICLE, "v", "d"), (2, ARTICLE, "v", "d")]
    pages = spark.createDataFrame(rows, "page_id long, html string, url string, text string")
    found = extract(pages)
    assert found.columns == ["page_id", "text", "url"]
    assert sorted(((r.page_id, r.text) for r in found.collect()), key=repr) == sorted(
        [(1, ""), (1, ""), (None, TEXT.split("\n")[0]), (2, TEXT.split("\n")[0]), (2, TEXT.split("\n")[0])], key=repr
    )
    assert extract(pages.where("false")).count() == 0


def test_formulas_are_text():
    page = "<p>We know that <math><mi>a</mi><mo>=</mo><mi>b</mi><annotation>a=b</annotation></math> holds for all of the cases.</p>"
    assert main_text(f"<article>{page}</article>") == "We know that a=b holds for all of the cases."


@pytest.mark.parametrize(
    "page",
    [
        "<p title='x" * 100_000,
        "<p title=\"x>" * 90_001,
        "<div>" * 200_000 + ARTICLE,
        "<div><b>" * 100_000 + ARTICLE * 20,
        ("<b>" * 50 + "<p>x y z</i></em></div>") * 5000,
        "<div>" * 60_000 + "</section>" * 40_000 + ARTICLE,
        "<p>x<script>" * 80_000,
        "<!--" * 250_000,
        "<div>some text " * 70_000,
        ARTICLE + "<a href='" + "</a>" * 250_000,
        ("<div>" * 500 + "words in it</div>" * 500) * 80,
    ],
)
def test_large_malformed_pages(page):
    """About a megabyte each: time and memory follow the size."""
    tracemalloc.start()
    started = time.perf_counter()
    main_text(page)
    took, (_, most) = time.perf_counter() - started, tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert took < 20 and most < 400e6


def test_text_after_a_quote_that_is_never_closed():
    page = f"<div>{ARTICLE}<p class='open>Text after it, which is here to be read.</p>{MORE}"
    assert main_text(page).split("\n")[0] == TEXT.split("\n")[0]
    assert main_text(page).split("\n")[-1] == TEXT.split("\n")[1]
