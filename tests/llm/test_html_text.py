import html
import re
import time

import pytest

from quernel.llm import html_text
from quernel.llm.queries import op12_html_extraction
from quernel.sources import load_table

RUNNING = "The cat sat on the mat and it was not at all sure that the dog had seen it from the door of the house. " * 3
RUNNING = RUNNING.strip()


def text_of(page):
    return " ".join(b.text for b in html_text.classify(html_text.cut(page)) if b.label == "good")


def marked_article(page):
    """Text between the article tags, block by block; the given pages have one each."""
    found = re.search(r"<article>(.*?)</article>", page or "", re.S)
    blocks = re.split(r"</?(?:p|h1)>", found[1].replace("<br>", " ") if found else "")
    texts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks]
    return " ".join(t for t in texts if t)


def test_given_pages(spark, small):
    pages = load_table(spark, "pages", folder=small)
    expected = {(r.page_id, r.url): marked_article(r.html) for r in pages.collect()}
    got = op12_html_extraction(spark, small).collect()
    assert len(got) == pages.count()
    assert {(r.page_id, r.url): r.text for r in got} == expected
    assert all(r.n_chars == len(r.text) for r in got)


def test_rules_without_marks(spark):
    """With no article tags and unnamed adverts the rules find most of it, and nothing else."""
    found = wanted = extra = 0
    for r in load_table(spark, "pages", folder="/root/testdata/sf0.01").collect():
        want = marked_article(r.html)
        page = re.sub(r"</?article>", "", r.html).replace(' class="ad"', "")
        got = [b.text for b in html_text.classify(html_text.cut(page)) if b.label == "good"]
        wanted += len(want)
        found += sum(len(t) for t in got if t in want)
        extra += sum(len(t) for t in got if t not in want)
    assert found > 0.9 * wanted and extra < 0.01 * found


def test_parts_that_are_not_the_article():
    page = f"""<!doctype html><html lang=en><head><title>T</title><style>p{{}}</style></head><body class="has-sidebar">
    <header><h1>Site</h1><p>{RUNNING}</p></header><nav><a href=/>Home</a> <a href=/x>All</a></nav>
    <div id="cookie-notice">{RUNNING}</div><!-- <p>{RUNNING}</p> --><script>var a = "</p><p>{RUNNING}"</script>
    <main><article class="post"><header><h1>Title &amp; <i>more</i></h1></header><p>{RUNNING}
    <p>Short one.<div class="adBox">{RUNNING}</div><p>{RUNNING}<ul><li>Plain item<li><a href=1>See this</a></ul>
    <div style="display: none">{RUNNING}</div><form><p>{RUNNING}</p><textarea>x</textarea></form>
    <section class="post-comments"><article><p>{RUNNING}</p></article></section></article>
    <aside><p>{RUNNING}</p></aside></main><div class=sidebar>{RUNNING}</div>
    <footer><p>{RUNNING}</p></footer></body></html>"""
    assert text_of(page) == f"Title & more {RUNNING} Short one. {RUNNING} Plain item"


def test_neighbours_decide_ambiguous_blocks():
    links = "<p><a href=1>One link</a> <a href=2>and another link</a></p>"
    page = f"<div>{links}<p>Next to links</p>{links}<h2>A heading</h2><p>{RUNNING}</p><p>Between.</p><p>{RUNNING}</p>{links}</div>"
    assert text_of(page) == f"A heading {RUNNING} Between. {RUNNING}"
    # A list of links at the end, and a word on either side of it.
    assert text_of(f"<p>{RUNNING}</p><p>Of it</p>{links}<p>xx</p>{links}") == f"{RUNNING} Of it"


def test_damaged_markup():
    assert text_of(f"<article><p>{RUNNING}<b>un<i>closed<p>next &lt;one&gt; &eacute;&#233;&nbsp;x") == f"{RUNNING}unclosed next <one> éé x"
    assert text_of(f"</div></p><article><p title='a>b'>{RUNNING}</p></span></article></div>") == RUNNING
    assert text_of(f"<article><p>{RUNNING}</p><p>a < b and c > d</p><p class=\"x") == f"{RUNNING} a < b and c > d"
    assert text_of(f"<article><p>{RUNNING}</p><a href=1>open link<p>{RUNNING}</article>") != ""
    assert text_of(f"<form><main><p>{RUNNING}</p></main></form>") == RUNNING


def test_unknown_language():
    text = "漢字仮名交じり文の例である。" * 20
    assert text_of(f"<body><p>{text}</p><p><a href=1>{text}</a></p></body>") == text


@pytest.mark.parametrize("piece", ["<div>", "<a href=\"", "<p 'x", "<script>", "<!--", "< ", "</div>", "<li>", "&amp", "x <b>y</b> "])
def test_time_grows_with_the_length(piece):
    def taken(n):
        start = time.perf_counter()
        html_text.classify(html_text.cut(piece * n))
        return time.perf_counter() - start

    taken(10)
    assert taken(200_000) < 40 * max(taken(20_000), 0.01)


def test_edges(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p></p>"), (4, "u", "no tags"), (4, "u", f"<article>{RUNNING}")]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id bigint, url string, html string, text string, blocks int")
    got = html_text.extract(pages).collect()
    assert [(r.page_id, r.url, r.text, r.n_chars) for r in got] == [
        (1, "u", "", 0), (2, None, "", 0), (None, "u", "", 0), (4, "u", "", 0), (4, "u", RUNNING, len(RUNNING))
    ]
    assert [len(r.blocks) for r in got] == [0, 0, 0, 1, 1]
    assert html_text.extract(pages.limit(0)).collect() == []
