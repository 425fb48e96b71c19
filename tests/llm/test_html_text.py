import re
from html import unescape

import pytest

from lakekit.llm import html_text, queries

TREE = html_text.trained()


def text_of(page):
    return html_text.main_text(page, TREE)[0]


def test_query_against_the_articles(spark, folder):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    found = queries.op6_html_extraction(spark, folder).collect()
    assert len(found) == len(pages)
    for r in found:
        article = re.search(r"<article>(.*?)(?:</article>|$)", pages[r.page_id] or "", re.DOTALL)
        blocks = re.split(r"</?(?:p|h1|br)\b[^>]*>", article[1] if article else "")
        expected = " ".join(" ".join(" ".join(unescape(re.sub(r"</?b\b[^>]*>", "", b)).split()) for b in blocks).split())
        assert (r.text, r.n_chars) == (expected, len(expected))


PARAGRAPH = "This is a paragraph of the article with enough words to be told apart from a menu by its length alone."


@pytest.mark.parametrize(("page", "expected"), [
    (None, ""), ("", ""), ("plain text without any markup at all, that is long enough to be a paragraph of its own here", None),
    (f"<html><head><title>T</title><style>p{{}}</style></head><body><nav><a>Home</a></nav><article><p>{PARAGRAPH}</p></article></body>", PARAGRAPH),
    (f"<header><h1>Site name</h1></header><main><h1>Head</h1><p>{PARAGRAPH}</main><footer>c</footer>", f"Head {PARAGRAPH}"),
    (f"<div class='cookie-notice'>{PARAGRAPH}</div><article>{PARAGRAPH}<aside>{PARAGRAPH}</aside></article>", PARAGRAPH),
    (f"<article>{PARAGRAPH}<div id=comments><p>{PARAGRAPH}</p></div><form>Name <input></form></article>", PARAGRAPH),
    (f"<article>{PARAGRAPH}<script>var a = '</p><p>{PARAGRAPH}';</script><!-- <p>{PARAGRAPH}</p> --></article>", PARAGRAPH),
    ("<article><p>a &lt;b&gt; &amp;amp; c&nbsp;d  \n e&#233; 1 < 2 R<i>e</i>d</p><p>x</article>", "a <b> &amp; c d eé 1 < 2 Red x"),
    (f"<article><p>{PARAGRAPH}</p><p>cut in a t<a href='x", f"{PARAGRAPH} cut in a t"),
    (f"<div><div class=\"sidebar left\"><p>{PARAGRAPH}</p></div><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></div>", f"{PARAGRAPH} {PARAGRAPH}"),
    ("<ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul>", ""),
    (f"<article><p>{PARAGRAPH}</p></div></span></b><p>Still here</p></article>", f"{PARAGRAPH} Still here"),
    (f"<article><p>{PARAGRAPH}<!-- never closed", PARAGRAPH),
])
def test_pages(page, expected):
    assert text_of(page) == (page if expected is None else expected)


def test_tree_learns_its_table():
    assert all(TREE(row[:-1]) == row[-1] for row in html_text.BLOCKS)


def test_deep_and_long_pages():
    assert text_of("<article>" + "<div>" * 20_000 + PARAGRAPH + "</div>" * 20_000) == PARAGRAPH
    assert len(text_of("<article><p>" + "word " * 300_000)) == 300_000 * 5 - 1


def test_awkward_rows(awkward, nothing):
    pages = awkward.withColumnRenamed("text", "html").selectExpr("*", "'t' AS Text", "1 AS n_kept")
    out = html_text.extract(pages)
    assert out.columns == [c for c in pages.columns if c not in ("html", "Text", "n_kept")] + ["text", "n_blocks", "n_kept"]
    assert out.count() == pages.count()
    assert html_text.extract(nothing, html="text").count() == 0


@pytest.mark.parametrize("wrapper", [
    "<body class='has-sidebar'>", "<body class='sidebar'>", "<div class='page no-sidebar'>", "<div id=content-with-comments>",
    "<div class='page sidebar-left'>", "<form id=all>", "<html class='menu'><body>",
])
@pytest.mark.parametrize("element", ["article", "main"])
def test_page_wrappers_are_not_beside(wrapper, element):
    page = f"{wrapper}<nav>Home</nav><{element}><p>{PARAGRAPH}</p></{element}><div class=related><article>{PARAGRAPH}</article></div>"
    assert text_of(page) == PARAGRAPH


def test_articles_that_are_comments_stay_beside():
    page = f"<article>{PARAGRAPH}</article><div id=comments><article class=comment>{PARAGRAPH}</article></div>"
    assert text_of(page) == PARAGRAPH


def test_short_paragraph_between_longer_ones_without_an_article():
    short, next_ = "He did not come back that evening.", "Nobody in the village had seen him since noon, and nobody asked."
    assert text_of(f"<div><p>{PARAGRAPH}</p><p>{short}</p><p>{next_}</p><p>{PARAGRAPH}</p></div>") == f"{PARAGRAPH} {short} {next_} {PARAGRAPH}"
