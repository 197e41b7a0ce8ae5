import html
import re

import pytest

from tests.conftest import SMALL
from tests.llm.brute import read
from tidewatch.llm import html_text
from tidewatch.llm.queries import QUERIES

LONG = "Here is a sentence of the article that is long enough to count as text. "


def article(page):
    """What stands in the only article of the synthetic pages, by plain replacement."""
    inner = re.search(r"<article>(.*?)</article>", page, re.DOTALL)[1]
    blocks = re.split(r"</?(?:p|h1|br)>", inner)
    texts = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", block)).split()) for block in blocks)
    return " ".join(filter(None, texts))


def test_query_equals_the_articles(spark):
    rows = {r.page_id: r for r in read(spark, SMALL, "pages", "page_id", "url", "html")}
    found = QUERIES["op8_html"](spark, SMALL).collect()
    assert len(found) == len(rows)
    for row in found:
        assert row.text == article(rows[row.page_id].html)
        assert row.n_chars == len(row.text) and row.url == rows[row.page_id].url


BODY = "".join(f"<p>{LONG}</p>" for _ in range(4))
EXPECTED = " ".join([LONG.strip()] * 4)


@pytest.mark.parametrize("page", [
    f"<body><div id=menu><a href=/>Home</a></div><div class='content'>{BODY}</div></body>",
    f"<body><header><h1>Site</h1></header><main>{BODY}</main><footer>{LONG}</footer></body>",
    f"<article>{BODY}<div class='comments'><p>{LONG}</p></div></article><aside>{LONG}</aside>",
    f"<article>{BODY}</article><section id='comment-list'>{BODY}{BODY}</section>",
    f"<div role=navigation>{LONG}</div>{BODY}<div class='cookie-notice'>{LONG * 9}</div>",
    f"<article><form>{LONG}<input name=q></form>{BODY}<script>var a = '<p>';</script></article>",
    f"<!-- <p>{LONG}</p> --><style>p {{}}</style><div class=ad>{LONG * 6}</div>{BODY}",
    f"<ul><li><a href=/a>one</a><li><a href=/b>two</a></ul><div>{BODY}</div><div hidden>{LONG}</div>",
    f"<ARTICLE>{BODY}</ARTICLE>", f"<article>{BODY}", f"<article>{BODY.replace('</p>', '')}</article>",
    f"<nav><p>{LONG}</nav>{BODY}", f"<div class='widget'><div><p>{LONG}</div></div>{BODY}",
])
def test_noise_goes_and_text_stays(page):
    assert html_text.main_text(page) == EXPECTED


@pytest.mark.parametrize("page,text", [
    ("", ""), ("   ", ""), ("plain words", "plain words"), ("<p></p><br>", ""), ("<nav>x</nav>", ""),
    ("<article><h1>A &amp; B</h1><p>c&nbsp;d\n e<b>f</b>&#x41;&lt;p&gt;</article>", "A & B c d efA<p>"),
    ("<article><p>one<br>two</p><p>three", "one two three"),
    ("<p>a < b and c > d</p>", "a < b and c > d"), ("<p title='x > y'>t</p>", "t"),
    ("<p title='open>t</p>", "t"), ("<p>&am;&amp</p>", "&am;&"),
    ("<article><header><h1>Title</h1></header><p>Short.</p></article>", "Title Short."),
])
def test_small_pages(page, text):
    assert html_text.main_text(page) == text


def test_long_page_is_kept_whole():
    many = "".join(f"<p>Paragraph {n}. {LONG}</p>" for n in range(5000))
    assert len(html_text.main_text(f"<div>{many}</div>")) > 5000 * len(LONG)


def test_odd_rows(spark):
    df = spark.createDataFrame(
        [(1, None, 5), (1, "<p>same</p>", 5), (1, "<p>same</p>", 5), (None, "", None)],
        "page_id long, html string, text int",
    )
    rows = html_text.extract(df).collect()
    assert sorted(r.text for r in rows) == ["", "", "same", "same"]
    assert html_text.extract(df.where("false")).collect() == []


LINE = "Seventy-five characters of text, as a paragraph of the article may well hold."[:75]


def paragraphs(count, text=LINE):
    return "".join(f"<p>{text}</p>" for _ in range(count))


@pytest.mark.parametrize("between", [
    paragraphs(4, "Short words, twenty."), "<ul>" + "<li>An item</li>" * 5 + "</ul>",
    "<table>" + "<tr><td>1</td><td>2</td></tr>" * 3 + "</table>", paragraphs(6, "'Yes.' 'No.'"),
    "<ul>" + "<li><a href=/x>Only a link of the text</a></li>" * 4 + "</ul>",
])
def test_short_lines_between_paragraphs_stay(between):
    page = f"<body><div id=menu>{LONG}</div><div>{paragraphs(4)}{between}{paragraphs(3)}</div></body>"
    inner = " ".join(re.sub(r"<[^>]*>", " ", between).split())
    assert html_text.main_text(page) == " ".join([*[LINE] * 4, inner, *[LINE] * 3])


def test_every_run_stays():
    gap = "<div>" + paragraphs(4, "<a href=/x>Link</a>") + "</div>"
    page = f"<body><div>{paragraphs(4)}</div>{gap}<div><div>{paragraphs(3)}</div></div></body>"
    found = html_text.main_text(page)
    assert found.count(LINE) == 7


def test_articles_beside_stay_and_noise_goes():
    page = f"<div><article>{BODY}</article><article><p>Short.</p></article><article hidden>x</article></div>"
    assert html_text.main_text(page) == f"{EXPECTED} Short."
    page = f"<main><article>{BODY}</article><div id=comments><article>{LONG}</article></div></main>"
    assert html_text.main_text(page) == EXPECTED


@pytest.mark.parametrize("page", [
    f"<div class='content has-sidebar'>{BODY}</div>", f"<main class='with-sidebar'>{BODY}</main>",
    f"<div id=page class='no-comments'><article>{BODY}</article></div>",
    f"<article class='post share-enabled'>{BODY}</article>", f"<article class='sidebar'>{BODY}</article>",
    f"<div class='sidebar-layout'><main>{BODY}</main><div class=sidebar>{LONG * 9}</div></div>",
    f"<main><div class='widget'><article>{BODY}</article></div></main>",
])
def test_classes_do_not_hide_an_article(page):
    assert html_text.main_text(page) == EXPECTED
