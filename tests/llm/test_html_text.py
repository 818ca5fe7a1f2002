import html as entities
import re

import pytest

from strata.llm import html_text
from strata.llm.html_text import main_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<div class="ad">Buy %(w)s</div><article><header><h1>Title &amp; more</h1></header><p>First   <b>para</b>graph<br>goes on</p>
<p>Second %(w)s<p>Third, unclosed<ul><li>one</li><li>two <a href=x>link</a></ul><form><input><button>Go</button></form>
<div class="share">Share</div><section id="comments"><p>I disagree %(w)s</p></section></article>
<aside>Side %(w)s</aside><footer>&copy; me</footer></body></html>""" % {"w": "word " * 30}


def test_article_only():
    assert main_text(PAGE).split("\n\n") == [
        "Title & more", "First paragraph goes on", ("Second " + "word " * 30).strip(), "Third, unclosed", "one", "two link",
    ]


def test_without_article_the_densest_subtree_and_its_heading():
    para = "some words of text, and so on. " * 8
    page = (f"<body><div id=top><a href=1>a</a><a href=2>b</a></div><div id=wrap><h2>Head</h2><div><p>{para}1</p>"
            f"<p>{para}2</p><p>{para}3</p></div></div><div><a href=1>more</a> <a href=2>links</a></div></body>")
    assert main_text(page).split("\n\n") == ["Head", *(f"{para}{i}" for i in "123")]


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("<html><body></body></html>", ""), ("plain &lt;text&gt;", "plain <text>"),
    ("<body><article>a &nbsp; b</article>", "a b"), ("<div class=ad>x<article><p>kept</p></article>", "kept"),
    ("<article><p>a<!-- no --><![CDATA[x]]>b</article><footer>f", "ab"),
])
def test_edges(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("page", [
    "<html><head><title>T</title><body><p>{}</body></html>", "<head><title>T</title><meta charset=utf-8><div><p>{}</div>",
    "<html><head><title>T</title>{}</html>",
])
def test_a_head_without_end(page):
    text = "some words of text, and so on. " * 8
    assert main_text(page.format(text)) == text.strip()


@pytest.mark.parametrize("mark", [
    "class='content with-sidebar'", "class=no-sidebar", "class=has-banner", "id=search-results", "class=social-history",
    "class='post comments-open'", "class=overflow-hidden", "class=header-fixed",
])
def test_a_class_word_does_not_drop_the_article(mark):
    text = "some words of text, and so on. " * 8
    page = (f"<html><head></head><body><div class=sidebar><p>Side words.</p></div><div {mark}><p>{text}1</p><p>{text}2</p>"
            f"<div class=ad>Buy</div></div><div id=comments><p>{text * 9}</p></div></body></html>")
    small = page.replace(text * 9, "I disagree")
    for one in (page, small) if "no-" in mark or "with-" in mark or "has-" in mark else (small,):
        assert main_text(one).split("\n\n") == [f"{text}1", f"{text}2"]


def test_deep_and_long_pages():
    assert main_text("<div>" * 50_000 + "deep" + "</div>" * 50_000) == "deep"
    assert main_text("<article>" + "<p>x y" * 50_000) == "\n\n".join(["x y"] * 50_000)


def by_template(page):
    """What the generated pages hold: headline and paragraphs of the article, read by patterns."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    blocks = (" ".join(entities.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner))
    return "\n\n".join(b for b in blocks if b)


def test_extract_matches_generated_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    out = html_text.extract(pages.withColumn("extra", pages.page_id), into="text").collect()
    assert len(out) == pages.count()
    assert [r for r in out if r.text != by_template(r.html)] == []


def test_extract_rows(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, None, "x"), (None, "<p>a", None)], "page_id int, html string, text string")
    assert sorted((r.page_id or 0, r.text) for r in html_text.extract(df).collect()) == [(0, "a"), (1, ""), (1, "")]
    assert html_text.extract(df.limit(0)).collect() == []


@pytest.mark.parametrize("end", ["<!-- open <p>after", "<!-- open", "<p class='x", "<div", "</p", "<!DOCTYPE", "<?pi"])
def test_what_the_end_of_a_page_cuts_off_is_no_text(end):
    assert main_text("<article><p>kept words of it</p>" + end) == "kept words of it"


def test_a_less_than_sign_is_text():
    assert main_text("<article><p>one < two and 3 <4") == "one < two and 3 <4"
