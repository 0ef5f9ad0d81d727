import pytest
from pyspark.sql import functions as F

from regspan.llm import html
from regspan.llm.labelled_pages import PAGES

W = html.learn()

CASES = {
    "<article><h1>Head &amp; more</h1><p>One  two\n three<br>four</p><p>f<b>iv</b>e</p></article>": "Head & more\nOne two three four\nfive",
    "<p>only &eacute;&nbsp;x &#8364;&lt;b&gt;</p>": "only é x €<b>",
    "<nav><ul><li><a href=a>x</a></li></ul></nav><footer><p>f</p></footer>": "",
    "": "",
    "plain text without any element": "plain text without any element",
    "<script>var a='<p>no</p>'</script><style>p{}</style><!-- <p>no</p> --><p>yes it is</p>": "yes it is",
    "<p>open <b>never closed<p>next one": "open never closed\nnext one",
    "a < b and <unknown>c</unknown> > d": "a < b and c > d",
}

_P = "This is a paragraph of the main text with words enough. " * 3
_T = " ".join(_P.split())

# Links in main text, and beside it.
LINKED = {
    f"<nav><a href=x>Home</a></nav><article><h1><a href=t>The Title</a></h1><p>{_P}</p></article>": f"The Title\n{_T}",
    f"<main><article><h2><a href=t>The Title</a></h2><p>{_P}</p></article></main>": f"The Title\n{_T}",
    f"<article><p>{_P}</p><p><a href=x>all of it is a link</a></p><p>{_P}</p></article>": f"{_T}\nall of it is a link\n{_T}",
    f"<article><p>{_P}</p><h2>References</h2><ul><li><a href=1>First ref</a><li><a href=2>Second ref</a></ul></article><footer>f</footer>": f"{_T}\nReferences\nFirst ref\nSecond ref",
    f"<div class=content><h1><a href=t>The Title</a></h1><p>{_P}</p><ol><li><a href=1>First ref</a></ol><p>{_P}</p></div>": f"The Title\n{_T}\nFirst ref\n{_T}",
    f"<article><p>{_P}</p><ul><li>No link</li></ul><p>{_P}</p></article>": f"{_T}\nNo link\n{_T}",
    f"<article><p>{_P}</p><nav><ul><li><a href=1>nav</a></li></ul></nav><div class=related><a href=x>rel</a></div><p>{_P}</p></article>": f"{_T}\n{_T}",
    f"<header><h1><a href=/>Site</a></h1></header><article><p>{_P}</p></article>": _T,
    f"<article><p>{_P}</p><section class=comments><article><p><a href=x>a user</a></p></article></section></article>": _T,
}

# Elements without text for the reader: closed, closing themselves, left open, and names like theirs.
SKIPPED = {
    "<article><p>a one <svg class='i'/> b two</p><p>c</p></article>": "a one b two\nc",
    "<article><p>a <svg><text>no</text></svg> b</p><svg><g><p>c</svg></article>": "a b\nc",
    "<article><p>a <svg><title/><style a='>'/><path/></svg> b</p><p>c</p></article>": "a b\nc",
    "<article><p>a</p><object data=x><p>b</p></article><footer>f</footer>": "a\nb",
    "<article><p>a</p><object><div>no</div></object><canvas>no</canvas><p>b</p></article>": "a\nb",
    "<article><p>a</p><canvas><p>b</p></article>": "a\nb",
    "<article><template-card><p>a b</p></template-card><select-box>z</select-box></article>": "a b\nz",
    "<article><p>a</p><template><div><template>no</template>no</div></template><p>b</p></article>": "a\nb",
    "<article><p>let <math><mi>x</mi><annotation>no</annotation></math> be</p><math/><p>b</p></article>": "let x be\nb",
    "<article><p>a</p><noscript><p>no</p></noscript><select><option>no</select><p>b</p></article>": "a\nb",
    "<article><p>a</p><script>no</script >b<style>no": "a\nb",
}

PAGE = """<!DOCTYPE html><html><head><title>T</title></head><body>
<div class="site-header"><h1>My Site</h1></div><div class="nav-menu"><a href=x>Home</a> <a href=y>About</a></div>
<div class="cookie-notice">We use cookies to make it better for you all the time and so on</div>
<div class="post-content"><h1>Headline here</h1><p>First para &amp; more <b>bold</b>text.</p>
<div class="sidebar-ad">Buy now cheap</div><ul><li>One</li><li>Two</li></ul><p>Second   para
 next.</p></div><div class="comments-area"><h3>Comments</h3><div class="comment-body"><p>I like this article
 very much indeed</p></div></div><form><p>Your email please</p></form><footer>(c)</footer></body></html>"""


@pytest.mark.parametrize("page, text", CASES.items())
def test_cases(page, text):
    assert html.main_text(page, W) == text


@pytest.mark.parametrize("page, text", LINKED.items())
def test_links_in_main_text(page, text):
    assert html.main_text(page, W) == text


@pytest.mark.parametrize("page, text", SKIPPED.items())
def test_elements_without_text(page, text):
    assert html.main_text(page, W) == text


def test_divisions_with_classes():
    expected = "Headline here\nFirst para & more boldtext.\nOne\nTwo\nSecond para next."
    assert html.main_text(PAGE, W) == expected


def test_labelled_pages_are_told_apart():
    """Blocks of the labelled pages, each page judged by what the others teach."""
    right = total = 0
    for i, page in enumerate(PAGES):
        weights = html.learn(PAGES[:i] + PAGES[i + 1 :])
        for block in html.blocks(page):
            total += 1
            right += (html.word_score(block, weights) > 0) == (block.label == "1")
    assert right / total > 0.75
    learned = [
        (html.word_score(b, W) > 0) == (b.label == "1") for p in PAGES for b in html.blocks(p)
    ]
    assert sum(learned) / len(learned) > 0.95


def test_given_pages(spark, sf_dir):
    """The given pages mark their article, which the operator is not told."""
    import re
    from html import unescape

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = html.query(spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search("<article>(.*)</article>", pages[r.page_id], re.S)[1]
        parts = [
            " ".join(unescape(re.sub("<[^>]*>", "", x.replace("<br>", " "))).split())
            for x in re.split("</?(?:p|h1)>", article)
        ]
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)


def test_odd_rows(spark):
    odd = [None, "", "<", "<p", "<p>" * 2000, "</div>" * 100, "<a href='x>y" + "z " * 10000, "&#0;&#x110000;&bad;"]
    pages = spark.createDataFrame([(i, h) for i, h in enumerate(odd)], "page_id long, html string")
    texts = {r.row.page_id: r.text for r in html.main_texts(pages.withColumn("text", F.lit(1))).collect()}
    assert texts[0] == texts[1] == texts[4] == "" and all(t is not None for t in texts.values())
    assert html.main_texts(pages.limit(0)).count() == 0
