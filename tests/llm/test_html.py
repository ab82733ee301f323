import itertools

import numpy as np
import pytest

from lakestrata.llm import html_dom, html_extract as he

SCHEMA = "page_id long, url string, html string"
PAGE = """<!DOCTYPE html><html><head><title>No</title><script>var t="</p>";</script><style>p{}</style></head><body><header><a href=x>Home</a></header>
<div class="cookie-notice">We use cookies.</div><nav><ul><li><a href=x>One</a><li><a href=x>Two</a></ul></nav><article><h1>Title &amp; more</h1>
<p>First&nbsp;paragraph has   words<br>and <b>bold <i>text</b> here, of course it does.<p>Second &lt;one&gt; follows with a <a href=x>link</a> in it and more.
<!-- <p>no</p> --><div class="ad">Buy this now</div><form><label>Mail</label><input><button>Go</button></form><p>Third closes it, at last, with words.</p></article>
<aside class="sidebar"><p>Other stories that look long enough to be text, really they do.</p></aside>
<section class="comments"><h3>Comments</h3><div class="comment"><p>First! I think that this is a fine long comment.</p></div></section><footer>&copy; us</footer></body></html>"""
TEXT = "Title & more\nFirst paragraph has words and bold text here, of course it does.\nSecond <one> follows with a link in it and more.\nThird closes it, at last, with words."


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(0)
    syllables = ["the", "ing", "tion", "eau", "sch", "ar", "o"]
    word = lambda: "".join(rng.choice(syllables, 2))
    return he.train([" ".join(word() for _ in range(rng.integers(8, 80))).capitalize() + "." for _ in range(300)], pages=500)


def test_page(model):
    assert he.extract_all([PAGE], model) == [TEXT]


def test_made_pages(model):
    maker = he.PageMaker(["Alpha beta gamma delta, epsilon zeta eta theta iota kappa.", "One two three four. " * 20], 99)
    pages = [html_dom.parse(maker.page()) for _ in range(150)]
    forest = html_dom.Forest(pages)
    kept = he.decode(forest, model.log_odds(html_dom.features(forest)))
    own = forest.own_chars > 0
    assert (kept[own] == (he.labels(forest)[own] > 0)).mean() > 0.98


def test_decoding_is_the_best_consistent_labelling():
    rng = np.random.default_rng(1)
    for _ in range(30):
        page = html_dom.Page()
        n = int(rng.integers(1, 9))
        for i in range(n):
            parent = int(rng.integers(0, i)) if i else -1
            page.parents.append(parent)
            page.depths.append(page.depths[parent] + 1 if i else 0)
            page.tags.append(0)
            page.flags.append(0)
            page.marks.append(-1)
        forest = html_dom.Forest([page])
        odds = rng.normal(size=n)
        got = he.decode(forest, odds)
        assert all(got[page.parents[i]] or not got[i] for i in range(1, n))
        best = max(sum(odds[i] for i in range(n) if y[i]) for y in itertools.product([0, 1], repeat=n) if all(y[page.parents[i]] or not y[i] for i in range(1, n)))
        assert np.isclose(odds[got].sum(), max(best, 0))


def test_parser_follows_usual_slips():
    page = html_dom.parse("<p>a<p>b<div>c<ul><li>d<li>e</ul></div>f</p><table><tr><td>g<td>h<tr><td>i</table><img><br/>j</b>k<a title='>' href=\"<p>\">l</a>")
    blocks = {}
    for _, block, text in page.texts:
        blocks.setdefault(block, []).append(text)
    assert ["".join(x).strip() for x in blocks.values()] == ["a", "b", "c", "d", "e", "f", "g", "h", "i", "jkl"]


@pytest.mark.parametrize("html", ["", "plain", "<", "<p", "<!--", "<script>x", "</p></p>", "<a " + "x='" * 1000, "<b>" * 3000 + "deep", "<p>" + "w " * 100_000, "<p title=\"a'b>c</p>"])
def test_odd_pages_do_not_crash(model, html):
    assert isinstance(he.extract_all([html], model)[0], str)


def test_tables(spark, model):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (3, "v", ""), (None, "w", PAGE)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'t' AS text", "1 AS n_chars")
    got = he.extract(df, model)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in got.collect()) == sorted((str(i), TEXT if h else "", len(TEXT) if h else 0) for i, _, h in rows)
    assert he.extract(df.limit(0), model).collect() == []


def test_learns_from_any_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert he.extract(empty, he.learn(empty)).collect() == []
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = he.extract(pages, he.learn(pages)).collect()
    assert len(got) == pages.count() and all(r.n_chars > 0 for r in got)
    for r, html in zip(sorted(got, key=lambda r: r.page_id), [x.html for x in pages.orderBy("page_id").collect()], strict=True):
        article = html[html.index("<article>") : html.index("</article>")]
        lines = [" ".join(he.entities.unescape(x).split()) for x in __import__("re").split(r"<[^>]*>", article)]
        assert r.text == "\n".join(x for x in lines if x)


@pytest.mark.parametrize("value", ['"true"', '""', '"0"', '"1"', "no"])
def test_marks_of_real_pages_mean_nothing(spark, model, value):
    page = PAGE.replace("<article>", f"<article data-keep={value}>").replace("<nav>", f"<nav data-keep={value}>")
    assert he.extract_all([page], model) == [TEXT]
    assert set(html_dom.parse(page, marked=False).marks) == {-1}


def test_learning_reads_no_marks(spark):
    pages = spark.createDataFrame([(1, "u", PAGE.replace("<article>", '<article data-keep="true">'))], SCHEMA)
    assert he.learn(pages).leaf


@pytest.mark.parametrize("inline", [
    "<math><mrow><mi>energy</mi><mo>=</mo><mi>mass</mi></mrow></math>", '<object data="x"><param name="a" value="b">fallback text</object>', "<object><p>fallback text</object>",
    "<svg><text>drawn words</text></svg>", "<audio><source src=x>no sound here</audio>", "<video>no film here</video>", "<canvas>drawn words</canvas>",
])
def test_text_of_embedded_elements_in_paragraphs_is_judged(model, inline):
    page = PAGE.replace("Second &lt;one&gt; follows", f"Second {inline} follows")
    got = he.extract_all([page], model)[0]
    words = html_dom.re.sub("<[^>]*>", " ", inline).split()
    assert "".join(words) in "".join(got.split())
    assert TEXT.split()[-1] == got.split()[-1] and "cookies" not in got and "Other stories" not in got


def texts_of(html):
    return " ".join(" ".join(t for _, _, t in html_dom.parse(html).texts).split())


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<head><title>t</title>Words here<p>more</p>", "Words here more"),
        ("<html><head><meta name=a>\n <title>t</title> \n</head><body><p>more</p></body></html>", "more"),
        ("<head><noscript>no <img src=x> script</noscript><title>t</title><p>more</p>", "more"),
        ("<head><title>t</title><noscript>never closed<p>more</p>", "never closed more"),
        ("<head><script>var x = 'a';</script><style>b {}</style>&amp; then", "&amp; then"),
    ],
)
def test_text_ends_the_head(html, want):
    assert texts_of(html) == want
