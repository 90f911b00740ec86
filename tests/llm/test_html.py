import html
import random
import re

import numpy as np
import pytest

from tests.llm.helpers import table
from textmart.llm.html_extract import MAIN_MARK, BoostedTrees, decode, extract, layout, main_texts, parse, train


@pytest.fixture(scope="module")
def model(spark):
    return train(table(spark, "pages", "sf0.01"), layouts=300)


def test_whole_table_against_the_article_element(spark, model):
    pages = {r.page_id: r.html for r in table(spark, "pages", "sf0.01").collect()}
    got = extract(table(spark, "pages", "sf0.01"), model).collect()
    assert len(got) == len(pages)
    for r in got:
        inner = re.search("<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inner)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_generated_layouts_held_out(model):
    rng, words = random.Random(77), "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda".split()
    tp = fp = fn = 0
    for _ in range(150):
        raw = layout(rng, words)
        want = {t.removeprefix(MAIN_MARK) for t in parse(raw).text if t.startswith(MAIN_MARK)}
        got = set(main_texts([parse(raw.replace(MAIN_MARK, ""))], model)[0].split("\n\n"))
        tp, fp, fn = tp + len(want & got), fp + len(got - want), fn + len(want - got)
    assert tp / (tp + fp) > 0.93 and tp / (tp + fn) > 0.93


def test_a_page_without_semantic_elements(model):
    page = """<body><div id="cookie-notice">We use cookies to make this better.</div><div class="container"><div class="post-content">
      <h1>Real title</h1><p>The first paragraph of the article, which says something long enough.</p><div class="ad">Buy this now!</div>
      <p>A second one, with <a href="x">a link</a> &amp; more
      text &lt;here&gt;.</p></div><aside class="sidebar"><ul><li><a href=1>Other</a></li></ul></aside><section id="comments"><div class="comment">
      <p>I really liked this article, thank you for writing it.</p></div></section></div><footer>Copyright</footer><script>var a = "<p>x</p>"</script></body>"""
    assert main_texts([parse(page)], model)[0] == ("Real title\n\nThe first paragraph of the article, which says something long enough."
                                                   "\n\nA second one, with a link & more text <here>.")


def test_text_of_formulas_fallbacks_and_unclosed_form_parts(model):
    page = """<body><nav><a href=1>Home</a></nav><article><h1>A title of the page</h1><p>The area is <math><mi>a</mi><mo>=</mo><mn>4</mn></math> in all, as said.</p>
      <noscript>Words that are shown without scripts, which count as well.</noscript><object>A fallback that was never closed, with a sentence.
      <p>After the object there is more of the article, quite a long sentence.</p></article><form><select><option>One<option>Two</form>
      <template><p>not shown</p></template></body>"""
    text = main_texts([parse(page)], model)[0]
    for part in ("The area is a=4 in all, as said.", "Words that are shown without scripts", "A fallback that was never closed", "After the object there is more"):
        assert part in text, text
    assert "One" not in text and "not shown" not in text
    after = "<article><p>Pick <select><option>Red<option>Blue</p><p>Next paragraph of the article, long enough to be kept.</p></article><p>z</p>"
    assert "Next paragraph of the article" in " ".join(parse(after).text)


def test_awkward_pages(spark, model):
    rows = [(1, "u", None), (1, "u", ""), (2, None, "<div>" * 3000 + "x"), (None, "u", "<p>a<p>b<div"), (3, "u", "</p></div>x &bogus; &#0;"), (4, "u", "<ul><li>" * 50),
            (5, "u", "<article><p>" + "long words here. " * 30_000 + "</article>")]
    pages = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "page_id long, url string, html string, text string, key string")
    got = extract(pages, model).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert [r.text for r in got if r.page_id == 1] == ["", ""]
    assert [len(r.text) for r in got if r.page_id == 5] == [17 * 30_000 - 1]
    assert extract(pages.limit(0), model).count() == 0
    assert train(pages.limit(0), layouts=40).leaf


def test_decoding_keeps_nothing_below_a_dropped_node():
    rng = np.random.default_rng(4)
    for _ in range(200):
        n = int(rng.integers(1, 9))
        parent = [-1, *(int(rng.integers(0, k)) for k in range(1, n))]
        logit = rng.normal(0, 2, n)
        kept = decode(parent, logit)
        best, pick = -np.inf, None
        for bits in range(1 << n):
            y = [bits >> k & 1 for k in range(n)]
            if all(not y[k] or y[parent[k]] for k in range(1, n)):
                value = sum(-np.logaddexp(0, -z) if v else -np.logaddexp(0, z) for z, v in zip(logit, y, strict=True))
                if value > best:
                    best, pick = value, y
        assert kept.tolist() == [bool(v) for v in pick]


def test_boosted_trees_learn_an_interaction():
    rng = np.random.default_rng(2)
    x = rng.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.3)).astype(float)
    model = BoostedTrees(depth=3, trees=20).fit(x[:2000], y[:2000])
    assert ((model.logit(x[2000:]) > 0) == y[2000:]).mean() > 0.95
