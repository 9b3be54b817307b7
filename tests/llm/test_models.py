"""Fitted operators: held-out accuracy, and odd input."""
import zlib

import pytest

from ledgerloom.llm import html_text, language, queries, toxicity

SF = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    found = queries.op3_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == 1000
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1
    apart = [r for r in found if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in apart) > 0.98 * len(apart)


def test_language_of_odd_texts(odd, none):
    from pyspark.sql import functions as F

    model = language.train(odd, F.lit(True))
    found = language.predict(odd, model, carry=odd.columns).select("input.text", "lang_pred", "score").collect()
    assert len(found) == odd.count()
    for r in found:
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or "")) and 0 <= r["score"] <= 1
    assert {r["lang_pred"] for r in language.predict(odd, language.train(none, F.lit(True))).collect()} == {"und"}
    assert language.predict(none, model).isEmpty()


def _fit_plainly(rows, idf):
    """The same regression, weight by weight in plain numbers; calibration aside."""
    import math

    labels = sorted({r[0] for r in rows})
    apart = len(rows) >= 2 * language.CALIBRATION
    z, n, empty = {}, {}, language.Model(labels, None, None, idf)

    def weight(at):
        s = z.get(at, 0.0)
        return 0.0 if abs(s) <= language.L1 else -(s - math.copysign(language.L1, s)) / ((language.BETA + math.sqrt(n.get(at, 0.0))) / language.ALPHA + language.L2)

    for _ in range(language.EPOCHS):
        for i, (label, buckets, counts) in enumerate(rows):
            if apart and i % language.CALIBRATION == 0:
                continue
            x = [*zip(buckets.tolist(), empty.features(buckets, counts).tolist()), (len(idf), 1.0)]
            w = {(y, b): weight((y, b)) for y in labels for b, _ in x}
            scores = [sum(w[y, b] * v for b, v in x) for y in labels]
            e = [math.exp(s - max(scores)) for s in scores]
            for y, part in zip(labels, e):
                p = part / sum(e) - (y == label)
                for b, v in x:
                    g, at = p * v, (y, b)
                    rate = (math.sqrt(n.get(at, 0.0) + g * g) - math.sqrt(n.get(at, 0.0))) / language.ALPHA
                    z[at] = z.get(at, 0.0) + g - rate * w[at]
                    n[at] = n.get(at, 0.0) + g * g
    return {at: weight(at) for at in z}


def test_regression_equals_a_plain_one():
    import numpy as np

    texts = [("en", "the quick brown fox and the lazy dog"), ("de", "der schnelle Fuchs und der faule Hund"), ("fr", "le renard rapide et le chien paresseux"),
             ("en", "of all the things that are"), ("de", "von allen Dingen die sind"), ("fr", "de toutes les choses qui sont")] * 4
    rows = [(label, *language.ngrams(text)) for label, text in texts]
    idf = np.linspace(1, 3, language.BUCKETS)
    model, plain = language.fit(rows, idf), _fit_plainly(rows, idf)
    full = np.column_stack([model.weights, model.bias])
    assert np.count_nonzero(full) == sum(w != 0 for w in plain.values()) > 0
    for (label, bucket), w in plain.items():
        assert abs(full[model.labels.index(label), bucket] - w) < 1e-9
    assert model.temperature > 0 and all(model.predict(t)[0] == label for label, t in texts)


def test_language_sample_is_bounded_by_rows_of_one_id(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(language, "SAMPLE_ROWS", 10)
    words = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, F.lit(None).cast("long")).otherwise(F.lit(7).cast("long")).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("the fox and the dog "), F.col("id"))).otherwise(F.lit("der Fuchs und der Hund")).alias("text"),
        F.when(F.col("id") % 3 == 0, "en").otherwise("de").alias("lang"))
    model = language.train(words, F.lit(True))
    found = language.predict(words, model).groupBy("lang_pred").count().collect()
    assert {r["lang_pred"]: r["count"] for r in found} == {"en": 1334, "de": 2666}


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    found = queries.op10_compression_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").collect()
    bad, good = ([r["score"] for r in found if r["toxic"] == t] for t in (1, 0))
    wins = sum((b > g) + (b == g) / 2 for b in bad for g in good) / (len(bad) * len(good))
    assert wins > 0.95
    assert sum(s >= 0.5 for s in bad) > 0.8 * len(bad) and sum(s >= 0.5 for s in good) < 0.02 * len(good)


def test_toxicity_of_odd_texts(spark, odd, none):
    from pyspark.sql import functions as F

    labels = spark.createDataFrame([(i, i % 2, None if i == 4 else i % 3 == 0) for i in range(41)] + [(None, 1, True)], "doc_id long, quality int, toxic boolean")
    labels = labels.withColumn("toxic", F.col("toxic").cast("int"))
    for known in (labels, labels.filter("false")):
        model = toxicity.train(odd, known, F.lit(True))
        found = toxicity.score(odd, model).collect()
        assert len(found) == odd.count()
        assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found)
        assert toxicity.score(none, model).isEmpty()
    assert toxicity.train(none, labels, F.lit(True)).score("any text") < 0.5


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><a href=/>Home</a></header><nav><ul><li><a href=/a>A</a></li></ul></nav><div class="cookie-notice">We use cookies.</div>
<div id="wrap"><main><article><h1>Head&amp;line</h1><p>First  paragraph of some
length, <b>with bold<br>and a break</b>.<p>Second &eacute; paragraph of the text&nbsp;here.</p><aside>Related things</aside><p>Short.</p>
<form><input><button>Send</button></form><ul><li>one<li>two</ul></article></main>
<section id="comments"><p>I like this very long reader comment, which goes on and on and on and on.</p></section></div>
<div class="sidebar"><p>Other</p></div><footer>&copy; us</footer></body></html>"""


def test_main_text():
    assert html_text.main_text(PAGE) == "\n\n".join(
        ["Head&line", "First paragraph of some length, with bold and a break.", "Second é paragraph of the text here.", "Short.", "one", "two"])


@pytest.mark.parametrize("page", [None, "", " ", "plain text", "<p>one", "<", "<!--", "<div><div><div>", "</p></p>", "<script>x", "<a" * 1000, "<p>" * 3000 + "x",
                                  "<![foo[bar]]>", "<![ ]>", "<![", "<![CDATA[x]]>", "<!x", "<?x", "</ >", "&#x110000;&#99999999999;"])
def test_broken_pages(page):
    text = html_text.main_text(page)
    assert isinstance(text, str) and "<p>" not in text
    if page in ("plain text", "<p>one"):
        assert text == page.removeprefix("<p>")


def test_marked_sections_are_comments():
    page = f"<![if IE]><article><p>{LONG * 3}</p><![endif]><![foo[bar]]><p>{LONG * 4}</p><![ ]><!-- <p>never closed"
    assert html_text.main_text(page).split("\n\n") == [(LONG * 3).strip(), (LONG * 4).strip()]


@pytest.mark.parametrize("part", ["<div>", "<div class=ad>", "<article>", "<i>", "<header>", "<div class=comments><article>x", "<div><p>a b", "<!--", "<a href='", "<a", "<![x", "<p>", "</x>", "<b><hr>"])
def test_deep_pages_cost_by_their_length(part):
    from time import process_time

    def seconds(n):
        start = process_time()
        assert isinstance(html_text.main_text(part * n + "text"), str)
        return process_time() - start

    few = seconds(2_000)
    assert seconds(50_000) < 25 * 3 * few + 3


def test_long_page():
    page = f"<body><nav><a href=1>a</a></nav><article>{f'<p>{LONG * 5}</p>' * 90_000}</article><footer>f</footer>"
    assert len(page) > 20_000_000 and html_text.main_text(page) == "\n\n".join([(LONG * 5).strip()] * 90_000)


def test_pages_without_article_element():
    menu = "<div class=menu><a href=1>a</a><a href=2>b</a><a href=3>c</a></div>"
    page = f"<body><div>{menu}</div><div><p>{'Long text of the first part. ' * 5}</p><p>Brief.</p><p>{'Long text of the last part. ' * 5}</p></div><div><a href=1>x</a> <a href=2>y</a></div></body>"
    assert [t[:9] for t in html_text.main_text(page).split("\n\n")] == ["Long text", "Brief.", "Long text"]


LONG = "Long text of the part, with many words in it. "


@pytest.mark.parametrize("first, second", [
    ("<div>{}</div>", "<div>{}</div>"), ("<main><article>{}</article>", "<article>{}</article></main>"),
    ("<section><article>{}</article></section>", "<section><article>{}</article></section>"),
])
def test_content_outside_the_article(first, second):
    page = f"<body><nav><a href=1>a</a></nav>{first.format(f'<p>{LONG * 5}</p>' * 40)}<p>Between.</p>{second.format(f'<p>{LONG * 5}</p>' * 4)}<footer>f</footer>"
    assert html_text.main_text(page).split("\n\n") == [(LONG * 5).strip()] * 40 + ["Between."] + [(LONG * 5).strip()] * 4


@pytest.mark.parametrize("start, end", [
    ('<article class="post has-comments">', "</article>"), ('<article class="category-social">', "</article>"), ('<article class="promo">', "</article>"),
    ('<div class="layout has-sidebar">', "</div>"), ('<div id="no-sidebar">', "</div>"), ('<div class="content with-menu">', "</div>"),
    ("<form id=aspnetForm>", "</form>"), ("<main><h1>Title</h1><form>", "</form></main>"), ("<form><div><p>Foreword of it.</p><article>", "</article></div></form>"), ("<div class=widget>", "</div>"),
])
def test_containers_with_names_of_boilerplate(start, end):
    side = '<div class="sidebar"><p>Other</p></div><div class="site-footer"><p>Imprint</p></div><ul class="nav-menu"><li>Menu</ul>'
    page = f"<body><nav><a href=1>a</a></nav>{start}<p>{LONG * 8}</p><p>Brief.</p><p>{LONG * 9}</p>{side}{end}{side}"
    assert html_text.main_text(page).split("\n\n")[-3:] == [(LONG * 8).strip(), "Brief.", (LONG * 9).strip()]
    comments = f'<section id="comments"><article class="comment-body"><p>{LONG * 30}</p></article></section>'
    assert "Other" not in html_text.main_text(page + comments) and len(html_text.main_text(f"<article><p>{LONG * 8}</p></article>{comments}")) < len(LONG * 9)


def test_pages_table(spark):
    rows = [(1, "u", PAGE, "x"), (2, None, None, None), (None, "v", "", "y"), (1, "u", PAGE, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = html_text.main_texts(pages)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r["page_id"] or 0, r["n_chars"] > 0) for r in found.collect()) == [(0, False), (1, True), (1, True), (2, False)]
    assert html_text.main_texts(pages.filter("false")).isEmpty()


def test_pages_against_their_markup(spark):
    import html as h
    import re

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in queries.op1_text_tag_ratio(spark, SF).collect():
        article = re.search(r"<article>(.*?)(</article>|$)", pages[r["page_id"]], re.S).group(1)
        blocks = (" ".join(h.unescape(re.sub(r"</?b>|<br>", "", x)).split()) for x in re.split(r"</?p>|</?h1>", article))
        assert r["text"] == "\n\n".join(b for b in blocks if b)
