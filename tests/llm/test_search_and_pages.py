"""Top-k search and page extraction."""

import json
import math
import zlib

import numpy as np
import pytest

from eventloom.llm import html_wrapper as H
from eventloom.llm.topk import search_shard, top_k


def brute(rows, queries, k):
    vectors = {(i, tuple(math.floor(1024 * x) for x in v)) for i, v in rows
               if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q, a in sorted(x for x in vectors if x[0] in queries):
        scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in vectors if i != q and len(a) == len(b))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    return sorted(out)


def test_messy_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=6)]) for i in range(300)]
    rows += [(300, rows[7][1]), (301, rows[7][1]), (7, rows[7][1]), (302, None), (303, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (400, [float("nan")] * 6),
             (401, [float("inf")] * 6), (None, [1.0] * 6), (500, [1.0, 2.0]), (501, [3.0, 1.0]), (600, []), (601, [])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, rank int, score int")
    got = top_k(df, df.where("vec_id % 100 = 0"), k=4)
    assert sorted(map(tuple, got.collect())) == brute(rows, {i for i in range(0, 700, 100)}, 4)
    assert top_k(df.where("false"), df.where("false")).count() == 0


@pytest.mark.parametrize("large", [1, 2**40])
def test_pruned_blocks_equal_all_scores(large):
    rng = np.random.default_rng(2)
    v = rng.integers(-50, 50, (500, 8)) * large
    blocks = [(np.arange(a, a + 50), v[a : a + 50]) for a in range(0, 500, 50)]
    found = {}
    for q, i, s in search_shard(v[:5], np.arange(5), blocks, 6):
        found.setdefault(q, []).append((i, s))
    for q in range(5):
        all_scores = sorted((-sum(int(x) * int(y) for x, y in zip(v[q], v[i])), i) for i in range(500) if i != q)[:6]
        assert sorted((-s, i) for i, s in found[q]) == all_scores


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header><a href=/>Home</a></header>
<nav><ul><li><a>m1</a><li><a>m2</a></ul></nav><div class="cookie-notice">We use cookies</div>%s<aside>side</aside>
<form><label>Mail</label><input name=q><button>Go</button></form><script>if (a < b) { x("</p>"); }</script><footer>&copy; 2024</footer></body></html>"""
ARTICLE = """<article><header><h1>Head &amp; &lt;line&gt;</h1></header><p>One  two<br>three<p><b>four<br><p>f&#105;ve &nbsp; six</p>
<ul><li>a<li>b</ul><div class="ad-slot">buy</div><!-- p --><p hidden>no</p><section id="comments"><p>me too</p></section><table><tr><td>c1<td>c2</table></article>"""


def test_article_text():
    want = "Head & <line>\nOne two three\nfour\nfive six\na\nb\nc1\nc2"
    assert H.main_text(PAGE % ARTICLE) == want
    wrapper = H._furniture_places(__import__("json").dumps(H.shape(H.parse(PAGE % ARTICLE))), 1)
    assert H.main_text(PAGE % ARTICLE, wrapper) == want
    assert H.main_text(PAGE % "<main><p>x</p><p class=share-links>s</p></main>") == "x"
    assert H.main_text(None) == H.main_text("") == H.main_text("<p>") == ""


def test_wrappers_decide_inside_articles(spark):
    line = "<div class=x7>Get our letter every week</div>"
    def article(i, own=line):
        return f"<article><h1>All the news</h1>{own}<p>text {i} of many words here</p></article>"
    pages = [(i, "http://a/", article(i)) for i in range(3)] + [(3, "http://a/", None), (4, "http://a/", "")]
    pages += [(10 + i, "http://b/", article(i)) for i in range(9)] + [(19, "http://b/", article(9, "<div class=x7>A text of its own</div>")), (20, "http://b/", "<main><p>other</p></main>")]
    pages += [(30 + i, "http://c/", article(0)) for i in range(5)]  # copies
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in H.extract_main_text(df).collect()}
    clean = lambda i: f"All the news\ntext {i} of many words here"
    want = {i: clean(i) for i in range(3)} | {3: "", 4: ""} | {10 + i: clean(i) for i in range(9)}
    want |= {19: "All the news\nA text of its own\ntext 9 of many words here", 20: "other"}
    want |= {30 + i: "All the news\nGet our letter every week\ntext 0 of many words here" for i in range(5)}
    assert got == want


def test_names_drop_no_text(spark):
    body = "<p>long text of the page, with many words</p>"
    for box in ("<div class='site-content right-sidebar'>%s</div>", "<div id=page class=has-sidebar>%s</div>", "<form id=f>%s</form>", "<div class=header-fixed>%s</div>"):
        assert H.main_text(box % f"<article>{body}</article><div class=sidebar><article>teaser</article></div>") == "long text of the page, with many words"
        assert H.main_text(box % body) == "long text of the page, with many words"
    inside = """<h2 id=related-work>Related</h2><section id=discussion><p>d</p></section><h3 id=search-trees>Trees</h3><p class=notice>n</p>
<pre><code>x = 1 <span class='hljs-comment'># one</span> <span class="token comment"># two</span></code></pre>"""
    assert H.main_text(f"<article>{body}{inside}</article>") == "long text of the page, with many words\nRelated\nd\nTrees\nn\nx = 1 # one # two"
    pages = [(i, "http://h/", f"<article><p>Text {i} of the host</p><p class=notice>Terms apply.</p></article>") for i in range(4)]
    pages += [(i, "http://k/", f"<article><p>Text {i} of the host</p><p class=notice>Notice {i}</p></article>") for i in range(4)]
    got = sorted(r.text for r in H.extract_main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect())
    assert got == sorted([f"Text {i} of the host" for i in range(4)] + [f"Text {i} of the host\nNotice {i}" for i in range(4)])


def test_repeated_text_of_the_article_stays(spark):
    def article(i):
        return f"""<article><h2>Summary</h2><p class=by>By Ann Lee</p><div class=byline>Ann Lee</div><p>Once more <b>Update</b> <a>the law</a>
<ul><li><a>Share it</a><li>One item</ul><div class=sharing-economy>Cars {i}</div><section class='comments-on-the-bill'>Views {i}</section>
<div class=acme-newsletter>Join us</div><div class=site-footer-links>f</div><p>text {i} of many words here</article>"""
    pages = [(i, "http://a/", article(i)) for i in range(5)] + [(10 + i, "http://b/", article(i)) for i in range(2)]
    got = {r.page_id: r.text for r in H.extract_main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    def clean(i, more=()):
        return "\n".join(["Summary", "By Ann Lee", "Ann Lee", "Once more Update the law", *more, "One item", f"Cars {i}", f"Views {i}", f"text {i} of many words here"])
    assert got == {i: clean(i) for i in range(5)} | {10 + i: clean(i, ["Share it"]) for i in range(2)}


def test_wrappers_stay_small_over_many_layouts(spark):
    def page(i):
        own = "".join(f"<div class=k{'abcdefghij'[(i // 10**j) % 10]}{j}{'xyz'[i % 3]}><p>own {i} {j}</p></div>" for j in range(4))
        names = "".join("abcdefghijklmnopqrstuvwxyz"[(i * 7919 + j * 104729) // 26**j % 26] for j in range(6))
        return f"<article><div class=x7>Our letter</div><div class={names}{'q' * 500}><i class=n{names}>t{i}</i></div>{own}</article>"
    pages = spark.range(3000).select("id").toPandas()["id"]
    df = spark.createDataFrame([(int(i), "http://a/", page(int(i))) for i in pages], "page_id long, url string, html string")
    (row,) = H.infer_wrappers(df.selectExpr("'a' AS host", "html")).collect()
    w = json.loads(zlib.decompress(row.wrapper))
    assert row.n_pages == 3000 and len(json.dumps(w)) < 200_000
    assert H.main_text(page(7), H._unpacked_places(bytes(row.wrapper), row.n_pages)) == "t7\nown 7 0\nown 7 1\nown 7 2\nown 7 3"


def test_the_most_frequent_elements_stay_with_those_around_them():
    w = ["", 0, [["a", 0, [["b", 1, [], None, 2]], None, 9], ["c", 1, [], None, 1], ["d", 1, [], None, 2]], None, 9]
    assert H.bounded(w, 5) is w
    assert H.bounded(w, 4) == ["", 0, [["a", 0, [["b", 1, [], None, 2]], None, 9]], None, 9]


def test_wrappers_find_furniture_outside_articles(spark):
    pages = [(i, "http://h.example/p" if i % 2 else "http://h.example/q", f"<body><div>Our site, since 1990</div><p>text {i}</p><p>more {i}</p></body>", i) for i in range(12)]
    pages += [(100, None, None, 1), (101, "http://x/", "", 1), (102, "http://x/", "<p>only</p>" * 3, 1), (102, "http://x/", "<p>only</p>" * 3, 1)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, host int")
    got = sorted((r.page_id, r.text, r.n_chars) for r in H.extract_main_text(df).collect())
    want = [(i, t := f"text {i}\nmore {i}", len(t)) for i in range(12)] + [(100, "", 0), (101, "", 0)] + [(102, "only\nonly\nonly", 14)] * 2
    assert got == sorted(want)
    assert H.extract_main_text(df.where("false")).count() == 0


def test_inference_gives_options_and_repetitions():
    a = H.shape(H.parse("<div><h1>a</h1><p>1</p><p>2</p></div>"))
    b = H.shape(H.parse("<div><p>1</p><i>x</i></div>"))
    assert H.expression(H._merged(a, b)) == "([(div[(h1[#])? (p[#])+ (i[#])?])])"


def test_deep_and_long_pages_end():
    assert H.main_text("<div>" * 20_000 + "x" + "</div>" * 20_000) == "x"
    H.shape(H.parse("<div>" * 20_000 + "x"))
    assert len(H.main_text("<p>" + "word " * 300_000)) == 1_499_999
