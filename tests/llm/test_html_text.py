from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyline.llm.html_text import Settings, blocks_of, main_text, repeated, runs_of, suffix_order

PAGES = "page_id long, url string, html string"
CASES = [
    ("<html><body><nav>Menu</nav><article><h1>A &amp; B</h1><p>One\n two&nbsp;three</p></article><footer>f</footer></body>", "A & B\nOne two three"),
    ("<article><p><b>open bold<br><p>next <i>in</i>line w<b>or</b>d</p></article>", "open bold\nnext inline word"),
    ("<article><p>keep</p><div class='ad-box'>buy</div><aside>side</aside><form>name <input> <p>x</p></form><p>also</p></article>", "keep\nalso"),
    ("<article>a<script>if (a < b) { '</p>' }</script>b<style>p{}</style><!-- <p>no</p> --><p>c &lt;p&gt;</p></article>", "a\nb\nc <p>"),
    ("<main><section id=comments><p>reader</p></section><p>text</p><div hidden>h</div><div style='display: none'>n</div></main>", "text"),
    ('<div role="main"><p title="a > b">q</p></div><div class="cookie notice">c</div>', "q"),
    ("<article><ul><li>one<li>two</ul><table><tr><td>x<td>y</table></article>", "one\ntwo\nx\ny"),
    ("<ARTICLE><P>Upper</P></ARTICLE><FOOTER>no</FOOTER>", "Upper"),
    ("<article><p>cut off &copy 5 &#233;&#x1F642; &bogus; &am", "cut off © 5 é🙂 &bogus; &am"),
    ("<article></article><p>no article text</p>", "no article text"),
    ("<nav>only</nav><footer>furniture</footer>", ""),
    ("", ""),
    (None, ""),
    ("plain text, no tags\nat all", "plain text, no tags at all"),
    ("<article><p> </p><p>&nbsp;</p></article>", ""),
    ("<article><p>" + "word " * 100_000 + "</p></article>", ("word " * 100_000).strip()),
    ("<article>a < b and c > d <3</article>", "a < b and c > d <3"),
    ("</div></p><article><p>x</div></p>y</article>", "x\ny"),
    # marks on the article or around it
    ('<html class="no-comments"><body class="has-sidebar"><nav>n</nav><article>text</article></body></html>', "text"),
    ('<body class="login search"><p>no article</p><div class="search">s</div></body>', "no article"),
    ('<div id="content-with-sidebar"><p>one</p><div class="sidebar">s</div></div>', "one"),
    ('<div class="site-header-wrap">w<article class="post share-ready"><p>text</p><div class="share">s</div></article>v</div>', "text"),
    ('<div class="widget"><main class="notice">text</main></div>', "text"),
    ('<td role="main" class="popup">text<div class="popup">p</div></td>', "text"),
    ('<article class="notice">one</article><article>two</article>', "one\ntwo"),
    ('<main><div class="search-page"><article>text</article></div></main>', "text"),
    ('<aside><article class="post">teaser</article></aside><article>text</article>', "text"),
    ('<article>text<section class="comments"><article class="comment">c</article></section></article>', "text"),
    ('<main><article>text</article><div id="comments"><article class="comment-body">c</article></div></main>', "text"),
    ('<div class="related"><article>only</article></div>', "only"),
    ("<header>site</header><article><header class='entry-header'><h1>title</h1><nav>n</nav></header>text<footer>f</footer></article>", "title\ntext"),
    # names that only hold such a word, and attributes that are none
    ('<article><h2 id="search-algorithm">h</h2><h2 id="related-work">r</h2><h2 class="share">s</h2>t</article>', "h\nr\ns\nt"),
    ('<article><section id="comments-on-the-law"><p>one</p></section><div class="search-results">two</div></article>', "one\ntwo"),
    ('<main><div class="search-results">found</div><p title="the hidden costs">p</p><p title=\'class="ad"\'>q</p></main>', "found\np\nq"),
    ('<article><p data-x="hidden">a</p><p HIDDEN>b</p><p hidden="">c</p><p aria-hidden=true>d</p><p style="color:red">e</p></article>', "a\ne"),
    ('<article data-path=/a/><p>text</p></article><footer>f</footer>', "text"),
    ("<article><div class=\"ad\" />x</div><p>a</p><section/>b</section></article>", "a\nb"),
    ('<article><p>see <a class="share" href=#>tweet</a>this <span class="ad">buy <b>now</b></span>text</p></article>', "see this text"),
    ('<article><p>a <span class="comment">b</span> <code class="header">c</code></p><div class="comment-body">d</div></article>', "a b c"),
    ('<article><div class="related-posts"><p>r</p></div><div class="share_buttons">s</div><ul class="social-links"><li>x</ul>t</article>', "t"),
    ("<article><p>a<svg><path d=x /><text>t</text></svg>b</p></article>", "a\nb"),
    # end tags left out
    ('<article><p class="notice">x<div>body</div><p>more</article>', "body\nmore"),
    ('<article><p class="notice">x<p>body<p>more</article>', "body\nmore"),
    ('<div><p class="notice"><b>x<ul><li class="ad">y<li>one</ul><p>two</div>', "one\ntwo"),
    ('<article><table><tr class="ad"><td>x<tr><td class="ad">y<td><p>z</table><dl><dt class="ad">a<dd>b</dl></article>', "z\nb"),
    ('<article><ul><li>a<ul><li class="ad">x</ul>b<li>c</ul><p class="ad"><button><p>in</button>x</p>d</article>', "a\nb\nc\nd"),
    ("<html><head><meta charset=utf-8><title>t</title><body><article>text</article>", "text"),
    ("<head><title>t</title><link rel=x><p>text", "text"),
    ("<head><title>t</title>text", "text"),
]


def texts(spark, rows):
    return {r["page_id"]: r["text"] for r in main_text(spark.createDataFrame(rows, PAGES)).collect()}


def test_markup(spark):
    rows = [(i, f"http://h{i}.example/", page) for i, (page, _) in enumerate(CASES)]
    got = texts(spark, rows)
    for i, (page, wanted) in enumerate(CASES):
        assert got[i] == wanted, page


def test_paragraphs_of_articles_may_repeat(spark):
    same = "<article><p>A paragraph that stands on every page of this host, word for word, each time.</p><p>own {}</p></article>"
    got = texts(spark, [(i, "http://h.example/" + str(i), same.format(i)) for i in range(20)])
    assert all(got[i].endswith(f"time.\nown {i}") for i in range(20))


def bare(i):
    top = "<p>Welcome to our site, the best place on the whole web for all of your reading</p>"
    return f"<body>{top}<p>Unique story number {i} about w{i * 7} and w{i * 13} " + " ".join(f"x{i}y{j}" for j in range(20)) + f"</p><p>short {i}</p>{top}</body>"


@pytest.mark.parametrize("most", [1 << 20, 1500])
def test_runs_on_distinct_pages_go_where_there_is_no_article(spark, most):
    rows = [(i, "http://bare.example/" + str(i), bare(i)) for i in range(40)]
    rows += [(100, "http://other.example/", bare(0)), (101, None, "<p>lost page of some text here and there, all by itself</p>")]
    got = {r["page_id"]: r["text"] for r in main_text(spark.createDataFrame(rows, PAGES), Settings(shard_tokens=most)).collect()}
    assert all(got[i].startswith(f"Unique story number {i} ") and got[i].endswith(f"\nshort {i}") and "Welcome" not in got[i] for i in range(40))
    assert got[100].startswith("Welcome")  # nothing repeats on its host
    assert got[101].startswith("lost page")


def test_a_run_on_two_pages_of_different_arrays_goes(spark):
    def twin(i):  # a notice that stands on two pages only, and on their exact copies
        notice = " ".join(f"notice{i // 2}word{j}" for j in range(12))
        return f"<p>{notice}</p><p>" + " ".join(f"own{i}word{j}" for j in range(30)) + "</p>"

    rows = [(i, f"http://twin.example/{i}", twin(i)) for i in range(40)] + [(40, "http://twin.example/40", twin(40)), (41, "http://twin.example/41", twin(40))]
    frame = spark.createDataFrame(rows, PAGES).repartition(5)
    for most in (1 << 20, 200):
        got = {r["page_id"]: r["text"] for r in main_text(frame, Settings(shard_tokens=most)).collect()}
        assert all(got[i].startswith(f"own{i}word0 ") and "notice" not in got[i] for i in range(40)), most
        assert all("notice20word0" in got[i] and "own40word0" in got[i] for i in (40, 41))  # copies are one page


def test_runs_known_from_elsewhere_are_covered():
    page = np.arange(20)
    assert not repeated([page], 4)[0].any()
    got = repeated([page, np.arange(50, 60)], 4, runs_of(page[5:9], 4))
    assert np.flatnonzero(got[0]).tolist() == [5, 6, 7, 8] and not got[1].any()


def test_copies_of_a_page_are_one_page(spark):
    got = texts(spark, [(i, f"http://bare.example/{i}", bare(1)) for i in range(3)])
    assert all("Unique story" in t and t.startswith("Welcome") for t in got.values())


def test_repeated_and_clashing_columns_and_empty(spark, clashing):
    frame = clashing(spark.createDataFrame([(1, "u", CASES[0][0]), (1, "u", CASES[0][0]), (None, None, None)], PAGES))
    result = main_text(frame)
    assert result.columns == [*frame.columns, "text"]
    assert sorted(r["text"] for r in result.collect()) == ["", CASES[0][1], CASES[0][1]]
    assert result.select("host", "page", "row").distinct().collect() == [("own host", "own page", "own row")]
    assert main_text(spark.createDataFrame([], PAGES)).collect() == []
    replaced = main_text(frame.withColumn("text", F.lit("old")))
    assert replaced.columns.count("text") == 1 and replaced.where("text = 'old'").count() == 0


def test_suffix_order_equals_sorted_suffixes():
    rng = np.random.default_rng(0)
    stream = rng.integers(0, 4, 300)
    order, rank = suffix_order(stream, 8)
    cut = [tuple(stream[i : i + 8].tolist()) for i in order]
    assert cut == sorted(cut)
    assert all((rank[i] == rank[j]) == (tuple(stream[i : i + 8]) == tuple(stream[j : j + 8])) for i in range(60) for j in range(60))


def test_repeated_equals_brute_force():
    rng = np.random.default_rng(1)
    pages = [rng.integers(0, 5, int(rng.integers(0, 60))) for _ in range(25)]
    pages[3] = pages[4].copy()
    got = repeated(pages, 4)
    for n, page in enumerate(pages):
        wanted = np.zeros(len(page), bool)
        for i in range(len(page) - 3):
            run = page[i : i + 4].tolist()
            if any(p.tolist() != page.tolist() and any(p[j : j + 4].tolist() == run for j in range(len(p) - 3)) for p in pages):
                wanted[i : i + 4] = True
        assert (got[n] == wanted).all()


def test_blocks_keep_their_kind():
    assert blocks_of("<nav>m</nav><p>u</p><article>c<footer>f</footer></article>") == [(-1, "m"), (0, "u"), (1, "c"), (-1, "f")]
