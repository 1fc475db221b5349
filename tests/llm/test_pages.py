import collections
import os
import html
import re

import pyarrow.parquet as pq
from finmarts.llm import wrappers
from finmarts.llm.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def article(page):
    """The blocks of the article of a given page; those pages have one article, with b and br inside its blocks."""
    m = re.search(r"<article>(.*?)(</article>|\Z)", page or "", re.S)
    inner = re.sub(r"<br>", " ", re.sub(r"</?b>|<[^>]*\Z", "", m[1] if m else ""))
    blocks = [" ".join(html.unescape(b).split()) for b in re.split(r"<[^>]+>", inner)]
    return "\n".join(b for b in blocks if b)


def test_given_pages(spark):
    pages = pq.read_table(f"{SF}/pages.parquet").to_pylist()
    found = {r.page_id: r for r in QUERIES["op4_wrapper_induction"](spark, SF).collect()}
    assert len(found) == len(pages)
    for p in pages:
        r = found[p["page_id"]]
        assert (r.url, r.text, r.n_chars) == (p["url"], article(p["html"]), len(article(p["html"])))


SHOP = """<html><head><title>T {n}</title></head><body><div id="top"><a href="/">Home</a> <a href="/x{n}">More {n}</a></div>
<div><p>Story {n} begins &amp; goes on<br>here.</p><p>It ends <i>now</i> {n}.</p><p>Subscribe to the letter.</p>
<div class="comments"><p>Reader {n} says hello</p></div></div>{extra}
<div class="cookie-notice">We use {n} cookies</div><script>var x = "<p>no</p>";</script></body>"""


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, text string, host string, slots int")


def test_constant_blocks_are_template_and_varying_ones_content(spark):
    extra = ["", "<div><ul><li><a href='/a'>A{n}</a></li><li><a href='/b'>B{n}</a></li></ul></div>"]
    rows = [(n, f"https://shop.example/{n}", SHOP.replace("{extra}", extra[n % 2]).replace("{n}", str(n)), "t", "h", 1) for n in range(12)]
    found = wrappers.main_text(pages(spark, rows)).collect()
    assert {r.page_id: r.text for r in found} == {n: f"Story {n} begins & goes on here.\nIt ends now {n}." for n in range(12)}


def test_odd_pages(spark):
    rows = [
        (1, None, None, "", "", 1), (2, "", "", "", "", 1), (None, "nonsense", "just &lt;text&gt;", "", "", 1),
        (3, "http://h.example/a", "<p>one<p>two", "", "", 1), (3, "http://h.example/a", "<p>one<p>two", "", "", 1),
        (4, "http://h.example/b", "<p>broken <b attr='x", "", "", 1), (5, "http://h.example/c", "<article>" + "<div>" * 200 + "deep", "", "", 1),
        (6, "http://h.example/d", "<p>" + "long " * 50000 + "</p>", "", "", 1), (7, "http://h.example/e", "a < b <3 & c &nbsp; d", "", "", 1),
    ]
    found = sorted(((r.page_id, r.text) for r in wrappers.main_text(pages(spark, rows)).collect()), key=repr)
    texts = {i: t for i, t in found}
    assert len(found) == len(rows) and texts[1] == texts[2] == ""
    assert texts[None] == "just <text>" and texts[5] == "deep"
    assert wrappers.main_text(pages(spark, [])).count() == 0


def test_simple_tree_matching():
    a = wrappers.read_shape("body(div(ul(li)) div(p) div(ul(li)))")
    b = wrappers.read_shape("body(div(p) div(ul(li)))")
    assert wrappers.matched(a, b)[0] == 6 and wrappers.matched(a, b)[1] == [(1, 0), (2, 1)]
    assert wrappers.write_shape(wrappers.merged(a, b)) == wrappers.write_shape(a)
    assert wrappers.aligned(b, a) == [0, 4, 5, 6, 7, 8]


def test_parser_keeps_raw_text_and_closes_blocks():
    root, blocks = wrappers.parse("<div>a<script>if (x < '</p>') {}</script>b<p>c<ul><li>d<li>e</ul>f</div><!-- g <p> -->h")
    assert [t for _, t, _ in blocks] == ["ab", "c", "d", "e", "f", "h"]
    assert [n.tag for n, _, _ in blocks] == ["div", "p", "li", "li", "div", "#"]


def test_main_elements_hold_for_their_own_page_only(spark):
    rows = [
        (3, "http://h.example/a", "<p>one<p>two", "", "", 1), (4, "http://h.example/b", "<p>broken <b attr='x", "", "", 1),
        (5, "http://h.example/c", "<p>outside</p><article><div>deep", "", "", 1),
        (6, "http://h.example/d", "<p>" + "long " * 50000 + "</p>", "", "", 1),
        (7, "http://h.example/e", "a < b <3 & c &nbsp; d", "", "", 1), (8, "http://h.example/f", "<p>text</p><main></main>", "", "", 1),
    ]
    found = {r.page_id: r.text for r in wrappers.main_text(pages(spark, rows)).collect()}
    assert found == {3: "one\ntwo", 4: "broken", 5: "deep", 6: ("long " * 50000).strip(), 7: "a < b <3 & c d", 8: "text"}


def test_pages_of_any_depth(spark):
    rows = [
        (1, "http://deep.example/a", "<div>" * 5000 + "deep", "", "", 1),
        (2, "http://deep.example/b", "<p>flat</p>" + "<div>" * 4000 + "deeper<p>one<p>two", "", "", 1),
        (3, "http://deep.example/c", "<p>plain</p>", "", "", 1),
    ]
    found = {r.page_id: r.text for r in wrappers.main_text(pages(spark, rows)).collect()}
    assert found == {1: "deep", 2: "flat\ndeeper\none\ntwo", 3: "plain"}


NAMED = """<body><div class="content with-sidebar no-header"><div class="article-header"><h1>Title {n}</h1></div>
<div class="post related-work" id="search-results"><p>Story {n} goes on for some words.</p></div>
<div class="sidebar"><p>Aside {n}</p></div></div><div id="site-footer"><p>Foot {n}</p></div></body>"""


def test_names_are_read_whole_and_never_empty_a_page(spark):
    rows = [(n, f"https://named.example/{n}", NAMED.replace("{n}", str(n)), "", "", 1) for n in range(8)]
    wrapped = '<body><div class="widget"><p>Long story {n} of many words.</p><div class="comments"><p>Hi {n}</p></div></div></body>'
    rows += [(n, f"https://w.example/{n}", wrapped.replace("{n}", str(n)), "", "", 1) for n in range(10, 18)]
    found = {r.page_id: r.text for r in wrappers.main_text(pages(spark, rows)).collect()}
    assert found == {n: f"Title {n}\nStory {n} goes on for some words." for n in range(8)} | {
        n: f"Long story {n} of many words." for n in range(10, 18)
    }


def test_given_pages_without_article_elements(spark):
    """Hosts of one page are left out: with nothing to compare, an element named "ad" that holds most of it stays."""
    given = pq.read_table(f"{SF}/pages.parquet").to_pylist()
    hosts = collections.Counter((p["url"] or "").split("/")[2:3][0] for p in given)
    given = [p for p in given if hosts[p["url"].split("/")[2]] > 1]
    plain = [(p["page_id"], p["url"], re.sub(r"(</?)article\b", r"\1div", p["html"] or ""), "", "", 1) for p in given]
    found = {r.page_id: r.text for r in wrappers.main_text(pages(spark, plain)).collect()}
    assert given and found == {p["page_id"]: article(p["html"]) for p in given}


COPIED = """<body><div id="top"><a href="/">Home</a></div><div class="text"><p>{a} first paragraph of some length, told at leisure.</p>
<p>{a} second one.</p></div><div class="offer"><p>Buy {n} now</p></div><div><p>Printed by the press of the town.</p></div></body>"""


def test_a_host_of_near_copies_keeps_its_article(spark):
    def kept(a, n, last=True):
        return f"{a} first paragraph of some length, told at leisure.\n{a} second one.\nBuy {n} now" + "\nPrinted by the press of the town." * last

    def made(host, articles):
        return [
            (100 * host + n, f"https://copies{host}.example/{n}", COPIED.replace("{a}", a).replace("{n}", str(n)), "", "", 1)
            for n, a in enumerate(articles)
        ]

    some, alone = ["Same"] * 6 + ["W", "X", "Y", "Z"], ["Same"] * 8
    found = {r.page_id: r.text for r in wrappers.main_text(pages(spark, made(1, some) + made(2, alone))).collect()}
    # six copies and four others: the printer's line stands beside five articles; with copies alone nothing tells it from the article
    assert found == {100 + n: kept(a, n, False) for n, a in enumerate(some)} | {200 + n: kept(a, n) for n, a in enumerate(alone)}


def test_a_host_with_many_skeletons_is_merged_in_rounds(spark):
    tags = ["div", "section", "ul", "table", "blockquote"]
    shapes = []
    for i in range(625):
        inner = " ".join(f"{tags[i // 5**j % 5]}.k{j}" for j in range(4))
        shapes.append(("many.example", f"#(body({inner}))", i))
    shapes.append(("one.example", "#(body(p))", 1))
    df = spark.createDataFrame(shapes, "host string, shape string, shape_hash long")
    whole = {r.host: r.wrapper for r in wrappers.wrappers(df, 8).collect()}
    assert whole["one.example"] == "#(body(p))" and len(whole) == 2
    tree = wrappers.read_shape(whole["many.example"])
    for _, shape, _ in shapes[:-1:50]:
        assert -1 not in wrappers.aligned(wrappers.read_shape(shape), tree)
