import html as library
import random
import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from tarmac.llm import html_text as h


def page(n, body, host="a.example.com"):
    return (n, f"https://{host}/{n}", body)


def run(spark, rows):
    docs = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return {r.page_id: r for r in h.extracted(docs).collect()}


ARTICLE = """<!doctype html><html><head><title>T</title><script>if (a<b) document.write("<p>no</p>")</script></head><body class="page">
<header><p>Site</p></header><nav><ul><li>Home<li>News</ul></nav><div id="cookie-notice"><p>We use cookies</p></div>
<main><article><header><h1>Title {n}</h1></header>{paragraphs}<div class="ad-slot"><p>Buy</p></div>
<form><label>Mail</label><input></form><section class="comments"><h2>2 comments</h2><p>First!</p></section></article>
<aside><p>Related</p></aside></main><footer>&copy; 2020</footer></body></html>"""


def test_boilerplate_goes_and_blocks_stay(spark):
    rows = [page(n, ARTICLE.format(n=n, paragraphs="".join(f"<p>Text\n {n}&nbsp;<b>bold</b>&amp;{i}<br>next" for i in range(n)))) for n in range(1, 6)]
    for n, r in run(spark, rows).items():
        assert r.text.split("\n\n") == [f"Title {n}", *(f"Text {n} bold&{i} next" for i in range(n))]
        assert r.matched and r.n_chars == len(r.text)


def test_without_a_container_text_that_never_changes_is_template(spark):
    body = "<html><body><div><p>Menu</p></div><div><div><h1>Head {n}</h1><p>Body {n}</p><p>More {n}</p></div></div><div><p>Fixed</p></div></body></html>"
    got = run(spark, [page(n, body.format(n=n)) for n in range(6)])
    assert [got[n].text for n in range(6)] == [f"Head {n}\n\nBody {n}\n\nMore {n}" for n in range(6)]


def test_layout_elements_with_telling_names_lose_nothing(spark):
    """Hints around the article, with and without a container; comments and teasers deeper in hints stay out."""
    layouts = {
        "a.example.com": '<div class="content-sidebar-wrap"><article><h1>Head {n}</h1><p>Body {n}</p></article><div id="comments"><article class="comment-body"><p>First {n}!</p></article></div></div>',
        "b.example.com": '<form id="aspnetForm"><main><h1>Head {n}</h1><p>Body {n}</p></main></form>',
        "c.example.com": '<div id="page-{n}" class="has-sidebar"><div><h1>Head {n}</h1><p>Body {n}</p></div><div class="sidebar"><p>More {n}</p></div></div>',
        "d.example.com": '<div class="sidebar"><article class="teaser"><p>T{n}</p></article></div><div class="entry"><h1>Head {n}</h1><p>Body {n}</p></div>',
        "e.example.com": '<div class="sidebar"><article><p>Other {n}</p></article></div><article><h1>Head {n}</h1><p>Body {n}</p></article>',
    }
    rows = [page(10 * i + n, f"<html><body>{html.format(n=n)}</body></html>", host) for i, (host, html) in enumerate(layouts.items()) for n in range(5)]
    got = run(spark, rows)
    assert {i: r.text for i, r in got.items()} == {10 * i + n: f"Head {n}\n\nBody {n}" for i in range(5) for n in range(5)}


def test_a_slot_met_once_is_no_template(spark):
    extra = {1: "<blockquote>Quote</blockquote>", 2: "<pre>Code</pre>", 3: "<h3>Sub</h3>", 4: "<table><tr><td>Cell</td></tr></table>"}
    body = "<html><body><div><p>Menu</p></div><div><div><h1>Head {n}</h1><p>Body {n} and so on</p>{extra}</div></div></body></html>"
    rows = [page(n, body.format(n=n, extra=extra.get(n, ""))) for n in range(6)]
    got = run(spark, [*rows, (11, *rows[1][1:])])  # a copy of a page is no second page
    more = {1: "Quote", 2: "Code", 3: "Sub", 4: "Cell"}
    for n in (*range(6), 11):
        assert got[n].text.split("\n\n") == [f"Head {n % 10}", f"Body {n % 10} and so on", *([more[n % 10]] if n % 10 in more else [])]


def test_names_of_single_pages_make_no_streams(spark):
    """Words of one page's class or id: one stream a host, and one slot a place where they have digits."""
    body = '<html><body class="page slug-{w} postid-{n}"><div id="post-{n}"><article id="post-{n}" class="post tag-{w}"><p>Text {n}</p></article></div></body></html>'
    rows = [page(n, body.format(n=n, w="abcdefghij"[n % 10] * (n + 1))) for n in range(200)]
    docs = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("url", "html")
    streams = {h.written(h.folded(h.Page(r[2]).stream)) for r in rows}
    assert len(streams) == 1
    (wrapper,) = h.wrappers(docs).collect()
    assert wrapper.wrapper == streams.pop()
    assert all(r.text == f"Text {n}" and r.matched for n, r in run(spark, rows).items())
    assert len({h.Page(body.format(n=n, w="x")).blocks[0][1] for n in range(9)}) == 1


def test_alignment():
    a = ["div", "#", "/div", "p", "#", "/p"]
    b = ["p", "#", "/p", "p", "#", "/p", "ul", "li", "#", "/li", "li", "#", "/li", "/ul"]
    wrapper = h.aligned(h.folded(a), h.folded(b))
    assert h.loaded(h.written(wrapper)) == wrapper
    assert h.accepts(wrapper, a) and h.accepts(wrapper, b)
    assert ("?", ("div", "#", "/div")) in wrapper and ("+", ("p", "#", "/p")) in wrapper
    assert not h.accepts(wrapper, ["p", "#", "/p", "table", "/table"])


def test_many_streams_of_one_host(spark):
    """More different streams than one task aligns: rounds, one wrapper, and every page accepted."""
    rows = [page(n, "<article>" + "".join(f"<{t}>x{n}</{t}>" for t in ("h1", "h2", "p", "ul", "pre", "table", "div", "dl") if n >> "h1 h2 p ul pre table div dl".split().index(t) & 1) + "</article>") for n in range(256)]
    got = run(spark, rows)
    assert len(got) == 256 and all(r.text.split("\n\n") == [f"x{n}"] * n.bit_count() for n, r in got.items() if n)
    assert all(r.matched for r in got.values())


def layouts(count, draw):
    """Pages of one host whose articles hold blocks of ten kinds in random order and number."""
    kinds = ["<p>x</p>", "<h2>x</h2>", "<h3>x</h3>", "<ul><li>x</li><li>x</li></ul>", "<ol><li>x</li></ol>", "<pre>x</pre>",
             "<blockquote><p>x</p></blockquote>", "<table><tr><td>x</td></tr></table>", "<figure><figcaption>x</figcaption></figure>", "<dl><dt>x</dt><dd>x</dd></dl>"]
    for n in range(count):
        body = "".join(draw.choice(kinds) for _ in range(draw.randint(10, 30)))
        yield f'<html><body><nav><ul><li>m</li></ul></nav><div class="sidebar"><p>s</p></div><article><h1>x{n}</h1>{body}</article><footer><p>f</p></footer></body></html>'


def test_wrapper_of_two_thousand_layouts():
    """Aligned as a host's streams are: its size does not grow with them, and it accepts them all."""
    streams = [h.Page(html).stream for html in layouts(2_000, random.Random(3))]
    sizes, began = [], time.process_time()
    wrapper = h.folded(streams[0])
    for n, stream in enumerate(streams[1:], 2):
        wrapper = h.aligned(wrapper, h.folded(stream))
        if n in (250, 2_000):
            sizes.append(len(h.written(wrapper)))
    assert sizes[1] <= 1.5 * sizes[0] and sizes[1] < 4_000
    assert all(h.accepts(wrapper, s) for s in streams)
    assert not h.accepts(wrapper, [*streams[0], "table", "/table"])
    assert time.process_time() - began < 120


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["p", "h2", "ul", "div"]), max_size=12), min_size=2, max_size=6))
def test_wrappers_accept_what_they_come_from(pages):
    streams = [["div", *[t for tag in tags for t in (tag, "#", f"/{tag}")], "/div"] for tags in pages]
    wrapper = h.folded(streams[0])
    for stream in streams[1:]:
        wrapper = h.aligned(wrapper, h.folded(stream))
    assert h.loaded(h.written(wrapper)) == wrapper
    assert all(h.accepts(wrapper, s) for s in streams)


def test_names_inside_an_article_are_not_boilerplate(spark):
    """Telling words in names of the article's own sections and headings; names made of such words alone still count."""
    inner = '<h1>Head {n}</h1><section id="search-methods"><p>Methods {n}</p></section><h2 id="related-work">Related work {n}</h2>' \
        '<div class="social-history"><p>History {n}</p></div><p id="comment-on-sidebar-design">Design {n}</p><div class="comments-area"><p>First {n}!</p></div>' \
        '<div id="ad-slot-{n}"><p>Buy {n}</p></div>'
    rows = [page(n, f"<html><body><article>{inner.format(n=n)}</article></body></html>") for n in range(8)]
    for n, r in run(spark, rows).items():
        assert r.text.split("\n\n") == [f"Head {n}", f"Methods {n}", f"Related work {n}", f"History {n}", f"Design {n}"]


def test_pages_of_any_kind(spark):
    deep = "<div>" * 3_000 + "deep" + "</div>" * 3_000
    rows = [page(1, None), page(2, ""), page(2, ""), (3, None, "<p>x"), (None, "nonsense", "just text"), page(4, "<article><p>cut <b off", "b.example.com")]
    rows += [page(5, "<article><h1>A &lt;b&gt; &#x41;</h1><p>unclosed", "b.example.com"), page(6, deep, "c.example.com"), page(7, "<" * 50_000, "d.example.com")]
    docs = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "page_id bigint, url string, html string, text string, host string")
    got = sorted(((r.page_id or 0), r.text) for r in h.extracted(docs).collect() if r.page_id != 7)
    assert got == [(0, "just text"), (1, ""), (2, ""), (2, ""), (3, "x"), (4, "cut"), (5, "A <b> A\n\nunclosed"), (6, "deep")]
    assert h.extracted(docs.where("false")).count() == 0


def test_given_pages_against_their_one_template(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    raw = {r.page_id: r.html for r in pages.collect()}
    for r in h.extracted(pages).collect():
        inner = re.search(r"<article>(.*?)(</article>|\Z)", raw[r.page_id], re.DOTALL)[1]
        blocks = [" ".join(library.unescape(re.sub("<[^>]*>", " ", b.replace("<b>", ""))).split()) for b in re.split("</?(?:p|h1)>", inner)]
        assert r.text == "\n\n".join(b for b in blocks if b)
        assert r.matched
