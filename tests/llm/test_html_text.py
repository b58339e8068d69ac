import pytest

from terrapipe.llm.html_text import Page, Wrapper, align, expression, extract, fold, label, main_text, observe, read_evidence


def wrapper(*pages):
    w = Wrapper()
    for p in pages:
        w.add(*observe(Page(p)))
    return w


def texts(*pages):
    told = read_evidence(wrapper(*pages).evidence())
    return [main_text(Page(p), told) for p in pages]


def test_repeats_and_options_are_inferred():
    w = wrapper("<ul><li>a</li><li>b</li></ul><p>x</p>", "<ul><li>c</li></ul><h2>t</h2><p>y</p><p>z</p>")
    assert expression(w.items) == "ul[li[#]+] h2[#]? p[#]+"
    assert expression(wrapper("<dl><dt>a<dd>b<dt>c<dd>d<dt>e<dd>f</dl>").items) == "dl[(dt[#] dd[#])+]"
    assert expression(wrapper("<div>a</div>", "<div><b>q</b>a</div>", "<div></div>").items) == "div[b[#]? #?]"
    assert expression(wrapper("").items) == "" and fold([]) == [] and align([], []) == []


def test_article_without_the_rest():
    page = ('<html><head><title>T &amp; t</title><style>p{}</style><script>var t="</p>";</script></head><body><header>Site</header><nav><ul><li>Home</li></ul></nav>'
            '<div class="cookie-notice">Cookies?</div><article><header><h1>Title &eacute;</h1></header><p><b>First  <i>line</i>\n of text<br><p>Second&nbsp;one</p>'
            '<ul><li>item<li>item 2</ul><form>Name</form><div class="ad-box">Buy</div><p></p>tail <!-- no --></article><div id="comments"><article>Great!</article></div>'
            '<aside>More</aside><footer>&copy; x</footer>')
    assert texts(page) == ["Title é\n\nFirst line of text\n\nSecond one\n\nitem\n\nitem 2\n\ntail"]


def test_containers_around_the_article_and_pages_without_one():
    page = '<div class="page has-sidebar"><main><p>{0}</p></main><div class="sidebar">side</div></div><div class="related-posts"><article>other</article></div>'
    plain = '<nav>menu</nav><div class="story"><p>{0}</p></div><div class="cookie-bar">ok?</div>'
    assert texts(page.format("one"), plain.format("two"), page.format("three")) == ["one", "two", "three"]


def test_hosts_without_article_keep_where_the_text_is():
    page = "<body><div class='top'>Our site</div><div class='content'><p>{0} {0} {0}</p><p>{0}</p></div><div class='end'>All rights reserved</div></body>"
    assert texts(*(page.format(w * 9) for w in "abc")) == [f"{w * 9} {w * 9} {w * 9}\n\n{w * 9}" for w in "abc"]


@pytest.mark.parametrize("page", ["", "<", "a < b", "<p", "</p></div>", "<!-- never closed", "<script>x", "&#0;&bogus;", "<a href='x>y'>z</a>", "<p>" * 300, "\x00"])
def test_broken_pages(page):
    assert isinstance(texts(page)[0], str)


def test_order_of_pages_does_not_matter():
    pages = ["<p>a</p>", "<p>b<b>c</b></p><p>d</p>", "<h1>t</h1><p>e</p>", "<div><p>f</p></div>"]
    one, two = wrapper(*pages), wrapper(*pages[::-1])
    assert one.slots == two.slots


def test_rows(spark):
    rows = [(i, "http://H.example.com/%s" % i, f"<nav>menu</nav><article><p>text {i}</p></article>", 1) for i in range(5)] + [
        (None, None, "<article>no url</article>", 1), (7, "http://h.example.com", None, 1), (7, "http://h.example.com", "", None), (8, "nothing", "plain text", 2),
        (3, "http://H.example.com/3", "<nav>menu</nav><article><p>text 3</p></article>", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host int").repartition(3)
    got = sorted((repr((r.page_id, r.url)), r.text, r.n_chars) for r in extract(pages).collect())
    want = [f"text {i}" for i in range(5)] + ["no url", "", "", "plain text", "text 3"]
    assert got == sorted((repr(r[:2]), t, len(t)) for r, t in zip(rows, want, strict=True))
    assert extract(pages.limit(0)).collect() == []


def test_whole_pages_of_the_fixture(spark, sf_small):
    import html
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_small}/pages.parquet").collect()}
    for r in extract(spark.read.parquet(f"{sf_small}/pages.parquet")).collect():
        inside = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


@pytest.mark.parametrize("copies", [1, 2, 3, 50])
def test_copies_keep_their_text(copies):
    page = "<nav>menu</nav><div class='story'><h1>Title</h1><p>The <b>one</b> text</p></div><script>track({0})</script>"
    assert texts(*(page.format(k) for k in range(copies))) == ["Title\n\nThe one text"] * copies


def test_constant_headings_and_inline_parts_stay():
    page = "<div class='top'>Our site</div><div class='story'><h2>Summary</h2><p>{0} <b>told</b> {0}</p><p>All rights reserved</p></div>"
    plain = "<div class='top'>Our site</div>"
    got = texts(*(page.format(w * 9) for w in "abcd"), plain)
    assert got[:4] == [f"Summary\n\n{w * 9} told {w * 9}\n\nAll rights reserved" for w in "abcd"] and got[4] == "Our site"


def test_two_layouts_on_one_host():
    one = "<body><div class='top'>Our site</div><div class='content'><h1>{0}</h1><p>{0} {0} {0}</p></div><div class='end'>All rights</div></body>"
    two = "<body><div class='top'>Our site</div><div class='post'><p>{0}</p><p>{0}</p></div><div class='end'>All rights</div></body>"
    both = "<body><div class='content'>Teaser {0}</div><div class='post'><p>{0} {0} {0}</p></div></body>"
    long, words = "several words of {0} and more of {0} ", "abcdefghij"
    pages = [(one if k < 7 else two).format(long.format(w * 5).strip()) for k, w in enumerate(words)]
    got = texts(*pages, both.format("other text " * 9))
    assert all(g.startswith("several") for g in got[:10]) and not any("Our site" in g or "All rights" in g for g in got)
    assert [g.count("several") for g in got] == [4] * 7 + [2] * 3 + [0]
    assert got[10].count("other text") >= 27


@pytest.mark.parametrize("block,parts", [
    ("<ul>{0}</ul>", "<li>{0}</li>"), ("<ol>{0}</ol>", "<li><p>{0}</p></li>"), ("<pre>{0}</pre>", "{0}"), ("<table>{0}</table>", "<tr><td>{0}</td></tr>"),
    ("<blockquote>{0}</blockquote>", "<p>{0}</p>"), ("<h2>{0}</h2>", "{0}"), ("<dl>{0}</dl>", "<dd>{0}</dd>")])
def test_blocks_of_content_are_not_the_whole_article(block, parts):
    page = "<h1>Our site</h1><div class='content'><h1>title {0}</h1><p>lead {0}</p>" + block.format(parts.format("item {0} " * 30)) + "<p>end {0}</p></div>"
    for w, got in zip("abcd", texts(*(page.format(w * 4) for w in "abcd")), strict=True):
        assert got.startswith(f"title {w * 4}\n\nlead {w * 4}\n\nitem") and got.endswith(f"\n\nend {w * 4}") and got.count("item") == 30


def test_headers_of_an_article_stay():
    page = ('<article class="post"><header class="entry-header"><h1>Title {0}</h1></header><div class="post-header">Lead {0}</div><p>text {0}</p>'
            '<header class="header">Sub {0}</header></article><div class="page-header">site</div><header>site</header>')
    want = "Title {0}\n\nLead {0}\n\ntext {0}\n\nSub {0}"
    assert texts(page.format("a")) == [want.format("a")]
    assert texts(*(page.format(w) for w in "abcd")) == [want.format(w) for w in "abcd"]


NEVER = ["comments", "comment-list", "ad", "ad-box", "related", "related-posts", "cookie-notice", "newsletter-signup", "sponsored", "reply"]


@pytest.mark.parametrize("name", NEVER)
@pytest.mark.parametrize("copies", [1, 2, 7])
def test_comments_and_adverts_inside_an_article_go_whatever_they_say(name, copies):
    page = '<article><p>text {0}</p><div class="%s"><p>very much more other text, and other than elsewhere: {0}</p></div><p>end {0}</p></article>' % name
    assert texts(*(page.format(w) for w in "abcdefg"[:copies])) == [f"text {w}\n\nend {w}" for w in "abcdefg"[:copies]]


@pytest.mark.parametrize("copies", [1, 2, 3, 7])
def test_other_blocks_with_template_words_stay_if_they_hold_the_article(copies):
    """The same for one page, for copies and for different pages."""
    around = '<article><div class="share-story"><p>Body {0} of the page</p><div class="comments"><p>Great {0}! Much longer than the body is.</p></div></div></article>'
    beside = '<article><p>text {0} and more text</p><div class="notice-box"><p>Notice {0}</p></div><div class="share-bar">Share this</div><nav>next {0}</nav></article>'
    for words in ("abcdefg"[:copies], "a" * copies):
        assert texts(*(around.format(w) for w in words)) == [f"Body {w} of the page" for w in words]
        assert texts(*(beside.format(w) for w in words)) == [f"text {w} and more text" for w in words]


@pytest.mark.parametrize("depth", [700, 5_000, 100_000])
@pytest.mark.parametrize("tag", ["div", "font", "b", "blockquote"])
def test_deep_pages(depth, tag):
    page = "<body>" + f"<{tag}>" * depth + "<p>the text {0}</p>"
    closed = page + f"</{tag}>" * depth + "<p>end</p>"
    assert texts(page.format("a")) == ["the text a"]
    got = texts(*((page, closed)[k % 2].format(w) for k, w in enumerate("abc")))
    assert [g.split("\n\n")[0] for g in got] == ["the text a", "the text b", "the text c"]


def test_deep_rows(spark):
    rows = [(k, "http://deep.example.com/", "<div>" * 20_000 + f"<p>text {k}") for k in range(6)]
    found = extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()
    assert sorted((r.page_id, r.text) for r in found) == [(k, f"text {k}") for k in range(6)]


@pytest.mark.parametrize("page", ["<b>" * 50_000 + "</i></b>" * 50_000, "<a " * 60_000, "<p>" * 60_000, "</p>" * 60_000, "<div><b>" * 30_000 + "</b>" * 30_000,
                                  "<a href=\"" * 30_000, "<!-" * 60_000, "<li><p>" * 30_000, "<x y='>" * 30_000])
def test_broken_runs_take_linear_time(page):
    import time

    began = time.perf_counter()
    texts(page)
    assert time.perf_counter() - began < 6


def test_slugs_do_not_make_wrappers_grow():
    """A title in every id and class: 5,000 pages have the slots of one, and alignment stays linear."""
    page = '<body id="page-{1}"><article class="post post-{1}-a-long-title-{0}" id="post-{0}-some-title"><h1>t {1}</h1><div class="entry-content"><p>x {1}</p></div></article></body>'
    words = ["".join(chr(97 + k // 26 ** i % 26) for i in range(3)) for k in range(5000)]
    w = wrapper(*(page.format(x, k) for k, x in enumerate(words)))
    assert len(w.slots) == 2 and len(w.dump()) < 2000 and len(w.evidence()) == 32


def test_many_children_align_in_linear_time():
    import time

    began = time.perf_counter()
    a, b = ([[f"t{(k * s) % 20_011}", [], False, False] for k in range(20_000)] for s in (1, 7))
    out = align(a, b)
    assert time.perf_counter() - began < 5 and len(out) >= 20_000


@pytest.mark.parametrize("page,text", [
    ("<article><p title=it's>one</p><p>don't</p></article>", "one\n\ndon't"), ("<img alt=Don't src=x><p>hello it's</p>", "hello it's"),
    ("<article><p title=\"a > b\">one</p></article>", "one"), ("<article><a href = 'x>y'>z</a></article>", "z"), ("<article><p data-class='ad'>one</p></article>", "one"),
    ("<article><p title=\"open>one</p><p>two</p></article>", "one\n\ntwo"), ("<article><p class=ad>one</p>two</article>", "two")])
def test_quotes_open_values_only(page, text):
    assert texts(page) == [text]


def test_labels():
    assert label("div", ' class="entry-content wide" id="post-12-hello-world" role=main') == "div.content.entry.main.wide"
    assert label("div", ' class="a-very-long-sidebar-slug-7"') == "div.sidebar" and label("p", " hidden") == "p"


LAYOUTS = {
    "article": "<article>{body}</article>", "main": "<main>{body}</main>", "div": '<div class="story">{body}</div>', "table": '<table><tr><td class="text">{body}</td></tr></table>',
    "nested": '<div id="page"><div class="col"><section>{body}</section></div></div>', "wrapped": '<div class="main has-sidebar"><article class="post">{body}</article></div>',
}
AROUND = {
    "nav": "<nav><ul><li>Menu {k}</li><li>Home</li></ul></nav>{inner}<footer>Imprint {k}</footer>",
    "words": '<div class="navbar">Home | Menu {k}</div>{inner}<div class="sidebar"><p>Latest {k}</p></div><div id="footer">Imprint</div>',
    "notices": '<div class="cookie-banner">Cookies?</div>{inner}<div class="comments"><p>Reader {k} says: a lot, and at length, about nothing at all</p></div>',
    "forms": '<form action="/s">Search {k}<input></form>{inner}<aside>Ad {k}</aside><script>var a = "<p>no</p>"</script><style>p {{}}</style>',
}
BODIES = {
    "paragraphs": ("<h1>Title {w}</h1><p>First {w} of the text.</p><p>Second <b>{w}</b> of it.</p>", ["Title {w}", "First {w} of the text.", "Second {w} of it."]),
    "list": ("<h2>Title {w}</h2><ul><li>One {w}</li><li>Two {w}</li></ul><p>End {w}, said at some more length.</p>",
             ["Title {w}", "One {w}", "Two {w}", "End {w}, said at some more length."]),
    "advert": ('<p>Lead {w}, which is long enough.</p><div class="ad-slot"><p>Buy {w}</p></div><p>Rest {w}.</p>', ["Lead {w}, which is long enough.", "Rest {w}."]),
}


def test_many_layouts_by_hand():
    """72 layouts, three pages each: what the article says, and no word more."""
    missed = surplus = total = 0
    for layout in LAYOUTS.values():
        for around in AROUND.values():
            for body, want in BODIES.values():
                pages = [around.format(k=w, inner=layout.format(body=body.format(w=w * 5))) for w in "abc"]
                for w, got in zip("abc", texts(*pages), strict=True):
                    wanted = [b.format(w=w * 5) for b in want]
                    found = got.split("\n\n")
                    missed += len(set(wanted) - set(found))
                    surplus += len(set(found) - set(wanted))
                    total += len(wanted)
    assert (missed, surplus) == (0, 0), (missed, surplus, total)
