import html
import re
import time

from lotwise.llm import html_extract, queries

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p><article>";</script></head><body class="has-sidebar">
<nav><ul><li><a href="/">Home</a></li></ul></nav><header><h1>Site</h1></header><div class="cookie-notice">Cookies!</div>
<div id="main-{n}" class="post-{n} content"><h1>Title &amp; more</h1><p>First <b>par</b>agraph,<br>same   block&nbsp;here &lt;b&gt;</p>
<div class="ad">Buy</div><p>Second<p>Third <a href="#">link</a><form><input><p>Name</p></form><aside>Side</aside>
<ul><li>one<li>two</ul></div><div class="comments"><p>Nice post, I like it very much and write a long comment about it, longer than the text itself,
so that only its class tells it from the article. </p></div><footer>&copy; me</footer><!-- <p>hidden</p> --></body></html>"""
TEXT = "Title & more\nFirst paragraph, same block here <b>\nSecond\nThird link\none\ntwo"


def test_article_without_what_surrounds_it():
    assert html_extract.extract(PAGE.format(n=7), None) == TEXT
    assert html_extract.candidates(PAGE.format(n=7))[0][0] == "html>body.has-sidebar>div.post-0"
    assert html_extract.extract(PAGE.format(n=8), "html>body.has-sidebar>div.post-0") == TEXT


def test_odd_pages_do_not_break():
    for page in (None, "", "   ", "<", "a < b", "<p", "</div></p>", "<!-- open", "<script>x", "<b>" * 3000, "<div>" * 3000 + "deep", "<p>&#0;&bogus;&amp</p>"):
        assert isinstance(html_extract.extract(page, "html>body"), str)
    assert html_extract.extract("just text", None) == "just text"
    assert html_extract.extract("a <i>b</i> < c", None) == "a b < c"
    assert html_extract.extract("<div>" * 3000 + "deep", None) == "deep"


def test_host_votes_for_one_path(spark):
    rows = [(i, f"http://a.org/{i}", PAGE.format(n=i)) for i in range(5)]
    # Here another container has more text, but the host's other pages agree on the article.
    rows.append((9, "http://A.org/x", PAGE.format(n=9).replace("<footer>", "<section><p>" + "Much other text. " * 40 + "</p></section><footer>")))
    rows += [(10, None, None), (11, "http://b.org/", ""), (12, "nowhere", "<p>Some</p>"), (12, "nowhere", "<p>Some</p>")]
    pages = spark.createDataFrame([(*r, 1, 2) for r in rows], "page_id long, url string, html string, text int, host int")
    winners = {r.host: r.path for r in html_extract.winning_paths(pages).collect()}
    assert winners["a.org"] == "html>body.has-sidebar>div.post-0"
    got = sorted((r.page_id, r.url or "", r.text) for r in html_extract.main_texts(pages).collect())
    assert got == sorted([(i, u or "", TEXT if i < 10 else "Some" if i == 12 else "") for i, u, _ in rows])
    assert html_extract.main_texts(pages.limit(0)).count() == 0


def test_query_matches_the_template_of_the_pages(spark, small):
    """Every given page has one article of headings and paragraphs, so a few replacements give its text."""
    want = {}
    for r in spark.read.parquet(f"{small}/pages.parquet").collect():
        inside = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        blocks = re.split("</?(?:p|h1)>", re.sub("</?b>", "", inside.replace("<br>", " ")))
        want[r.page_id] = "\n".join(y for x in blocks if (y := " ".join(html.unescape(x).split())))
    got = queries.op6_html_extract(spark, small).collect()
    assert {r.page_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)


def test_captions_are_part_of_the_article():
    page = "<body><nav>menu</nav><article><p>one</p><figure><img src=x><figcaption>two</figcaption></figure><p>three</p></article></body>"
    assert html_extract.extract(page, None) == "one\ntwo\nthree"


def test_articles_in_several_parts():
    a, b = "First part. " * 80, "Second part. " * 70
    parts = f'<body><div><div class="post-body"><p>{a}</p></div><div class="ad">Buy</div><div class="post-body">{b}<p><a href="#">More</a></p></div></div></body>'
    want = "\n".join([a.strip(), b.strip(), "More"])
    path = html_extract.candidates(parts)[0][0]
    assert path == "body>div>div.post-body"
    assert html_extract.extract(parts, path) == html_extract.extract(parts, None) == want
    # A part of links alone belongs to the article too, and what lies inside a part isn't there twice.
    linked = parts.replace('<div class="ad">', '<div class="post-body"><a href="#">Source</a></div><div class="ad">')
    assert html_extract.extract(linked, path) == want.replace(a.strip(), a.strip() + "\nSource")
    articles = "<body><article><p>one</p></article><nav>menu</nav><article><p>two two</p></article><article>three</article></body>"
    assert html_extract.extract(articles, None) == html_extract.extract(articles, "body>article") == "one\ntwo two\nthree"
    deep = "<div>" * 30 + "deep" + "</div>" * 10 + "<p>less deep</p>"
    assert html_extract.extract(deep, html_extract.candidates(deep)[0][0]) == "deep\nless deep"


def test_layout_classes_do_not_hide_the_article():
    for names in ("content has-sidebar", "main-content with-sidebar", "entry-content no-comments", "container no-sidebar", "content-sidebar-wrap", "sidebar-left-layout", "content sidebar"):
        for tag in ("div", "section", "span"):
            page = f'<body><{tag} class="{names}"><h1>Title</h1><p>Text</p><div class="ad">Buy</div></{tag}></body>'
            assert html_extract.extract(page, None) == "Title\nText", names
    # What is named after it stays out, also behind a prefix, before a neutral word or a number, and by its role.
    for names in ("class=sidebar", "class='main-nav'", "class='post-comments'", "id=comments-area", "class='ad-slot x'", "class=sidebar-2", "class='widget widget_text'", "class=main role=navigation", "class='post comment'"):
        page = f"<body><div><p>Text</p><div {names}>Other things</div></div></body>"
        assert html_extract.extract(page, None) == "Text", names
    # A page that is one skipped class alone keeps its text.
    assert html_extract.extract('<body><div class="widget"><p>All there is</p><nav>menu</nav></div></body>', None) == "All there is"
    assert html_extract.extract("<body><nav class=menu>menu</nav></body>", None) == ""


def test_forms_around_and_within_the_article():
    article = "<h1>Title</h1><p>" + "Some text here. " * 40 + "</p>"
    want = "Title\n" + ("Some text here. " * 40).strip()
    search = '<div class="search"><input name=q><button>Go</button></div>'
    hidden = '<input type="hidden" name="__VIEWSTATE" value="a>b">'
    for wrapped in (
        f'<body><form id="aspnetForm">{hidden}{search}<div class="post">{article}</div></form></body>',
        f"<body><form>{hidden}<div><p>Short.</p></div></form></body>",
        f"<body><form>{search}<article><p>Short.</p></article></form></body>",
        f'<body><form id=aspnetForm>{search}<div class="post">{article}</div></body>',
    ):
        assert html_extract.extract(wrapped, None) == (want if article in wrapped else "Short."), wrapped
    contact = "<form><p>Your name</p><input><p>Message</p><textarea>x</textarea><button>Send</button></form>"
    for page in (
        f"<body><article>{article}{contact}</article></body>",
        f"<body><div>{article}{contact}</div></body>",
        f"<body>{contact}<form>{hidden}<div>{article}{contact}</div></form>{contact}</body>",
    ):
        assert html_extract.extract(page, None) == want, page
    # In an article a form goes, whatever it holds; a page of a form alone has no text.
    assert html_extract.extract("<article><p>Text</p><form><p>" + "Terms. " * 100 + "</p></form></article>", None) == "Text"
    assert html_extract.extract(f"<body>{contact}</body>", None) == ""


LAYOUTS = {
    "header of the article": ("<body><header>Site</header><article><header><h1>Title</h1></header><p>Text</p><footer>Tags</footer></article></body>", "Title\nText"),
    "main with a header around": ("<main><header>Site</header><p>Text</p></main>", "Text"),
    "table layout": ("<body><table><tr><td class=nav>Menu<td><h1>Title</h1><p>Text of some length</table></body>", "Title\nText of some length"),
    "empty svg": ("<body><svg class=x /><p>Text</p><svg><path d='M0'/></svg></body>", "Text"),
    "noscript never closed": ("<body><noscript><p>Text</p></body>", "Text"),
    "quote never closed": ('<body><p title="it>One</p><p>Two</p></body>', "One\nTwo"),
    "sign in an attribute": ("<body><p title='a > b' data-id=footer>Text</p></body>", "Text"),
    "empty comments": ("<body><!--><p>One</p><!---><p>Two</p><!-- a > b --></body>", "One\nTwo"),
    "stray closing tags": ("<body></div></nav><p>Text</span></section></p></body>", "Text"),
    "capital letters": ("<BODY><NAV>Menu</NAV><ARTICLE><P>Text</P></ARTICLE></BODY>", "Text"),
    "script with markup": ("<body><script>if (a < b) document.write('<p>no</p>')</script ><p>Text</p></body>", "Text"),
    "definition list": ("<body><dl><dt>Term<dd>Meaning<dt>Other<dd>More</dl></body>", "Term\nMeaning\nOther\nMore"),
    "odd references": ("<body><p>&#0000000000065; &#" + "9" * 9000 + "; &amp;lt;</p></body>", "A � &lt;"),
    "comment to the end": ("<body><p>Text</p><!-- <p>hidden</p>", "Text"),
    "sign without an end": ("<p>Text</p> a < b <!-- hidden", "Text\na < b"),
}


def test_layouts():
    for name, (page, want) in LAYOUTS.items():
        assert html_extract.extract(page, None) == want, name


def test_time_grows_with_the_page():
    for unit in ("<script ", "<a ", "<a", '<a "', "<a '\">\"'", "<!", "<!--", "<svg>", "<title", "<", "</p>", "<div>", "<form>", "<p id=' ", "&#1", "<b class=ad>"):
        for page in (unit * (1_000_000 // len(unit)), "<div>" * 60_000 + unit * (700_000 // len(unit)) + ">"):
            begin = time.process_time()
            html_extract.extract(page, None)
            assert time.process_time() - begin < 10, unit
