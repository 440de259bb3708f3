"""Main text of pages: the oracle covers the given pages, these the cases they lack."""

from soukline.llm import page_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head>
<body class="with-sidebar"><header>Site <a href=/>home</a></header>
<div id="mainMenu"><a href="/a">a</a></div><div class="cookie-notice">We use cookies a lot.</div>
<main class="post"><header><h1>Head &amp; more</h1><p>By someone</p></header>
<p>One<p>Two&nbsp; &#x74;hree <b>fo</b>ur<br>five
<div class="ad-slot">Buy this now, it is a very long advert that no one wants to read at all, ever.</div>
<script>if (a < b) document.write("<p>no</p>")</script><ul><li>x<li>y</ul>
<table><tr><td>1<td>2<tr><td>3</table><form><p>Your name</p></form>
<section id="comments"><article class="comment">Nice!</article></section><p>End: a < b</p></main>
<aside>Side</aside><footer>&copy; f</footer></body></html>"""


def test_article_without_its_surroundings():
    assert page_text.main_blocks(PAGE) == ["Head & more", "One", "Two three four five", "x", "y",
                                           "1 2", "3", "End: a < b"]


def test_page_without_article_mark():
    long = "running text " * 10
    page = (f'<div><a href=a>Home</a> <a href=b>News</a></div><div><h2>Head</h2><p>{long}</p>'
            f'<p><a href=c>linked</a></p><p>Short.</p></div><a href=d>More</a>'
            f'<div class="footer">{long}</div>')
    assert page_text.main_blocks(page) == ["Head", long.strip(), "linked", "Short."]


def test_broken_pages():
    blocks = page_text.main_blocks
    assert blocks("<p>only this") == ["only this"]
    assert blocks("plain") == ["plain"]
    assert blocks('<p title="a>b>c</p>d') == ["b>c", "d"]
    assert blocks("<p>a<!-- left open <p>b") == ["a"]
    assert blocks("<p>a</p><script>x") == ["a"]
    assert blocks("<p>a</p><p class=") == ["a"]
    assert blocks("<article>&amp;lt; &quot;&am") == ['&lt; "&am']
    assert blocks('<a href="/">links alone</a>') == []
    assert blocks("") == blocks(None) == []


def test_deep_and_long_pages_take_linear_time():
    assert page_text.main_blocks("<div>" * 30_000 + "<p>x") == ["x"]
    long = "<article>" + "<p>word</p>" * 30_000 + "</article>"
    assert len(page_text.main_blocks(long)) == 30_000
    assert page_text.main_blocks("<a href=\"x" * 20_000) == []


def test_rows(spark):
    rows = [(1, "u", PAGE, 7), (1, "u", PAGE, 7), (None, None, "<p>a&#10;b", 8), (3, "v", None, 9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")
    got = page_text.page_texts(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    out = sorted(map(tuple, got.collect()), key=str)
    assert out[-1] == (None, None, "a b", 3) and out[2] == (3, "v", "", 0)
    assert out[0] == out[1] and out[0][2].startswith("Head & more\n\nOne\n\n")
    assert page_text.page_texts(pages.limit(0)).count() == 0
