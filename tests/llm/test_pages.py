import html
import re
import time

from wayfare.llm import html_text, url_filter
from wayfare.llm.html_text import main_text

PAGE = """<html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><p>Site name and slogan of the site, rather long text here</p></header>
<nav><a href="/">Home</a> <a href="/x">More</a></nav>
<div class="cookie-notice"><p>We use cookies to make this site better for all of you.</p></div>
<div class=content><h1>A &amp; B</h1><p>First   paragraph<br>with <b>bold
words</b> &copy; and enough text to count.<p>Second paragraph, not closed either, long enough.
<p>Short.</p><form><p>Sign up to the letter</p></form></div>
<aside><p>Related text that must not be here at all</p></aside>
<section id="comments"><p>First comment, very long, and full of words that mislead.</p></section>
<footer>Impressum</footer><script>var x = "</p><p>no</p>";</script></body></html>"""


def test_article_only():
    assert main_text(PAGE).split("\n") == [
        "A & B",
        "First paragraph with bold words © and enough text to count.",
        "Second paragraph, not closed either, long enough.",
        "Short.",
    ]


def test_link_lists_weigh_less_than_text():
    links = "".join(f'<li><a href="/{i}">link number {i} with a long name</a></li>' for i in range(30))
    page = f"<div><ul>{links}</ul></div><div><p>{'text ' * 40}</p><p>{'more ' * 40}</p></div>"
    assert main_text(page) == f"{('text ' * 40).strip()}\n{('more ' * 40).strip()}"


TEXT = " ".join(f"word{n}" for n in range(30))


def test_an_article_in_a_form_stays():
    inner = f"<nav><a href=/>x</a></nav><h1>Title</h1><p>{TEXT}</p><p>{TEXT}</p><select><option>no</select>"
    page = f"<body><form id=aspnetForm action=/>{inner}<form><p>Sign up</p></form></form><footer>f</footer></body>"
    assert main_text(page).split("\n")[:3] == ["Title", TEXT, TEXT]
    assert main_text(f"<form><div><p>{TEXT}</p></div></form>") == ""
    assert main_text(f"<form><article><p>{TEXT}</p></article></form>") == TEXT
    assert main_text(f"<article><p>{TEXT}</p><p>{TEXT}</p><form><p>{TEXT}</p></form></article>") == f"{TEXT}\n{TEXT}"


def test_names_that_may_be_titles_are_judged_by_their_text():
    parts = [f'<section id="discussion"><h2>Discussion</h2><p>{TEXT}</p></section>']
    parts += [f'<section class="related-work"><h2>Related work</h2><p>{TEXT}</p></section>']
    parts += [f'<p class="social-policy">{TEXT}</p>', f'<p class="search-engines">{TEXT}</p>']
    page = f"<body><article><h1>A</h1><p>{TEXT}</p>{{}}</article></body>"
    found = main_text(page.format("".join(parts))).split("\n")
    assert found == ["A", TEXT, "Discussion", TEXT, "Related work", TEXT, TEXT, TEXT]
    links = "".join(f"<li><a href=/{n}>a long title of another page {n}</a></li>" for n in range(9))
    gone = [f'<div class="related">{links}</div>', '<div class="related-posts">See also this</div>']
    gone += [f'<div id="{x}"><p>{TEXT}</p></div>' for x in ("comments", "ad-slot", "cookie-notice", "newsletter-box")]
    assert main_text(page.format("".join(gone))) == f"A\n{TEXT}"
    after = f'<section id="discussion"><p>{TEXT} {TEXT}</p></section>'
    assert main_text(f"<article><p>{TEXT}</p></article>{after}") == TEXT


def test_pages_made_to_take_long():
    size = 250_000
    pages = [
        "<i><div>" + "<b></i>" * size,
        "<dt><dl>" + "<b>" * size + "<dd></dd>" * size,
        "<tr><table>" + "<b>" * size + "<tr></tr>" * size,
        "<a " + 'b="1" ' * size,
        "<p>" * size + "x",
        "<form>" * size + "<h1>x" + "</form>" * size,
        "<!" * size,
        "</x" * size,
        "<a href='" * size,
        '<div class="related">' * size + "x",
    ]
    for page in pages:
        start = time.process_time()
        main_text(page)
        assert time.process_time() - start < 10, page[:40]


def test_odd_pages():
    for page in ("", "<", "<!--", "<a href='", "</", "<script>x", "<p hidden>x</p>", "<!doctype html>"):
        assert main_text(page) in ("", "<")
    assert main_text("plain text only") == "plain text only"
    assert main_text("<table><tr><td>a</td><td>b</td></tr><tr><td>c</table>") == "a b\nc"
    assert main_text("<div>" * 30_000 + "deep") == "deep"


def test_generated_pages(spark, tables):
    """All pages of the table have their article between known tags."""
    pages = tables("pages")
    found = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_text.extract(pages).collect()}
    for row in pages.collect():
        article = re.search("<article>(.*?)</article>", row["html"], re.S)[1]
        blocks = [re.sub("<[^>]*>", " ", x) for x in re.split("</?(?:p|h1)>", article)]
        text = "\n".join(x for b in blocks if (x := " ".join(html.unescape(b).split())))
        assert found[row["page_id"]] == (text, len(text))


def test_page_rows(spark):
    rows = [(1, None, None, 1), (1, None, None, 1), (None, "u", "<p>x</p>", 2), (3, "u", "", 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    found = sorted((tuple(r) for r in html_text.extract(pages).collect()), key=repr)
    assert found == sorted(
        [(1, None, "", 0), (1, None, "", 0), (None, "u", "x", 1), (3, "u", "", 0)], key=repr
    )
    assert html_text.extract(pages.limit(0)).count() == 0


def test_canonical_urls(spark):
    cases = {
        "http://WWW.Example.com:80/a/?utm_source=x&b=2&a=1#top": "example.com/a?a=1&b=2",
        "https://example.com": "example.com",
        "https://example.com/A//": "example.com/A",
        "no scheme": None,
        None: None,
    }
    frame = spark.createDataFrame([(u,) for u in cases], "url string")
    got = frame.select("url", url_filter.canonical(frame["url"]).alias("c")).collect()
    assert {r["url"]: r["c"] for r in got} == cases


def test_verdicts(spark):
    urls = [
        "http://a.net", "http://a.net/x", "https://B.Example.NET/en/1?q", "http://example.com/de/2",
        "http://notexample.com/de/2", "http://x.org/fr/", "http://listed.info/p?utm_a=1", None, "a/b",
        "http://listed.info/q", "http://net/1",
    ]
    rows = [(i, u, "x") for i, u in enumerate(urls)] + [(6, urls[6], "x"), (None, urls[1], "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, listed string")
    listed = spark.createDataFrame([("https://listed.info/p/",), (None,), ("bad",)] * 2, "u string")
    found = {(r[0], r[3], r[4], r[5]) for r in url_filter.judge(pages, listed, url_filter.RULES).collect()}
    assert found == {
        (0, None, False, "allow"), (1, "net/", False, "block"), (2, "example.net/en/", False, "allow"),
        (3, "example.com/de/", False, "block"), (4, None, False, "allow"), (5, "org/fr/", False, "allow"),
        (6, None, True, "block"), (7, None, False, "allow"), (8, None, False, "allow"),
        (9, None, False, "allow"), (10, "net/", False, "block"), (None, "net/", False, "block"),
    }
    assert url_filter.judge(pages, listed, url_filter.RULES).count() == len(rows)
    assert url_filter.judge(pages.limit(0), listed.limit(0)).count() == 0


def test_the_filter_only_saves_work(spark, monkeypatch):
    """Many more keys than bits: false positives go in the exact join; and by shuffle."""
    monkeypatch.setattr(url_filter, "KEYS_PER_BLOCK", 500)
    monkeypatch.setattr(url_filter, "BROADCAST_BLOCKS", 0)
    pages = spark.range(2000).selectExpr("id AS page_id", "concat('http://h.x/', id) AS url")
    found = url_filter.judge(pages, pages.where("page_id % 2 = 0").select("url"))
    assert {r["page_id"] for r in found.where("listed").collect()} == set(range(0, 2000, 2))
