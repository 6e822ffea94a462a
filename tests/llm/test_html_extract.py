"""Main text of pages."""

import html
import re
from html.parser import HTMLParser

import pytest

from freightlane.llm.html_extract import extract, lines_of, main_text, runs
from freightlane.llm.queries import op1_main_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p><article>x";</script></head>
<body class="has-sidebar"><header class="site-header"><h1>Site</h1></header><nav><ul><li><a href="/x">Menu</a></li></ul></nav>
<div class="cookie-notice">We use cookies <b>a lot</b></div>{article}<div id="comments"><article>A reader says</article></div>
<aside>Side</aside><form><label>Name</label></form><footer>&copy; all</footer></body></html>"""


@pytest.mark.parametrize(
    ("article", "text"),
    [
        ("<article><h1>Head &amp; tail</h1><p>One\n  two<p>Of.</article>", "Head & tail One two Of."),
        ("<article><p>a<b>b</b>c<br>d<!-- no > --></article>", "abc d"),
        ("<article><p>x<div class='ad'>buy<p>now</p></div>y</article>", "x y"),
        ("<article><header><h1>T</h1></header>x<section class=comments>c</section><footer>f</footer></article>", "T x"),
        ("<main><p title='a > b'>&lt;b&gt; &#233;&eacute; &unknown;</p></main>", "<b> éé &unknown;"),
        ("<article><table><tr><td>1<td>2<tr><td>3</table><ul><li>x<li>y</ul></article>", "1 2 3 x y"),
        ("<article><p><a href=x>All linked</a></p><p hidden>no</p><p style='display: none'>no</p></article>", "All linked"),
        ("<article></article>", ""),
    ],
)
def test_article(article, text):
    assert main_text(PAGE.format(article=article)) == text


def test_page_without_an_article_keeps_the_dense_part():
    body = "<h1>A title</h1><p>" + "words and more " * 10 + "</p><p>Of.</p><p>" + "then others " * 12 + "</p>"
    page = f"<body><div><a href=/>Home</a> <a href=/b>News</a></div>{body}<div><a href=/c>More links here</a></div></body>"
    assert main_text(page) == " ".join(["A title", ("words and more " * 10).strip(), "Of.", ("then others " * 12).strip()])
    assert main_text("<p>short") == "short"


LONG = "<p>" + "words and more " * 20 + "</p>"


@pytest.mark.parametrize(
    "page",
    [
        "<body><form id=aspnetForm><nav><a href=/>Menu</a></nav><article>{}</article></form></body>",
        "<body><div class='content has-sidebar'><article>{}</article></div></body>",
        "<article class='post related-x'>{}</article>",
        "<article class='related'>{}</article>",
        "<body><form>{}</form></body>",
        "<article><h1>T</h1><div class=sidebar>{}</div></article>",
        "<body><button>x{}</body>",
        "<body><svg><video><audio><select><math><object data=x>{}</body>",
        "<div class=sidebar><aside>{}</aside></div>",
        "<article>{}</article><div id=comments>" + "<article>" + "A reader says " * 60 + "</article></div>",
    ],
)
def test_wrappers_and_unclosed_elements_keep_the_text(page):
    assert main_text(page.format(LONG)).removeprefix("T ").removeprefix("x ") == ("words and more " * 20).strip()


def test_regions_are_text_where_nothing_else_is():
    assert main_text("<nav>a bc</nav><footer>d ef</footer>") != ""
    assert main_text(f"<body>{LONG}<div class='cookie-notice'>We use cookies</div></body>") == ("words and more " * 20).strip()
    assert main_text("<p>kept<script>dropped") == "kept"


def test_surge_and_dive():
    assert runs([0, 0, 0, 5, 90, 3, 0, 0, 0, 7, 0, 0], 80) == [(3, 6)]
    assert runs([], 80) == []


@pytest.mark.parametrize("page", [None, "", "<", "<p", "<a title=\"x>y", "<script>", "<!-- x", "</p></p>", "<p>" * 500, "a" * 100_000])
def test_odd_pages(page):
    text = main_text(page)
    assert text == (page if page and page.startswith("a") else text)
    assert isinstance(lines_of(page or ""), list)


def test_pages_of_the_test_data(spark, folder):
    got = {r["page_id"]: r for r in op1_main_text(spark, folder).collect()}
    pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        article = re.search(r"<article>(.*)</article>", p["html"], re.S)[1]
        expected = " ".join(html.unescape(re.sub(r"<[^>]*>", "\n", re.sub(r"</?b>", "", article))).split())
        assert (got[p["page_id"]]["text"], got[p["page_id"]]["n_chars"]) == (expected, len(expected))


JUNK = [
    "comments-area", "reader-comments", "comment-list", "post-comments", "comment-thread", "user-comment", "site-footer", "sidebar-left",
    "ad-container", "newsletter-signup", "share-buttons", "related-posts", "author-bio", "cookie-banner",
]


@pytest.mark.parametrize("name", JUNK)
@pytest.mark.parametrize("shape", ["<article>{0}{1}</article>", "<article>{0}</article>{1}", "<div>{0}</div>{1}", "{1}<main>{0}</main>"])
def test_regions_named_by_heads_and_parts(name, shape):
    junk = f'<div class="{name}"><p>{"one long paragraph of another kind " * 9}</p></div>'
    assert main_text(f"<body>{shape.format(f'<h1>T</h1>{LONG}{LONG}', junk)}</body>") == " ".join(["T", *[("words and more " * 20).strip()] * 2])


@pytest.mark.parametrize("name", ["post", "content", "post-content", "article-body", "has-sidebar", "section", "main-column", "user-post", "entry-header"])
def test_names_of_texts_are_no_regions(name):
    text = " ".join(["T", *[("words and more " * 20).strip()] * 2])
    assert main_text(f'<body><div class="{name}"><h1>T</h1>{LONG}{LONG}</div></body>') == text
    assert main_text(f'<article><div class="{name}"><h1>T</h1></div>{LONG}{LONG}</article>') == text


def test_windows_decide_inside_the_article():
    links = "".join(f"<li><a href=/{i}>Another page {i}</a></li>" for i in range(6))
    text = ("words and more " * 20).strip()
    assert main_text(f"<article><h1><a href=/>T</a></h1>{LONG}<ul>{links}</ul>{LONG}<ul>{links}</ul></article>") == f"T {text} {text}"
    assert main_text(f"<article>{LONG}<p><a href=x>The whole report</a></p></article>") == f"{text} The whole report"
    assert main_text(f"<article>{LONG}<p>See <a href=x>this</a> and <a href=y>that</a>.</p></article>") == f"{text} See this and that."


def test_the_longest_of_several_articles():
    text = ("words and more " * 20).strip()
    card = "<article class='card'><h2>Teaser</h2><p>Some words.</p></article>"
    assert main_text(f"<article>{LONG}</article>{card}{card}") == text
    assert main_text(f"<main>{card}<article>{LONG}</article>{card}</main>") == text
    assert main_text(f"<main><h1>T</h1>{LONG}{card}</main>") == f"T {text}"
    assert main_text(f"<article>{LONG}</article><article>{LONG}</article>") == f"{text} {text}"


class Blocks(HTMLParser):
    """Lines of text with their linked part, by another reader of markup; regions by element only."""

    def __init__(self):
        super().__init__()
        self.lines, self.text, self.linked, self.skip, self.link = [], "", 0, 0, 0

    def flush(self):
        text = " ".join(self.text.split())
        if text:
            self.lines.append((text, self.linked))
        self.text, self.linked = "", 0

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("nav", "footer", "script", "style", "title") or tag == "div" and dict(attrs).get("class") == "ad"
        self.link += tag == "a"
        if tag not in ("a", "b", "i"):
            self.flush()

    def handle_endtag(self, tag):
        if tag not in ("a", "b", "i"):
            self.flush()
        self.skip -= tag in ("nav", "footer", "script", "style", "title") or tag == "div" and self.skip > 0
        self.link -= tag == "a"

    def handle_data(self, data):
        if not self.skip:
            self.text += data
            self.linked += len("".join(data.split())) if self.link else 0


def line_blocks(page):
    """The method itself, without marked articles: sums over three lines, from a surge of 80 to the next dive."""
    reader = Blocks()
    reader.feed(page)
    reader.flush()
    lengths = [len(t.replace(" ", "")) - linked for t, linked in reader.lines]
    kept, at = [], 0
    while at < len(lengths):
        stop = at
        while stop < len(lengths) and sum(lengths[stop : stop + 3]) and (lengths[at] or stop > at):
            stop += 1
        if stop > at and lengths[at] and max(sum(lengths[i : i + 3]) for i in range(at, stop)) >= 80:
            kept += [t for t, _ in reader.lines[at:stop]]
        at = max(stop, at + 1)
    return " ".join(kept)


def test_pages_without_article_marks_against_brute_force(spark):
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    compared = 0
    for page in pages:
        bare = page.replace("<article>", "<div>").replace("</article>", "</div>").replace("&amp;", "and")
        expected = line_blocks(bare)
        if expected:
            assert main_text(bare) == expected
            compared += 1
    assert compared > 200


def test_nulls_repeats_and_extra_columns(spark):
    rows = [(1, "u", "<article>a</article>", "t"), (1, "u", "<article>a</article>", "t"), (None, None, None, None)]
    schema = "page_id long, url string, html string, text string"
    out = extract(spark.createDataFrame(rows, schema))
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(tuple, out.collect()), key=repr) == [(1, "u", "a", 1), (1, "u", "a", 1), (None, None, "", 0)]
    assert extract(spark.createDataFrame([], schema)).count() == 0
