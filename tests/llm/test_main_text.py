import html
import html.parser
import random

import pytest

from capstream.llm import main_text, queries

LONG = "A sentence of some length that a reader of the page came for, with more words behind it."


class Article(html.parser.HTMLParser):
    """Text blocks of the article element of a page as the given tables hold them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.blocks = 0, [""]

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        if tag in ("p", "h1"):
            self.blocks.append("")
        if tag == "br":
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        self.depth -= tag == "article"
        if tag in ("p", "h1"):
            self.blocks.append("")

    def handle_data(self, data):
        if self.depth:
            self.blocks[-1] += data


def expected(page):
    a = Article()
    a.feed(page)
    return " ".join(t for b in a.blocks if (t := " ".join(b.split())))


def test_query_equals_the_article_elements(spark, sf):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = {r.page_id: r for r in queries.op12(spark, sf).collect()}
    assert got.keys() == pages.keys()
    for i, r in got.items():
        assert r.url == pages[i].url and r.text == expected(pages[i].html or "") and r.n_chars == len(r.text)


BODY = f"<h1>Title</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p>"
TEXT = f"Title {LONG} Short. {LONG}"
AROUND = ["<nav><ul><li><a href='/'>Home</a></li><li><a href=/x>Other pages</a></ul></nav>", "<header><p>The site's name and its long claim for everyone.</p></header>",
          f"<footer>&copy; all rights. {LONG}</footer>", f"<aside><p>{LONG}</p></aside>", f'<div class="ad">{LONG}</div>',
          f'<div id="cookie-notice"><p>{LONG}</p><button>Accept</button></div>', f"<form action='/s'><label>Mail</label><input name=m> {LONG}</form>",
          "<script>if (a < b) document.write('<p>no</p>');</script>", "<style>p > b {margin: 0}</style>", f"<!-- <p>{LONG}</p> -->",
          f'<section class="comments"><article class="comment"><p>{LONG}</p></article><div class="comment"><p>{LONG}</p></div></section>',
          f'<div class="sidebar widget"><h2>More</h2><p>{LONG}</p></div>', f"<noscript><p>{LONG}</p></noscript>", f'<div role="complementary"><p>{LONG}</p></div>',
          f'<p style="display: none">{LONG}</p>', "<ul class='breadcrumb'><li>Here</li></ul>", "<template><p>never</p></template>",
          f'<section class="related"><h2>Read on</h2><article><h3>Another</h3><p>{LONG} {LONG}</p></article></section>', f'<div id="header"><p>{LONG}</p></div>',
          f'<div class="alert alert-info">{LONG}</div>']


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", "<div class='page with-sidebar'><article>{}</article></div>", "<div class='menu page'><article>{}</article></div>",
                                  "<div class='post'><div class='post-header'></div>{}</div>", "<div>{}</div>",
                                  "<div class='entry-content'>{}</div>", "<div class=x><div role='main'>{}</div></div>", "{}"])
def test_only_the_article_stays(wrap):
    for part in AROUND:
        for page in (part + wrap.format(BODY), wrap.format(BODY) + part, "".join(AROUND) + wrap.format(BODY) + "".join(reversed(AROUND))):
            assert main_text.main_text(f"<!DOCTYPE html><html><head><title>No {LONG}</title></head><body>{page}</body></html>") == TEXT, (part, wrap)


def test_parts_inside_the_article_go_too():
    for part in AROUND:
        assert main_text.main_text(f"<body><article>{BODY}{part}<p>The last one.</p></article></body>") == TEXT + " The last one.", part
    assert main_text.main_text(f"<article><header><h1>Title</h1><p>by someone</p></header><p>{LONG}</p></article>") == f"Title {LONG}"


def test_unmarked_menus_do_not_surge():
    menu = "<ul>" + "".join(f"<li><a href='/{i}'>Menu entry {i}</a></li>" for i in range(9)) + "</ul>"
    assert main_text.main_text(f"<body>{menu}<div>{BODY}</div>{menu}<div>Imprint</div></body>") == TEXT


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("just text", "just text"), ("<article></article>", ""), ("<p>a &lt; b &amp;amp; &#233;&nbsp;x</p>", "a < b &amp; é x"),
    ("<article><p>one<p>two <b>bo</b>ld<br>x  \n y</article>", "one two bold x y"), ("<article><p>a < b and 3<4</p></article>", "a < b and 3<4"),
    ("<article><p>x<!-- never ends", "x"), ("<article><p title='a > b'>x</p></article>", "x"), ("<article><script>never ends <p>x</p>", ""),
    ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a b c"), ("<ARTICLE><P>Be.</P></ARTICLE>", "Be."), ("<article>\x00 a</article>", "\x00 a")])
def test_pages(page, text):
    assert main_text.main_text(page or "") == text


def test_long_page_in_linear_time():
    assert main_text.main_text("<article>" + "<p>word <b>" * 60000 + "</article>") == " ".join(["word"] * 60000)
    main_text.main_text("<a href=\"" * 20000)
    main_text.main_text("<" * 100000 + "<div " * 20000)


def test_any_text_survives():
    rng = random.Random(3)
    for _ in range(300):
        blocks = [" ".join("".join(rng.choice("ab<>&é'\"") for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(1, 20))) for _ in range(rng.randrange(1, 6))]
        page = f"<nav>{LONG}</nav><article>" + "".join(f"<p>{html.escape(b)}</p>" for b in blocks) + "</article>"
        assert main_text.main_text(page) == " ".join(" ".join(b.split()) for b in blocks)


def test_rows(spark):
    df = spark.createDataFrame([(1, None, "u", 1), (None, "<p>x</p>", None, 2), (1, "<p>x</p>", "u", 3)], "page_id int, html string, url string, text int")
    got = main_text.extract(df, ("page_id", "url"))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in got.collect()) == [("1", "", 0), ("1", "x", 1), ("None", "x", 1)]
    assert main_text.extract(df.limit(0)).collect() == []
    assert main_text.extract(df.withColumnRenamed("page_id", "a.b"), ("a.b",)).columns == ["a.b", "text", "n_chars"]
