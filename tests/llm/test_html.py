import math
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from motolake.llm import html

ARTICLE = "<p>" + "</p><p>".join(f"Paragraph {i} of the story goes on for quite a while, as stories do." for i in range(5)) + "</p>"
TEXT = " ".join(f"Paragraph {i} of the story goes on for quite a while, as stories do." for i in range(5))


@pytest.mark.parametrize(
    "around",
    [
        "<html><head><title>t</title><style>p{}</style></head><body><nav><ul><li><a href=/>home</a></li></ul></nav><article>%s</article><footer>&copy; x</footer></body></html>",
        "<body><header><h1>Site</h1></header><div id='main'>%s</div><div class=\"sidebar-left\"><p>side text here</p></div></body>",
        "<body><div class='cookie-notice'>We use cookies</div><main>%s<aside>more</aside></main><form><p>Your mail</p><input></form></body>",
        "<div class=ad>Buy this now, it is very cheap and very good, really</div><div>%s</div><script>var a='</p>';</script>",
        "<article>%s</article><section class='comments'><p>First! I am a reader and this is a comment about it.</p></section>",
        "<div role=navigation><a href=a>a</a></div>%s<ul><li><a href=x>one link</a><li><a href=y>two link</a></ul>",
        "<!-- <p>no</p> --><div><div><div>%s</div></div></div><div hidden>unseen</div>",
    ],
)
def test_the_article_alone(around):
    assert html.extract(around % ARTICLE) == TEXT


def test_blocks_references_and_spaces():
    page = "<article><h1>A &amp; B</h1><p>x<b>y</b>z&nbsp; &#233;\n\t&lt;tag&gt;<br>next</p><p><i>one<p>two<table><tr><td>c1<td>c2<tr><td>c3</table><pre>a  b</pre></article>"
    assert html.extract(page) == "A & B xyz é <tag> next one two c1 c2 c3 a b"


def test_quoted_brackets_and_raw_text():
    assert html.extract("<article><p title='a>b' data-x=\"<p>\">q</p><script>if (a < b) { '</div>' }</script><p>r</p></article>") == "q r"


def test_long_and_deep_pages():
    assert len(html.extract("<article>" + "<p>word word</p>" * 50_000 + "</article>")) == 10 * 50_000 - 1
    assert html.extract("<div>" * 5000 + "text" + "</div>" * 5000) == "text"


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="<>/abp \"'=!-&;#x1", max_size=80))
def test_any_markup_is_read(page):
    out = html.extract(page)
    assert out == " ".join(out.split())


def test_table(spark):
    rows = [(1, "u", "<article><p>é x</p></article>"), (2, "u", None), (3, None, ""), (3, None, "<nav>n</nav>"), (None, "u", "<p>k</p>")]
    df = spark.createDataFrame([(*r, "clash", 5) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    out = [(r["page_id"], r["text"], r["n_chars"]) for r in html.extract_pages(df).collect()]
    assert sorted(out, key=str) == sorted([(1, "é x", 3), (2, "", 0), (3, "", 0), (3, "", 0), (None, "k", 1)], key=str)
    assert html.extract_pages(df.limit(0)).count() == 0


def test_density_prefers_text_over_links():
    root, _ = html.parse("<div><a href=x>link text link text</a></div><div>plain text plain text plain text</div>")
    order = html.measure(root)
    links, plain = [n for n in order if n.tag == "div"]
    assert plain.density > links.density


@pytest.mark.parametrize(
    "around",
    [
        "<body><div class='page has-sidebar'><article>%s</article><div class=sidebar>side text</div></div></body>",
        "<body><div class='no-sidebar'><main>%s</main></div></body>",
        "<body><div class='layout-sidebar-right'><div><article>%s</article></div></div><div class=widget>more</div></body>",
        "<body><div id='search-page'><article>%s</article></div></body>",
        "<body><div class='social notice'>%s</div><p class=share>share it</p></body>",
        "<body><div class='with-comments'><article>%s</article><div class=comments><article><p>First! I am a reader.</p></article></div></div></body>",
        "<body><article>%s</article><div class=comments>" + "<article><p>First! I am a reader and this is a comment about it all.</p></article>" * 20 + "</div></body>",
        "<body><article>%s</article><div class=related><article><p>Another story.</p></article></div></body>",
    ],
)
def test_class_words_of_wrappers_drop_no_article(around):
    assert html.extract(around % ARTICLE) == TEXT


def test_many_suspects_take_no_long_time():
    assert html.extract("<div class=widget>" * 3000 + "<article>text</article>") == "text"
    assert html.extract("<p>text of the page, which is long</p>" + "<div class=ad>a</div>" * 50_000).startswith("text")


@pytest.mark.parametrize(
    "page, text",
    [
        ("<html><body>Plain text.</body></html>", "Plain text."),
        ("<html><body><h1>Title</h1>First line of the text.<br>Second line of the text.<br>Third <b>bold</b> line.</body></html>", "Title First line of the text. Second line of the text. Third bold line."),
        ("<html>No body here, but text.</html>", "No body here, but text."),
        ("<body><main><h1>T</h1><article>A</article><article>B</article></main></body>", "T A B"),
        ("<body><main><h1>T</h1>" + f"<article>{ARTICLE}</article>" * 2 + "<ul><li><a href=x>one link</a><li><a href=y>two link</a></ul></main></body>", f"T {TEXT} {TEXT}"),
        (f"<body><article>{ARTICLE}</article><nav>n</nav><article>{ARTICLE}</article></body>", f"{TEXT} {TEXT}"),
        (f"<body>Words before the story, in the body itself, are of the page too.<div>{ARTICLE}</div></body>", f"Words before the story, in the body itself, are of the page too. {TEXT}"),
    ],
)
def test_no_main_text_is_lost(page, text):
    assert html.extract(page) == text


PROSE = "Long prose of the story that goes on and on, sentence after sentence, as a story does when it is told."
#: Pages whose parts no tag, role, class or id tells apart.
BARE = [
    f"<body><div>Buy now!</div><div>{f'<p>{PROSE}</p>' * 6}</div><div>All rights are reserved.</div></body>",
    f"<body><div><a href=a>one</a> <a href=b>two</a> <a href=c>three</a></div><div><div><h2>Head</h2>{f'<p>{PROSE}</p>' * 4}</div><div><a href=x>Read</a> or <a href=y>leave</a></div></div></body>",
    f"<body><div><p>Sign in</p><p>Help</p><p>Terms</p></div><table><tr><td><div>{f'<p>{PROSE} <b>bold</b></p>' * 5}</div></td><td><p>Top</p><p>New</p></td></tr></table></body>",
    f"<body><div><div>{f'<p>{PROSE}</p>' * 5}</div><div>{f'<p>{PROSE}</p>' * 2}</div></div><div>By the editors</div></body>",
]
KEPT = [" ".join([PROSE] * 6), " ".join(["Head", *[PROSE] * 4]), " ".join([PROSE + " bold"] * 5), " ".join([PROSE] * 7)]


@pytest.mark.parametrize("page, text", list(zip(BARE, KEPT, strict=True)))
def test_densities_alone_find_the_text(page, text):
    assert html.extract(page) == text


@pytest.mark.parametrize("other", [lambda n: 0.0, lambda n: 1.0, lambda n: float(n.chars), lambda n: -n.density])
def test_other_values_in_place_of_densities_give_other_texts(monkeypatch, other):
    measure = html.measure

    def replaced(root):
        order = measure(root)
        for node, value in [(n, other(n)) for n in order]:
            node.density = value
        return order

    monkeypatch.setattr(html, "measure", replaced)
    assert [html.extract(p) for p in BARE] != KEPT


def test_densities_are_those_of_the_formula():
    page = "<body><div>some words <a href=x>a link</a><p>more words here</p></div><p>the last words</p></body>"
    root, _ = html.parse(page)
    nodes = {(n.tag, n.chars): n for n in html.measure(root)}
    body, div = nodes["body", 39], nodes["div", 27]

    def density(c, t, lc, lt, whole):
        lc, lt = max(lc, 1), max(lt, 1)
        base = math.log(c / max(c - lc if lc > 1 else c, 1) * lc + whole[1] / whole[0] * c + math.e)
        return c / max(t, 1) * math.log(c / lc * max(t, 1) / lt) / math.log(base)

    assert (body.tags, div.tags, div.link_chars, div.link_tags) == (5, 3, 5, 1)
    assert div.density == pytest.approx(density(27, 3, 5, 1, (39, 5)))
    assert body.density == pytest.approx(density(39, 5, 5, 1, (39, 5)))
    assert nodes["p", 13].density == pytest.approx(density(13, 0, 0, 0, (39, 5)))


@pytest.mark.parametrize("page", ["<a " * 40_000, "<a " * 40_000 + "<!-- ", "<div>" * 16_000 + "x", "<div>" * 16_000 + "</span>" * 16_000, "<p><button>" + "<div>" * 16_000, "<table>" * 8000 + "</p>" * 8000, "<article><p>some words</p>" * 8000, "<div>" * 8000 + "<header></header>" * 8000])
def test_time_grows_with_the_length(page):
    began = time.perf_counter()
    html.extract(page)
    assert time.perf_counter() - began < 3
