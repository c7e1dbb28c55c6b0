import html
import re
import time

import pytest

from quern.llm import html_extraction
from quern.llm.html_extraction import extract

LONG = "A sentence of the article, with commas, words, and some length to it, so that it earns its points. " * 3

CASES = {
    "nothing": ("", ""),
    "no markup": ("plain text only", "plain text only"),
    "unclosed": ("<p>one<p>two", "one\n\ntwo"),
    "references": ("<p>a &amp; b&nbsp;c &lt;d&gt; &eacute; &#233; &copy 1</p>", "a & b c <d> é é © 1"),
    "cut off reference": ("<p>a</p>&am", "a\n\n&am"),
    "white space": ("<p> a \n\t b<br>c </p>", "a b c"),
    "script and style": ("<script>if(a<b) x='<p>no</p>'</script><style>p{}</style><p>x</p>", "x"),
    "comments of the page": ("<!-- <p>no</p> --><p>x</p>", "x"),
    "lists": ("<article><ul><li>a<li>b</ul></article>", "a\n\nb"),
    "tables": ("<table><tr><td>a, b<td>c</table>", "a, b\n\nc"),
    "header of the article": ("<header>Site</header><article><header><h1>T</h1></header><p>x</p></article>", "T\n\nx"),
    "inline markup": ("<p>a <b>b <i>c</i></b>d<a href=x>e</a></p>", "a b cde"),
    "head without end": ("<html><head><title>t</title><body><article><p>one</p></article>", "one"),
    "head without end or body": ("<head><meta charset=x><title>t</title><noscript><img src=x></noscript><p>one</p>", "one"),
    "text after head": ("<head><title>t</title>one", "one"),
    "crossed": ("<p><b>one<p>two</b> three", "one\n\ntwo three"),
}


@pytest.mark.parametrize("name", CASES)
def test_cases(name):
    page, want = CASES[name]
    assert extract(page) == want


@pytest.mark.parametrize(
    "part",
    [
        "<nav><ul><li><a href=1>Home</a></ul></nav>", "<aside><p>{}</p></aside>", "<footer><p>{}</p></footer>", "<header><p>{}</p></header>", "<form><p>{}</p></form>", "<div class='ad'><p>{}</p></div>", "<div id='cookie-notice'><p>{}</p></div>",
        "<section class='comments'><p>{}</p></section>", "<div class='sideBar left'><p>{}</p></div>", "<div role='navigation'><p>{}</p></div>", "<div hidden><p>{}</p></div>", "<ul class=menu><li>{}</ul>", "<div class='related-posts'><p>{}</p></div>",
    ],
)
@pytest.mark.parametrize("shape", ["<body>{a}<article><h1>T</h1>{b}</article>{a}</body>", "<body>{a}<div id=content><h1>T</h1>{b}{a}</div></body>", "<body><div class=wrap><div>{a}</div><div class=post>{b}</div>{a}</div></body>"])
def test_what_is_not_the_article_goes(part, shape):
    body = f"<p>{LONG}</p><p>{LONG}</p><p>short</p>"
    got = extract(shape.format(a=part.format("Other words, " * 30), b=body))
    assert "Other" not in got and "Home" not in got
    assert got.endswith("\n\n".join([LONG.strip()] * 2 + ["short"]))


SIDE = "<div class=sidebar><p>Other words, other words.</p></div>"


@pytest.mark.parametrize("wrapper", ["<div class=has-sidebar>{}</div>", "<div class='with-sidebar'>{}</div>", "<section id=social-science>{}</section>", "<form action=x><input type=hidden name=state><select><option>No</select>{}<button>Go</button></form>", "<form><div class='page with-sidebar'>{}</div></form>", "<div role=dialog>{}</div>", "<div class='post comments-open'>{}</div>"])
@pytest.mark.parametrize("body", ["<article>{}</article>", "<main>{}</main>", "<div>{}</div>"])
def test_wrappers_round_the_article_are_spared(wrapper, body):
    text = f"<h1>T</h1><p>{LONG}</p><p>{LONG}</p><p>short</p>"
    got = extract("<body><nav>Home</nav>" + wrapper.format(body.format(text) + SIDE) + "<footer><p>Other</p></footer></body>")
    assert got == "\n\n".join(["T", LONG.strip(), LONG.strip(), "short"])


def test_a_wrapper_is_spared_beside_a_teaser_article():
    page = f"<article><p>Teaser, short.</p></article><div class=has-sidebar><article><p>{LONG}</p><p>{LONG}</p></article></div>"
    assert LONG.strip() in extract(page)


@pytest.mark.parametrize("shape", ["<article>{a}</article><div class=comments>{c}</div>", "<div>{a}</div><section class=comments>{c}</section>", "<main>{a}<div class=comments>{c}</div></main>"])
@pytest.mark.parametrize("comment", ["<p>Other words, " + LONG + "</p>", "<article class=comment-body><p>Other words, " + LONG + "</p></article>"])
def test_many_comments_stay_cut(shape, comment):
    got = extract(shape.format(a=f"<p>{LONG}</p>", c=comment * 20))
    assert got == LONG.strip()


def test_related_articles_stay_cut():
    related = "<div class=related>" + "<article><p>Other words, short.</p></article>" * 3 + "</div>"
    for tag in ("article", "div"):
        assert extract(f"<{tag}><p>{LONG}</p><p>{LONG}</p></{tag}>{related}") == "\n\n".join([LONG.strip()] * 2)


def test_a_main_in_a_wrapper_is_spared_beside_much_text():
    page = f"<div><p>{LONG}</p></div><form><main><p>Main, and longer. {LONG}</p><p>{LONG}</p></main></form>"
    assert "Main, and longer." in extract(page)


@pytest.mark.parametrize("tag", ["article", "main"])
def test_scores_pick_the_container_whatever_the_tag(tag):
    story = "".join(f"<div>{LONG}</div>" for _ in range(5))
    assert extract(f"<{tag}><p>A teaser, of one line.</p></{tag}><div><div>{story}</div></div>").count(LONG.strip()) == 5


@pytest.mark.parametrize("wrapper", ["content has-sidebar", "main-content no-banner", "post-with-comments", "page with-menu", "share-worthy", "ad-free story"])
@pytest.mark.parametrize("inner", ["article", "div"])
def test_wrappers_named_for_what_they_lack_or_have(wrapper, inner):
    assert LONG.strip() in extract(f'<body><div class="{wrapper}"><{inner}><p>{LONG}</p><p>{LONG}</p></{inner}></div></body>')


@pytest.mark.parametrize("page", ["<b>" * 100_000 + "</i>" * 100_000, "<li><ul>" + "<b>" * 100_000 + "<li></li>" * 100_000, "<b>" * 100_000 + "<div></div>" * 100_000, "<a " * 100_000, "<!--" * 100_000, '<a href="' * 100_000])
def test_time_is_linear(page):
    began = time.process_time()
    extract(f"<p>{LONG}</p>{page}")
    assert time.process_time() - began < 10  # some hundred times as much where time is quadratic


def test_cut_off_markup():
    assert extract("<p>One, two.</p><!-- open <p>gone</p>") == "One, two."
    assert extract("<p>One, two.</p><p>1 < 2") == "One, two.\n\n1 < 2"
    assert extract('<p>One, two.</p><a href="x') == "One, two."


def test_link_lists_do_not_win():
    links = "<div>" + "".join(f"<p><a href={i}>{LONG}</a></p>" for i in range(9)) + "</div>"
    assert extract(f"<body>{links}<div><p>{LONG}</p><p>{LONG}</p></div></body>") == f"{LONG.strip()}\n\n{LONG.strip()}"


def test_siblings_that_score_well_are_kept():
    page = f"<body><div><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div><div><p>{LONG}</p><p>{LONG}</p></div><p>{LONG}</p></body>"
    assert extract(page).count(LONG.strip()) == 6


@pytest.mark.parametrize("page", ["<div>" * 3000 + "deep" + "</div>" * 3000, "<" * 10_000, "<p" * 5000, "&" * 10_000, "</p>" * 5000, "<a href='" + "x" * 100_000, "<p>" + "w " * 300_000])
def test_strange_pages_end(page):
    extract(page)


PARAGRAPHS = "".join(f"<p>{i} {LONG}</p>" for i in range(8))
WANTED = [f"{i} {LONG}".strip() for i in range(8)]
#: Bodies of an article and their blocks, as written by hand.
BODIES = {
    "a short last section": ("<h1>Title</h1><section>" + PARAGRAPHS + "</section><section><h2>Closing</h2><p>A short closing remark.</p></section>", ["Title", *WANTED, "Closing", "A short closing remark."]),
    "list and quote beside": ("<h1>Title</h1><div>" + PARAGRAPHS + "</div><ul><li>First point<li>Second point</ul><blockquote>So it was.</blockquote>", ["Title", *WANTED, "First point", "Second point", "So it was."]),
    "table and late heading": ("<div>" + PARAGRAPHS + "</div><table><tr><td>1<td>2</table><h2>Late heading</h2><p>Short last.</p>", [*WANTED, "1", "2", "Late heading", "Short last."]),
    "text of the article itself": ("Lead in.<div>" + PARAGRAPHS + "</div>The end.", ["Lead in.", *WANTED, "The end."]),
    "a heading that is a link": ("<h1><a href=x>Title</a></h1><div>" + PARAGRAPHS + "</div><p><a href=y>More of it</a></p>", ["Title", *WANTED, "More of it"]),
    "nested sections": ("<section><h2>One</h2><div>" + PARAGRAPHS + "</div></section><section><h2>Two</h2><div><div><p>Deep.</p></div></div></section>", ["One", *WANTED, "Two", "Deep."]),
    "names with a listed word": ("<div>" + PARAGRAPHS + "</div><div id='social-security'><p>Pensions.</p></div><div class='banner-history'><p>Flags of old.</p></div>", [*WANTED, "Pensions.", "Flags of old."]),
    "articles within": ("<article><h2>One</h2>" + PARAGRAPHS + "</article><article><h2>Two</h2><p>Short.</p></article>", ["One", *WANTED, "Two", "Short."]),
    "links, adverts and notices go": ("<div>" + PARAGRAPHS + "</div><ul><li><a href=1>Link one</a><li><a href=2>Link two</a></ul><div class='ad-slot'><p>Buy, now.</p></div><div class='cookie-notice'><p>We use them, all.</p></div>", WANTED),
}


@pytest.mark.parametrize("name", BODIES)
@pytest.mark.parametrize("shape", ["<body><nav>Home</nav><article>{}</article><footer>x</footer></body>", "<body><main>{}</main><div>Copyright of this site.</div></body>", "<html><head><title>t</title><body><div><article>{}</article><aside>x</aside></div>"])
def test_whole_articles_are_kept(name, shape):
    body, want = BODIES[name]
    if name == "articles within" and "main" in shape:  # articles side by side in a main are judged one by one
        want = want[: WANTED.index(WANTED[-1]) + 2]
    assert extract(shape.format(body)) == "\n\n".join(want)


@pytest.mark.parametrize("name", ["a short last section", "list and quote beside", "table and late heading", "nested sections"])
def test_a_plain_container_widens_below_the_body(name):
    body, want = BODIES[name]
    assert extract(f"<body><div>Site</div><div id=content>{body}</div><div>Copyright of this site.</div></body>") == "\n\n".join(want)


@pytest.mark.parametrize("name", ["social-security", "banner-history", "promoWeek", "share-prices"])
def test_a_weak_name_in_a_plain_container(name):
    page = f"<body><div><p>{LONG}</p><p>{LONG}</p><div id='{name}'><p>Inside. {LONG}</p></div></div></body>"
    assert "Inside." in extract(page)


def test_a_page_wrapper_with_menus_is_not_the_article():
    menu = "<ul><li><a href=1>Home</a><li><a href=2>News</a></ul>"
    assert extract(f"<body><div>{menu}<div>{PARAGRAPHS}</div><div>Copyright of this site.</div></div></body>") == "\n\n".join(WANTED)


def brute(page):
    """The text between the article's tags, of pages with h1, p, b and br alone."""
    at = page.index("<article>") + 9
    end = page.find("</article>")
    body = page[at : end if end >= 0 else len(page)].replace("<br>", " ")
    blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", body))
    return "\n\n".join(b for b in blocks if b)


def test_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").selectExpr("*", "url AS text", "page_id AS n_chars")
    extra = spark.createDataFrame([(None, None, None, None, None), (1, "u", "", "x", 1)], pages.schema)
    got = html_extraction.extract_pages(pages.unionByName(extra)).collect()
    assert sorted((r.text for r in got), key=str) == sorted([*(brute(r.html) for r in pages.collect()), "", ""], key=str)
    assert all(r.n_chars == len(r.text) for r in got)
    assert html_extraction.extract_pages(pages.limit(0)).count() == 0
