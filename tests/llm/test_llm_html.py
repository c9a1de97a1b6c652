"""Main texts against a plain reading of the given pages, and hand-made markup."""

import html
import re

import pytest

from hammerline.llm import html_text
from hammerline.llm.html_text import Page
from hammerline.llm.queries import QUERIES


def plain(source):
    article = re.search(r"<article>(.*?)(?:</article>|\Z)", source, re.S)[1]
    blocks = (html.unescape(re.sub(r"<[^>]*>", " ", part)) for part in re.split(r"</?(?:p|h\d)>", article))
    return "\n".join(b for b in (" ".join(x.split()) for x in blocks) if b)


def test_query_matches_plain_reading(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = QUERIES["op3_main_text"](spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.url == pages[r.page_id].url and r.text == plain(pages[r.page_id].html) and r.n_chars == len(r.text)


CASES = {
    "": "",
    "just text &amp; more": "just text & more",
    "<p>a<p>b <b>c<p>d</b> e": "a\nb c\nd e",
    "<body><nav>menu</nav><main><h1>T</h1> x <br>y<ul><li>one<li>two</ul></main><footer>f</footer>": "T\nx y\none\ntwo",
    "<article><h1>&#233;&eacute;&#x27;&am</h1><p>1 &lt; 2 &nbsp;3</p></article>": "éé'&am\n1 < 2 3",
    "<article><header>by me<h2>Head</h2></header><p>t</p><div class='comments'><p>c</p></div></article>": "Head\nt",
    "<header><h1>Site</h1></header><article><p>t</p><aside>s</aside><form>f</form></article>": "t",
    "<article><script>var a='</p><p>x';</script><p>t<!-- <p>no</p> --></p><style>p{}</style>": "t",
    "<article><p class='lead cookie'>no</p><p>yes</p><div id=ad-1>no</div><p hidden>no</p>": "yes",
    "<article class='post'>short</article><article>a much longer one</article>": "a much longer one",
    "<div class='ad'><article><p>in an advert</p></article></div><main><p>main</p></main>": "main",
    "<article><table><tr><td>a<td>b<tr><td>c</table>1 < 2 <p": "a b\nc\n1 < 2",
    "<article><p title='a > b'>x</p><p title=\"unclosed>y</p><p>z</p>": "x\ny\nz",
    "<div role=navigation>n</div><div class=content><div>a</div>b<div>c</div></div>tail": "a\nb\nc",
    "<div class='page-header'><h1>Site</h1></div><div id=main><p>t</p><div class=header><p>x</p></div></div>": "t",
    "<article class='has-comments'><p class=commentary>t</p><ol class=commentlist><li>c</ol><div id='cookiebar'>k</div></article>": "t",
    "<article class=comment>first!</article><article><p>t</p><article id=comment-3>me too</article></article>": "t",
    "<article><div class='post-header'><h1>T</h1>by</div><p>t</p></article>": "T\nby\nt",
    "<article><p>a\x0b  　b</p></article>": "a b",
}


@pytest.mark.parametrize("source", list(CASES))
def test_markup(source):
    assert Page(source).text() == CASES[source]


LONG = "<p>" + "many words " * 30 + "</p>"
TEXT = " ".join(["many words"] * 30)
NAMED = {
    f"<article><h1>T</h1>{LONG}<section id='related-work'><h2>Related</h2><p>r</p></section>"
    f"<section id=recommendations><p>m</p></section><h2 id='search-algorithms'>S</h2></article>": f"T\n{TEXT}\nRelated\nr\nm\nS",
    "<body><section id='related-work' class='level1'><h1>Related</h1><p>r</p></section><div class=section id=comments><p>c</p></div>": "Related\nr\nc",
    f"<div class='layout has-sidebar'><article>{LONG}</article><div class=sidebar><p>s</p></div></div>": TEXT,
    f"<div class='top-content'>Hi</div><div class='layout sidebar-right'><main>{LONG}<div class='related'><article>tease</article></div></main></div>": TEXT,
    f"<div class='nav'><a href=x>a</a></div><div id='search-page'>{LONG}</div><p>f</p>": f"{TEXT}\nf",
    f"<div class='main-content sidebar-left'>{LONG}</div><div class=promo>buy</div>": TEXT,
    f"<main><h1>T</h1><div class='sidebar-wrap'><div class='widget-wrap'>{LONG}</div></div></main>": f"T\n{TEXT}",
    f"<article><p>my short own text here</p><div id=comments>{'<p>me too</p>' * 9}</div></article>": "my short own text here",
    f"<div class=post>{LONG}</div><div class='related-posts'><article>teaser</article></div>": TEXT,
    f"<article><div class='no-comments with-ads'>{LONG}</div><div class='post-share'>x</div></article>": TEXT,
}


@pytest.mark.parametrize("source", list(NAMED))
def test_names_of_wrappers_states_and_anchors(source):
    assert Page(source).text() == NAMED[source]


def test_many_named_wrappers():
    assert Page("<div class=nav>" * 20_000 + "<article>x</article>").text() == "x"


def test_deep_and_long_pages():
    deep = "<div>" * 30_000 + "x" + "</div>" * 30_000
    assert Page(deep).text() == "x"
    assert len(Page("<article>" + "<p>word &amp; more</p>" * 50_000).text().split("\n")) == 50_000
    assert Page("<p " * 20_000 + "'").text() == ""


def template_pages(spark):
    rows = []
    for i in range(12):
        widget = "<div><p>Read more at our site</p><ul><li>one</li><li>two</li></ul></div>"
        rows.append((i, "https://User@WWW.Host.example:80/a?b", f"<body><div>{widget}</div><p>text {i}</p><p>tail {i}</p></body>"))
        rows.append((300 + i, "https://c.example/", f"<main><p>The same line</p><p>own {i}</p></main><div>Terms</div>"))
        rows.append((100 + i, "https://b.example/x", f"<article><p>The same line</p><div><p>x</p></div><section>By us</section><p>own {i}</p></article>"))
    rows += [(200, None, None), (201, "odd", "<p>The same line</p>"), (201, "odd", "<p>The same line</p>")]
    return spark.createDataFrame([(*r, 1, "t") for r in rows], "page_id long, url string, html string, hash int, text string")


@pytest.mark.parametrize("most_rows", [200_000, 0])
def test_template_goes_per_host(spark, most_rows):
    pages = template_pages(spark)
    got = html_text.main_text(pages, most_rows=most_rows).collect()
    texts = {r.page_id: r.text for r in got}
    assert len(got) == pages.count() and all(r.n_chars == len(r.text) for r in got)
    assert texts[3] == "text 3\ntail 3"
    assert texts[105] == "The same line\nown 5"  # boxes go, plain paragraphs stay
    assert texts[307] == "The same line\nown 7"
    assert texts[200] == "" and texts[201] == "The same line"
    assert html_text.main_text(pages.limit(0), most_rows=most_rows).count() == 0


def test_copies_and_shared_lines_are_no_template(spark):
    entry = "<nav>n</nav><article><div class=entry><p>a</p><ul><li>1 tsp</li></ul><table><tr><td>c</table></div></article>"
    content = "<div><div class=content><p>a</p><div>d</div></div></div><script>{}</script>"
    rows = [(i, "http://copies.example/", entry) for i in range(6)]
    rows += [(10 + i, "http://content.example/", content.format(i)) for i in range(6)]
    for i in range(8):
        body = f"<ul><li>1 tsp salt</li><li>{i}</li></ul><table><tr><td>x<tr><td>{i}</table><dl><dd>y<dd>{i}</dl><div>z{i // 6}</div>"
        rows.append((20 + i, "http://recipes.example/", f"<article><p>{i}</p>{body}<div>Follow us</div><div><p>box</p></div></article>"))
        rows.append((30 + i, "http://copies.example/", f"<article><p>{i}</p></article>"))
        rows.append((40 + i, "http://content.example/", f"<article><p>{i}</p></article>"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for most_rows in (200_000, 0):
        texts = {r.page_id: r.text for r in html_text.main_text(pages, most_rows=most_rows).collect()}
        assert texts[0] == "a\n1 tsp\nc" and texts[10] == "a\nd"
        assert texts[21] == "1\n1 tsp salt\n1\nx\n1\ny\n1"
        assert texts[27] == "7\n1 tsp salt\n7\nx\n7\ny\n7\nz1"


def test_one_of_many_templates_and_inline_boxes(spark):
    rows = []
    for i in range(100):
        box = f"<div><p>box of section {i % 4}</p></div>"
        rows.append((i, "http://hot.example/", f"<article><p>own {i}</p>{box}</article>"))
    for i in range(10):
        inline = "<site-footer>Follow us</site-footer><span>Share</span><a href=x>Tags</a>"
        rows.append((200 + i, "http://inline.example/", f"<body><p>own <b>bold</b> {i}</p><div>more <i>text</i> {i}</div>{inline}</body>"))
        rows.append((300 + i, "http://custom.example/", f"<article><p>own {i}</p>tail {i} <site-footer>Follow us</site-footer></article>"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for most_rows in (200_000, 0):
        texts = {r.page_id: r.text for r in html_text.main_text(pages, most_rows=most_rows).collect()}
        assert texts[7] == "own 7" and texts[203] == "own bold 3\nmore text 3" and texts[304] == "own 4\ntail 4"


def test_hosts(spark):
    urls = ["https://User@WWW.Host.example:80/a", "http://x.org", None, "no url", "ftp://h/"]
    rows = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r[0] for r in rows.select(html_text.host(rows.url)).collect()] == ["www.host.example", "x.org", "", "", "h"]


WATCHED = sorted(html_text.NAMES) + ["comment", "related", "sidebar", "footer", "advert", "newsletter", "hidden"]


def article(inner, rest="<p>And here the article ends.</p>"):
    return f"<body><nav>menu</nav><article><p>First of all.</p>{inner}{rest}</article></body>"


def test_watched_words_in_values_are_no_names():
    for word in WATCHED:
        for tag in (f'title="the {word} cost"', f'data-hidden="{word}"', f"data-id={word}-1", f'data-role="{word}"', f"aria-label='{word} x'",
                    f'data-x="a > b" title="class={word}"', f"alt='id=&quot;{word}&quot;'"):
            assert html_text.Page(article(f"<p {tag}>kept</p>")).text().split("\n") == ["First of all.", "kept", "And here the article ends."], tag
            assert html_text.Page(f"<article {tag}><p>kept</p></article>").text() == "kept", tag
        for url in (f'"/view?id={word}-4"', f"/view?id={word}&class={word}", f"'?role={word}'"):
            page = html_text.Page(article(f"<p>see <a href={url}>this</a> ok</p>"))
            assert "see this ok" in page.text(), url


def test_attributes_are_read_as_browsers_do():
    for tag in ("hidden", 'class=ad class="x"', "CLASS='ad'", "class = ad", 'class="&#97;d"', "title='x'class=ad", "style='display:&#32;none'"):
        assert "gone" not in html_text.Page(article(f"<div {tag}>gone</div>")).text(), tag
    for tag in ('class="x" class=ad', "class='' ad", "data-class=ad"):
        assert "stays" in html_text.Page(article(f"<div {tag}>stays</div>")).text(), tag


def test_doubtful_names_need_a_second_sign_within_an_article():
    prose = "Some running prose of the article that goes on for a while."
    for inner in (f'<p class="social">{prose}</p>', f'<div class="search-history"><p>{prose}</p></div>', f'<div id="alert-levels">{prose}</div>'):
        assert prose in html_text.Page(article(inner)).text(), inner
        assert prose not in html_text.Page(article("<p>" + 9 * "more of it " + "</p>" + inner, rest="")).text(), inner
    for inner in (
        f'<div class="ad">{prose}</div>', f'<p class="advert-box">{prose}</p>', f'<div class="share">{prose}</div>',
        f'<div class="share-this"><a href="/x">{prose}</a></div>', f'<div class="search-box">{prose}<form><input></form></div>',
        f'<div class="comments">{prose}</div>',
    ):
        assert prose not in html_text.Page(article(inner, "<p>" + 9 * "more of it " + "</p>")).text(), inner


def test_headings_of_main_and_parts():
    page = "<main><h1>Title</h1><p>by someone</p><article><p>Text of it.</p></article><article><p>Less.</p></article></main>"
    assert html_text.Page(page).text() == "Title\nText of it."
    assert html_text.Page("<main><h1>Site</h1><article><h1>Own</h1><p>Text.</p></article></main>").text() == "Own\nText."
