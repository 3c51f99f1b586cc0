"""Names, forms and unclosed elements that stand around a page's content."""

import pytest

from paceline.llm.html_extraction import Page, extract_text

BODY = "<p>" + "one long sentence of the story " * 8 + "</p><p>" + "and one more of them " * 8 + "</p>"
TEXT = ("one long sentence of the story " * 8).strip() + "\n" + ("and one more of them " * 8).strip()
SIDE = "<div class='sidebar'><p>links and more links</p></div><div id='comments'><p>me too</p></div><div class='site-footer'>c</div>"


def found(source: str) -> str:
    page = Page(source)
    return page.text(page.best()) if page.best() else "\n".join(t for _, t in page.blocks)


@pytest.mark.parametrize("name", ["site has-sidebar", "no-sidebar", "content-with-sidebar", "search-results", "post comments-open", "promo", "page sidebar"])
@pytest.mark.parametrize("content", ["<article>{}</article>", "<main>{}</main>", "<div class='text'>{}</div>"])
def test_wrappers_keep_the_content(name, content):
    inner = content.format(BODY)
    assert found(f"<body><div class='{name}'>{inner}{SIDE}</div></body>") == TEXT
    assert found(f"<body><nav>menu</nav><form action='/x'>{inner}{SIDE}</form></body>") == TEXT


def test_boilerplate_is_still_dropped():
    cards = "<div class='related-posts'>" + "<article><p>another story</p></article>" * 3 + "</div>"
    notes = "<ol class='comment-list comments'>" + "<li><article><p>" + "me too " * 9 + "</p></article></li>" * 3 + "</ol>"
    page = Page(f"<body><div class='text'>{BODY}</div>{cards}{notes}{SIDE}<form><p>mail</p></form></body>")
    assert [t for _, t in page.blocks] == TEXT.split("\n")


@pytest.mark.parametrize("tag", ["button", "select", "object", "svg", "math", "noscript"])
def test_unclosed_elements_end_nothing(tag):
    assert TEXT in found(f"<body><article><{tag}>{BODY}</article></body>")


def test_unclosed_button_before_another():
    assert TEXT in found(f"<body><article><button>x{BODY}<button>y</button></article></body>")
    assert found(f"<body><article>{BODY}<script>x</article>") == TEXT and Page("<button>" * 20000).blocks == []


def test_math_is_text(spark):
    source = "<article><p>so <math><mi>E</mi><mo>=</mo><mi>m</mi><annotation encoding='tex'>E=m</annotation></math> holds</p></article>"
    assert extract_text(spark.createDataFrame([(1, "http://h/", source)], "page_id long, url string, html string")).first().text == "so E=m holds"


LONG = "<p>" + "what a reader thinks of it all " * 60 + "</p>"
SHORT = "<h1>Title</h1><p>A short story.</p><p>Of two paragraphs.</p>"
KEPT = "Title\nA short story.\nOf two paragraphs."


@pytest.mark.parametrize("name", ["comment-list", "user-comments", "comments", "post-comments", "replies", "disqus_thread", "comment-list social"])
@pytest.mark.parametrize("page", ["<article>{0}{1}</article>", "<div class='post-body'>{0}</div>{1}", "<article>{0}</article>{1}", "<div class='text'>{0}{1}</div>", "<main>{0}</main>{1}"])
def test_comments_are_dropped_however_long(name, page):
    for inner in (LONG * 3, f"<ol><li><article>{LONG}{LONG}</article></li></ol>", f"<article>{LONG}</article>", f"<form>{LONG}</form>"):
        for tag in ("div", "section", "ol"):
            assert found(f"<body>{page.format(SHORT, f'<{tag} class={name!r}>{inner}</{tag}>')}</body>") == KEPT


@pytest.mark.parametrize("name", ["social science", "related research", "search methods", "reply", "banner story", "menu", "notice"])
def test_words_of_two_meanings_keep_content(name):
    body = "<h2>Part</h2><p>" + "long text of the page " * 9 + "</p><p>" + "and more of it " * 9 + "</p>"
    text = "Part\n" + ("long text of the page " * 9).strip() + "\n" + ("and more of it " * 9).strip()
    assert found(f"<body><p>short</p><div class='{name}'>{body}</div></body>").endswith(text)
    assert found(f"<body><article><p>short</p><div class='{name}'>{body}</div></article></body>") == "short\n" + text


@pytest.mark.parametrize("side", ["<div class='social'><a href='/f'>share on f</a> <a href='/t'>share on t</a></div>", "<div class='related'><h3>Also</h3><p><a href='/1'>one more story of the day</a></p><p><a href='/2'>and another one</a></p></div>", "<div class='notice'>We keep cookies.</div>", "<div class='banner'><p>Buy this now.</p></div>", "<div class='share-bar'><p>a</p><p>b</p></div>", "<div class='ad'>" + LONG + "</div>", "<div class='cookie-notice'><h2>Cookies</h2>" + LONG * 2 + "</div>", "<div class='sidebar left'>" + LONG + "</div>", "<div class='related-posts'><h3>More</h3>" + LONG * 2 + "</div>"])
def test_boilerplate_of_any_length_is_dropped(side):
    for page in (f"<article>{SHORT}</article>{side}", f"{side}<article>{SHORT}</article>", f"<div class='text'>{SHORT}</div>{side}", f"<article>{SHORT}{side}</article>"):
        assert found(f"<body>{page}</body>") == KEPT


@pytest.mark.parametrize("wrap", ["<form action='/'>{}</form>", "<div class='promo-page'>{}</div>", "<div class='widget-area menu'>{}</div>"])
def test_wrappers_with_text_beside_them_keep_the_title_and_its_text(wrap):
    assert KEPT in found(f"<body>{wrap.format(f'<div class=text>{SHORT}</div>')}<div class='legal'>All rights reserved.</div></body>")


def test_host_vote_overrules_a_page(spark):
    body = lambda i: f"<div class='story'><h1>T{i}</h1><p>" + f"story {i} of the host " * 8 + "</p></div>"
    side = "<div class='extra'><p>" + "a long extra that is no story " * 30 + "</p></div>"
    rows = [(i, "http://h/x", f"<body>{body(i)}</body>") for i in range(6)] + [(9, "http://h/y", f"<body>{body(9)}{side}</body>"), (10, "http://other/y", f"<body>{body(10)}{side}</body>")]
    out = {r.page_id: r.text for r in extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out[9] == "T9\n" + ("story 9 of the host " * 8).strip() and out[10].startswith("a long extra")
