import pytest
from helpers import CLASH, CLASHING

from noticelens.llm import extract

STORY = (
    "It is the story of a man who was in the city for a long time and had not been seen by any of his "
    "friends, and so it is that they were looking for him in all of the houses on the road."
)
CASES = {
    "": "",
    "plain text &amp; more\n  x": "plain text & more x",
    "<p>Hello</p>": "Hello",
    "<p>a<!-- no end": "a",
    "<p>a</p><script>no end <p>b</p>": "a",
    "<P>One<BR>two<br/>three&nbsp;<b>f</b>our &lt;5&gt; &eacute;&#233;</P>": "One two three four <5> éé",
    '<p title="a>b">x</p><p>y': "x\n\ny",
    "3 < 4 and 5 > 2": "3 < 4 and 5 > 2",
    "<html><head><title>t</title><style>p{}</style></head><body><article><h1>T</h1><p>x</article></body>": "T\n\nx",
    "<title>t</title><nav><ul><li><a>Home</a></ul></nav><header><h1>Site</h1></header><main><p>Short.</p>"
    "<form><p>Name</p><input></form><p>More.</p></main><aside><p>Side</p></aside><footer>&copy;</footer>": "Short.\n\nMore.",
    "<article><header><h1>T</h1></header><p>One <button>Click</button>two</p><div class='cookie-notice'>c</div>"
    "<div id=ad-1>buy</div><ul><li><a>link only</a></li><li>point</li></ul><section class='comments'><p>c</p>"
    "</section></article><p>out</p>": "T\n\nOne two\n\npoint",
    '<div id="header"><h1>Site</h1><ul class="menu"><li><a>Home</a></ul></div><div id="content"><h2>Title</h2>'
    f'<p>{STORY}</p><p>Short one.</p><p>{STORY}</p></div><div class="commentList"><p>{STORY}</p></div>'
    '<div id="sidebar"><p>Popular</p></div>': f"Title\n\n{STORY}\n\nShort one.\n\n{STORY}",
    f"<div><a>One</a> <a>two</a></div><p>{STORY}</p><p>Tiny.</p><p>{STORY}</p><div><a>Three</a></div><p>End</p>"
    "<div><a>Four</a></div>": f"{STORY}\n\nTiny.\n\n{STORY}",
    "<nav><p>a</nav></div></nav><p hidden>h</p><div style='display: none'>n</div><p>ok</p>": "",
}


@pytest.mark.parametrize("page", CASES)
def test_main_text(page):
    assert extract.main_text(page) == CASES[page]


def test_all_pages_of_the_table(spark):
    """Every page of the table has one article; its blocks come out, and nothing else."""
    import html
    import re

    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in extract.extract(rows).collect()}
    assert len(got) == rows.count()
    for row in rows.collect():
        article = re.search("(?s)<article>(.*?)</article>", row.html)[1]
        parts = [re.sub("<[^>]+>", " ", p) for p in re.split("</?(?:p|h1)>", article)]
        parts = [" ".join(html.unescape(p).split()) for p in parts]
        text = "\n\n".join(p for p in parts if p)
        assert (got[row.page_id].text, got[row.page_id].n_chars, got[row.page_id].url) == (text, len(text), row.url)


def test_undecided_blocks_take_the_nearest_label():
    def block(text, heading=False):
        return extract.Block(text, 0.0, False, 0, heading, False)

    blocks = [block("x"), block("x"), block("x" * 100), block("x"), block("x", True), block("x")]
    assert extract.second_pass(blocks, [None] * 6) == [True] * 6
    assert extract.second_pass(blocks, [True, None, None, None, None, False]) == [True, True, True, False, False, False]
    assert extract.second_pass(blocks, [True, None, None, None, False, None])[2] is True
    assert extract.second_pass(blocks, [False, None, None, None, None, True])[4] is True


def test_broken_pages_end_soon():
    for page in ('<a "' * 20000, "<div>" * 50000 + "x", "<" * 200000, "<!--" * 50000, "<script>" * 20000):
        extract.main_text(page)


def test_frame(spark):
    rows = [(n, "u", page, *CLASH) for n, page in enumerate(CASES)]
    rows += [(100, None, None, *CLASH), (None, "u", "<p>x" + " y" * 200_000, *CLASH), (0, "u", "", *CLASH)]
    df = spark.createDataFrame(rows, f"page_id long, url string, html string, {CLASHING}")
    got = extract.extract(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    found = sorted((str((r.page_id, r.url, r.text)) for r in got.collect()))
    assert found == sorted(str((i, u, extract.main_text(p or ""))) for i, u, p, *_ in rows)
    assert extract.extract(df.limit(0)).count() == 0


MENU = "<nav><a href=/>Home</a></nav><div><a href=/a>One</a> <a href=/b>two</a></div>"
RUSSIAN = "Это рассказ о человеке, который долгое время жил в городе и которого давно не видел никто из друзей."
VERSE = [f"Short line number {n}, said she," for n in range(12)]


@pytest.mark.parametrize(
    "lines",
    [["Заголовок", RUSSIAN, "Да.", RUSSIAN], ["这是一个故事。" * 12], VERSE, ["0x1f 17 42 " * 12] * 5, [STORY, *["17 42 99 " * 12] * 9]],
)
def test_text_beside_menus_only(lines):
    page = MENU + "".join(f"<p>{x}</p>" for x in lines) + "<footer>foot</footer>"
    assert extract.main_text(page) == "\n\n".join(x.strip() for x in lines)


def test_heading_before_links_stays_with_them():
    page = MENU + "".join(f"<p>{x}</p>" for x in VERSE) + "<h3>Related</h3><div><a>Else</a></div>"
    assert extract.main_text(page) == "\n\n".join(VERSE)


@pytest.mark.parametrize("name", ["has-sidebar", "content-with-sidebar", "navbar-fixed", "no-ads", "sidebar", "page comments"])
@pytest.mark.parametrize("body", ["<article>{}</article>", "<div>{}</div>", "<main>{}</main>", "<div id=content>{}</div>"])
def test_page_wrappers_with_bad_words(name, body):
    text = body.format(f"<h1>Title</h1><p>{STORY}</p><p>{RUSSIAN}</p>")
    page = f"<body><div class='{name}'>{MENU}{text}<div class=widget><p>Side</p></div></div><footer>f</footer></body>"
    assert extract.main_text(page) == f"Title\n\n{STORY}\n\n{RUSSIAN}"


def test_small_regions_decide_nothing_outside():
    card = "<article class='card'><p>Read this too</p></article>"
    assert extract.main_text(f"<main><p>{STORY}</p>{card}<p>{RUSSIAN}</p></main>") == f"{STORY}\n\nRead this too\n\n{RUSSIAN}"
    for text in (STORY, RUSSIAN):
        page = f"{MENU}<div class='post-date'>May 1</div><div><p>{text}</p><p>{text}</p></div><footer>f</footer>"
        assert f"{text}\n\n{text}" in extract.main_text(page)
        assert f"{text}\n\n{text}" in extract.main_text(f"{MENU}{card}<div><p>{text}</p><p>{text}</p></div>")


def test_bad_parts_stay_bad_beside_an_article():
    page = f"<article><p>{STORY}</p></article><div class='related'><article>{RUSSIAN}</article></div>"
    assert extract.main_text(page + f"<div class=comments><p>{STORY * 9}</p></div>") == STORY


SENTENCE = "The old mill by the river was sold to the town in the spring of that year, and it is to be a museum. "


@pytest.mark.parametrize("name", ["comments", "related", "cookie-consent", "sidebar", "ads", "newsletter", "discussion"])
def test_what_stands_beside_a_short_post_is_never_the_post(name):
    """However long it is, on a page without article or main."""
    page = f'<body><div class="post"><p>{SENTENCE}</p></div><div class="{name}"><p>{SENTENCE * 3}</p><p>{SENTENCE * 4}</p></div></body>'
    assert extract.main_text(page) == SENTENCE.strip()
    nested = page.replace("<p>", "<article><p>").replace("</p>", "</p></article>").replace('post"><article>', 'post">', 1)
    assert SENTENCE * 3 not in extract.main_text(nested)
    alone = f'<body><p>{SENTENCE}</p><div class="{name}"><p>{SENTENCE * 5}</p></div></body>'
    assert extract.main_text(alone) == SENTENCE.strip()


def test_a_wrapper_around_everything_is_cleared():
    page = f'<body><div class="widget overlay"><h1>Title</h1><p>{SENTENCE}</p><p>{SENTENCE}</p></div></body>'
    assert extract.main_text(page) == "\n\n".join(["Title", SENTENCE.strip(), SENTENCE.strip()])
