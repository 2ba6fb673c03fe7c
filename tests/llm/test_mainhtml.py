import html
import re

from reviewlens.llm.mainhtml import blocks, extract_main, main_text

from .util import clashing, frame

LONG = "The house on the hill was built for the owner of the mill and it is the oldest of the houses in this part of the town. " * 2


def test_article_pages():
    page = (
        "<html><head><title>T</title><script>var t='<p>x</p>';</script><style>p{}</style></head><body>"
        "<header><h1>Site</h1></header><nav><ul><li><a href='/'>Home</a></li></ul></nav><div class='ad'>Buy the thing of the day</div>"
        f"<article><h1>Caf&eacute; &amp; more</h1><p>{LONG}<p>Short.<div class='share'>Share this</div><p>Also <a href='#'>a</a> short &#x41;&lt;b&gt;"
        "<section id='comments'><p>I think that this is the best of the posts</p></section></article>"
        "<aside>Most read: the list of the day</aside><form><label>Name</label><input></form><footer>&copy; all of it</footer></body>"
    )
    assert main_text(page).split("\n\n") == ["Café & more", LONG.strip(), "Short.", "Also a short A<b>"]


def test_pages_without_article():
    page = (
        f"<div id='menu'>One Two</div><div><h2>Heading</h2><p>{LONG}</p><p>Between.</p><p>{LONG}</p></div>"
        "<div><a href='x'>More of the same</a> <a href='y'>And even more</a></div><div class='sidebar'><p>" + LONG + "</p></div>"
    )
    assert main_text(page).split("\n\n") == ["Heading", LONG.strip(), "Between.", LONG.strip()]


def test_names_that_only_seem_to_condemn():
    for page in (
        f'<body class="single no-sidebar"><article><p>{LONG}</p></article>', f'<div class="content has-banner"><p>{LONG}</p></div>',
        f'<article id="copyright-law"><p>{LONG}</p></article>', f'<article><p data-id="search">{LONG}</p></article>',
        f'<article><p title="the hidden garden">{LONG}</p></article>', f'<div id="legal"><p>{LONG}</p><p>{LONG}</p></div><div class="sidebar"><p>The list</p></div>',
    ):
        assert set(main_text(page).split("\n\n")) == {LONG.strip()}, page
    # readers' words stay out, however many there are
    assert main_text(f'<article><p>{LONG}</p></article><div class="comments"><p>{LONG * 5}</p></div>') == LONG.strip()


def test_bad_elements_within_a_line():
    page = f'<article><p>{LONG}<span class="advert">Buy now!</span><span hidden>secret <b>code</b></span> End.</p></article>'
    assert main_text(page) == LONG.strip() + " End."


def test_languages_without_listed_stop_words():
    italian = "Gli alberi del bosco che si vede dalla finestra della casa sono molto alti e ogni anno gli uccelli vi fanno i loro nidi, che si vede dal prato. " * 2
    chinese = "这座城市的图书馆建于一百年前，现在仍然是人们读书和学习的地方，每天有许多学生来到这里查阅资料，准备考试。周末的时候，家长也会带着孩子来听故事，参加各种有趣的活动。" * 2
    menu = "<ul><li><a href='/'>Uno</a><li><a href='/b'>Due</a></ul>"
    for text in (italian, chinese):
        assert main_text(f"<body>{menu}<div><p>{text}</p><p>{text}</p></div></body>") == "\n\n".join([text.strip()] * 2)


def test_broken_markup():
    assert main_text(None) == main_text("") == main_text("<p>") == main_text("<![foo bar]>") == ""
    assert main_text("<article><p>a<b>b</p></i>c") == "ab\n\nc"
    assert main_text(f"<nav><a>x<article><p class=\"a>{LONG}") == LONG.strip()
    assert main_text("<article><p title='unclosed>text < 3 and 4 > 2</article>") != ""
    assert main_text("<article>" + "<div>" * 5000 + "deep text") == "deep text"
    assert main_text("<article><p>a&nbsp;\n\t b<br>c</p><!-- x -->d<!-- open") == "a b c\n\nd"
    assert len(blocks("<p>x" * 20_000)) == 20_000
    assert len(blocks("<b>" * 50_000 + "<i>y</i></u>" * 50_000)) == 1


def test_operator(spark):
    rows = [(1, "u", f"<article>{LONG}</article>"), (2, None, None), (None, "v", ""), (1, "u", f"<article>{LONG}</article>"), (3, "w", "<article>" + LONG * 2000)]
    df = clashing(frame(spark, rows, "page_id long, url string, html string"))
    got = sorted(((str(r.page_id), r.text, r.n_chars) for r in extract_main(df).collect()))
    want = sorted((str(i), t, len(t)) for i, t in [(1, LONG.strip()), (2, ""), (None, ""), (1, LONG.strip()), (3, (LONG * 2000).strip())])
    assert got == want
    assert extract_main(frame(spark, [], "page_id long, url string, html string")).collect() == []


def test_articles_of_the_given_pages(spark):
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)
        parts = re.split(r"</?(?:p|h1)>", article[1])
        want = [" ".join(html.unescape(re.sub(r"</?\w+>", " " , p.replace("<br>", " "))).split()) for p in parts]
        assert main_text(r.html) == "\n\n".join(w for w in want if w)
