import pytest

from reviewlens.operators import clean
from reviewlens.operators.extract import explode_blocks, parse, pick, refused_pages, step
from reviewlens.plans import catalogue

ITEM = (
    '<div class="item"><em>1</em><a href="u"><span class="title">T</span><span class="other"> / O</span></a>'
    '<span class="rating_num">9.7</span><span>1,234人评价</span><p class="quote"><span>Q</span></p></div>'
)


@pytest.fixture
def movies(spark):
    def run(*pages):
        df = spark.createDataFrame([(i, f"http://h/{i}", h) for i, h in enumerate(pages)], "page_id long, url string, html string")
        return catalogue.parse_movies(df).orderBy("page_id", "position").collect()

    return run


def test_item(movies):
    (m,) = movies(ITEM)
    assert (m.rank_num, m.title, m.rating, m.comment_num, m.quote, m.detail_url) == (1, "T O", 9.7, 1234, "Q", "u")
    assert m.reject_reason is None and m.poster_name == "T O.jpg"


def test_two_blocks_and_none(movies):
    got = movies(ITEM + ITEM.replace("<em>1", "<em>2"), "<p>nothing</p>", None)
    assert [(m.page_id, m.rank_num) for m in got] == [(0, 1), (0, 2)]


def test_no_blocks_at_all(movies):
    assert movies("<p>nothing</p>", "") == []


def test_quote_variants(movies):
    bare = ITEM.replace("<span>Q</span>", "“Quoted” text\"")
    none = ITEM.replace('<p class="quote"><span>Q</span></p>', "")
    blank = ITEM.replace("<span>Q</span>", "<span> </span>")
    assert [m.quote for m in movies(bare, none, blank)] == ["Quoted” text", "无经典台词", "无经典台词"]


def test_rejects(movies, spark):
    got = movies(ITEM.replace("9.7", "9.7.1"), ITEM.replace("<em>1", "<em>x"), ITEM.replace("T<", "<").replace(" / O", " / "))
    assert [m.reject_reason for m in got] == ["rating", "rank_num", "title"]
    df = spark.createDataFrame([(0, "u", ITEM), (1, "u", ITEM.replace("9.7", "x"))], "page_id long, url string, html string")
    parsed = catalogue.parse_movies(df)
    assert clean.accepted(parsed).count() == clean.rejected(parsed).count() == 1


def test_info_text(movies):
    html = ITEM.replace("</div>", '<div class="bd"><p> line one  x<br>\nline two </p></div></div>')
    (m,) = movies(html)
    assert m.info == "line one x\nline two"


def test_items_of_the_nested_flow(spark):
    html = (
        '<div class="item"><div class="pic"><em> 3 </em></div><div class="hd"><a href=" /s/3 "><span class="title">A</span>'
        '<span class="title">&nbsp;/&nbsp;B</span></a></div><div class="bd"><p> d1 <br> d2 </p><div class="star">'
        '<span class="rating_num">9.0</span><span>77人评价</span></div><span class="inq">q</span></div></div>'
        '<div class="item"><div class="pic"><em>4</em></div></div>'
    )
    pages = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    (m,) = catalogue.parse_items(pages).collect()
    assert (m.rank, m.title_cn, m.title_en, m.rating, m.rating_count) == ("3", "A", "/\xa0B", "9.0", "77人评价")
    assert (m.directors_cast, m.quote, m.detail_link) == ("d1 d2", "q", "/s/3")


def test_item_details(spark):
    html = (
        '<body><span class="year">(1994)</span><div id="mainpic"><img src=" p.jpg "></div><div id="info">片长: 142分钟'
        '<span property="v:genre">剧情</span>/<span property="v:genre">犯罪</span>'
        '<a href="http://x/">no</a><a href="http://www.imdb.com/t"> tt01 </a></div></body>'
    )
    pages = spark.createDataFrame([("u", html), ("v", "<body></body>")], "url string, html string")
    got = {r.detail_link: r for r in catalogue.parse_item_details(pages).collect()}
    u, v = got["u"], got["v"]
    assert (u.year, u.duration, u.genre, u.imdb_rating, u.poster_url) == ("1994", "142分钟", "剧情, 犯罪", "tt01", "p.jpg")
    assert (v.year, v.duration, v.genre, v.imdb_rating, v.poster_url) == (None, None, "", None, None)


def test_details(spark):
    pages = spark.createDataFrame(
        [("u", '<div id="info">…1994… 142 分钟 … imdb: tt01</div>'), ("v", '<div id="info">x</div>')], "url string, html string"
    )
    got = {r.detail_url: (r.year, r.runtime, r.imdb) for r in catalogue.parse_details(pages).collect()}
    assert got == {"u": ("1994", "142分钟", "tt01"), "v": ("", "", "")}


def test_reviews(spark):
    one = (
        '<div class="comment-item"><span class="comment-info"><a>ann</a><span class="allstar50 rating" title="力荐"></span>'
        '<span class="comment-time"> t </span></span><span class="short"> good <b>one</b> </span></div>'
    )
    none = '<div class="comment-item"><span class="short"> </span></div>'
    unrated = '<div class="comment-item"><span class="short">x</span></div>'
    pages = spark.createDataFrame([(1, "u", one + none + unrated)], "page_id long, url string, html string")
    got = [(r.position, r.username, r.rating, r.content, r.comment_time) for r in catalogue.parse_reviews(pages).collect()]
    assert got == [(1, "ann", "力荐", "good one", "t"), (3, "", "无评分", "x", "")]


def test_parser_takes_broken_markup(spark):
    root = parse("<ul><li>a<li><b>b</ul><p>one<p>two<br/>three</i><img src=x></p>&lt;&eacute;")
    tags = [n.tag for n in root.inside()]
    assert tags.count("li") == 2 and tags.count("p") == 2
    assert [n.text() for n in root.inside() if n.tag == "p"] == ["one", "twothree"]
    assert root.text().endswith("<é")
    pages = spark.createDataFrame([(1, "<li>a</li><li><i>b</i></li>")], "page_id long, html string")
    got = explode_blocks(pages, step("li"), {"t": pick(), "all": pick("i", every=True)}, keep=("page_id",)).collect()
    assert [(r.position, r.t, r["all"]) for r in got] == [(1, "a", []), (2, "b", ["b"])]


def test_assemble(spark):
    second = ITEM.replace("<em>1", "<em>2").replace('href="u"', 'href="v"')
    unlinked = ITEM.replace("<em>1", "<em>3").replace(' href="u"', "")
    refused = ITEM.replace("<em>1", "<em>0").replace('href="u"', 'href="w"')
    lists = spark.createDataFrame([(1, "l", ITEM + second), (2, "m", unlinked + refused)], "page_id long, url string, html string")
    known = '<span class="comment-info"><a>n</a></span><span class="comment-time">t</span>'
    block = '<div class="comment-item">' + known + '<span class="short">{}</span></div>'
    nameless = '<div class="comment-item"><span class="short">nobody</span></div>'
    info = '<div id="info">1994 142 分钟</div>'
    many = "".join(block.format("" if i == 0 else f"r{i:02d}") for i in range(20))
    details = spark.createDataFrame([("u", info + many), ("w", block.format("orphan") + nameless), ("u", info + many)], "url string, html string")
    posters = spark.createDataFrame([("T O.jpg", 2000), ("T O.jpg", 3000)], "name string, length long")
    movies, reviews = catalogue.assemble(lists, details, posters, "posters/")
    got = {m.rank_num: m for m in movies.collect()}
    assert set(got) == {"1", "2", "3"}
    assert (got["1"].year, got["1"].runtime, got["1"].imdb) == ("1994", "142分钟", "")
    assert (got["2"].year, got["3"].year, got["1"].poster_path) == ("", None, "posters/T O.jpg")
    rows = sorted((r.ordinal, r.movie_rank, r.content) for r in reviews.collect())
    # Of the first 15 blocks one is empty; the review of the refused movie stays, under rank 0.
    assert rows == [(i, 1, f"r{i:02d}") for i in range(1, 15)] + [(15, 0, "orphan")]
    cleaned = catalogue.clean_movies(movies)
    assert cleaned.count() == 1  # one title and rating three times


def test_refused_pages_are_listed(spark):
    pages = spark.createDataFrame([(1, "<li>a</li>"), (2, "<li>b</li><![foo bar]>"), (3, None)], "page_id long, html string")
    assert [(r.page_id, r.t) for r in explode_blocks(pages, step("li"), {"t": pick()}, keep=("page_id",)).collect()] == [(1, "a")]
    refused = refused_pages(pages, keep=("page_id",)).collect()
    assert [r.page_id for r in refused] == [2] and refused[0].reason.startswith("AssertionError")


def test_first_anchor_and_anchor_by_link(spark):
    html = '<li><a name="t">TOP</a><a href="/x">X</a><a href="http://www.imdb.com/t">tt1</a></li>'
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    fields = {"first": pick("a", attr="href", only_first=True), "any": pick("a", attr="href"), "imdb": pick("a", where=("href", "imdb.com"))}
    (row,) = explode_blocks(pages, step("li"), fields, keep=("page_id",)).collect()
    assert (row["first"], row["any"], row.imdb) == (None, "/x", "tt1")
