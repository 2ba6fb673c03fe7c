"""HTML pages into fields and rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import markup, names
from ..operators import extract
from ..operators.extract import block_function, explode_blocks, pick, step
from ..plans import catalogue
from ..session import spread
from .base import query, sql_strip, table


def sql_decode(x: str) -> str:
    """The references that the given pages hold, written out here so that the check has its own list."""
    for entity, char in (("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        x = f"replace({x}, '{entity}', '{char}')"
    return x


def sql_text(found: str) -> str:
    return sql_strip(sql_decode(found))


def sql_open(tag: str, cls: str | None = None) -> str:
    return f'<{tag} class="{cls}">' if cls else f"<{tag}>"


@query(
    f"""
SELECT page_id,
  {sql_text(f"regexp_extract(html, '{sql_open('title')}([^<]*)', 1)")} AS title,
  {sql_text(f"regexp_extract(html, '{sql_open('h1')}([^<]*)', 1)")} AS heading,
  coalesce(nullif({sql_text(f"regexp_extract(html, '{sql_open('div', 'ad')}([^<]*)', 1)")}, ''), 'none') AS ad,
  coalesce(nullif({sql_text(f"regexp_extract(html, '{sql_open('h2')}([^<]*)', 1)")}, ''), 'none') AS subheading,
  {sql_text("regexp_extract(html, '<a[ ][^>]*?href=\"([^\"]*)\"', 1)")} AS first_link
FROM pages
"""
)
def html_fields(spark, sf):
    html = F.col("html")
    return table(spark, sf, "pages").select(
        "page_id",
        markup.first_text(html, "title").alias("title"),
        markup.first_text(html, "h1").alias("heading"),
        markup.first_text(html, "div", "ad", default="none").alias("ad"),
        markup.first_text(html, "h2", default="none").alias("subheading"),
        markup.first_attribute(html, "a", "href").alias("first_link"),
    )


LINKS = (
    """
WITH l AS (SELECT page_id, url,
  unnest(regexp_extract_all(html, '<li><a href="[^"]*">[^<]*')) AS link,
  generate_subscripts(regexp_extract_all(html, '<li><a href="[^"]*">[^<]*'), 1) AS position FROM pages)
SELECT page_id, url, CAST(position AS INTEGER) AS position, """
    + sql_text("regexp_extract(link, 'href=\"([^\"]*)\"', 1)")
    + " AS href, "
    + sql_text("regexp_extract(link, '>([^<>]*)$', 1)")
    + " AS label FROM l"
)


@query(LINKS)
def html_items(spark, sf):
    """Repeated blocks by regular expressions, inside the JVM."""
    blocks = F.regexp_extract_all("html", F.lit('(<li><a href="[^"]*">[^<]*)'), 1)
    found = table(spark, sf, "pages").select("page_id", "url", F.posexplode(blocks).alias("at", "link"))
    return found.select(
        "page_id",
        "url",
        (F.col("at") + 1).alias("position"),
        markup.first_attribute(F.col("link"), "a", "href").alias("href"),
        markup.first_text(F.col("link"), "a").alias("label"),
    )


@query(LINKS)
def html_items_parsed(spark, sf):
    """The same blocks by the parser for irregular pages."""
    fields = {"href": pick("a", attr="href"), "label": pick("a")}
    return explode_blocks(spread(table(spark, sf, "pages")), step("li"), fields)


@query(LINKS)
def html_items_sql(spark, sf):
    """The same blocks in SQL: a table function joined to each page."""
    block_function(spark, "page_links", step("li"), {"href": pick("a", attr="href"), "label": pick("a")})
    sql = "SELECT p.page_id, p.url, b.position, b.href, b.label FROM {pages} AS p, LATERAL page_links(p.html) AS b"
    return spark.sql(sql, pages=spread(table(spark, sf, "pages")))


ITEMS_ALL = "regexp_extract_all(html, '<li><a href=\"[^\"]*\">([^<]*)', 1)"


@query(
    f"""
WITH t AS (SELECT page_id, list_transform({ITEMS_ALL}, lambda x: {sql_text("x")}) AS t FROM pages)
SELECT page_id, t[1] AS main, t[2] AS alternative, t[-1] AS votes, CAST(len(t) AS INTEGER) AS n,
  array_to_string(list_filter(t, lambda x: x <> ''), ' ') AS joined FROM t
"""
)
def html_match_list(spark, sf):
    listed = table(spark, sf, "pages").select("page_id", markup.all_texts(F.col("html"), "a").alias("t"))
    return listed.select(
        "page_id",
        F.get("t", F.lit(0)).alias("main"),
        F.get("t", F.lit(1)).alias("alternative"),
        F.get("t", F.size("t") - 1).alias("votes"),
        F.size("t").alias("n"),
        markup.join_texts(F.col("t"), " ").alias("joined"),
    )


@query(
    """
SELECT page_id, concat(regexp_replace(url, '/+$', ''), '/comments?status=P') AS reviews,
  concat(regexp_extract(url, '^([a-z]+://[^/?#]*)', 1), regexp_extract(html, '<a[ ][^>]*?href="([^"]*)"', 1)) AS link
FROM pages
"""
)
def derived_url(spark, sf):
    link = markup.first_attribute(F.col("html"), "a", "href")
    return table(spark, sf, "pages").select(
        "page_id",
        names.review_url(F.col("url")).alias("reviews"),
        names.absolute_url(F.col("url"), link).alias("link"),
    )


# List pages made from every part: one page per part, with two blocks, the second without a link.
def _list_pages(spark, sf):
    part = table(spark, sf, "part")
    n = F.col("p_partkey").cast("string")
    votes = F.when(
        F.col("p_size") % 7 != 0, F.concat(F.lit("<span>"), F.col("p_size").cast("string"), F.lit(",345人评价</span>"))
    ).otherwise(F.lit(""))
    quote = F.when(
        F.col("p_size") % 5 != 0, F.concat(F.lit('<p class="quote"><span> '), F.col("p_type"), F.lit(" </span></p>"))
    ).when(F.col("p_size") % 3 != 0, F.concat(F.lit('<p class="quote">“'), F.col("p_type"), F.lit("”</p>")))
    html = F.concat(
        F.lit('<ol><div class="item"><div class="pic"><em>'),
        n,
        F.lit('</em></div><div class="hd"><a href=" /subject/'),
        n,
        F.lit('/ "><span class="title">'),
        F.col("p_name"),
        F.lit('</span><span class="title">Alt</span><span class="other"> / '),
        F.col("p_brand"),
        F.lit('</span></a></div><div class="bd"><p> line one<br>line  two </p><div class="star"><span class="rating_num">'),
        F.concat((F.col("p_size") % 10).cast("string"), F.lit(".5")),
        F.lit("</span>"),
        votes,
        F.lit("</div>"),
        F.coalesce(quote, F.lit("")),
        F.lit('</div></div><div class="item big"><em>0</em><span class="title">&lt;No&gt; rank</span></div></ol>'),
    )
    return part.select(
        F.col("p_partkey").alias("page_id"), F.concat(F.lit("https://movies.example.com/list/"), n).alias("url"), html.alias("html")
    )


@query(
    """
SELECT p_partkey AS page_id, 1 AS position, p_partkey AS rank_num, concat(p_name, ' ', p_brand) AS title,
  CAST(p_size % 10 AS DOUBLE) + 0.5 AS rating,
  CAST(CASE WHEN p_size % 7 <> 0 THEN p_size * 1000 + 345 ELSE 0 END AS BIGINT) AS comment_num,
  'line oneline two' AS info,
  CASE WHEN p_size % 5 <> 0 OR p_size % 3 <> 0 THEN p_type ELSE '无经典台词' END AS quote,
  concat('/subject/', p_partkey, '/') AS detail_url, '' AS poster_url,
  concat(trim(left(replace(concat(p_name, ' ', p_brand), '#', '_'), 30)), '.jpg') AS poster_name,
  CASE WHEN p_partkey = 0 THEN 'rank_num' END AS reject_reason
FROM part
UNION ALL
SELECT p_partkey, 2, 0, '<No> rank', 0.0, 0, '', '无经典台词', '', '', '_No_ rank.jpg', 'rank_num' FROM part
"""
)
def movie_pages(spark, sf):
    parsed = catalogue.parse_movies(spread(_list_pages(spark, sf)))
    return parsed.drop("url")


@query(
    """
SELECT p_partkey AS page_id, 1 AS position, CAST(p_partkey AS VARCHAR) AS rank, p_name AS title_cn, 'Alt' AS title_en,
  concat(p_size % 10, '.5') AS rating,
  CASE WHEN p_size % 7 <> 0 THEN concat(p_size, ',345人评价') ELSE concat(p_size % 10, '.5') END AS rating_count,
  CASE WHEN p_size % 5 = 0 AND p_size % 3 <> 0 THEN concat('line one line  two “', p_type, '”')
       ELSE 'line one line  two' END AS directors_cast,
  '' AS quote, concat('/subject/', p_partkey, '/') AS detail_link
FROM part
"""
)
def item_pages(spark, sf):
    return catalogue.parse_items(spread(_list_pages(spark, sf))).drop("url")


# Detail pages made from every part, each with two reviews, the second without text.
def _detail_pages(spark, sf, before, after):
    n, size = F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    html = F.concat(
        F.lit('<body><div id="info">上映: '),
        (F.col("p_size") + 1900).cast("string"),
        F.when(F.col("p_size") % 4 != 0, F.concat(F.lit("-10-14<br>片长: "), size, F.lit(" 分钟"))).otherwise(F.lit("")),
        F.when(F.col("p_size") % 3 != 0, F.concat(F.lit("<br>imdb:  tt"), n, F.lit(" more"))).otherwise(F.lit("")),
        F.lit('</div><div class="comment-item"><span class="comment-info">'),
        F.when(F.col("p_size") % 5 != 0, F.concat(F.lit('<a href="/u">user '), size, F.lit("</a>"))).otherwise(F.lit("")),
        F.lit('<span class="comment-time"> 2024-01-02 </span></span><span class="short">about '),
        F.col("p_name"),
        F.lit('</span></div><div class="comment-item"><span class="short"></span></div></body>'),
    )
    return table(spark, sf, "part").select(
        F.concat(F.lit(before), n, F.lit(after)).alias("url"), html.alias("html")
    )


@query(
    """
SELECT concat('https://movies.example.com/subject/', p_partkey) AS detail_url, CAST(1900 + p_size AS VARCHAR) AS year,
  CASE WHEN p_size % 4 <> 0 THEN concat(p_size, '分钟') ELSE '' END AS runtime,
  CASE WHEN p_size % 3 <> 0 THEN concat('tt', p_partkey) ELSE '' END AS imdb
FROM part
"""
)
def detail_pages(spark, sf):
    return catalogue.parse_details(spread(_detail_pages(spark, sf, "https://movies.example.com/subject/", "")))


@query(
    f"""
SELECT conv_id, turn, CAST(1 AS INTEGER) AS position, role AS username,
  CASE WHEN turn % 2 = 0 THEN '推荐' ELSE '无评分' END AS rating, {sql_strip("text")} AS content,
  concat('2024-01-0', turn + 1) AS comment_time
FROM conversations WHERE {sql_strip("text")} <> ''
"""
)
def review_pages(spark, sf):
    def escaped(col):
        for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            col = F.replace(col, F.lit(char), F.lit(entity))
        return col

    html = F.concat(
        F.lit('<div class="comment-item"><span class="comment-info"><a href="/u">'),
        F.col("role"),
        F.lit("</a>"),
        F.when(F.col("turn") % 2 == 0, F.lit('<span class="allstar rating" title="推荐"></span>')).otherwise(F.lit("")),
        F.lit('<span class="comment-time"> 2024-01-0'),
        (F.col("turn") + 1).cast("string"),
        F.lit('</span></span><p><span class="short">'),
        escaped(F.col("text")),
        F.lit('</span></div><div class="comment-item"><span class="short"> </span></div>'),
    )
    pages = table(spark, sf, "conversations").select("conv_id", "turn", html.alias("html"))
    return catalogue.parse_reviews(spread(pages), keep=("conv_id", "turn"))


# Every ninth detail page is there twice, the earlier one with another year.
def _repeated_details(spark, sf):
    details = _detail_pages(spark, sf, "/subject/", "/").withColumn("fetched", F.lit(2))
    key = F.regexp_extract("url", "([0-9]+)", 1).cast("long")
    earlier = details.where(key % 9 == 0).select(
        "url", F.regexp_replace("html", "上映: [0-9]+", "上映: 1888").alias("html"), F.lit(1).alias("fetched")
    )
    return spread(details.unionByName(earlier))


@query(
    """
SELECT CAST(p_partkey AS VARCHAR) AS rank_num, concat(p_name, ' ', p_brand) AS title,
  concat(p_size % 10, '.5') AS rating,
  CAST(CASE WHEN p_size % 7 <> 0 THEN p_size * 1000 + 345 ELSE 0 END AS VARCHAR) AS comment_num, 'line oneline two' AS info,
  CASE WHEN p_size % 5 <> 0 OR p_size % 3 <> 0 THEN p_type ELSE '无经典台词' END AS quote,
  concat('/subject/', p_partkey, '/') AS detail_url, '' AS poster_path,
  CAST(1900 + p_size AS VARCHAR) AS year, CASE WHEN p_size % 4 <> 0 THEN concat(p_size, '分钟') ELSE '' END AS runtime,
  CASE WHEN p_size % 3 <> 0 THEN concat('tt', p_partkey) ELSE '' END AS imdb
FROM part WHERE p_partkey > 0
"""
)
def assembled_movies(spark, sf):
    """All columns of raw movies; a repeated detail page counts once, in its later form."""
    details = _repeated_details(spark, sf)
    return catalogue.assemble_movies(spread(_list_pages(spark, sf)), details, order_by=["fetched"])


@query(
    """
SELECT row_number() OVER (ORDER BY p_partkey) AS ordinal, CAST(p_partkey AS INTEGER) AS movie_rank,
  concat('user ', p_size) AS username, '无评分' AS rating, concat('about ', p_name) AS content, '2024-01-02' AS comment_time
FROM part WHERE p_size % 5 <> 0
"""
)
def assembled_reviews(spark, sf):
    """Reviews of all listed movies, the one the gate refuses among them; blocks without an author are skipped."""
    details = _repeated_details(spark, sf)
    return catalogue.assemble_reviews(spread(_list_pages(spark, sf)), details, order_by=["fetched"])


@query(
    """
SELECT page_id, CAST(position AS INTEGER) AS position, label, CAST(NULL AS VARCHAR) AS reason FROM (
  SELECT page_id, unnest(regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)', 1)) AS label,
    generate_subscripts(regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)', 1), 1) AS position
  FROM pages WHERE page_id % 5 <> 0)
UNION ALL
SELECT page_id, 0, NULL, 'AssertionError' FROM pages WHERE page_id % 5 = 0
"""
)
def refused_pages(spark, sf):
    """Every fifth page holds a declaration that the parser refuses: listed with its reason, the others give rows."""
    broken = F.when(F.col("page_id") % 5 == 0, F.concat(F.col("html"), F.lit("<![foo bar]>"))).otherwise(F.col("html"))
    pages = spread(table(spark, sf, "pages").select("page_id", "url", broken.alias("html")))
    good = explode_blocks(pages, step("li"), {"label": pick("a")}, keep=("page_id",))
    bad = extract.refused_pages(pages, keep=("page_id",)).select(
        "page_id", F.lit(0).alias("position"), F.lit(None).cast("string").alias("label"),
        F.substring_index("reason", ":", 1).alias("reason"),
    )
    return good.withColumn("reason", F.lit(None).cast("string")).unionByName(bad)


@query(
    """
SELECT concat('/subject/', p_partkey, '/') AS detail_link, CAST(1900 + p_size AS VARCHAR) AS year,
  CASE WHEN p_size % 4 <> 0 THEN concat(p_size, '分钟') END AS duration, concat(p_type, ', ', p_brand) AS genre,
  CASE WHEN p_size % 3 <> 0 THEN concat('tt', p_partkey) END AS imdb_rating, concat('p', p_partkey, '.jpg') AS poster_url
FROM part
"""
)
def item_details(spark, sf):
    """Detail pages of the nested flow, with anchors that have no href before the one wanted."""
    return catalogue.parse_item_details(spread(_item_detail_pages(spark, sf)))


def _item_detail_pages(spark, sf):
    n, size = F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    html = F.concat(
        F.lit('<body><a name="top">TOP</a><a href="/x">X</a><span class="year">('), (F.col("p_size") + 1900).cast("string"),
        F.lit(')</span><div id="mainpic"><a href="/p"><img src="p'), n, F.lit('.jpg"></a></div><div id="info">'),
        F.when(F.col("p_size") % 4 != 0, F.concat(F.lit("片长: "), size, F.lit("分钟"))).otherwise(F.lit("")),
        F.lit('<span property="v:genre">'), F.col("p_type"), F.lit('</span><span property="v:genre">'), F.col("p_brand"),
        F.lit("</span>"),
        F.when(F.col("p_size") % 3 != 0, F.concat(F.lit('<a href="http://www.imdb.com/t">tt'), n, F.lit("</a>"))).otherwise(F.lit("")),
        F.lit("</div></body>"),
    )
    return table(spark, sf, "part").select(F.concat(F.lit("/subject/"), n, F.lit("/")).alias("url"), html.alias("html"))
