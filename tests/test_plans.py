"""The movie corpus from raw records to reports, and what the plans must look like."""

import json

import pytest

import reviewlens.__main__ as program
from reviewlens import schemas as S
from reviewlens.operators import clean, relate, validate
from reviewlens.plans import catalogue, items
from reviewlens.registry import QUERIES

SF = "/root/testdata/sf0.001"


def movie(rank, title, rating, **more):
    return {"rank_num": rank, "title": title, "rating": rating, "info": "导演: 甲\n1994 / x / 剧情 犯罪", **more}


RAW = [
    movie("1", "a", "9.75", comment_num="1,234", quote="", year="1888"),
    movie("2", "a", "9.8"),
    movie("3", "a", "9.1"),
    movie("4", None, "9"),
    movie("5", "bad", "abc", runtime=""),
    movie("6", "high", "10.1"),
    movie("7", "low", "-0.1"),
    movie("8", "ten", "10", info=None),
    movie("9", "nan", "NaN"),
]


@pytest.fixture
def cleaned(spark):
    raw = spark.createDataFrame([tuple(m.get(c) for c in S.RAW_MOVIES.names) for m in RAW], S.RAW_MOVIES)
    return {r.rank_num: r for r in catalogue.clean_movies(raw.repartition(4)).collect()}


def test_clean_movies(cleaned):
    assert sorted(cleaned) == [1, 3, 5, 8, 9]
    first = cleaned[1]
    # Half-even rounding makes 1 and 2 the same title and rating; the first stays.
    assert (first.rating, first.comment_num, first.quote) == (9.8, 1234, "")
    assert (first.year, first.director, first.genre) == ("1994", "甲", "剧情 犯罪")
    assert (first.runtime, cleaned[5].runtime) == ("未知片长", "")
    assert cleaned[3].quote == "无经典台词" and cleaned[3].comment_num == 0
    assert cleaned[5].rating == 0.0 and cleaned[9].rating == 0.0
    assert (cleaned[8].info, cleaned[8].director, cleaned[8].year) == ("无详细信息", "未知导演", "未知年份")


def test_fill_ignores_absent_columns_and_empty_text(spark):
    df = spark.createDataFrame([("",), (None,)], "quote string")
    assert [r.quote for r in clean.fill_defaults(df, S.MOVIE_DEFAULTS).collect()] == ["", "无经典台词"]


def test_null_report(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    assert {(r.column_name, r.nulls, r.total_rows) for r in validate.null_report(df).collect()} == {("a", 1, 2), ("b", 2, 2)}


def test_program(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(program, "build_session", lambda: spark)
    movies, reviews, out = tmp_path / "m.json", tmp_path / "r.json", tmp_path / "out"
    movies.write_text(json.dumps(RAW, ensure_ascii=False), encoding="utf-8")
    rows = [
        {"ordinal": i, "movie_rank": r, "username": u, "rating": "力荐", "content": c, "comment_time": "t"}
        for i, (r, u, c) in enumerate([(1, "a", "好看 喜欢"), (1, "a", "好看 喜欢"), (2, "b", "难看"), (77, "c", "无聊 难看")])
    ]
    reviews.write_text(json.dumps(rows, ensure_ascii=False), encoding="utf-8")
    labelled = tmp_path / "labelled"
    spark.createDataFrame([("好看 喜欢", 1), ("难看 无聊", 0)], "text string, label int").write.parquet(str(labelled))
    argv = ["movies", "--movies", str(movies), "--reviews", str(reviews), "--labelled", str(labelled), "--out", str(out)]
    assert program.main(argv) == 0
    stored = {r.id: r for r in spark.read.parquet(f"{out}/movies").collect()}
    assert sorted(stored) == [1, 2, 3, 4, 5] and stored[2].rank_num == 3 and stored[1].created_at is not None
    assert {r.id for r in spark.read.parquet(f"{out}/reports/rank_id_mismatch").collect()} == {2, 3, 4, 5}
    assert [r.username for r in spark.read.parquet(f"{out}/comments").collect()] == ["a"]
    reports = {p.name for p in (out / "reports").iterdir()}
    assert {"top_movies", "directors", "genres", "decades", "keywords", "sentiment_summary", "orphan_reviews"} <= reports
    scored = {r.ordinal: r.sentiment for r in spark.read.parquet(f"{out}/reports/sentiment").collect()}
    assert scored[0] == "正面" and scored[3] == "负面" and len(scored) == 4
    words = {r.token: r.n for r in spark.read.parquet(f"{out}/reports/keywords").collect()}
    assert words == {"好看": 2, "喜欢": 2, "难看": 2, "无聊": 1}


def test_program_without_movies(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(program, "build_session", lambda: spark)
    empty = tmp_path / "m.json"
    empty.write_text("[]", encoding="utf-8")
    assert program.main(["movies", "--movies", str(empty), "--out", str(tmp_path / "o")]) == 1


def test_page_program(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(program, "build_session", lambda: spark)
    html = '<div class="item"><em>1</em><a href="u"><span class="title">T</span></a><span class="rating_num">9</span></div>'
    lists = spark.createDataFrame([(1, "l", html), (2, "m", "请验证")], "page_id long, url string, html string")
    known = '<span class="comment-info"><a>n</a></span><span class="comment-time">t</span>'
    review = '<div class="comment-item">' + known + '<span class="short">good</span></div>'
    lists.write.parquet(str(tmp_path / "l"))
    spark.createDataFrame([("u", review)], "url string, html string").write.parquet(str(tmp_path / "d"))
    out = tmp_path / "out"
    assert program.main(["pages", "--lists", str(tmp_path / "l"), "--details", str(tmp_path / "d"), "--out", str(out)]) == 0
    assert [r.url for r in spark.read.parquet(f"{out}/blocked").collect()] == ["m"]
    argv = ["movies", "--lines", "--movies", f"{out}/movies.json", "--reviews", f"{out}/reviews.json", "--out", f"{out}/final"]
    assert program.main(argv) == 0
    assert [(r.rank_num, r.rating) for r in spark.read.parquet(f"{out}/final/movies").collect()] == [(1, 9.0)]
    assert [(r.movie_id, r.content) for r in spark.read.parquet(f"{out}/final/comments").collect()] == [(1, "good")]


def item(link, at, title, comments, **more):
    return {"rank": "1", "title_cn": title, "rating": "9", "detail_link": link, "crawled_at": at, "hot_comments": comments, **more}


def comment(text):
    return {"author": "a", "score": "", "time": "t", "content": text}


def test_item_program(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(program, "build_session", lambda: spark)
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    argv = ["items", "--source", str(source), "--out", str(out)]

    def put(name, *rows):
        (source / name).write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in rows), encoding="utf-8")
        assert program.main(argv) == 0

    put("1.json", item("l/a", "1", "甲", [comment("x"), comment("y")], year="1994"), item("l/b", "1", "乙", []), item("l/a", "2", "甲2", [comment("z")], year="1995"))
    put("2.json", item("l/b", "3", None, [comment("w")], rating="11"))
    movies = {r.detail_link: r for r in spark.read.parquet(f"{out}/movies").collect()}
    assert (movies["l/a"].title_cn, movies["l/a"].year, movies["l/a"].flags) == ("甲2", "1995", [])
    assert (movies["l/b"].title_cn, movies["l/b"].flags) == (None, ["missing:title_cn", "range:rating"])
    comments = {(r.movie_id, r.position, r.content) for r in spark.read.parquet(f"{out}/comments").collect()}
    assert comments == {(movies["l/a"].id, 1, "z"), (movies["l/b"].id, 1, "w")}
    exported = spark.read.json(f"{out}/json")
    assert exported.count() == 4 and "flags" not in exported.columns
    header = spark.read.option("header", True).csv(f"{out}/movies_csv").columns
    assert [c for c in header if c != "batch_id"] == sorted(c for c in S.ITEMS.names if c != "hot_comments")
    assert spark.read.option("header", True).csv(f"{out}/comments_csv").count() == 4


def test_compare_program(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(program, "build_session", lambda: spark)
    runs = tmp_path / "runs.json"
    run = {"success": True, "memory_used": 0, "data_count": 10, "db_size_mb": 0, "movies": 0, "comments": 0}
    runs.write_text("\n".join(json.dumps({**run, "run": n, "execution_time": t}) for n, t in (("a", 145.0), ("b", 107.0))))
    out = tmp_path / "out"
    assert program.main(["compare", "--runs", str(runs), "--baseline", "a", "--candidate", "b", "--out", str(out)]) == 0
    got = spark.read.json(f"{out}/comparison").first()
    assert got.time_verdict == "candidate faster" and got.memory_ratio is None and got.completeness_baseline == 1.0


def test_items_from_pages(spark):
    lists = spark.createDataFrame([("a", "A"), ("b", "B")], "detail_link string, title_cn string")
    details = spark.createDataFrame([("a", "1994")], "detail_link string, year string")
    rows = [("a", p, i, "u", "", f"{p}-{i}", "t") for p in (1, 2, 3, 4) for i in range(6)] + [("a", 1, 9, "u", "", "", "t")]
    reviews = spark.createDataFrame(
        rows, "detail_link string, page int, position int, username string, rating string, content string, comment_time string"
    )
    got = {r.detail_link: r for r in items.items_from_pages(lists, details, reviews).collect()}
    want = [f"{p}-{i}" for p in (1, 2) for i in range(6)] + ["3-0", "3-1", "3-2"]
    assert [c.content for c in got["a"].hot_comments] == want and got["a"].year == "1994"
    assert got["b"].hot_comments is None and got["b"].spider_name == "reviewlens"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


CROSS = ("CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream_")))
def test_no_cross_joins(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert not any(kind in text for kind in CROSS)


def test_range_filter_is_pushed_below_the_window(spark):
    part = spark.read.parquet(f"{SF}/part.parquet")
    kept = clean.in_range(relate.keep_first(part, ["p_name", "p_retailprice"], ["p_partkey"]), "p_retailprice", 920, 960)
    assert "GreaterThanOrEqual(p_retailprice,920.0)" in plan(kept)


def test_columns_are_pruned(spark):
    text = plan(QUERIES["value_counts_top"](spark, SF))
    assert "ReadSchema: struct<p_brand:string>" in text and "TakeOrderedAndProject" in text


def test_rank_windows_follow_a_limit(spark):
    for name in ("keywords_top", "value_counts_top", "share_top", "topk_rating", "term_weights"):
        text = plan(QUERIES[name](spark, SF))
        assert text.index("Window") < text.index("TakeOrderedAndProject")


def test_reviews_without_ordinals(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(program, "build_session", lambda: spark)
    movie = {"rank_num": "1", "title": "T", "rating": "9", "info": "", "quote": "q"}
    (tmp_path / "m.json").write_text(json.dumps([movie]), encoding="utf-8")
    reviews = [{"movie_rank": 1, "username": f"u{i}", "content": f"好看 喜欢 {i}"} for i in range(5)]
    (tmp_path / "r.json").write_text(json.dumps(reviews), encoding="utf-8")
    spark.createDataFrame([("好看", 1), ("难看", 0)], "text string, label int").write.parquet(str(tmp_path / "t"))
    argv = ["movies", "--movies", str(tmp_path / "m.json"), "--reviews", str(tmp_path / "r.json"), "--labelled", str(tmp_path / "t")]
    assert program.main([*argv, "--out", str(tmp_path / "o")]) == 0
    scored = spark.read.parquet(str(tmp_path / "o/reports/sentiment")).collect()
    assert sorted(r.ordinal for r in scored) == [1, 2, 3, 4, 5]
    stored = spark.read.parquet(str(tmp_path / "o/comments")).collect()
    assert sorted(r.content for r in stored) == [f"好看 喜欢 {i}" for i in range(5)]
