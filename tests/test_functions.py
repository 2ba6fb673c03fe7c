import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewlens.functions import markup, names, numbers
from reviewlens.functions import patterns as P
from reviewlens.functions import texts as X
from reviewlens.schemas import MOVIE_DEFAULTS as D


def x():
    return F.col("x")


def test_half_even_and_bad_ratings(column):
    got = column(numbers.safe_double(x(), 0.0, 1), "9.75", "9.65", " 8.25 ", "abc", "NaN", "", None, "1.0f", " 9.7　")
    assert got == [9.8, 9.6, 8.2, 0.0, 0.0, 0.0, 0.0, 0.0, 9.7]


def test_separators_and_truncation(column):
    got = column(numbers.safe_long(x(), separators=","), "1,234", "3.9", "-3.9", "x", None, "1e300", "1e3")
    assert got == [1234, 3, -3, 0, 0, 0, 1000]


def test_guarded_numbers(column):
    assert column(numbers.digits_or_zero(x()), "12", "1a", "", "-1") == [12, 0, 0, 0]
    assert column(numbers.decimal_or_zero(x()), "9.7", "9.7.1", "x", "9") == [9.7, None, 0.0, 9.0]


def test_decade(column):
    assert column(numbers.decade(x()), "1994", "2000", "未知年份", None) == [1990, 2000, None, None]


def test_report_texts(column):
    assert column(numbers.fixed_text(x(), 1, "%"), 66.66, 12.25, 0.0, kind="double") == ["66.7%", "12.2%", "0.0%"]
    assert column(numbers.fixed_text(x(), 3), 1.3532, -0.5, kind="double") == ["1.353", "-0.500"]


# The six infos and what has to come out of each: director, year, genre, actors.
INFOS = [
    (
        "导演: 甲乙·丙 Ann Bee   主演: 丁一 Cee / 戊二·己 Dee / 庚三 / 辛四\n   1994 / 某国 / 犯罪 剧情",
        ("甲乙·丙", "1994", "犯罪 剧情", "丁一、戊二·己、庚三"),
    ),
    ("Director X 1999 / USA / Drama", (D["director"], "1999", "Drama", D["actors"])),
    (
        "导演: John Smith 主演: Tom Roe / Ann Lee\n2001(某地) / 2002 / 爱情",
        ("John", "2001", "爱情", "Tom Roe / Ann Lee"),
    ),
    ("导演:  主演: \n无年份", (D["director"], D["year"], D["genre"], D["actors"])),
    ("", (D["director"], D["year"], D["genre"], D["actors"])),
    ("导演: 甲\n1961 / A / B /  ", ("甲", "1961", D["genre"], D["actors"])),
]


@pytest.mark.parametrize("info, want", INFOS)
def test_info_fields(column, info, want):
    exprs = [
        X.director(x(), D["director"]),
        X.year(x(), D["year"]),
        X.genre(x(), D["genre"]),
        X.actors(x(), D["actors"]),
    ]
    assert tuple(column(e, info)[0] for e in exprs) == want


def test_actors_fallback_is_cut(column):
    assert column(X.actors(x(), "none"), "主演: " + "a" * 80) == ["a" * 50]


def test_clean_delete(column):
    got = column(X.clean_delete(x()), "好看！！ 100% good\n真 的", "。。。", None, "", "é test")
    assert got == ["好看 100 good 真 的", "", "", "", "test"]


def test_clean_space(column):
    assert column(X.clean_space(x()), "好a看 1 的!", None) == ["好 看 的", ""]


def test_title(column):
    assert column(X.full_title(x(), F.lit(" / O / P")), " T ", "", None) == ["T O  P", "O  P", "O  P"]
    assert column(X.full_title(F.lit(None).cast("string"), x()), " / ") == [""]


def test_safe_names(column):
    assert column(names.safe_name(x()), "a/b:c", None, "", " 'x. ", "y" * 40) == ["a_b_c", "unknown", "unknown", "_x_", "y" * 30]
    got = column(names.safe_title(x(), F.lit(""), F.lit(7)), "a/:b", None, "")
    assert got == ["a_b", "movie_7", "movie_7"]


def test_extension(column):
    got = column(names.extension(x()), "image/jpeg", "image/png; q", "image/webp", "text/html", None)
    assert got == [".jpg", ".png", ".webp", ".jpg", ".jpg"]
    assert column(names.is_image(x()), "image/png", "image/jpg", None) == [True, False, False]


def test_urls(column):
    assert column(names.review_url(x()), "http://a/s/1//", "http://a/s/1") == ["http://a/s/1/comments?status=P"] * 2
    base = F.lit("https://h.example/a/b?x=1")
    got = column(names.absolute_url(base, x()), "/c", "d", "?p=2", "//o/e", "http://z/", "")
    assert got == [
        "https://h.example/c", "https://h.example/a/d", "https://h.example/a/b?p=2", "https://o/e", "http://z/",
        "https://h.example/a/b?x=1",
    ]


def test_marked_number(column):
    texts = F.array(F.lit("9.7"), x(), F.lit("other"))
    assert column(markup.marked_number(texts, "人评价"), "1,234人评价", "多人评价", "none") == [1234, 0, 0]


def test_details(column):
    assert column(X.first_match(x(), P.YEAR), "…1994… 142 分钟", "none") == ["1994", ""]
    assert column(F.regexp_extract(x(), P.RUNTIME, 1), "142 分钟", "x") == ["142", ""]
    assert column(X.first_match(x(), P.IMDB), "imdb: tt01 x", "IMDB:　tt2") == ["tt01", "tt2"]
    assert column(X.first_match(x(), P.DURATION), "片长： 142分钟", "片长142 分钟") == ["142分钟", ""]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=40), min_size=20, max_size=60))
def test_cleaning_agrees_with_python(column, values):
    def python(text):
        return re.sub(r"\s+", " ", re.sub(r"[^一-龥a-zA-Z0-9\s]", "", text)).strip()

    values = [v.encode("utf-8", "ignore").decode() for v in values]
    once = column(X.clean_delete(x()), *values)
    assert once == [python(v) for v in values]
    assert column(X.clean_delete(x()), *once) == once


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1000, 1000), min_size=20, max_size=60))
def test_rounding_agrees_with_pandas(column, values):
    import pandas as pd

    want = pd.Series(values).round(1).tolist()
    assert column(numbers.half_even(x(), 1), *values, kind="double") == want
