"""Cleaning and cutting of text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P


def strip(col: Column) -> Column:
    """Without leading and trailing Unicode white space."""
    return F.btrim(col, F.lit(P.SPACE_CHARS))


def collapse(col: Column) -> Column:
    """Each run of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(col, P.SPACES, " "))


def delete_other(col: Column, keep: str) -> Column:
    """Without what is neither in ``keep`` nor white space; NULL becomes ''."""
    return F.regexp_replace(F.coalesce(col, F.lit("")), f"(?U:[^{keep}{P.SPACE}]+)", "")


def clean_delete(col: Column, keep: str = P.KEEP_MIXED) -> Column:
    """As ``delete_other``, with white space collapsed."""
    return collapse(delete_other(col, keep))


def clean_space(col: Column, keep: str = P.KEEP_CJK) -> Column:
    """Turn every run of characters outside ``keep`` into one space; NULL becomes ''."""
    return F.trim(F.regexp_replace(F.coalesce(col, F.lit("")), f"[^{keep}]+", " "))


def or_default(col: Column, default: str) -> Column:
    """``default`` for NULL and ''."""
    return F.coalesce(F.nullif(col, F.lit("")), F.lit(default))


def first_non_empty(*cols: Column, default: str) -> Column:
    """The first column that is neither NULL nor '', after stripping."""
    return F.coalesce(*[F.nullif(strip(c), F.lit("")) for c in cols], F.lit(default))


def first_match(col: Column, pattern: str, default: str = "", group: int = 1) -> Column:
    """The first match of ``pattern``, else ``default``."""
    return or_default(F.regexp_extract(col, pattern, group), default)


def first_line(col: Column) -> Column:
    return F.substring_index(col, "\n", 1)


def second_line(col: Column) -> Column:
    """The second line; the whole text when it has one line only."""
    return F.coalesce(F.get(F.split(col, "\n"), F.lit(1)), col)


def between(col: Column, start: str, end: str | None = None) -> Column:
    """Text after the first ``start`` (up to the next one) and before ``end``; NULL without ``start``."""
    part = F.get(F.split(col, _literal(start)), F.lit(1))
    if end is not None:
        part = F.substring_index(part, end, 1)
    return strip(part)


def last_segment(col: Column, sep: str, default: str) -> Column:
    """Text after the last ``sep`` with white space collapsed; ``default`` if there is none."""
    return F.when(F.contains(col, F.lit(sep)), or_default(collapse(F.substring_index(col, sep, -1)), default)).otherwise(
        F.lit(default)
    )


def first_matches(col: Column, pattern: str, n: int, sep: str) -> Column:
    """Up to ``n`` matches joined by ``sep``; '' when there is none."""
    return F.array_join(F.slice(F.regexp_extract_all(col, F.lit(f"({pattern})"), 1), 1, n), sep)


def drop_slashes(col: Column) -> Column:
    return strip(F.replace(strip(col), F.lit("/"), F.lit("")))


def full_title(main: Column, other: Column) -> Column:
    """Main and alternative title with one space between, '' when both are missing."""
    empty = F.lit("")
    return strip(F.concat(strip(F.coalesce(main, empty)), F.lit(" "), drop_slashes(F.coalesce(other, empty))))


def director(info: Column, default: str) -> Column:
    """Name after the director mark of line 1: Chinese run, else first word, else ``default``."""
    part = between(first_line(info), "导演:", "主演:")
    return F.coalesce(
        F.nullif(F.regexp_extract(part, f"({P.CJK_NAME})", 1), F.lit("")),
        F.nullif(F.regexp_extract(part, f"({P.WORD})", 1), F.lit("")),
        F.lit(default),
    )


def actors(info: Column, default: str, n: int = 3, width: int = 50) -> Column:
    """Up to ``n`` Chinese names after the cast mark of line 1, else its first ``width`` characters."""
    part = between(first_line(info), "主演:")
    return F.coalesce(
        F.nullif(first_matches(part, P.CJK_NAME, n, "、"), F.lit("")),
        F.nullif(F.left(part, F.lit(width)), F.lit("")),
        F.lit(default),
    )


def year(info: Column, default: str) -> Column:
    return first_match(second_line(info), P.YEAR, default)


def genre(info: Column, default: str) -> Column:
    return last_segment(second_line(info), "/", default)


def _literal(text: str) -> str:
    """``text`` quoted for a regular expression."""
    return "\\Q" + text + "\\E"
