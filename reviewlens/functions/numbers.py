"""Numbers out of strings, without failing on bad input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .patterns import NUMBER
from .texts import strip


def parse_double(col: Column) -> Column:
    """The number in ``col``, surrounding space ignored; NULL where there is none."""
    text = strip(col.cast("string"))
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def half_even(col: Column, digits: int) -> Column:
    """Round to ``digits`` places, ties to the even neighbour."""
    scale = float(10**digits)
    return F.rint(col * F.lit(scale)) / F.lit(scale)


def safe_double(col: Column, default: float = 0.0, digits: int | None = None) -> Column:
    """A double, ``default`` for text that is no number."""
    value = F.coalesce(parse_double(col), F.lit(float(default)))
    return value if digits is None else half_even(value, digits)


def safe_long(col: Column, default: int = 0, separators: str = "") -> Column:
    """A whole number cut toward zero; characters of ``separators`` are removed first."""
    text = col.cast("string")
    for char in separators:
        text = F.replace(text, F.lit(char), F.lit(""))
    return F.coalesce(parse_double(text).try_cast("bigint"), F.lit(default).cast("bigint"))


def digits_or_zero(col: Column) -> Column:
    """A run of digits as a number, anything else 0."""
    return F.coalesce(F.when(col.rlike("^[0-9]+$"), col.try_cast("bigint")), F.lit(0).cast("bigint"))


def decimal_or_zero(col: Column) -> Column:
    """Digits and dots as a double, other text 0.0; NULL for a value such as ``9.7.1``."""
    plain = F.replace(col, F.lit("."), F.lit("")).rlike("^[0-9]+$")
    return F.when(plain, col.try_cast("double")).otherwise(F.lit(0.0))


def decade(year: Column) -> Column:
    """1994 → 1990; text that is no number gives NULL."""
    return (F.floor(parse_double(year) / 10) * 10).cast("int")


def fixed_text(value: Column, digits: int, unit: str = "") -> Column:
    """A number as text with a fixed number of places, for reports: ``66.7%``."""
    pattern = "0." + "0" * digits if digits else "0"
    return F.concat(F.call_function("format_number", value, F.lit(pattern)), F.lit(unit))
