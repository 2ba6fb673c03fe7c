"""File names, extensions and links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .texts import strip

# Characters a file name of the first style may not hold.
UNSAFE_CHARS = "\\/:*?\"<>|`~!@#$%^&*()+=[]{};'."
# Characters of the second style, replaced run by run.
UNSAFE_RUNS = r'[\\/:*?"<>|]+'
# Content types of images, and the ending each one gets.
IMAGE_TYPES = "image/(jpeg|png|webp)"
EXTENSIONS = [("jpeg", ".jpg"), ("jpg", ".jpg"), ("png", ".png"), ("webp", ".webp")]
DEFAULT_EXTENSION = ".jpg"


def safe_name(name: Column, width: int = 30) -> Column:
    """Each unsafe character as ``_``, cut to ``width``; NULL and '' become ``unknown``."""
    named = F.coalesce(F.nullif(name, F.lit("")), F.lit("unknown"))
    return strip(F.left(F.translate(named, UNSAFE_CHARS, "_" * len(UNSAFE_CHARS)), F.lit(width)))


def safe_title(main: Column, other: Column, rank: Column, width: int = 100) -> Column:
    """First title that is not empty, else ``movie_<rank>``; runs of unsafe characters as one ``_``."""
    empty = F.lit("")
    named = F.coalesce(
        F.nullif(main, empty), F.nullif(other, empty), F.concat(F.lit("movie_"), rank.cast("string"))
    )
    return F.left(F.regexp_replace(named, UNSAFE_RUNS, "_"), F.lit(width))


def is_image(content_type: Column) -> Column:
    return F.coalesce(content_type.rlike(IMAGE_TYPES), F.lit(False))


def extension(content_type: Column) -> Column:
    """File ending for a content type, ``.jpg`` when unknown."""
    out = F.lit(DEFAULT_EXTENSION)
    for part, ending in reversed(EXTENSIONS):
        out = F.when(F.contains(content_type, F.lit(part)), F.lit(ending)).otherwise(out)
    return out


def review_url(link: Column) -> Column:
    """Address of a movie's review list."""
    return F.concat(F.regexp_replace(link, "/+$", ""), F.lit("/comments?status=P"))


def absolute_url(base: Column, link: Column) -> Column:
    """``link`` seen from page ``base``: empty, absolute, rooted, query-only or relative."""
    site = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    page = F.regexp_extract(base, r"^([^?#]*)", 1)
    folder = F.regexp_extract(page, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/]*.*/)", 1)
    has_folder = page.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*/")
    return (
        F.when(link == "", base)
        .when(link.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(F.regexp_extract(base, r"^([^:]*:)", 1), link))
        .when(link.startswith("/"), F.concat(site, link))
        .when(link.startswith("?"), F.concat(page, link))
        .otherwise(F.concat(F.when(has_folder, folder).otherwise(F.concat(site, F.lit("/"))), link))
    )
