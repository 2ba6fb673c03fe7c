"""Expressions over regular HTML. Irregular pages go through ``operators.extract``."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .texts import or_default, strip

# The entities regular pages use.
ENTITIES = [
    ("&nbsp;", " "),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&amp;", "&"),
]


def open_tag(tag: str, cls: str | None = None) -> str:
    """Pattern of an opening tag, with ``cls`` among its classes if given."""
    tag = re.escape(tag)
    if cls is None:
        return f"<{tag}(?:[ \\t\\r\\n][^>]*)?>"
    return f'<{tag}[ \\t\\r\\n][^>]*class="(?:[^">]* )?{re.escape(cls)}(?: [^">]*)?"[^>]*>'


def decode(col: Column) -> Column:
    """The entities of ``ENTITIES`` as characters."""
    for entity, char in ENTITIES:
        col = F.replace(col, F.lit(entity), F.lit(char))
    return col


def first_text(html: Column, tag: str, cls: str | None = None, default: str = "") -> Column:
    """Text right after the first ``tag``, up to the next tag."""
    found = F.regexp_extract(html, open_tag(tag, cls) + "([^<]*)", 1)
    return or_default(strip(decode(found)), default)


def all_texts(html: Column, tag: str, cls: str | None = None) -> Column:
    """Array of the texts right after each ``tag``, stripped."""
    found = F.regexp_extract_all(html, F.lit(open_tag(tag, cls) + "([^<]*)"), 1)
    return F.transform(found, lambda x: strip(decode(x)))


def join_texts(texts: Column, sep: str) -> Column:
    """The texts that are not empty, joined."""
    return F.array_join(F.filter(texts, lambda x: x != ""), sep)


def first_attribute(html: Column, tag: str, attr: str, default: str = "") -> Column:
    """Attribute of the first ``tag`` that has it."""
    found = F.regexp_extract(html, f'<{re.escape(tag)}[ \\t\\r\\n][^>]*?{re.escape(attr)}="([^"]*)"', 1)
    return or_default(strip(decode(found)), default)


def marked_number(texts: Column, mark: str) -> Column:
    """Number of the first text holding ``mark``: mark and commas removed, else 0."""
    hit = F.get(F.filter(texts, lambda x: F.contains(x, F.lit(mark))), F.lit(0))
    bare = strip(F.replace(F.replace(hit, F.lit(mark), F.lit("")), F.lit(","), F.lit("")))
    return F.coalesce(F.when(bare.rlike("^[0-9]+$"), bare.try_cast("bigint")), F.lit(0).cast("bigint"))
