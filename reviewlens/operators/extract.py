"""Repeated blocks of irregular HTML as rows.

Pages are read by the standard library's parser, a batch at a time inside ``mapInPandas``; Spark
splits the pages over tasks. Regular markup needs no Python: see ``functions.markup``.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import send_by_value

send_by_value(__name__)

ROWS_OUT = 5000  # rows handed on at once
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
# An open element of these kinds ends where the next of its kind starts.
IMPLIED_END = {"p": {"p"}, "li": {"li"}, "option": {"option"}, "tr": {"tr", "td"}, "td": {"td"}}


@dataclass
class Node:
    tag: str
    attrs: dict[str, str]
    parts: list = field(default_factory=list)

    def inside(self) -> Iterator[Node]:
        """Elements below this one, in document order."""
        stack = list(reversed(self.parts))
        while stack:
            part = stack.pop()
            if isinstance(part, Node):
                yield part
                stack.extend(reversed(part.parts))

    def text(self) -> str:
        out, stack = [], list(reversed(self.parts))
        while stack:
            part = stack.pop()
            if isinstance(part, Node):
                stack.extend(reversed(part.parts))
            else:
                out.append(part)
        return "".join(out)


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open = [Node("", {})]

    def handle_starttag(self, tag, attrs):
        ended = IMPLIED_END.get(tag, ())
        while self.open[-1].tag in ended:
            self.open.pop()
        node = Node(tag, {name: value or "" for name, value in attrs})
        self.open[-1].parts.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag == tag:
                del self.open[depth:]
                return

    def handle_data(self, data):
        self.open[-1].parts.append(data)


def parse(html: str) -> Node:
    tree = _Tree()
    tree.feed(html)
    tree.close()
    return tree.open[0]


def parsed_or_reason(html: str | None) -> tuple[Node | None, str | None]:
    """The tree of a page, or why the parser refuses it. Its refusals are plain AssertionErrors and ValueErrors."""
    try:
        return parse(html or ""), None
    except (AssertionError, ValueError) as refusal:
        return None, f"{type(refusal).__name__}: {refusal}"


@dataclass(frozen=True)
class Step:
    """An element kind: tag name, class, id and other attributes it must have."""

    tag: str
    cls: str | None = None
    having: tuple[tuple[str, str], ...] = ()

    def fits(self, node: Node) -> bool:
        return (
            node.tag == self.tag
            and (self.cls is None or self.cls in node.attrs.get("class", "").split())
            and all(node.attrs.get(name) == value for name, value in self.having)
        )


@dataclass(frozen=True)
class Pick:
    """Values below a block: the elements along ``path``, their text, own text nodes or an attribute.

    With ``where`` (attribute, text) only elements whose attribute holds the text count; with
    ``only_first`` the first element alone, which then may have no value.
    """

    path: tuple[Step, ...]
    attr: str | None = None
    own_text: bool = False
    every: bool = False
    where: tuple[str, str] | None = None
    only_first: bool = False

    def values(self, block: Node, inside: list[Node]) -> list[str]:
        """Values below ``block``, whose elements are ``inside``."""
        found = [node for node in inside if self.path[0].fits(node)] if self.path else [block]
        for step in self.path[1:]:
            seen: dict[int, Node] = {}
            for node in found:
                for below in node.inside():
                    if step.fits(below):
                        seen.setdefault(id(below), below)
            found = list(seen.values())
        if self.where is not None:
            found = [node for node in found if self.where[1] in node.attrs.get(self.where[0], "")]
        if self.only_first:
            found = found[:1]
        if self.attr is not None:
            return [node.attrs[self.attr] for node in found if self.attr in node.attrs]
        if self.own_text:
            return [part for node in found for part in node.parts if isinstance(part, str)]
        return [node.text() for node in found]


def pick(*path: str, **options) -> Pick:
    """``pick("div.hd", "a", attr="href")``: steps are ``tag`` or ``tag.class``, outermost first; options as in ``Pick``."""
    return Pick(tuple(step(p) for p in path), **options)


def step(text: str, **having: str) -> Step:
    tag, _, cls = text.partition(".")
    return Step(tag, cls or None, tuple(having.items()))


def explode_blocks(
    pages: DataFrame,
    block: Step,
    fields: Mapping[str, Pick],
    keep: Sequence[str] = ("page_id", "url"),
    html: str = "html",
) -> DataFrame:
    """(keep, position, fields): one row per ``block`` of a page, a page without any gives none.

    A page that the parser refuses gives none either; ``refused_pages`` lists those.
    A field is the first value of its pick, stripped and NULL when there is none; with ``every``
    it is the array of all values.
    """
    schema = T.StructType(
        [pages.schema[c] for c in keep]
        + [T.StructField("position", T.IntegerType())]
        + [
            T.StructField(name, T.ArrayType(T.StringType()) if p.every else T.StringType())
            for name, p in fields.items()
        ]
    )
    names = [f.name for f in schema.fields]
    picks = list(fields.values())
    keep = list(keep)

    def row_values(node: Node) -> list:
        out, inside = [], list(node.inside())
        for p in picks:
            values = [v.strip() for v in p.values(node, inside)]
            out.append(values if p.every else (values[0] if values else None))
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for *kept, text in batch[[*keep, html]].itertuples(index=False, name=None):
                tree, _ = parsed_or_reason(text)
                blocks = [n for n in tree.inside() if block.fits(n)] if tree else []
                for position, node in enumerate(blocks, start=1):
                    rows.append([*kept, position, *row_values(node)])
                    if len(rows) >= ROWS_OUT:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
            yield pd.DataFrame(rows, columns=names)

    return pages.select(*keep, html).mapInPandas(run, schema)


def block_function(spark: SparkSession, name: str, block: Step, fields: Mapping[str, Pick]) -> None:
    """Register ``explode_blocks`` as a table function for SQL: ``SELECT ... FROM pages, LATERAL name(html)`` gives (position, fields)."""
    types = ["position int", *(f"`{n}` {'array<string>' if p.every else 'string'}" for n, p in fields.items())]
    picks = list(fields.values())

    class Blocks:
        def eval(self, html: str) -> Iterator[tuple]:
            tree, _ = parsed_or_reason(html)
            for position, node in enumerate([n for n in tree.inside() if block.fits(n)] if tree else [], start=1):
                inside = list(node.inside())
                values = [[v.strip() for v in p.values(node, inside)] for p in picks]
                yield (position, *(v if p.every else (v[0] if v else None) for p, v in zip(picks, values, strict=True)))

    spark.udtf.register(name, F.udtf(Blocks, returnType=", ".join(types), useArrow=True))


def refused_pages(pages: DataFrame, keep: Sequence[str] = ("page_id", "url"), html: str = "html") -> DataFrame:
    """(keep, reason) of the pages that the parser refuses, so that none is lost silently."""
    keep = list(keep)
    schema = T.StructType([pages.schema[c] for c in keep] + [T.StructField("reason", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for *kept, text in batch[[*keep, html]].itertuples(index=False, name=None):
                _, reason = parsed_or_reason(text)
                if reason:
                    rows.append([*kept, reason])
            yield pd.DataFrame(rows, columns=[*keep, "reason"])

    return pages.select(*keep, html).mapInPandas(run, schema)
