"""Main text of HTML pages by two passes of block rules.

A page becomes blocks of text between block-level tags. The first pass decides a block where its place,
link density, length and density of stop words are clear: navigation, footers, forms, adverts and comments
are bad, long running text is good. The second pass gives the short and ambiguous blocks the label of the
nearest decided neighbours; inside an article element the neighbours are those of the article.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship, slices, table
from .registry import QUERIES

ship(__name__)

MANY_LINKS, FEW_STOPS, MANY_STOPS = 0.4, 0.15, 0.3
SHORT, LONG = 70, 200  # characters

# Frequent function words of the languages at hand.
STOP_WORDS = frozenset(
    """the of and to in a is that for it was on are as with they be at this have from or by but not were his her
    der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an er so bei oder
    le la les de des et un une du en que qui est pour dans par pas sur au aux avec ce il elle sont ou leur
    el los las y en que un una del se por con no su para es al lo como más pero sus o fue""".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    """address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 header hr html label legend li main menu nav ol option p pre section select
    summary table tbody td tfoot th thead tr ul""".split()
)
BAD_TAGS = frozenset("nav footer aside form button select option menu dialog fieldset label head".split())
HINTS = frozenset(
    """ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav
    navbar navigation breadcrumb breadcrumbs footer comment comments disqus respond reply replies cookie cookies consent
    gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social
    related recommended recommendations widget toolbar pagination pager search copyright legal skip teaser""".split()
)
# Hints that hold however much text stands there: what readers write, and the page's own furniture.
FIRM_HINTS = frozenset(
    "comment comments disqus respond reply replies nav navbar navigation menu footer cookie cookies consent gdpr breadcrumb breadcrumbs".split()
)
NEGATIONS = ("no-", "has-", "with-", "without-", "hide-", "is-")  # a class "no-sidebar" does not name what its element is
OUTER_HINTS = frozenset("header masthead topbar".split())  # bad outside the article only
ROLES = frozenset("navigation banner contentinfo complementary search form menu alert dialog".split())
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|iframe|svg|title)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)>"
    r"|<[!?][^>]*>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s\"'>]+)))?")  # in order, so that no name is found inside a value
HEADING = re.compile("h[1-6]")
LETTERS = re.compile(r"[^\W\d_]+")


NOT_BAD, HINTED, BAD = 0, 1, 2


def _badness(tag: str, rest: str, in_article: bool) -> int:
    """BAD: an element holds no main text, by its name and attributes. HINTED: a class or id says so, which its text may outweigh."""
    if tag in BAD_TAGS or (tag == "header" and not in_article):
        return BAD
    found = NOT_BAD
    for name, a, b, c in ATTRIBUTE.findall(rest):
        name, value = name.lower(), (a or b or c).lower()
        if name in ("class", "id"):
            words = {w for part in value.split() if not part.startswith(NEGATIONS) for w in re.split(r"[^a-z0-9]+", part)}
            if words & FIRM_HINTS and tag not in ("html", "body", "main"):
                return BAD
            if tag in ("html", "body", "main", "article"):
                continue  # what else such an element is called tells nothing of its text
            if words & HINTS or (words & OUTER_HINTS and not in_article and not words & {"article", "post", "entry"}):
                found = HINTED
        elif name == "role" and value in ROLES and tag not in ("html", "body", "main", "article"):
            return BAD
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            return BAD
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return BAD
    return found


def blocks(page: str) -> list[tuple[str, int, bool, int, bool]]:
    """(text, characters inside links, inside a bad element, number of the article or 0, heading) of each block in page order."""
    out: list[tuple[str, int, bool, int, bool]] = []
    pieces: list[str] = []
    linked = articles = links = bad = dropped = 0
    stack: list[tuple[str, int, int]] = []  # element, badness, number of the article it opens
    hinted: list[int] = []  # numbers of the open block elements that are bad by hint only
    under: list[tuple[int, ...]] = []  # per block the hinted elements around it
    plain: Counter[int] = Counter()  # characters outside links per hinted element; 0 for the page
    hints = 0
    inside: list[int] = []
    opened: Counter[str] = Counter()

    def flush() -> None:
        nonlocal linked
        text = " ".join(html_lib.unescape("".join(pieces)).split())
        if text:
            heading = any(HEADING.fullmatch(tag) for tag, _, _ in stack[-3:])
            out.append((text, linked, bad > 0, inside[-1] if inside else 0, heading))
            under.append(tuple(hinted))
            if not bad:
                plain.update({number: len(text) - linked for number in (0, *hinted)})
        pieces.clear()
        linked = 0

    def pop() -> None:
        nonlocal bad, links, dropped
        tag, was_bad, number = stack.pop()
        opened[tag] -= 1
        if was_bad and tag not in BLOCK:
            dropped -= 1
        elif was_bad == BAD:
            bad -= 1
        elif was_bad:
            hinted.pop()
        links -= tag == "a"
        if number:
            inside.pop()

    def add(text: str) -> None:
        nonlocal linked
        if dropped:
            return  # inside a bad element within a line
        pieces.append(text)
        if links:
            linked += len("".join(html_lib.unescape(text).split()))

    at = 0
    for token in TOKEN.finditer(page):
        if token.start() > at:
            add(page[at : token.start()])
        at = token.end()
        tag = (token["tag"] or token["tag2"] or "").lower()
        if not tag:
            continue
        if tag in ("br", "wbr"):
            pieces.append(" " if tag == "br" else "")
            continue
        if tag in BLOCK:
            flush()
        if token["close"] or token["close2"]:
            # an end tag closes what is open inside its element, and nothing without one
            if opened[tag]:
                while stack[-1][0] != tag:
                    pop()
                pop()
            continue
        if tag in VOID:
            continue
        # a page's main part does not lie inside its navigation, however badly that was closed
        if tag in ("body", "main", "article"):
            while stack and stack[-1][0] in ("nav", "header", "head", "ul", "ol", "li", "a", "p"):
                pop()
        elif tag in BLOCK:
            while stack and stack[-1][0] == "p":
                pop()
        if tag == "a" and stack and stack[-1][0] == "a":
            pop()
        rest = (token["rest"] if token["tag"] else token["rest2"]) or ""
        found = _badness(tag, rest, bool(inside))
        number = 0
        if tag in ("article", "main") and not found and not bad:
            articles += 1
            number = articles
            inside.append(number)
        stack.append((tag, found, number))
        opened[tag] += 1
        if found and tag not in BLOCK:
            dropped += 1
        elif found == BAD:
            bad += 1
        elif found:
            hints += 1
            hinted.append(hints)
        links += tag == "a"
    if at < len(page):
        add(page[at:])
    flush()
    # an element that holds most of the page's text outside links is its main part, whatever it is called
    weak = {number for number, held in plain.items() if number and 2 * held > plain[0]}
    return [(t, k, bad_ or not weak.issuperset(around), a, h) for (t, k, bad_, a, h), around in zip(out, under, strict=True)]


def _weight(text: str) -> int:
    """Length of a text; a character of a script that writes words in one or two of them counts as three."""
    return len(text) + 2 * sum("\u3040" <= c <= "\u9fff" or "\uac00" <= c <= "\ud7a3" for c in text)


def _stop_share(text: str, stops: frozenset[str]) -> float:
    words = LETTERS.findall(text.lower())
    return sum(w in stops for w in words) / max(len(words), 1)


def _page_stops(found: list[tuple[str, int, bool, int, bool]]) -> frozenset[str] | None:
    """The stop words for a page: the fixed ones and, where its long blocks hold none of those, its own frequent short words; None if it has none either."""
    long = [text for text, linked, bad, _, _ in found if not bad and not linked and len(text) >= SHORT]
    if not long or any(_stop_share(text, STOP_WORDS) >= FEW_STOPS for text in long):
        return STOP_WORDS
    counts = Counter(w for text in long for w in LETTERS.findall(text.lower()) if len(w) <= 4)
    own = frozenset(w for w, n in counts.most_common(20) if n >= 3)
    return STOP_WORDS | own if any(_stop_share(text, own) >= FEW_STOPS for text in long) else None


def _decide(text: str, linked: int, bad: bool, article: int, stop_words: frozenset[str] | None = STOP_WORDS) -> bool | None:
    """First pass: True good, False bad, None ambiguous. Without stop words a long block free of links is good."""
    if bad:
        return False
    dense = len(text.replace(" ", ""))
    if linked > MANY_LINKS * dense:
        return False
    stops = _stop_share(text, STOP_WORDS if stop_words is None else stop_words)
    if article:
        # an article's own text may lack known stop words; only its short blocks are open
        return True if len(text) >= SHORT or stops >= MANY_STOPS else None
    if _weight(text) < SHORT:
        return False if linked else None
    if stop_words is None and not linked and _weight(text) >= LONG:
        return True
    if stops >= MANY_STOPS and len(text) >= LONG:
        return True
    if stops >= FEW_STOPS:
        return True if len(text) >= LONG else None
    return False if linked else None


def main_text(page: str | None) -> str:
    """The blocks of the main text, joined by an empty line; '' where there is none."""
    found = blocks(page or "")
    articles = any(b[3] for b in found)
    stop_words = STOP_WORDS if articles else _page_stops(found)
    first = [_decide(*b[:4], stop_words) for b in found]
    if articles:
        # with an article on the page, text outside of it is decided against
        first = [label if b[3] else False for label, b in zip(first, found, strict=True)]
    before: list[tuple[int, bool] | None] = []
    last: dict[int, tuple[int, bool]] = {}
    for i, (label, b) in enumerate(zip(first, found, strict=True)):
        before.append(last.get(b[3]))
        if label is not None:
            last[b[3]] = (i, label)
    after: list[tuple[int, bool] | None] = []
    last = {}
    for i in range(len(found) - 1, -1, -1):
        after.append(last.get(found[i][3]))
        if first[i] is not None:
            last[found[i][3]] = (i, first[i])
    after.reverse()
    kept = []
    for i, (label, b) in enumerate(zip(first, found, strict=True)):
        if label is None:
            near = [x for x in (before[i], after[i]) if x]
            if not near:
                label = bool(b[3])
            elif len(near) == 2 and near[0][1] != near[1][1]:
                gaps = [abs(i - x[0]) for x in near]
                # between a good and a bad block the nearer decides; in a tie, articles keep and headings go with what follows
                tie = bool(b[3]) or (b[4] and near[1][1])
                label = tie if gaps[0] == gaps[1] else near[gaps.index(min(gaps))][1]
            else:
                label = near[0][1]
        if label:
            kept.append(b[0])
    return "\n\n".join(kept)


def extract_main(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` (its code points) added or replaced, from the whole ``html``.

    NULL, '' and pages without main text have ''. White space inside a block is one blank, blocks are joined by
    two line feeds. Broken markup is read as far as it goes; what follows the last tag counts as text. Repeated
    rows get equal results; other columns stay; an empty table stays empty.
    """
    kept = [c for c in pages.columns if c not in (text, "n_chars")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, html):
                found = [main_text(page) for page in part.column(html).to_pylist()]
                columns = [part.column(c) for c in kept]
                columns += [pa.array(found, pa.string()), pa.array([len(x) for x in found], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, text, "n_chars"])

    schema = pages.select(*kept).schema.add(text, "string").add("n_chars", "long")
    return pages.select(*kept).mapInArrow(run, schema)


def op1_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_main(pages).select("page_id", "url", F.col("text"), "n_chars")


QUERIES["op1_html_main_text"] = op1_html_main_text
