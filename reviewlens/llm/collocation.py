"""Phrase collocation mining by top-order marginalisation.

Every word occurrence is given its following words by a lead over its piece, padded with '' where the
piece ends: its longest window. Only these windows are counted. One ROLLUP over (lang, w1, w2, ...) then
sums them to successively shorter prefixes, which are the counts of all shorter phrases, of words and
of the language: no n-gram of another length is ever exploded.

Windows are counted once inside each slice of text before they are shuffled, in sorted order, so that a
row costs few bytes. They are dealt out by all words but the last, so that a prefix meets whole: windows and prefixes
that turn out rarer than the smallest count are folded into their own shorter prefix before the
ROLLUP, which leaves their sums as they are and the ROLLUP's shuffle small. Prefixes with a large share
of all windows (a bounded list, found by a first pass) are dealt out by the last word as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import flat, lower_ascii, ship, slices, stored, table, word_spans
from .registry import ORACLE, QUERIES

ship(__name__)

LONGEST = 3
SHORTEST = 2
LEAST = 10
TOP = 2000
INSIDE_PERCENT = 50
SLICE = 1 << 22
HOT_SHARE = 256  # a prefix with more than one in so many windows of a slice is reported as hot; so at most that many in all
SALTS = 64
TOP_PARTS = 32
BREAKS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"


def word_table(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(index of each span's word in the sorted distinct words, those words)."""
    lengths = ends - starts
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    places = np.repeat(starts - offsets[:-1], lengths) + np.arange(offsets[-1])
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data[places].tobytes()))
    coded = words.dictionary_encode()
    distinct = coded.dictionary
    order = pc.sort_indices(distinct.cast(pa.large_binary())).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank[coded.indices.to_numpy()], distinct.take(pa.array(order))


def windows(codes: np.ndarray, pieces: np.ndarray, longest: int) -> list[np.ndarray]:
    """Of every word occurrence the words that follow it in its piece: columns of codes from 1, 0 is padding."""
    columns = [codes + 1]
    for step in range(1, longest):
        after = np.zeros(len(codes), np.int64)
        same = pieces[step:] == pieces[:-step]
        after[: len(codes) - step][same] = codes[step:][same] + 1
        columns.append(after)
    return columns


def distinct_rows(columns: list[np.ndarray], many: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows of ``columns`` (values from 0 to ``many``) in order, and how often each stands there."""
    base = many + 1
    if base ** len(columns) < 1 << 63:
        key = columns[0].copy()
        for column in columns[1:]:
            key = key * base + column
        key, counts = np.unique(key, return_counts=True)
        out = []
        for _ in columns[1:]:
            out.append(key % base)
            key = key // base
        return [key, *out[::-1]], counts
    rows, counts = np.unique(np.stack(columns, axis=1), axis=0, return_counts=True)
    return list(rows.T), counts


def _window_rows(docs: DataFrame, longest: int, hot: set[str] | None) -> DataFrame:
    """(packed): the windows of each slice; or, ``hot`` None, (head, n): its frequent prefixes.

    A packed row is one text, which shuffles in the fewest bytes: salt (of hot heads only), words of the prefix and language, parted by
    blanks; a line feed; the last words, each with a tab and its count, parted by blanks. No word holds a blank, tab or line feed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lower = lower_ascii()
        breaks, blanks = np.zeros(256, bool), np.zeros(256, bool)
        breaks[list(BREAKS)] = True
        blanks[list(BLANKS)] = True
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                langs = part.column("lang").to_pylist()
                for lang in sorted(set(langs)):
                    own = part.filter(pa.array([x == lang for x in langs])) if len(set(langs)) > 1 else part
                    data, offsets = flat(own.column("text"))
                    data = lower[data]
                    ends_piece = breaks[data]
                    starts, ends = word_spans(~(ends_piece | blanks[data]), offsets)
                    if not len(starts):
                        continue
                    seen = np.concatenate(([0], np.cumsum(ends_piece, dtype=np.int32)))
                    pieces = seen[starts] + np.searchsorted(offsets[1:], starts, side="right")
                    codes, words = word_table(data, starts, ends)
                    many, every = len(words), len(codes)
                    del data, seen, ends_piece, starts, ends
                    width = longest - 1 if hot is None else longest
                    rows, counts = distinct_rows(windows(codes, pieces, longest)[:width], many)
                    spelt = pa.concat_arrays([pa.array([""], words.type), words])
                    blank = pa.scalar(" ", words.type)
                    spell = lambda column: spelt.take(pa.array(column))  # noqa: B023, E731
                    if hot is None:
                        much = np.flatnonzero(counts * HOT_SHARE > every)
                        heads = pc.binary_join_element_wise(*(spell(r[much]) for r in rows), pa.scalar(lang, words.type), blank)
                        yield pa.RecordBatch.from_arrays([heads.cast(pa.string()), pa.array(counts[much], pa.int64())], names=["head", "n"])
                        continue
                    new = np.ones(len(counts), bool)
                    new[1:] = np.logical_or.reduce([r[1:] != r[:-1] for r in rows[:-1]])
                    first = np.flatnonzero(new)
                    heads = pc.binary_join_element_wise(*(spell(r[first]) for r in rows[:-1]), pa.scalar(lang, words.type), blank)
                    salt = np.full(len(counts), -1, np.int32)
                    for at in np.flatnonzero(pc.is_in(heads, pa.array(sorted(hot), heads.type)).to_numpy(zero_copy_only=False)):
                        low, high = first[at], first[at + 1] if at + 1 < len(first) else len(counts)
                        salt[low:high] = [hash_text(w) % SALTS for w in spell(rows[-1][low:high]).to_pylist()]
                        # a hot head has a row of its own for every salt
                        order = low + np.argsort(salt[low:high], kind="stable")
                        rows[-1][low:high], counts[low:high], salt[low:high] = rows[-1][order], counts[order], salt[order]
                        new[low + 1 : high] |= salt[low + 1 : high] != salt[low : high - 1]
                    starts_at = np.flatnonzero(new)
                    heads = heads.take(pa.array(np.cumsum(np.isin(starts_at, first)) - 1))
                    pairs = pc.binary_join_element_wise(spell(rows[-1]), pa.array(counts).cast(words.type), pa.scalar("\t", words.type))
                    tails = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(starts_at, len(counts)).astype(np.int32)), pairs), blank)
                    salts = pa.array(["" if x < 0 else str(x) for x in range(-1, SALTS)], words.type).take(pa.array(salt[starts_at] + 1))
                    salted = pc.binary_join_element_wise(salts, heads, blank)
                    packed = pc.binary_join_element_wise(salted, tails, pa.scalar("\n", words.type)).cast(pa.string())
                    made = pa.RecordBatch.from_arrays([packed], names=["packed"])
                    del rows, counts, salt, salts, salted, packed, pairs, tails, heads, spelt, codes, pieces, words
                    for row in range(0, made.num_rows, 50_000):
                        yield made.slice(row, 50_000)

    return docs.mapInArrow(run, "head string, n long" if hot is None else "packed string")


def hash_text(word: str) -> int:
    """A number that depends on the word alone, the same in every process."""
    value = 0xCBF29CE484222325
    for byte in word.encode():
        value = (value ^ byte) * 0x100000001B3 % (1 << 64)
    return value


def phrase_counts(docs: DataFrame, text: str, lang: str, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """(lang, phrase: array of words, f) of words and phrases with ``f >= least``, and (lang, empty array, n); stored."""
    picked = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    picked = picked.where(F.length("text") > 0)
    heavy = _window_rows(picked, longest, None).groupBy("head").agg(F.sum("n").alias("n"))
    # the HOT_SHARE most frequent prefixes are dealt out by their last word as well
    hot = {r["head"] for r in heavy.orderBy(F.desc("n"), "head").limit(HOT_SHARE).collect()}
    size = F.length("packed") - F.length(F.substring_index("packed", "\n", -1)) - 1
    rows = _window_rows(picked, longest, hot).repartition(F.substr("packed", F.lit(1), size))
    tail = F.split("tail", "\t")
    single = rows.select(
        F.substr("packed", F.lit(1), size).alias("head"), F.explode(F.split(F.substring_index("packed", "\n", -1), " ")).alias("tail")
    ).select("head", tail[0].alias("last"), tail[1].cast("long").alias("n"))
    counted = single.groupBy("head", "last").agg(F.sum("n").alias("n"))
    # rare windows fold into their prefix, rare prefixes into what is before their last word
    whole = F.sum("n").over(Window.partitionBy("head"))
    frequent = (F.col("whole") >= least) | ~F.startswith("head", F.lit(" "))
    folded = counted.withColumn("whole", whole).select(
        F.when(frequent, F.regexp_replace("head", "^[0-9]* ", ""))
        .otherwise(F.regexp_replace("head", rf"^ ((?:[^ ]* ){{{longest - 2}}})[^ ]* ", "$1 ")).alias("head"),
        F.when(frequent & (F.col("n") >= least), F.col("last")).otherwise("").alias("last"), "n",
    )
    summed = folded.groupBy("head", "last").agg(F.sum("n").alias("n"))
    names = [f"w{k + 1}" for k in range(longest)]
    words = F.split("head", " ", longest)
    spread = summed.select(words[longest - 1].alias("lang"), *(words[k].alias(names[k]) for k in range(longest - 1)), F.col("last").alias(names[-1]), "n")
    level = F.grouping_id().alias("level")
    rolled = spread.rollup("lang", *names).agg(F.sum("n").alias("f"), level)
    phrases = []
    for size in range(longest + 1):
        at = F.col("level") == (1 << (longest - size)) - 1
        kept = at & (F.col("f") >= least) & (F.col(names[size - 1]) != "") if size else at
        phrases.append(F.when(kept, F.array(*names[:size]) if size else F.array().cast("array<string>")))
    out = rolled.select("lang", F.coalesce(*phrases).alias("phrase"), "f").where("lang IS NOT NULL AND phrase IS NOT NULL")
    return stored(out, "phrases")


def _exact_score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (left right)), exact below counts of 10**16."""
    wide = "decimal(19,0)"
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (a.cast("decimal(16,0)") * a.cast("decimal(16,0)")),
                           left.cast(wide) * right.cast(wide))


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", shortest: int = SHORTEST, longest: int = LONGEST,
    least: int = LEAST, inside_percent: int = INSIDE_PERCENT, top: int = TOP,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases by score.

    Words are runs without blanks and tabs inside pieces that ``. , ; : ! ?`` and line ends part; A-Z are lower-cased.
    A phrase of ``shortest`` to ``longest`` words is a candidate if it occurs ``least`` times (a), overlaps included. Of
    its cuts into a first part (l times) and a rest (r times) the one with the smallest floor(10**6 a a / (l r))
    counts, ties to the shortest first part. Candidates inside a longer candidate that occurs at least
    ``inside_percent`` percent as often go, whether or not that one goes too. Order: score descending, a
    descending, phrase (UTF-8 bytes). A NULL lang is 'und'; NULL and empty texts have no words; repeated rows count
    each time; other columns are not looked at; an empty table, or a language without candidates, gives no rows.
    """
    counts = phrase_counts(docs, text, lang, longest, least)
    totals = counts.where(F.size("phrase") == 0).select("lang", F.col("f").alias("n"))
    parts = counts.where(F.size("phrase") > 0).select("lang", F.concat_ws(" ", "phrase").alias("part"), F.col("f"))
    many = F.size("phrase")
    candidates = counts.where((many >= shortest) & (many >= 2)).select("lang", "phrase", F.concat_ws(" ", "phrase").alias("named"), F.col("f").alias("a"))
    cut = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), many - 1))).select(
        "lang", "named", "a", "k", F.concat_ws(" ", F.slice("phrase", F.lit(1), F.col("k"))).alias("first"),
        F.concat_ws(" ", F.slice("phrase", F.col("k") + 1, many - F.col("k"))).alias("rest"),
    )
    lefts = parts.select("lang", F.col("part").alias("first"), F.col("f").alias("l"))
    rights = parts.select("lang", F.col("part").alias("rest"), F.col("f").alias("r"))
    scored = cut.join(lefts, ["lang", "first"]).join(rights, ["lang", "rest"])
    scored = scored.withColumn("score", _exact_score(F.col("a"), F.col("l"), F.col("r")))
    best = scored.groupBy("lang", "named", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(shortest), many - 1),
            lambda size: F.transform(F.sequence(F.lit(1), many - size + 1), lambda at: F.concat_ws(" ", F.slice("phrase", at, size))),
        )
    )
    covers = candidates.where(many > shortest).select("lang", F.explode(F.array_distinct(spans)).alias("named"), F.col("a").alias("longer"))
    longer = covers.groupBy("lang", "named").agg(F.max("longer").alias("longer"))
    kept = best.join(longer, ["lang", "named"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * inside_percent)
    )
    # two steps, so that no language's candidates meet in one task: the first rows of each part, then of these
    order = [F.desc("best.score"), F.desc("a"), F.asc("named")]
    part = F.pmod(F.xxhash64("named"), F.lit(TOP_PARTS)).alias("part")
    firsts = kept.select("*", part).withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    ranked = firsts.where(F.col("place") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.where(F.col("rank") <= top).join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), F.col("named").alias("phrase"), "a", F.col("best.l").alias("l"),
        F.col("best.r").alias("r"), "n", F.col("best.score").cast("long").alias("score"),
    )


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


QUERIES["op13_collocations"] = op13_collocations
ORACLE["op13_collocations"] = r"""
WITH pieces AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n-\r]')) AS piece
  FROM documents),
listed AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM listed WHERE len(w) > 0),
grams AS (
  SELECT lang, unnest([w[i:i], w[i:i+1], w[i:i+2]]) AS p, unnest([1, 2, 3]) AS size, i, len(w) AS many FROM starts),
counts AS (SELECT lang, p, count(*) AS f FROM grams WHERE i + size - 1 <= many GROUP BY lang, p),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE len(p) = 1 GROUP BY lang),
cands AS (SELECT lang, p, f AS a FROM counts WHERE len(p) >= 2 AND f >= 10),
cuts AS (SELECT lang, p, a, unnest(generate_series(1, len(p) - 1)) AS k FROM cands),
scored AS (
  SELECT c.lang, c.p, c.a, c.k, l.f AS l, r.f AS r,
    (1000000::HUGEINT * c.a * c.a // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM cuts c JOIN counts l ON l.lang = c.lang AND l.p = c.p[1:c.k]
  JOIN counts r ON r.lang = c.lang AND r.p = c.p[c.k+1:len(c.p)]),
best AS (
  SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, k) AS place FROM scored QUALIFY place = 1),
covers AS (
  SELECT lang, p[1:2] AS p, a FROM cands WHERE len(p) = 3 UNION ALL SELECT lang, p[2:3], a FROM cands WHERE len(p) = 3),
longer AS (SELECT lang, p, max(a) AS longer FROM covers GROUP BY lang, p),
ranked AS (
  SELECT b.lang, array_to_string(b.p, ' ') AS phrase, b.a, b.l, b.r, b.score,
    row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, array_to_string(b.p, ' ')) AS rank
  FROM best b LEFT JOIN longer g ON g.lang = b.lang AND g.p = b.p
  WHERE g.longer IS NULL OR 100 * g.longer < 50 * b.a)
SELECT x.lang, x.rank, x.phrase, x.a, x.l, x.r, t.n, x.score FROM ranked x JOIN totals t ON t.lang = x.lang WHERE x.rank <= 2000
"""
