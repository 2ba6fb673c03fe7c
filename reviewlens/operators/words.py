"""Tokens, keywords and term weights."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.texts import delete_other
from ..session import freeze, scratch_dir, send_by_value
from .stats import ranked, row_count, value_counts

send_by_value(__name__)

# A dictionary is a word list of its own, not a table that grows with the texts.
MAX_DICTIONARY_BYTES = 64 * 1024 * 1024
# What a task cuts at a time and the runs it remembers, see ``dictionary_splitter``.
SLICE_BYTES = 1 << 20
REMEMBERED = 50_000
REMEMBERED_LENGTH = 64
# How often a counted run is repeated at a time.
REPEATS = 4096
SALTS = 16
# A word with more than one in HOT_PART of all occurrences is dealt out; there are at most HOT_PART such words.
HOT_PART = 4096

Splitter = Callable[[Column], Column]


def split_runs(text: Column) -> Column:
    """Runs of Chinese characters and runs of other characters."""
    return F.regexp_extract_all(text, F.lit(P.RUN), 0)


def split_pairs(text: Column) -> Column:
    """As ``split_runs``, with a long Chinese run as its overlapping character pairs."""

    def pairs(run: Column) -> Column:
        at = F.sequence(F.lit(1), F.length(run) - 1)
        return F.when(run.rlike(f"^[{P.CJK}]{{3,}}$"), F.transform(at, lambda i: F.substr(run, i, F.lit(2)))).otherwise(
            F.array(run)
        )

    return F.flatten(F.transform(split_runs(text), pairs))


def longest_matches(run: str, words: frozenset[str], longest: int) -> list[str]:
    """Cut ``run`` from the left into the longest dictionary words; a character in none stands alone."""
    out, at = [], 0
    while at < len(run):
        size = next((n for n in range(min(longest, len(run) - at), 1, -1) if run[at : at + n] in words), 1)
        out.append(run[at : at + size])
        at += size
    return out


def text_slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """``texts`` in slices of about ``most`` bytes; a longer text is a slice of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        before = int(ends[at - 1]) if at else 0
        stop = max(int(np.searchsorted(ends, before + most, side="right")), at + 1)
        yield texts.slice(at, stop - at)
        at = stop


def dictionary_splitter(df: DataFrame, dictionary: Iterable[str]) -> Splitter:
    """Splitter by forward longest match; the words are sent to each executor once.

    A text goes to Python and back as one string with a space between tokens, which costs Arrow far
    less than arrays do. Texts are Python objects a slice at a time, and only short runs are remembered, so a task's
    memory follows its Arrow batch and the longest text.
    """
    words = frozenset(w for w in dictionary if w)
    if sum(len(w.encode()) for w in words) > MAX_DICTIONARY_BYTES:
        raise ValueError(f"dictionary is over {MAX_DICTIONARY_BYTES} bytes")
    shared = df.sparkSession.sparkContext.broadcast((words, max(map(len, words), default=1)))

    @F.arrow_udf("string")
    def cut(texts: pa.Array) -> pa.Array:
        known, longest = shared.value

        def split(run: str) -> str:
            return " ".join(longest_matches(run, known, longest))

        remembered = lru_cache(maxsize=REMEMBERED)(split)

        def tokens_of(text: str) -> str:
            return " ".join(remembered(run) if len(run) <= REMEMBERED_LENGTH else split(run) for run in text.split(" "))

        done = [
            pa.array([None if text is None else tokens_of(text) for text in part.to_pylist()], pa.string()) for part in text_slices(texts)
        ]
        return pa.concat_arrays(done) if done else pa.array([], pa.string())

    return lambda text: F.split(cut(F.array_join(split_runs(text), " ")), " ")


def best_routes(lengths: np.ndarray, owner: np.ndarray, start: np.ndarray, size: np.ndarray, share: np.ndarray, alone: float) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of the words along which many runs are cut, so that the sum of their ``share`` is largest; ties to the longer word.

    ``lengths`` are those of the runs; run ``owner`` has a word of ``size`` at ``start`` (from 0) with the logarithm ``share``. A character
    that is no word of its own has ``alone``. Returns where each run's places begin, and by the place ``r`` characters from
    the end of a run the size of the word that starts there. All runs are worked on together, a place after the other from their ends.
    """
    first = np.concatenate(([0], np.cumsum(lengths + 1)))
    best, step = np.zeros(first[-1]), np.ones(first[-1], np.int64)
    single = np.full(first[-1], alone)
    rest = lengths[owner] - start
    one = size == 1
    single[first[owner[one]] + rest[one]] = share[one]
    order = np.flatnonzero(~one)
    order = order[np.argsort(rest[order], kind="stable")]
    at, back, value, rest = first[owner[order]] + rest[order], size[order], share[order], rest[order]
    long_first = np.argsort(-lengths, kind="stable")
    starts = first[long_first]
    longest = int(lengths.max(initial=0))
    running = np.searchsorted(-lengths[long_first], -np.arange(1, longest + 1), side="right")
    bounds = np.searchsorted(rest, np.arange(1, longest + 2))
    for r in range(1, longest + 1):
        places = starts[: running[r - 1]] + r
        best[places] = single[places] + best[places - 1]
        a, b = bounds[r - 1], bounds[r]
        if a < b:
            spots, sizes = at[a:b], back[a:b]
            sums = value[a:b] + best[spots - sizes]
            np.maximum.at(best, spots, sums)
            top = sums == best[spots]
            np.maximum.at(step, spots[top], sizes[top])
    return first, step


def run_words(runs: DataFrame, dictionary: DataFrame, run: str = "run", word: str = "word", frequency: str = "n") -> DataFrame:
    """(run, words) of the distinct values of ``run``, cut along the best route through a dictionary table of any size.

    The substrings of a run that are words are found by a join, so the dictionary is neither broadcast nor held by a task;
    a task holds one run's words at a time.
    """
    distinct = runs.select(F.col(run).alias("run")).where(F.length("run") > 0).distinct()
    known = dictionary.groupBy(F.col(word).alias("word")).agg(F.sum(frequency).cast("double").alias("frequency"))
    # written, so that its size is known when the join is planned: a small one spares the substrings a shuffle
    path = scratch_dir(known.sparkSession, "dictionary")
    known.write.parquet(path)
    known = known.sparkSession.read.schema(known.schema).parquet(path)
    facts = known.agg(F.struct(F.max(F.length("word")).alias("longest"), F.sum("frequency").alias("total")).alias("facts")).scalar()
    starts = distinct.select("run", F.explode(F.sequence(F.lit(1), F.length("run"))).alias("start"))
    most = F.least(F.coalesce(facts.getField("longest"), F.lit(1)), F.length("run") - F.col("start") + 1)
    pieces = starts.select("run", "start", F.explode(F.sequence(F.lit(1), most)).alias("size")).select(
        "run", "start", "size", F.substr("run", F.col("start"), F.col("size")).alias("word")
    )
    met = pieces.join(known, "word").groupBy("run").agg(F.collect_list(F.struct("start", "size", "frequency")).alias("found"))
    total = F.coalesce(facts.getField("total"), F.lit(1.0))
    rows = distinct.join(met, "run", "left").select("run", "found", total.alias("total"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = batch.column("total")[0].as_py()
            lengths = pc.utf8_length(batch.column("run")).to_numpy(zero_copy_only=False).astype(np.int64)
            found = batch.column("found")
            owner = np.repeat(np.arange(batch.num_rows), pc.fill_null(pc.list_value_length(found), 0).to_numpy(zero_copy_only=False))
            start, size, count = (pc.struct_field(found.flatten(), i).to_numpy(zero_copy_only=False) for i in range(3))
            counts, which = np.unique(count, return_inverse=True)
            share = np.array([math.log(max(f, 1.0) / whole) for f in counts.tolist()])[which]
            first, step = best_routes(lengths, owner, start.astype(np.int64) - 1, size.astype(np.int64), share, math.log(1.0 / whole))
            words, ends = [], [0]
            for run_, base, left in zip(batch.column("run").to_pylist(), first.tolist(), lengths.tolist(), strict=False):
                steps, at = step[base : base + left + 1].tolist(), 0
                while at < left:
                    words.append(run_[at : at + steps[left - at]])
                    at += steps[left - at]
                ends.append(len(words))
            listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(words, pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column("run"), listed], names=["run", "words"])

    return rows.mapInArrow(cut, "run string, words array<string>")


def dictionary_tokens(
    df: DataFrame, col: str, dictionary: DataFrame, *ids: str, keep: str = P.KEEP_MIXED, min_len: int = 2, word: str = "word",
    frequency: str = "n",
) -> DataFrame:
    """(ids, token): as ``tokens`` with the best route through a dictionary table. Every distinct run is cut once.

    The texts are read once; a run that repeats under the same ids is counted, joined as one row and repeated afterwards, in
    arrays of at most ``REPEATS``.
    """
    runs = df.select(*ids, F.explode(split_runs(delete_other(F.col(col), keep))).alias("run"))
    times, part = "__times", "__part"
    counted = freeze(runs.groupBy(*ids, "run").agg(F.count(F.lit(1)).alias(times)))
    met = counted.join(run_words(counted, dictionary, "run", word, frequency), "run")
    cut = met.select(*ids, times, F.explode("words").alias("token")).where(F.length("token") >= min_len)
    parts = cut.select(*ids, "token", times, F.explode(F.sequence(F.lit(0), F.floor((F.col(times) - 1) / REPEATS))).alias(part))
    here = F.least(F.lit(REPEATS), F.col(times) - F.col(part) * REPEATS).cast("int")
    return parts.select(*ids, "token", F.explode(F.sequence(F.lit(1), here)).alias(part)).select(*ids, "token")


def tokens(
    df: DataFrame,
    col: str,
    *ids: str,
    keep: str = P.KEEP_MIXED,
    stop: Sequence[str] = (),
    min_len: int = 2,
    splitter: Splitter = split_runs,
) -> DataFrame:
    """(ids, token), one row per token of the cleaned text; stop words and short tokens left out."""
    cut = df.select(*ids, F.explode(splitter(delete_other(F.col(col), keep))).alias("token"))
    kept = cut.where(F.length("token") >= min_len)
    return kept.where(~F.col("token").isin(*stop)) if stop else kept


def without(counts: DataFrame, stop: DataFrame, col: str = "token") -> DataFrame:
    """Counts of the tokens that are not in the table ``stop``. Joins after counting, not before."""
    return counts.join(stop.select(col), col, "left_anti")


def keywords(df: DataFrame, col: str, top: int = 20, **options) -> DataFrame:
    """(rank, token, n): the most frequent tokens."""
    return value_counts(tokens(df, col, **options), "token", top)


def _weighted(top_rows: DataFrame) -> DataFrame:
    return top_rows.withColumn("weight", F.col("n") / F.max("n").over(W.partitionBy()))


def term_weights(df: DataFrame, col: str, top: int = 300, **options) -> DataFrame:
    """(rank, token, n, weight): frequency of the ``top`` tokens over that of the first."""
    return _weighted(keywords(df, col, top, **options))


def _neighbours(words: Column) -> Column:
    """Array of (first, second) for each pair of adjacent elements."""
    inner = F.greatest(F.size(words) - 1, F.lit(0))
    return F.arrays_zip(
        F.slice(words, F.lit(1), inner).alias("first"), F.slice(words, F.lit(2), inner).alias("second")
    )


def kept_words(
    col: str, keep: str = P.KEEP_MIXED, stop: Sequence[str] = (), min_len: int = 2, splitter: Splitter = split_runs
) -> Column:
    """Array of a text's tokens without stop words and short tokens."""

    def wanted(word: Column) -> Column:
        long_enough = F.length(word) >= min_len
        return long_enough & ~word.isin(*stop) if stop else long_enough

    return F.filter(splitter(delete_other(F.col(col), keep)), wanted)


def term_bigrams(df: DataFrame, col: str, top: int = 300, **options) -> DataFrame:
    """(rank, first, second, n, weight): the most frequent neighbours, stop words already out."""
    words = df.select(kept_words(col, **options).alias("w"))
    counts = words.select(F.inline(_neighbours(F.col("w")))).groupBy("first", "second").agg(row_count())
    return _weighted(ranked(counts, top, "first", "second"))


def term_counts(df: DataFrame, col: str, **options) -> DataFrame:
    """(first, second, n): counts of tokens (``second`` is NULL) and of neighbours, from one pass.

    Frozen, as its users read it several times and it is far smaller than the texts.
    """
    words = df.select(kept_words(col, **options).alias("w"))
    single = F.transform("w", lambda x: F.struct(x.alias("first"), F.lit(None).cast("string").alias("second")))
    both = words.select(F.inline(F.concat(single, _neighbours(F.col("w")))))
    return freeze(both.groupBy("first", "second").agg(row_count()))


def _log_likelihood(k: Column, n: Column, x: Column) -> Column:
    """Logarithm of x^k (1-x)^(n-k), x kept inside (0, 1)."""
    bounded = F.greatest(x, F.lit(1e-10))
    return F.log(bounded) * k + F.log(F.greatest(1 - x, F.lit(1e-10))) * (n - k)


def collocations(counts: DataFrame, threshold: float = 30) -> DataFrame:
    """(first, second, n, score) for neighbours in ``term_counts`` that meet more often than chance.

    The score is Dunning's likelihood ratio; pairs at or below ``threshold`` are left out.
    """
    words = counts.where(F.col("second").isNull()).select(F.col("first").alias("token"), F.col("n").alias("c"))
    total = words.agg(F.sum("c").cast("double")).scalar()
    # A frequent word has very many neighbours: its pairs are dealt out over the salts on both sides. Such words are few
    # whatever the corpus, so the pairs learn by a broadcast which they are; all other words join as they are.
    frequent = F.col("c") * HOT_PART > total
    marks = F.broadcast(words.where(frequent).select(F.col("token").alias("hot")))
    salts = F.when(frequent, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    sides = words.select("token", "c", F.explode(salts).alias("salt"))

    def with_count(pairs: DataFrame, word: str, other: str, name: str) -> DataFrame:
        side = sides.select(F.col("token").alias(word), F.col("c").alias(name), "salt")
        part = F.when(F.col("hot").isNotNull(), F.pmod(F.xxhash64(other), F.lit(SALTS))).otherwise(F.lit(0))
        dealt = pairs.join(marks, F.col(word) == F.col("hot"), "left").withColumn("salt", part.cast("int")).drop("hot")
        return dealt.join(side, [word, "salt"]).drop("salt")

    pairs = counts.where(F.col("second").isNotNull())
    joined = with_count(with_count(pairs, "first", "second", "c1"), "second", "first", "c2").withColumn("total", total)
    n12, c1, c2, t = (F.col(c).cast("double") for c in ("n", "c1", "c2", "total"))
    # A text of one distinct word leaves nothing outside c1; the pair is then expected anyway.
    p, p1, p2 = c2 / t, n12 / c1, F.coalesce(F.try_divide(c2 - n12, t - c1), F.lit(0.0))
    score = -2 * (
        _log_likelihood(n12, c1, p)
        + _log_likelihood(c2 - n12, t - c1, p)
        - _log_likelihood(n12, c1, p1)
        - _log_likelihood(c2 - n12, t - c1, p2)
    )
    return joined.select("first", "second", "n", score.alias("score")).where(F.col("score") > threshold)


def cloud_terms(df: DataFrame, col: str, top: int = 300, threshold: float = 30, **options) -> DataFrame:
    """(rank, term, n, weight) of words and collocations together.

    A collocation counts as a term of its own and its occurrences no longer count for its two words.
    """
    counts = term_counts(df, col, **options)
    # Each found pair gives three rows at once: itself, and what its words lose.
    found = collocations(counts, threshold).select(
        F.explode(
            F.array(
                F.struct(F.concat_ws(" ", "first", "second").alias("term"), F.col("n").alias("n")),
                F.struct(F.col("first").alias("term"), (-F.col("n")).alias("n")),
                F.struct(F.col("second").alias("term"), (-F.col("n")).alias("n")),
            )
        ).alias("t")
    )
    words = counts.where(F.col("second").isNull()).select(F.col("first").alias("term"), "n")
    merged = words.unionAll(found.select("t.term", "t.n")).groupBy("term").agg(F.sum("n").alias("n"))
    return _weighted(ranked(merged.where(F.col("n") > 0), top, "term"))
