"""Language identification by cross-parsing: the language whose training text needs fewest phrases wins.

A suffix automaton of each language's training text accepts exactly the substrings of that text. A
text is parsed greedily: a phrase is the longest piece that the automaton still accepts, and the next
phrase starts after it. Phrases per symbol estimate the cross entropy with the language.

The automata are fitted on a bounded sample of labelled rows (``sample_chars`` symbols a language, from at
most ``sample_rows`` rows) and laid out as hash tables of state and symbol, whose size does not depend on the
number of letters, so that a task walks thousands of text blocks in step. Blocks of ``BLOCK`` symbols keep long texts from setting the pace; a phrase ends with its block.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import _FACTOR, ship, slices, table
from .registry import QUERIES

ship(__name__)

UNDETERMINED = "und"
BLOCK = 1024
SAMPLE_CHARS = 24_000
SAMPLE_ROWS = 200
PARTS = 64
SPACE = 0  # the symbol of everything that is no letter; runs of it count once


class Automaton(NamedTuple):
    """Transitions of a suffix automaton as three columns; ``size`` is one more than the largest symbol there can be."""

    state: np.ndarray
    symbol: np.ndarray
    target: np.ndarray
    size: int


def suffix_automaton(symbols: np.ndarray, size: int) -> Automaton:
    """Automaton of all substrings of ``symbols``; state 0 is the start, and no transition leads there."""
    follow: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols.tolist():
        new = len(follow)
        follow.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in follow[p]:
            follow[p][c] = new
            p = link[p]
        if p >= 0:
            q = follow[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(follow)
                follow.append(dict(follow[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and follow[p].get(c) == q:
                    follow[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    degrees = np.fromiter(map(len, follow), np.int64, len(follow))
    edges = int(degrees.sum())
    return Automaton(
        np.repeat(np.arange(len(follow)), degrees), np.fromiter((c for f in follow for c in f), np.int64, edges),
        np.fromiter((t for f in follow for t in f.values()), np.int64, edges), size,
    )


class Walk:
    """Transitions in a hash table with linear probing, at most a quarter full."""

    def __init__(self, automaton: Automaton) -> None:
        self.size = automaton.size
        self.bits = max(4, (4 * len(automaton.state)).bit_length())
        keys = automaton.state * self.size + automaton.symbol
        home = self.slots(keys)
        order = np.argsort(home, kind="stable")
        # in the order of their slots each key takes its own one or the next free one
        rank = np.arange(len(order))
        place = np.maximum.accumulate(home[order] - rank) + rank if len(order) else rank
        self.reach = int((place - home[order]).max(initial=0))
        cells = (1 << self.bits) + len(order) + 1
        self.keys, self.targets = np.full(cells, -1, np.int64), np.zeros(cells, np.int32)
        self.keys[place], self.targets[place] = keys[order], automaton.target[order]
        self.root = np.zeros(self.size, np.int64)
        first = automaton.state == 0
        self.root[automaton.symbol[first]] = automaton.target[first]

    @classmethod
    def of(cls, held: dict) -> Walk:
        made = cls.__new__(cls)
        vars(made).update(held)
        return made

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(_FACTOR)) >> np.uint64(64 - self.bits)).view(np.int64)

    def follow(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Next state for each pair, 0 where there is none."""
        keys = state * self.size + symbol
        at = self.slots(keys)
        held = self.keys[at]
        hit = held == keys
        out = np.where(hit, self.targets[at], 0)
        left = np.flatnonzero(~hit & (held >= 0))
        for further in range(1, self.reach + 1):
            if not len(left):
                break
            there = at[left] + further
            held = self.keys[there]
            hit = held == keys[left]
            out[left[hit]] = self.targets[there[hit]]
            left = left[~hit & (held >= 0)]
        return out


def walk_table(automaton: Automaton) -> Walk:
    """What ``count_phrases`` walks by.

    Where the phrase cannot go on, the next one starts with this symbol. A symbol that the training
    text lacks is a phrase of its own.
    """
    return Walk(automaton)


def letter_symbols(known: list[str]) -> np.ndarray:
    """Code point to symbol: 0 no letter, 1.. the known letters in any case, last any other letter."""
    number = {c: i + 1 for i, c in enumerate(known)}
    other = len(known) + 1
    out = np.zeros(0x110000, np.uint32)
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            out[point] = number.get(c.lower(), other)
    return out


def symbols_of(texts: list[str], lookup: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts end to end with runs of SPACE as one, and where each text starts and the last ends."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    borders = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    symbols = lookup[points]
    keep = np.ones(len(symbols), bool)
    keep[1:] = (symbols[1:] != SPACE) | (symbols[:-1] != SPACE)
    firsts = borders[:-1]
    keep[firsts[firsts < len(symbols)]] = True
    before = np.concatenate(([0], np.cumsum(keep)))
    return symbols[keep], before[borders]


def count_phrases(symbols: np.ndarray, starts: np.ndarray, walks: list[Walk]) -> np.ndarray:
    """Phrases of each text (rows) under each language's automaton (columns)."""
    texts = len(starts) - 1
    blocks = -(-np.diff(starts) // BLOCK)
    owner = np.repeat(np.arange(texts), blocks)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    begin = starts[owner] + nth * BLOCK
    size = np.minimum(starts[owner + 1] - begin, BLOCK)
    order = np.argsort(-size, kind="stable")
    owner, begin, size = owner[order], begin[order], size[order]
    active = len(size) - np.searchsorted(size[::-1], np.arange(BLOCK), side="right")
    padded = np.concatenate((symbols, np.zeros(BLOCK, symbols.dtype)))
    lanes = np.ascontiguousarray(padded[begin[:, None] + np.arange(BLOCK)[None, :]].T)
    out = np.zeros((texts, len(walks)), np.int64)
    for column, walk in enumerate(walks):
        state = np.zeros(len(begin), np.int64)
        ended = np.zeros(len(begin), np.int64)
        for step in range(BLOCK):
            k = active[step]
            if not k:
                break
            symbol = lanes[step, :k]
            found = walk.follow(state[:k], symbol)
            over = found == 0
            ended[:k] += over
            state[:k] = np.where(over, walk.root[symbol], found)
        out[:, column] = np.bincount(owner, weights=ended, minlength=texts)
    return out


def learned_from(doc_id: str) -> Column:
    """Whether a document's label may be learned: crc32 of its id as text is not 1 modulo 3; never for NULL ids."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 != 1, F.lit(False))


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang",
        sample_chars: int = SAMPLE_CHARS, sample_rows: int = SAMPLE_ROWS) -> dict:
    """Automata of the languages of ``labelled``; rows without text, letters or language teach nothing.

    Per language the sample holds the rows with the smallest text hashes, each distinct text once: at
    most ``sample_rows`` of them, and whole texts until ``sample_chars`` characters are reached.
    """
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(text).alias("h")
    )
    # a language's rows compete in parts first, so that the last step sees a bounded number of them
    in_part = W.partitionBy("lang", F.pmod("h", F.lit(PARTS))).orderBy("h")
    by_hash = W.partitionBy("lang").orderBy("h")
    running = F.sum("size").over(by_hash.rowsBetween(W.unboundedPreceding, -1))
    picked = (
        rows.groupBy("lang", "h").agg(F.min(F.length("text")).alias("size"))
        .withColumn("place", F.row_number().over(in_part)).where(F.col("place") <= sample_rows)
        .withColumn("place", F.row_number().over(by_hash)).where(F.col("place") <= sample_rows)
        .withColumn("before", F.coalesce(running, F.lit(0))).where(F.col("before") < sample_chars)
        .select("lang", "h")
    )
    # at most sample_rows rows a language, so the broadcast and the collect are bounded
    chosen = rows.join(F.broadcast(picked), ["lang", "h"]).dropDuplicates(["lang", "h"])
    sample: dict[str, str] = {}
    for row in sorted(chosen.collect(), key=lambda r: (r.lang, r.h)):
        sample[row.lang] = sample.get(row.lang, "") + "\n" + row.text
    letters = sorted({c for t in sample.values() for c in t.lower() if c.isalpha()})
    lookup = letter_symbols(letters)
    languages = sorted(sample)
    size = len(letters) + 2
    walks = []
    for x in languages:
        a = suffix_automaton(symbols_of([sample[x]], lookup)[0], size)
        known = a.symbol < size - 1  # the last one is a letter that no language has shown
        walks.append(walk_table(Automaton(a.state[known], a.symbol[known], a.target[known], size)))
    return {"languages": languages, "lookup": lookup, "walks": walks}


def judge(texts: list[str], model: dict) -> tuple[list[str], np.ndarray]:
    """Predicted language and score of each text."""
    symbols, starts = symbols_of(texts, model["lookup"])
    seen = np.concatenate(([0], np.cumsum(symbols != SPACE)))
    letters = seen[starts[1:]] - seen[starts[:-1]]
    if not model["languages"]:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts))
    phrases = count_phrases(symbols, starts, model["walks"])
    best = phrases.argmin(axis=1)
    fewest = phrases.min(axis=1)
    if phrases.shape[1] == 1:
        second = np.maximum(starts[1:] - starts[:-1], 1)
    else:
        second = np.partition(phrases, 1, axis=1)[:, 1]
    score = np.where(letters > 0, 1 - fewest / np.maximum(second, 1), 0.0)
    names = [model["languages"][b] if n else UNDETERMINED for b, n in zip(best, letters, strict=True)]
    return names, np.clip(score, 0.0, 1.0)


def identify(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` added (or replaced), from the whole ``text`` alone.

    NULL, '' and texts without letters are 'und' with score 0, as all texts are under a model without
    languages. Ties go to the language that sorts first and score 0. The score is the share of
    phrases that the winner saves against the second. Repeated rows get equal results; other columns stay.
    """
    # a broadcast names classes by module, which workers may lack: plain arrays go, tasks make walks of them
    plain = {**model, "walks": [vars(w) for w in model["walks"]]}
    shared = docs.sparkSession.sparkContext.broadcast(plain)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {**shared.value, "walks": [Walk.of(w) for w in shared.value["walks"]]}
        for batch in batches:
            for part in slices(batch, text, 2 << 20):
                texts = [t or "" for t in part.column(text).to_pylist()]
                names, scores = judge(texts, held)
                columns = [part.column(c) for c in kept] + [pa.array(names, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, "lang_pred", "score"])

    schema = docs.select(*kept).schema.add("lang_pred", "string").add("score", "double")
    return docs.select(*kept).mapInArrow(run, schema)


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents in a language that could be told; those without any letter go."""
    model = fit(docs.where(learned_from("doc_id")))
    judged = identify(docs, model)
    return judged.where(F.col("lang_pred") != UNDETERMINED).select(*docs.columns)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(learned_from("doc_id")))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)).alias("held_out")
    return identify(docs.select("doc_id", held_out, "text"), model).select("doc_id", "held_out", "lang_pred", "score")


QUERIES["op7_language_id"] = op7_language_id
