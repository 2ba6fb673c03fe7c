"""Benchmark decontamination: an FM-index for each shard of the texts, searched with the test phrases.

A shard is some megabytes of texts inside a task. Its words become symbols of the test phrases'
vocabulary; a word outside it cannot be part of any phrase and ends a run, and runs shorter than the
shortest phrase are left out, so the index holds exactly what a phrase can match. Phrases are searched
backwards through wavelet ranks, located by sampled suffix positions, and their words merged to spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Powers, byte_values, flat, lower_ascii, prefix_hash, ship, slices, span_hash, table, word_spans
from .fmindex import FMIndex
from .registry import QUERIES

ship(__name__)

WINDOW = 13
SHARD_BYTES = 4 << 20
# Items reach the tasks in blocks of about so many bytes of text; every block is one pass inside the same tasks.
BLOCK_BYTES = 16 << 20
OWN = ["n_words", "n_hit", "n_items", "items", "spans", "contaminated"]


def word_bytes() -> np.ndarray:
    """Bytes of words: digits, letters, and all of non-ASCII characters."""
    flags = np.zeros(256, bool)
    flags[0x30:0x3A] = flags[0x41:0x5B] = flags[0x61:0x7B] = True
    flags[0x80:] = True
    return flags


PIECE = 1 << 19


class Words:
    """Starts, ends and two hashes of the lower-cased words of texts laid end to end, worked out in pieces of ``PIECE`` bytes."""

    def __init__(self) -> None:
        self.inside, self.lower, self.powers = word_bytes(), lower_ascii(), Powers()
        self.values = [byte_values(seed)[self.lower] for seed in (1, 2)]

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        starts, ends = word_spans(self.inside[data], offsets)
        hashes: list[list[np.ndarray]] = [[] for _ in self.values]
        first = 0
        while first < len(starts):
            # whole words; a longer one is a piece of its own
            last = max(int(np.searchsorted(ends, starts[first] + PIECE, side="right")), first + 1)
            low, high = starts[first], ends[last - 1]
            for found, values in zip(hashes, self.values, strict=True):
                sums = prefix_hash(values[data[low:high]], self.powers)
                found.append(span_hash(sums, starts[first:last] - low, ends[first:last] - low, self.powers))
            first = last
        none = np.zeros(0, np.uint64)
        return starts, ends, [np.concatenate(found) if found else none for found in hashes]


def phrases(items: list[tuple[str, str]], window: int = WINDOW) -> dict:
    """Vocabulary, distinct phrases by length, and the items each phrase belongs to."""
    column = pa.array([t for _, t in items], pa.large_string())
    data, offsets = flat(column)
    starts, _, (h1, h2) = Words()(data, offsets)
    pairs = np.stack([h1, h2], axis=1) if len(h1) else np.zeros((0, 2), np.uint64)
    vocabulary, symbols = np.unique(pairs, axis=0, return_inverse=True)
    symbols = symbols.ravel() + 1
    borders = np.searchsorted(starts, offsets)
    found: dict[tuple[int, ...], set[int]] = {}
    for number in range(len(items)):
        own = symbols[borders[number] : borders[number + 1]].tolist()
        width = min(window, len(own))
        for i in range(len(own) - width + 1 if width else 0):
            found.setdefault(tuple(own[i : i + width]), set()).add(number)
    by_length: dict[int, list[tuple[int, ...]]] = {}
    for phrase in found:
        by_length.setdefault(len(phrase), []).append(phrase)
    groups, owners = [], []
    for length, listed in sorted(by_length.items()):
        groups.append(np.array(listed, np.int64))
        owners += [sorted(found[p]) for p in listed]
    return {
        "h1": vocabulary[:, 0], "h2": vocabulary[:, 1], "groups": groups, "names": [n for n, _ in items],
        "owner_starts": np.concatenate(([0], np.cumsum([len(o) for o in owners]))).astype(np.int64),
        "owners": np.array([x for o in owners for x in o], np.int64),
    }


class Searcher:
    """Finds the phrases of one block of items in the words of a shard."""

    def __init__(self, block: dict) -> None:
        self.block = block
        self.shortest = min((g.shape[1] for g in block["groups"]), default=0)
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[(block["h1"] & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def symbols(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Vocabulary number of each word from 1, or 0."""
        out = np.zeros(len(h1), np.int64)
        maybe = np.flatnonzero(self.sieve[(h1 & np.uint64((1 << 20) - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.block["h1"], h1[maybe]), len(self.block["h1"]) - 1)
        hit = (self.block["h1"][at] == h1[maybe]) & (self.block["h2"][at] == h2[maybe])
        out[maybe[hit]] = at[hit] + 1
        return out

    def find(self, h1: np.ndarray, h2: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first word, number of words, phrase) of every occurrence; ``borders``: first word of each text and the end."""
        none = (np.zeros(0, np.int64),) * 3
        if not self.shortest or not len(h1):
            return none
        symbols = self.symbols(h1, h2)
        starts, ends = word_spans(symbols > 0, borders)
        long = ends - starts >= self.shortest
        starts, ends = starts[long], ends[long]
        if not len(starts):
            return none
        size = ends - starts
        begin = np.cumsum(size + 1) - (size + 1)
        place = np.arange(size.sum() + len(size)) - np.repeat(begin, size + 1) + np.repeat(starts, size + 1)
        text = symbols[np.minimum(place, len(symbols) - 1)]
        text[begin + size] = 0
        index = FMIndex(text, int(len(self.block["h1"])) + 1)
        firsts, widths, which, number = [], [], [], 0
        for group in self.block["groups"]:
            low, high = index.search(group)
            count = high - low
            phrase = np.repeat(np.arange(len(group)), count)
            rows = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
            firsts.append(place[index.locate(rows)])
            widths.append(np.full(len(rows), group.shape[1]))
            which.append(phrase + number)
            number += len(group)
        return np.concatenate(firsts), np.concatenate(widths), np.concatenate(which)


def _blocks(benchmark: DataFrame, item_id: str, text: str, window: int, block_bytes: int) -> list[dict]:
    """The items as blocks of phrases, each of about ``block_bytes`` of text at most, collected one after the other."""
    items = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("name"), F.col(text).alias("text")
    ).where(F.length("text") > 0)
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = total // block_bytes + 1
    part = F.pmod(F.xxhash64("name", "text"), F.lit(count))
    return [phrases([(r.name, r.text) for r in items.where(part == b).collect()], window) for b in range(count)]


def search(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
           item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``n_words, n_hit, n_items, items, spans, contaminated`` added (or replaced).

    Words are runs of digits, letters (A-Z lower-cased) and non-ASCII characters. A phrase is ``window``
    consecutive words of an item; an item of fewer words is one phrase, one without words is none.
    ``n_hit`` counts the words inside any occurrence, ``spans`` are the merged occurrences as code
    points [start, end) of the text, ``items`` the sorted ids found. ``contaminated``: there is a hit and
    5 % of the words or more are hit. NULL and '' have no words. Items without id count under ''; repeated
    items and rows are no special case. Other columns stay.
    """
    blocks = _blocks(benchmark, item_id, item_text, window, block_bytes)
    shared = docs.sparkSession.sparkContext.broadcast(blocks)
    kept = [c for c in docs.columns if c not in OWN]

    def judge(batch: pa.RecordBatch, words: Words, searchers: list[Searcher]) -> list[pa.Array]:
        data, offsets = flat(batch.column(text))
        starts, ends, (h1, h2) = words(data, offsets)
        borders = np.searchsorted(starts, offsets)
        change = np.zeros(len(starts) + 1, np.int64)
        named: dict[int, set[str]] = {}
        for searcher in searchers:
            first, width, phrase = searcher.find(h1, h2, borders)
            np.add.at(change, first, 1)
            np.add.at(change, first + width, -1)
            row = np.searchsorted(borders, first, side="right") - 1
            both = np.unique(row * np.int64(1 << 32) + phrase)
            block = searcher.block
            for pair in both.tolist():
                p = pair & 0xFFFFFFFF
                own = block["owners"][block["owner_starts"][p] : block["owner_starts"][p + 1]]
                named.setdefault(pair >> 32, set()).update(block["names"][o] for o in own)
        hit = np.cumsum(change[:-1]) > 0
        so_far = np.concatenate(([0], np.cumsum(hit)))
        n_words = np.diff(borders)
        n_hit = so_far[borders[1:]] - so_far[borders[:-1]]
        items = [sorted(named.get(row, ())) for row in range(batch.num_rows)]
        spans: list[list[dict]] = [[] for _ in range(batch.num_rows)]
        if hit.any():
            first, last = word_spans(hit, borders)
            points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
            row = np.searchsorted(borders, first, side="right") - 1
            base = points[offsets[row]]
            for r, a, b in zip(row, points[starts[first]] - base, points[ends[last - 1]] - base, strict=True):
                spans[r].append({"start": int(a), "end": int(b)})
        return [
            pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array([len(i) for i in items], pa.int64()),
            pa.array(items, pa.list_(pa.string())),
            pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            pa.array((n_hit > 0) & (20 * n_hit >= n_words), pa.bool_()),
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, searchers = Words(), [Searcher(b) for b in shared.value]
        for batch in batches:
            for part in slices(batch, text, SHARD_BYTES):
                own = judge(part, words, searchers)
                yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + own, names=kept + OWN)

    schema = docs.select(*kept).schema
    for name in ("n_words", "n_hit", "n_items"):
        schema = schema.add(name, "long")
    span = T.StructType().add("start", "long").add("end", "long")
    schema = schema.add("items", T.ArrayType(T.StringType())).add("spans", T.ArrayType(span))
    return docs.select(*kept).mapInArrow(run, schema.add("contaminated", "boolean"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: contaminated documents go, all others stay as they are."""
    return search(docs, table(spark, sf_dir, "benchmark")).where(~F.col("contaminated")).select(*docs.columns)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


QUERIES["op8_decontaminate"] = op8_decontaminate
