"""Quality rules: an isolation forest on rule statistics.

Each document's statistics (word length, symbols, repeated lines and words, case, punctuation, line length)
form a point. Random splits isolate unusual points after few steps; the mean path length over the
trees is a document's anomaly score. The forest is fitted on ``SAMPLE`` documents, each tree on ``TREE_ROWS`` of
them; statistics, scores and the calibration cover all documents. The threshold is the score at which
labelled good documents and labelled bad ones separate best.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Powers, byte_values, flat, gram_hash, is_space, prefix_hash, ship, slices, span_hash, stored, table, word_spans
from .registry import QUERIES

ship(__name__)

WINDOW = 8
SAMPLE = 8192
TREES = 200
TREE_ROWS = 64
BINS = 2000
STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["word_length", "symbols", "dup_lines", "repeats", "capitals", "short_words", "marks", "bars", "line_words"]


def _flags(text: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(text.encode())] = True
    return out


class Measure:
    """Rule statistics and features of texts laid end to end."""

    def __init__(self) -> None:
        self.powers, self.values = Powers(), byte_values()
        self.space, self.symbol, self.mark = is_space(), _flags("#*$%&|<>"), _flags("!?.,;:")

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = len(offsets) - 1
        sums = prefix_hash(self.values[data], self.powers)
        starts, ends = word_spans(~self.space[data], offsets)
        words = span_hash(sums, starts, ends, self.powers)
        borders = np.searchsorted(starts, offsets)
        n_words = np.diff(borders)

        def per_text(flags: np.ndarray) -> np.ndarray:
            so_far = np.concatenate(([0], np.cumsum(flags)))
            return so_far[offsets[1:]] - so_far[offsets[:-1]]

        lead = (data & 0xC0) != 0x80
        points = np.concatenate(([0], np.cumsum(lead)))
        chars = points[ends] - points[starts]
        up_to = np.concatenate(([0], np.cumsum(chars)))
        word_chars = up_to[borders[1:]] - up_to[borders[:-1]]
        short = np.concatenate(([0], np.cumsum(chars <= 3)))
        n_short = short[borders[1:]] - short[borders[:-1]]
        n_symbols = per_text(self.symbol[data])

        # lines with a word, compared as they are
        breaks = data == 0x0A
        line_starts, line_ends = word_spans(~breaks, offsets)
        first_word = np.searchsorted(starts, line_starts)
        wordy = (first_word < len(starts)) & (np.concatenate((starts, [len(data)]))[first_word] < line_ends)
        line_starts, line_ends = line_starts[wordy], line_ends[wordy]
        lines = span_hash(sums, line_starts, line_ends, self.powers)
        line_row = np.searchsorted(offsets, line_starts, side="right") - 1
        n_lines = np.bincount(line_row, minlength=rows)
        n_dup = np.bincount(line_row[self._repeats(line_row, lines)[1]], minlength=rows)

        # words inside a window that the text holds twice or more
        grams = gram_hash(words, WINDOW)
        gram_row = np.searchsorted(borders, np.arange(len(grams)), side="right") - 1
        inside = np.arange(len(grams)) + WINDOW <= borders[gram_row + 1] if len(grams) else np.zeros(0, bool)
        at = np.flatnonzero(inside)
        twice = at[self._repeats(gram_row[at], grams[at])[0]]
        change = np.zeros(len(starts) + 1, np.int64)
        np.add.at(change, twice, 1)
        np.add.at(change, twice + WINDOW, -1)
        covered = np.concatenate(([0], np.cumsum(np.cumsum(change[:-1]) > 0)))
        n_repeat = covered[borders[1:]] - covered[borders[:-1]]

        some = np.maximum(n_words, 1)
        letters = np.maximum(per_text(((data | 0x20) >= 0x61) & ((data | 0x20) <= 0x7A)), 1)
        features = [
            word_chars / some, n_symbols / some, n_dup / np.maximum(n_lines, 1), n_repeat / some,
            per_text((data >= 0x41) & (data <= 0x5A)) / letters, n_short / some, per_text(self.mark[data]) / some,
            per_text(data == 0x7C) / some, np.log1p(n_words / np.maximum(n_lines, 1)),
        ]
        statistics = np.stack([n_words, word_chars, n_symbols, n_dup, n_repeat], axis=1)
        return statistics, np.stack(features, axis=1) if rows else np.zeros((0, len(FEATURES)))

    @staticmethod
    def _repeats(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which entries equal another one of their row, and which equal an earlier one."""
        order = np.lexsort((value, row))
        same = np.zeros(len(row), bool)
        same[1:] = (row[order][1:] == row[order][:-1]) & (value[order][1:] == value[order][:-1])
        either, later = np.zeros(len(row), bool), np.zeros(len(row), bool)
        later[order] = same
        either[order] = same | np.concatenate((same[1:], [False]))[: len(row)]
        return either, later


def average_path(n: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search in a random tree of ``n`` points."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def fit_forest(points: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS, seed: int = 7) -> list[dict]:
    """Isolation trees as arrays: feature (-1 in a leaf), cut, left and right child, depth plus the leaf's average path."""
    rng, forest = np.random.default_rng(seed), []
    if not len(points):
        return forest
    limit = int(np.ceil(np.log2(max(rows, 2)))) + 2
    for _ in range(trees):
        own = points[rng.choice(len(points), min(rows, len(points)), replace=False)]
        nodes: list[list] = []

        def grow(part: np.ndarray, depth: int, nodes=nodes) -> int:
            number = len(nodes)
            nodes.append([-1, 0.0, 0, 0, depth + float(average_path(len(part)))])
            low, high = part.min(axis=0), part.max(axis=0)
            usable = np.flatnonzero(high > low)
            if depth < limit and len(part) > 1 and len(usable):
                feature = int(rng.choice(usable))
                cut = float(rng.uniform(low[feature], high[feature]))
                left = part[:, feature] <= cut
                if left.any() and not left.all():
                    nodes[number][:4] = [feature, cut, grow(part[left], depth + 1), grow(part[~left], depth + 1)]
            return number

        grow(own, 0)
        table_ = np.array(nodes)
        forest.append({
            "feature": table_[:, 0].astype(int), "cut": table_[:, 1], "left": table_[:, 2].astype(int),
            "right": table_[:, 3].astype(int), "path": table_[:, 4], "limit": limit, "usual": float(average_path(len(own))),
        })
    return forest


def anomaly(points: np.ndarray, forest: list[dict]) -> np.ndarray:
    """Score of each point, 0 to 1, higher for points that few splits isolate; 0 without trees."""
    if not forest or not len(points):
        return np.zeros(len(points))
    total, rows = np.zeros(len(points)), np.arange(len(points))
    for tree in forest:
        node = np.zeros(len(points), int)
        for _ in range(tree["limit"] + 1):
            feature = tree["feature"][node]
            down = np.where(points[rows, np.maximum(feature, 0)] <= tree["cut"][node], tree["left"][node], tree["right"][node])
            node = np.where(feature < 0, node, down)
        total += tree["path"][node] / max(tree["usual"], 1e-9)
    return 2.0 ** (-total / len(forest))


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, statistics, features) of every whole text; NULL has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = Measure()
        for batch in batches:
            for part in slices(batch, "text"):
                statistics, features = measure(*flat(part.column("text")))
                columns = [part.column("doc_id")] + [pa.array(statistics[:, k], pa.int64()) for k in range(len(STATISTICS))]
                columns.append(pa.array(list(features), pa.list_(pa.float64())))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *STATISTICS, "features"])

    picked = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = picked.select("doc_id").schema
    for name in STATISTICS:
        schema = schema.add(name, "long")
    return picked.mapInArrow(run, schema.add("features", T.ArrayType(T.DoubleType())))


def base_failed() -> Column:
    """Fewer than 20 words, or more than 30 % of them in repeated windows."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def threshold(scored: DataFrame, labels: DataFrame, doc_id: str, quality: str, weight: float) -> float:
    """The score above which documents go: bad ones found less ``weight`` times good ones lost is greatest there.

    ``labels`` may repeat documents (the lowest quality counts) and hold NULLs (no label). Without both kinds
    of labels nothing goes (2.0). The counts come as a histogram of ``BINS`` bins.
    """
    marks = labels.where(F.col(quality).isNotNull()).groupBy(F.col(doc_id).alias("doc_id")).agg(F.min(quality).alias("good"))
    joined = scored.where(~F.col("base_failed")).join(marks, "doc_id")
    bins = joined.groupBy(F.floor(F.col("score") * BINS).alias("bin"), (F.col("good") > 0).alias("good")).count().collect()
    counts = np.zeros((2, BINS + 2))
    for row in bins:
        counts[int(row.good), min(row.bin, BINS)] += row["count"]
    if not counts.sum(axis=1).all():
        return 2.0
    # found or lost when documents of bin k and above go
    above = counts[:, ::-1].cumsum(axis=1)[:, ::-1] / counts.sum(axis=1, keepdims=True)
    return int(np.argmax(above[0] - weight * above[1])) / BINS


def judge_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  label_id: str = "doc_id", quality: str = "quality", weight: float = 3.0) -> DataFrame:
    """(doc_id, statistics, base_failed, score, kept), one row per row of ``docs``.

    ``n_words`` counts runs without ASCII white space, ``word_chars`` their code points, ``n_symbols`` the
    characters ``#*$%&|<>``, ``n_dup_lines`` lines with a word that equal an earlier line, ``n_repeat_words`` the
    words in windows of 8 words that the text holds twice or more. NULL and '' have no words and fail the
    base rules. ``kept``: the base rules hold and the anomaly score lies below the calibrated threshold. Repeated
    rows get equal results; other columns are not returned; an empty table gives no rows.
    """
    points = stored(measured(docs, doc_id, text), "measures")
    # The documents with the smallest hashes: a bounded sample, the same on every run. Only hashes below a bound that
    # leaves some four times as many take part, so that the tasks together hand on no more than that.
    share = min(1.0, 4 * SAMPLE / max(points.count(), 1))
    hashed = points.select(F.xxhash64("doc_id", "features").alias("h"), "features")
    low = hashed.where(F.col("h") <= int(-(1 << 63) + share * ((1 << 64) - 1)) if share < 1 else F.lit(True))
    drawn = low.orderBy("h").limit(SAMPLE).collect()
    sample = sorted((r.h, tuple(r.features)) for r in drawn)
    forest = fit_forest(np.array([f for _, f in sample]))
    shared = docs.sparkSession.sparkContext.broadcast(forest)
    own = ["doc_id", *STATISTICS, "base_failed"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat_features = batch.column("features").flatten().to_numpy(zero_copy_only=False)
            score = anomaly(flat_features.reshape(batch.num_rows, len(FEATURES)), shared.value)
            columns = [batch.column(c) for c in own]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(score)], names=[*own, "score"])

    rows = points.withColumn("base_failed", base_failed())
    scored = stored(rows.mapInArrow(run, rows.select(*own).schema.add("score", "double")), "scores")
    most = threshold(scored, labels, label_id, quality, weight)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("score") < most))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES["op5_quality_rules"] = op5_quality_rules
