"""Toxicity by class-conditional Kneser-Ney models of characters.

Two models of the same order, one learned from toxic and one from ordinary texts, tell how likely each
character of a word is after those before it (a word is a run of letters and digits, lower-cased, and ends in a blank). Each
class has counts of its own at the top order, from which ``CLASS_DISCOUNT`` is taken off: counts up to it vanish. All
mass that this frees goes to one backoff distribution that both classes share: a Kneser-Ney model of the counts of both together, with continuation
counts (in how many contexts an n-gram was met) from the order below down to the single character. So a rare expression
says nothing for either class; only what is frequent in one class and not in the other does.

A word's log-likelihood ratio is the sum over its characters. The classes' shares of languages and topics, and the sparser counts of the
smaller class, move the ratios of all words a little, so only what exceeds ``MARGIN`` counts. A text's raw score is the sum of
these excesses divided by its words. A threshold fitted on labelled rows that the counts have not seen turns it into a score.

Counts are made of all learned rows, aggregated in each piece of text before the shuffle; everything up to the table
of log-ratios is SQL over distinct n-grams. The table is then folded to a fixed number of slots by
hash, which is what the tasks get: ``SLOTS`` and ``CONTEXTS`` floats, whatever the corpus holds. n-grams of one slot share their mean.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import flat, mix, ship, slices, stored, table
from .registry import QUERIES

ship(__name__)

ORDER = 5
DISCOUNT = 0.75
CLASS_DISCOUNT = 4
MARGIN = 2.0
SLOTS = 1 << 22
CONTEXTS = 1 << 20
SLICE = 1 << 19
PIECE = 1 << 18  # characters worked on at once
BINS = 4096  # of the raw scores that set the threshold, BIN_WIDTH wide from 0 on, the last one open
BIN_WIDTH = 1 / 1024


def word_characters() -> np.ndarray:
    """Which of the first 128 code points belong to words; all others do."""
    flags = np.zeros(129, np.uint32)
    flags[0x30:0x3A] = flags[0x41:0x5B] = flags[0x61:0x7B] = flags[128] = 1
    return flags


WORDS = word_characters()


def characters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of all texts, everything between words as 0, a 0 after each text; and where texts start and end."""
    texts = [(t or "").lower() for t in column.to_pylist()]
    borders = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts]))).astype(np.int64)
    points = np.zeros(borders[-1], np.uint32)
    for low, t in zip(borders[:-1].tolist(), texts, strict=True):
        points[low : low + len(t)] = np.frombuffer(t.encode("utf-32-le"), np.uint32)
    points *= WORDS[np.minimum(points, 128)]
    return points, borders


def grams(points: np.ndarray, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Columns of the n-grams (last character first, 0 before a word and at its end), and the place of each one's last character."""
    columns = [points]
    for step in range(1, order):
        before = np.zeros(len(points), np.uint32)
        if step < len(points):
            before[step:] = points[:-step]
        if step > 1:
            before[columns[-1] == 0] = 0
        columns.append(before)
    at = np.flatnonzero((columns[0] != 0) | (columns[1] != 0))
    # the character before a text's first one is another text's closing 0, so nothing crosses texts
    return [c[at] for c in columns], at


def pieces(points: np.ndarray) -> Iterator[np.ndarray]:
    """(start, characters) of pieces of whole words, about ``PIECE`` characters each, so that a very long text takes no more memory than others."""
    low = 0
    while low < len(points):
        high = min(low + PIECE, len(points))
        if high < len(points):
            ends = np.flatnonzero(points[low:high] == 0)
            if len(ends):
                high = low + int(ends[-1]) + 1
            else:  # a word longer than a piece
                further = np.flatnonzero(points[high:] == 0)
                high += int(further[0]) + 1 if len(further) else len(points) - high
        yield low, points[low:high]
        low = high


def hashes(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each n-gram and of its context."""
    context = np.zeros(len(columns[0]), np.uint64)
    for column in columns[1:]:
        context = context * np.uint64(0x100000001B3) + column.astype(np.uint64)
    return mix(context * np.uint64(0x9E3779B97F4A7C15) + columns[0].astype(np.uint64) + np.uint64(1)), mix(context)


def count_grams(rows: DataFrame, order: int) -> DataFrame:
    """(gram, slot, context_slot, c0, c1): the n-grams of the texts of (text, toxic) with their counts in each class; stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                points, borders = characters(part.column("text"))
                labels = part.column("toxic").to_numpy()
                for low, piece in pieces(points):
                    columns, at = grams(piece, order)
                    if not len(at):
                        continue
                    whole, context = hashes(columns)
                    toxic = labels[np.searchsorted(borders, at + low, side="right") - 1]
                    key, first, which = np.unique(whole, return_index=True, return_inverse=True)
                    found = [np.bincount(which[toxic == c], minlength=len(key)) for c in (0, 1)]
                    spelt = np.stack([c[first] for c in columns[::-1]], axis=1)
                    spelt[spelt == 0] = 0x20
                    text = spelt.astype("<u4").tobytes().decode("utf-32-le")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([text[i : i + order] for i in range(0, len(text), order)]),
                         pa.array((key % np.uint64(SLOTS)).astype(np.int32)), pa.array((context[first] % np.uint64(CONTEXTS)).astype(np.int32)),
                         pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64())],
                        names=["gram", "slot", "context_slot", "c0", "c1"],
                    )

    made = rows.select("text", "toxic").mapInArrow(run, "gram string, slot int, context_slot int, c0 long, c1 long")
    return stored(made.groupBy("gram", "slot", "context_slot").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1")), "grams")


def shared_backoff(counted: DataFrame, order: int, discount: float) -> DataFrame:
    """(suffix, shared): Kneser-Ney probability of the last character of every suffix of ``order - 1`` characters."""
    tables = {}
    longer = counted.select("gram")
    for size in range(order - 1, 0, -1):
        # how many different characters were met before it, in either class
        longer = longer.groupBy(F.substring("gram", 2, size).alias("gram")).agg(F.count(F.lit(1)).alias("met"))
        tables[size] = longer
        longer = longer.select("gram")
    lower = None
    for size in range(1, order):
        here = stored(tables[size].withColumn("context", F.substring("gram", 1, size - 1)), "continuations")
        sums = here.groupBy("context").agg(F.sum("met").alias("all"), F.count(F.lit(1)).alias("kinds"))
        own = F.greatest(F.col("met") - discount, F.lit(0.0))
        if lower is None:
            # below single characters: all characters met alike, and one unmet
            joined = here.join(sums, "context").withColumn("below", 1 / (F.col("kinds") + 1))
        else:
            below = lower.select(F.col("gram").alias("end"), F.col("shared").alias("below"))
            joined = here.join(sums, "context").withColumn("end", F.substring("gram", 2, size - 1)).join(below, "end")
        lower = joined.select("gram", ((own + discount * F.col("kinds") * F.col("below")) / F.col("all")).alias("shared"))
    return lower.withColumnRenamed("gram", "suffix")


def log_ratios(counted: DataFrame, order: int, discount: float, class_discount: float) -> tuple[DataFrame, DataFrame]:
    """(gram, slot, weight, ratio) of the n-grams met and (context, slot, weight, ratio) of contexts, for n-grams not met."""
    named = counted.withColumn("context", F.substring("gram", 1, order - 1)).withColumn("suffix", F.substring("gram", 2, order - 1))
    both = F.col("c0") + F.col("c1")
    contexts = named.groupBy("context", "context_slot").agg(
        *(F.sum(f"c{c}").alias(f"all{c}") for c in (0, 1)),
        *(F.sum(F.least(F.col(f"c{c}"), F.lit(class_discount))).alias(f"freed{c}") for c in (0, 1)), F.count(F.lit(1)).alias("kinds"),
    )
    contexts = stored(contexts, "contexts")
    # what a class hands to the shared distribution; all of it where the class has not met the context
    freed = {c: F.when(F.col(f"all{c}") > 0, F.col(f"freed{c}") / F.col(f"all{c}")).otherwise(1.0) for c in (0, 1)}
    every = F.col("all0") + F.col("all1")
    shared = (F.greatest(both - discount, F.lit(0.0)) + discount * F.col("kinds") * F.col("shared")) / every

    def chance(c: int) -> Column:
        own = F.when(F.col(f"all{c}") > 0, F.greatest(F.col(f"c{c}") - class_discount, F.lit(0.0)) / F.col(f"all{c}")).otherwise(0.0)
        return own + freed[c] * shared

    backoff = shared_backoff(counted, order, discount)
    met = named.join(contexts.drop("context_slot"), "context").join(backoff, "suffix")
    met = met.select("gram", "slot", both.alias("weight"), F.log(chance(1) / chance(0)).alias("ratio"))
    unmet = contexts.select(
        "context", F.col("context_slot").alias("slot"), (F.col("all0") + F.col("all1")).alias("weight"), F.log(freed[1] / freed[0]).alias("ratio")
    )
    return met, unmet


def _folded(ratios: DataFrame, size: int) -> np.ndarray:
    """The mean ratio of each slot, NaN for empty ones: at most ``size`` rows come to the driver."""
    rows = ratios.groupBy("slot").agg((F.sum(F.col("ratio") * F.col("weight")) / F.sum("weight")).cast("float").alias("ratio")).toArrow()
    out = np.full(size, np.nan, np.float32)
    out[rows.column("slot").to_numpy()] = rows.column("ratio").to_numpy()
    return out


def raw_scores(docs: DataFrame, model: dict, text: str, kept: list[str], out: str) -> DataFrame:
    """The columns ``kept`` and ``out``, the excess of a text's log-likelihood ratios per word; 0 for texts without words."""
    shared = docs.sparkSession.sparkContext.broadcast((model["met"], model["unmet"]))
    order, margin = model["order"], model["margin"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met, unmet = shared.value
        for batch in batches:
            for part in slices(batch, text, SLICE):
                points, borders = characters(part.column(text))
                total, words = np.zeros(part.num_rows), np.zeros(part.num_rows)
                for low, piece in pieces(points):
                    columns, at = grams(piece, order)
                    ends = np.flatnonzero(columns[0] == 0)
                    if not len(ends):
                        continue
                    whole, context = hashes(columns)
                    ratio = met[(whole % np.uint64(len(met))).astype(np.int64)]
                    new = np.flatnonzero(np.isnan(ratio))
                    ratio[new] = unmet[(context[new] % np.uint64(len(unmet))).astype(np.int64)]
                    ratio = np.nan_to_num(ratio, nan=0.0).astype(float)
                    word = np.add.reduceat(ratio, np.concatenate(([0], ends[:-1] + 1)))
                    row = np.searchsorted(borders, at[ends] + low, side="right") - 1
                    total += np.bincount(row, np.maximum(word - margin, 0), part.num_rows)
                    words += np.bincount(row, minlength=part.num_rows)
                    del columns, whole, context, ratio, word, row
                del points
                score = total / np.maximum(words, 1)
                yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + [pa.array(score)], names=[*kept, out])

    picked = docs.select(*dict.fromkeys([*kept, text]))
    return picked.mapInArrow(run, docs.select(*kept).schema.add(out, "double"))


def threshold(bins: list[tuple[int, int, int]]) -> tuple[float, float]:
    """Where the raw score parts the classes best (largest F1, the middle of equally good places) and the spread inside the classes."""
    counts = {0: np.zeros(BINS), 1: np.zeros(BINS)}
    for number, toxic, rows in bins:
        counts[toxic][number] += rows
    if not counts[0].any() or not counts[1].any():
        return BINS * BIN_WIDTH, 1.0
    above = {c: np.concatenate((np.cumsum(n[::-1])[::-1], [0])) for c, n in counts.items()}
    f1 = 2 * above[1] / (above[0] + above[1] + counts[1].sum())
    best = np.flatnonzero(f1 == f1.max())
    run = best[: int(np.argmax(np.append(np.diff(best) > 1, True))) + 1]
    middle = (np.arange(BINS) + 0.5) * BIN_WIDTH
    spread = 0.0
    for n in counts.values():
        mean = (n * middle).sum() / n.sum()
        spread += (n * (middle - mean) ** 2).sum()
    width = math.sqrt(spread / (counts[0].sum() + counts[1].sum()))
    # a bin's rows lie above its lower end; the classes part between the last bin below and the first one above
    return float(run[0] + run[-1]) / 2 * BIN_WIDTH, max(width, BIN_WIDTH)


def fit(labelled: DataFrame, text: str = "text", toxic: str = "toxic", held: str = "held", order: int = ORDER, discount: float = DISCOUNT,
        class_discount: float = CLASS_DISCOUNT, margin: float = MARGIN) -> dict | None:
    """The model of ``labelled``: counts of the rows where ``held`` is false, threshold by those where it is true.

    Rows with NULL text or with another label than 0 and 1 teach nothing. None if either class has no n-gram. Where the held rows
    lack a class, no text is predicted toxic.
    """
    rows = labelled.where(F.col(text).isNotNull() & F.col(toxic).isin(0, 1)).select(
        F.col(text).alias("text"), F.col(toxic).cast("int").alias("toxic"), F.coalesce(F.col(held), F.lit(False)).alias("held")
    )
    rows = stored(rows, "labelled")
    counted = count_grams(rows.where("not held"), order)
    seen = counted.agg(F.sum("c0"), F.sum("c1")).first()
    if not seen[0] or not seen[1]:
        return None
    met, unmet = log_ratios(counted, order, discount, class_discount)
    model = {"order": order, "margin": margin, "met": _folded(met, SLOTS), "unmet": _folded(unmet, CONTEXTS)}
    raw = raw_scores(rows.where("held"), model, "text", ["toxic"], "raw")
    number = F.least(F.floor(F.col("raw") / BIN_WIDTH), F.lit(BINS - 1)).cast("int")
    bins = raw.groupBy(number.alias("bin"), "toxic").agg(F.count(F.lit(1)).alias("rows")).collect()  # 2 BINS rows at most
    model["threshold"], model["width"] = threshold([(r["bin"], r["toxic"], r["rows"]) for r in bins])
    return model


def score(docs: DataFrame, model: dict | None, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 if the score is 0.5 or more) added or replaced, from the whole ``text`` alone.

    NULL, '' and texts without words have raw score 0 like a text that speaks for neither class. Without a model all scores
    are 0. Equal texts get equal scores; other columns stay; an empty table stays empty.
    """
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    if model is None:
        return docs.select(*kept, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    raw = "score"
    scored = raw_scores(docs, model, text, kept, raw)
    chance = 1 / (1 + F.exp(F.lit(model["threshold"] / model["width"]) - F.col(raw) / F.lit(model["width"])))
    return scored.select(*kept, chance.alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from ids whose crc32 is 1 to 3 modulo 5; 4 sets the threshold; 0 is held out. A text teaches once per row of labels."""
    part = F.crc32(F.col("doc_id").cast("string")) % 5
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where((part != 0) & F.col("toxic").isin(0, 1)).select("doc_id", "toxic")
    model = fit(docs.join(labels.hint("shuffle_hash"), "doc_id").withColumn("held", part == 4))
    # the texts that have labels are shuffled to them; the plan is the same whatever the size of either
    judged = score(docs.withColumn("held_out", F.coalesce(part == 0, F.lit(False))), model)
    return judged.select("doc_id", "held_out", "score", "predicted")


QUERIES["op12_toxicity"] = op12_toxicity
