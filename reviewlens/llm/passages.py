"""Suffix-array dedup of repeated passages by prefix-free parsing of the corpus.

Parse. A rolling hash over ``GRAM`` bytes triggers a phrase wherever it is the smallest of the
``length - GRAM + 1`` values around some window of ``length`` bytes. (A trigger at fixed residues would leave
stretches without one, and every window needs one.) So each window of ``length`` bytes has one trigger, its
smallest value, and equal windows have it at the same place. The phrase of a trigger is the text of
all windows that belong to it; a document is the sequence of its phrases.

Dictionary. Phrases meet by trigger, are sorted by trigger and digest in each task, equal ones by document and offset.
Every phrase but the first of its kind repeats all its windows. The first one needs a closer look only where its
trigger starts another phrase of the dictionary as well. Triggers that a part of the texts shows to be frequent are dealt
out by digest too; their first phrases all get the closer look.

Order. Those distinct phrases get their bytes and meet by trigger again. Blocks of whole triggers get a
suffix array of their dictionary, to a depth of ``length`` bytes: suffixes with a common prefix of that length are one
class, and all but the first in corpus order are repeats. A trigger whose phrases do not fit into a block is parsed
once more: each phrase is cut into pieces of fewer windows, and the text common to all windows of a piece, longer than
the trigger was, is the piece's trigger. A piece of one window is its own trigger, so that this ends.
A phrase carries its text to the end of its last window, so the parse needs no order beyond that of documents and offsets.

Repeated windows of a document are merged and cut out of its bytes. Texts are shuffled once, into a bucketed
table that all later readings of the bytes join without another shuffle.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import Powers, byte_values, flat, mix, prefix_hash, ship, slices, span_hash, stored, table, word_spans
from .registry import QUERIES

ship(__name__)

LENGTH = 100
GRAM = 20
BLOCK_BYTES = 4 << 20  # at most; a trigger gets half of it
SUFFIX_BYTES = 1 << 17  # blocks of small triggers: their sorts stay in the processor's cache
FINER = 8  # pieces have so many times fewer windows than the phrases they are cut from
# Triggers found FREQUENT_LEAST times in one document of FREQUENT_PART, and at most FREQUENT_MOST of them, are dealt out.
FREQUENT_PART, FREQUENT_LEAST, FREQUENT_MOST = 64, 64, 4096
PHRASES = "trigger long, phrase long, u byte, k long, d long, low int, high int"
KEY = ["u", "k", "d"]  # what tells documents apart, in corpus order


def minima_runs(values: np.ndarray, width: int, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of windows of ``width`` values that have one place as their leftmost smallest value: first window, that place.

    A run never goes on over a window in ``begins``.
    """
    count = len(values) - width + 1
    # doubling: the smallest of 1, 2, 4, ... values, then two overlapping stretches make up the width
    least, span = values, 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    least = np.minimum(least[:count], least[width - span : width - span + count])
    leaves = values[:count] == least  # the smallest value is the window's first one
    cut = np.empty(count, bool)
    cut[0] = True
    cut[1:] = (least[1:] != least[:-1]) | leaves[:-1]
    cut[begins] = True
    first = np.flatnonzero(cut)
    last = np.append(first[1:] - 1, count - 1)
    # known are places that end a run by leaving it and those that begin one by being smaller than all before
    place = np.where(leaves[last], last, first + width - 1)
    comes = np.zeros(len(first), bool)
    comes[1:] = least[first[1:]] < least[first[1:] - 1]
    seek = np.flatnonzero(~(comes | leaves[last]))
    if len(seek):
        windows = np.lib.stride_tricks.sliding_window_view(values, width)
        place[seek] = first[seek] + np.argmin(windows[first[seek]], axis=1)
    return first, place


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost smallest value of every ``width`` consecutive ones."""
    first, place = minima_runs(values, width, np.zeros(0, np.int64))
    return np.repeat(place, np.diff(np.append(first, len(values) - width + 1)))


class Parser:
    """Triggers and phrases of texts laid end to end."""

    def __init__(self, length: int, gram: int) -> None:
        self.length, self.gram, self.powers = length, gram, Powers()
        self.values = [byte_values(seed) for seed in (1, 2)]

    def phrases(self, data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
        """Per phrase: row, first and last window start inside the text, and two hashes (trigger bytes, whole phrase)."""
        long = np.flatnonzero(np.diff(offsets) >= self.length)
        if not len(long):
            none = np.zeros(0, np.int64)
            return {k: none for k in ("row", "low", "high", "spot", "trigger", "phrase")}
        sums, others = self.sums(data)
        size = len(data) - self.gram + 1
        _, down = self.powers.get(len(sums))
        grams = mix((sums[self.gram :] - sums[:size]) * down[:size] + np.uint64(self.gram))
        count = len(data) - self.length + 1
        # runs of all windows of the slice, cut where a text begins and where its last window has been
        ends = offsets[long + 1] - self.length + 1
        begins = np.concatenate((offsets[long], ends[ends < count]))
        first, spot = minima_runs(grams, self.length - self.gram + 1, begins)
        last = np.append(first[1:] - 1, count - 1)
        row = np.searchsorted(offsets, first, side="right") - 1
        within = first <= offsets[row + 1] - self.length
        first, last, spot, row = first[within], last[within], spot[within], row[within]
        base = offsets[row]
        return {
            "row": row, "low": first - base, "high": last - base, "spot": spot - base,
            "trigger": grams[spot].view(np.int64), "phrase": self.digest(others, first, last, spot),
        }

    def sums(self, data: np.ndarray) -> list[np.ndarray]:
        return [prefix_hash(np.take(v, data), self.powers) for v in self.values]

    def digest(self, sums: np.ndarray, first: np.ndarray, last: np.ndarray, spot: np.ndarray) -> np.ndarray:
        """Hash of the text of some windows; how they lie around the trigger is part of it."""
        whole = span_hash(sums, first, last + self.length, self.powers)
        shape = mix((spot - first).astype(np.uint64) * np.uint64(1 << 32) + (last - first).astype(np.uint64))
        return (whole ^ shape).view(np.int64)


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(u, k, d, text): 1 for a NULL id and 0 for others, the id, and 64 bits that tell texts of one id apart.

    NULL ids have another 64 bits of their text as ``k``, so that any number of them stay apart.
    """
    unnamed = F.col(doc_id).isNull()
    return docs.select(
        unnamed.cast("byte").alias("u"), F.when(unnamed, F.xxhash64(F.lit("k"), text)).otherwise(F.col(doc_id).cast("long")).alias("k"),
        F.xxhash64(text).alias("d"), F.coalesce(text, F.lit("")).alias("text"),
    )


def _told(columns: list[np.ndarray]) -> pa.RecordBatch:
    """Phrases of one batch, as columns of PHRASES; of equal phrases only the first can be the first of all.

    The others get NULL as phrase and a trigger of their own, so that a phrase of very many documents does not gather in one task.
    """
    trigger = columns[0]
    order = np.argsort(trigger)
    t = trigger[order]
    tie = np.zeros(len(order), bool)
    tie[1:] = t[1:] == t[:-1]
    tie[:-1] |= tie[1:]
    some = order[tie]
    order[tie] = some[np.lexsort([c[some] for c in columns[5::-1]])]
    columns = [c[order] for c in columns]
    # rows that repeat an id and its text are one document
    again = np.zeros(len(order), bool)
    again[1:] = np.logical_and.reduce([c[1:] == c[:-1] for c in columns[:6]])
    trigger, phrase, u, k, d, low, high = (c[~again] for c in columns)
    later = np.zeros(len(trigger), bool)
    later[1:] = (trigger[1:] == trigger[:-1]) & (phrase[1:] == phrase[:-1])
    spread = mix((k * 31 + low).astype(np.uint64)).view(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.where(later, spread, trigger)), pa.array(phrase, mask=later), pa.array(u), pa.array(k), pa.array(d),
         pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32))],
        names=["trigger", "phrase", *KEY, "low", "high"],
    )


def _phrases(keyed: DataFrame, length: int, gram: int) -> DataFrame:
    """(trigger, phrase, u, k, d, low, high) of every phrase, see ``_told``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Parser(length, gram)
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                found: dict[str, list[np.ndarray]] = {}
                row = 0
                for piece in slices(part, "text", 1 << 20):
                    one = parser.phrases(*flat(piece.column("text")))
                    one["row"] = one["row"] + row
                    row += piece.num_rows
                    for name, values in one.items():
                        found.setdefault(name, []).append(values)
                got = {name: np.concatenate(values) for name, values in found.items()}
                key = [part.column(c).to_numpy()[got["row"]] for c in KEY]
                yield _told([got["trigger"], got["phrase"], *key, got["low"], got["high"]])

    return keyed.mapInArrow(run, PHRASES)


def _pieces(opened: DataFrame, length: int, gram: int, width: int) -> DataFrame:
    """Phrases (trigger, u, k, d, low, bytes) cut into pieces of ``width`` windows at most, as PHRASES; see ``_told``.

    Windows go to a piece by their distance from the phrase's trigger, so equal windows lie in pieces with the same common text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Parser(length, gram)
        for batch in batches:
            for part in slices(batch, "bytes"):
                data, offsets = flat(part.column("bytes"))
                phrase = parser.phrases(data, offsets)  # one of each row
                sums, others = parser.sums(data)
                near, far = (phrase["spot"] - phrase["high"]) // width, phrase["spot"] // width
                row = np.repeat(np.arange(part.num_rows), far - near + 1)
                ends = np.cumsum(far - near + 1)
                step = (near[row] + np.arange(len(row)) - np.repeat(np.append(0, ends[:-1]), far - near + 1)) * width
                spot = phrase["spot"][row]
                first = np.maximum(spot - step - width + 1, 0)
                last = np.minimum(spot - step, phrase["high"][row])
                base = offsets[row]
                at = base + spot - step  # where the piece's last window begins, were it whole
                core = span_hash(sums, at, at - width + 1 + length, parser.powers).view(np.int64)
                digest = parser.digest(others, base + first, base + last, base + spot - step)
                u, k, d, low = (part.column(c).to_numpy()[row] for c in (*KEY, "low"))
                yield _told([core, digest, u, k, d, low + first, low + last])

    return opened.mapInArrow(run, PHRASES)


def _part(rows: DataFrame) -> DataFrame:
    """The rows of one document of FREQUENT_PART."""
    return rows.where(F.pmod(F.xxhash64(F.lit("part"), "k", "d"), F.lit(FREQUENT_PART)) == 0)


def _frequent(phrases: DataFrame) -> list[int]:
    """The most frequent triggers among phrases of a part of the documents. They only say how rows are dealt out."""
    found = phrases.where("phrase is not null").groupBy("trigger").count().where(F.col("count") >= FREQUENT_LEAST)
    return [r.trigger for r in found.orderBy(F.desc("count"), "trigger").limit(FREQUENT_MOST).collect()]


def _repeats(phrases: DataFrame, frequent: list[int]) -> DataFrame:
    """(u, k, d, low, high, trigger) of phrases that repeat an earlier one (trigger NULL) or are open (trigger given); stored.

    Open are the first of their kind whose trigger has another phrase. For a ``frequent`` trigger, whose kinds lie in
    several tasks, that is not asked, and all of them count as open.
    """
    dealt = [F.when(F.col("trigger").isin(frequent), F.col("phrase"))] if frequent else []
    met = phrases.repartition("trigger", *dealt).sortWithinPartitions("trigger", "phrase", *KEY, "low")
    marked = np.array(frequent, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = ()  # class, document and offset of the row before
        held = None  # the last first-of-its-kind, open if the next one has its trigger: (row, open)
        names = [*KEY, "low", "high", "trigger"]
        types = [pa.int8(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]

        def out(columns: list[np.ndarray], repeats: np.ndarray) -> pa.RecordBatch:
            arrays = [pa.array(c, t) for c, t in zip(columns[:5], types, strict=True)]
            return pa.RecordBatch.from_arrays([*arrays, pa.array(columns[5], pa.int64(), mask=repeats)], names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            done = batch.column("phrase").is_null().to_numpy(zero_copy_only=False)
            columns = [batch.column(c).to_numpy() for c in names]
            if done.any():
                yield out([c[done] for c in columns], np.ones(int(done.sum()), bool))
            live = ~done
            if not live.any():
                continue
            columns = [c[live] for c in columns]
            trigger = columns[5]
            phrase = batch.column("phrase").fill_null(0).to_numpy()[live]
            same = np.zeros(len(trigger), bool)
            again = np.zeros(len(trigger), bool)
            same[1:] = (trigger[1:] == trigger[:-1]) & (phrase[1:] == phrase[:-1])
            again[1:] = same[1:]
            for c in columns[:4]:
                again[1:] &= c[1:] == c[:-1]
            ends = [tuple(int(c[i]) for c in (trigger, phrase, *columns[:4])) for i in (0, -1)]
            same[0], again[0] = last[:2] == ends[0][:2], last == ends[0]
            last = ends[1]
            # rows that repeat an id and its text are one document
            columns, first = [c[~again] for c in columns], ~same[~again]
            trigger = columns[5]
            if not len(trigger):
                continue
            if not first.all():
                yield out([c[~first] for c in columns], np.ones(int((~first).sum()), bool))
            kinds = [c[first] for c in columns]
            if not len(kinds[5]):
                continue
            if held is not None:
                kinds = [np.concatenate(([h], c)) for h, c in zip(held[0], kinds, strict=True)]
            open_ = np.isin(kinds[5], marked)
            same = kinds[5][1:] == kinds[5][:-1]
            open_[1:] |= same
            open_[:-1] |= same
            open_[0] |= held is not None and held[1]
            held = ([c[-1] for c in kinds], bool(open_[-1]))
            tell = open_.copy()
            tell[-1] = False
            if tell.any():
                yield out([c[tell] for c in kinds], np.zeros(int(tell.sum()), bool))
        if held is not None and held[1]:
            yield out([np.array([h]) for h in held[0]], np.zeros(1, bool))

    return stored(met.mapInArrow(run, "u byte, k long, d long, low int, high int, trigger long"), "repeats")


def suffix_classes(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of the suffixes at ``starts`` to ``length`` bytes, and where a new class of equal ones begins.

    Sorted by ranks of 8, 16, ... bytes (prefix doubling); ``length`` bytes are two overlapping stretches.
    """
    bytes_ = np.concatenate((data, np.zeros(8, np.uint8))).astype(np.uint64)
    count = len(data)
    word = np.zeros(count, np.uint64)
    for k in range(8):
        word = (word << np.uint64(8)) | bytes_[k : k + count]
    rank = np.unique(word, return_inverse=True)[1].astype(np.int64)
    span = 8
    while 2 * span <= length:
        follow = np.concatenate((rank[span:], np.zeros(min(span, count), np.int64)))[:count]
        rank = np.unique(rank * count + follow, return_inverse=True)[1].astype(np.int64)
        span *= 2
    key = rank[starts] * count + rank[starts + length - span]
    order = np.argsort(key, kind="stable")
    fresh = np.concatenate(([True], key[order][1:] != key[order][:-1])) if len(order) else np.zeros(0, bool)
    return order, fresh


def _windows(opened: DataFrame, length: int) -> DataFrame:
    """Of open phrases (trigger, u, k, d, low, bytes), where no trigger has more than half of BLOCK_BYTES: repeated windows (u, k, d, low, high)."""
    met = opened.repartition("trigger").sortWithinPartitions("trigger")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def judged(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            block = pa.Table.from_batches(parts)
            # in corpus order; rows that repeat an id and its text are one document
            places = [block.column(c).to_numpy() for c in (*KEY, "low")]
            sort = np.lexsort(places[::-1])
            moves = np.ones(len(sort), bool)
            moves[1:] = np.logical_or.reduce([c[sort][1:] != c[sort][:-1] for c in places])
            block = block.take(pa.array(sort[moves])).combine_chunks()
            data, offsets = flat(block.column("bytes").combine_chunks())
            u, k, d, low = (block.column(c).to_numpy() for c in (*KEY, "low"))
            windows = np.diff(offsets) - length + 1
            row = np.repeat(np.arange(len(k)), windows)
            inner = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
            order, fresh = suffix_classes(data, offsets[row] + inner, length)
            # in each class of the suffix array the first in corpus order stays
            repeated = np.ones(len(row), bool)
            repeated[np.minimum.reduceat(order, np.flatnonzero(fresh))] = False
            runs, ends = word_spans(repeated, np.concatenate(([0], np.cumsum(windows))))
            at = low[row] + inner
            arrays = [pa.array(c[row[runs]]) for c in (u, k, d)] + [pa.array(c.astype(np.int32)) for c in (at[runs], at[ends - 1])]
            return pa.RecordBatch.from_arrays(arrays, names=[*KEY, "low", "high"])

        held: list[pa.RecordBatch] = []  # the last trigger may go on
        seen = None
        for batch in batches:
            for part in slices(batch, "bytes", SUFFIX_BYTES):
                trigger = part.column("trigger").to_numpy()
                begin = int(np.searchsorted(trigger, trigger[-1]))
                if held and (begin or trigger[0] != seen):
                    yield judged([*held, part.slice(0, begin)])
                    held = []
                elif begin:
                    yield judged([part.slice(0, begin)])
                held.append(part.slice(begin))
                seen = trigger[-1]
        if held:
            yield judged(held)

    return met.mapInArrow(run, "u byte, k long, d long, low int, high int")


def _opened(texts: DataFrame, rows: DataFrame, length: int) -> DataFrame:
    """(trigger, u, k, d, low, bytes) of the phrases in ``rows`` (u, k, d, low, high, trigger)."""
    wanted = rows.groupBy(*KEY).agg(F.collect_set(F.struct("trigger", "low", "high")).alias("open"))
    found = texts.join(wanted, KEY).select(*KEY, F.encode("text", "utf-8").alias("all"), F.explode("open").alias("o"))
    return found.select(
        F.col("o.trigger").alias("trigger"), *KEY, F.col("o.low").alias("low"),
        F.substring("all", F.col("o.low") + 1, F.col("o.high") - F.col("o.low") + length).alias("bytes"),
    )


def _large(rows: DataFrame, length: int) -> DataFrame:
    """Triggers whose phrases do not fit into half a block, so at most two per BLOCK_BYTES of phrases; stored."""
    size = F.sum(F.col("high") - F.col("low") + length)
    return stored(rows.groupBy("trigger").agg(size.alias("size")).where(F.col("size") > BLOCK_BYTES // 2).select("trigger"), "large")


def _bucketed(keyed: DataFrame) -> DataFrame:
    """The texts in buckets of their keys, so that joins on them do not move them again."""
    spark = keyed.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"texts_{uuid.uuid4().hex}"
    writer = keyed.repartition(buckets, *KEY).write.bucketBy(buckets, *KEY).option("compression", "zstd")
    writer.option("path", scratch_dir(spark, "texts")).saveAsTable(name)
    return spark.table(name)


def remove_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept), one row per row of ``docs``.

    Texts are UTF-8 bytes, NULL is ''. A byte goes if a string of ``length`` bytes that covers it also starts
    earlier: in a row with a smaller id (NULL ids last, rows of one id by 64 bits of their text's digest, NULL ids by 128), or in the same row
    at an earlier byte. ``n_spans`` counts the maximal runs removed, ``kept`` holds the bytes left, in order.
    Repeated rows are one document and get equal results. Texts shorter than ``length`` stay whole. Other columns
    are not returned. An empty table gives no rows.
    """
    if not 8 <= gram <= length:
        raise ValueError("gram must lie between 8 and length")
    texts = _bucketed(_keyed(docs, doc_id, text))
    found = _repeats(_phrases(texts, length, gram), _frequent(_phrases(_part(texts), length, gram)))
    span = ["u", "k", "d", "low", "high"]
    spans = found.where("trigger is null").select(*span)
    opened, fitting, width = found.where("trigger is not null"), [], length - gram + 1
    while width > 1 and not (large := _large(opened, length)).isEmpty():
        fitting.append(opened.join(F.broadcast(large), "trigger", "left_anti"))
        rest = opened.join(F.broadcast(large), "trigger", "left_semi")
        width = max(1, width // FINER)
        cut_up = [_pieces(_opened(texts, rows, length), length, gram, width) for rows in (rest, _part(rest))]
        found = _repeats(cut_up[0], _frequent(cut_up[1]))
        spans = spans.unionByName(found.where("trigger is null").select(*span))
        opened = found.where("trigger is not null")
    # pieces of one window have one kind for each trigger
    if width > 1 or not fitting:
        fitting.append(opened)
    judged = _windows(_opened(texts, reduce(DataFrame.unionByName, fitting), length), length)
    per_text = spans.unionByName(judged).groupBy(*KEY).agg(F.collect_list(F.struct("low", "high")).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = flat(part.column("text"))
                change = np.zeros(len(data) + 1, np.int64)
                lists = part.column("spans")
                values = lists.flatten()
                row = np.repeat(np.arange(part.num_rows), lists.value_lengths().fill_null(0).to_numpy())
                low = offsets[row] + values.field("low").to_numpy(zero_copy_only=False)
                high = offsets[row] + values.field("high").to_numpy(zero_copy_only=False) + length
                np.add.at(change, low, 1)
                np.add.at(change, high, -1)
                gone = np.cumsum(change[:-1]) > 0
                first, _ = word_spans(gone, offsets)
                n_spans = np.bincount(np.searchsorted(offsets, first, side="right") - 1, minlength=part.num_rows) if len(first) else np.zeros(part.num_rows, np.int64)
                so_far = np.concatenate(([0], np.cumsum(gone)))
                n_removed = so_far[offsets[1:]] - so_far[offsets[:-1]]
                kept = data[~gone].tobytes()
                ends = (offsets - so_far[offsets]).tolist()
                rest = [kept[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(offsets)), pa.array(n_removed, pa.int64()), pa.array(n_spans.astype(np.int64)),
                     pa.array(rest, pa.binary())],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    named = F.when(F.col("u") == 0, F.col("k")).alias("doc_id")
    joined = texts.join(per_text.hint("shuffle_hash"), KEY, "left").select(named, "text", "spans")
    return joined.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op2_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_passages(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES["op2_passage_dedup"] = op2_passage_dedup
