"""Hard-negative mining by Fagin's threshold algorithm over blocks of vectors.

Rows fall into blocks by the hash of their id. A task holds one block at a time, with one list per dimension,
sorted by that component, and meets the anchors in groups, which follow the block's rows in its partition. For
a group the lists are read from the top where an anchor's component is positive and from the bottom where it is
negative (sorted access), ever deeper; each row met for the first time is scored exactly (random access). What
has not been met by depth d cannot score more than the threshold, the inner product of the anchor with
the components at depth d. An anchor is done when its threshold falls strictly below the kth score of each
of its windows (below a window's lower end while the window holds fewer), strictly because ties go by id.

Two rounds: the first looks for the positives, one window without bounds over the anchor's own label; their scores
give the windows of the second, over all other labels. Blocks answer with their k best, and one
aggregation per round, limited before its shuffle, makes them the answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ship, stored, table
from .registry import ORACLE, QUERIES

ship(__name__)

POSITIVES = 5
NEGATIVES = 3
LOW_PERCENT = 50
HIGH_PERCENT = 95
SCALE = 256
BLOCK_ROWS = 4096
GROUP_ANCHORS = 256
FIRST_DEPTH = 16
EXACT = 1 << 53  # below, sums of integers in float64 are exact


def matrix(vectors: pa.Array) -> np.ndarray:
    """Rows of a list column as one float64 matrix; shorter ones end in zeros."""
    lengths = vectors.value_lengths().to_numpy()
    width = int(lengths.max()) if len(lengths) else 0
    out = np.zeros((len(vectors), width))
    out[np.arange(width)[None, :] < lengths[:, None]] = vectors.flatten().to_numpy()
    return out


def widened(rows: np.ndarray, width: int) -> np.ndarray:
    return np.pad(rows, ((0, 0), (0, width - rows.shape[1])))


def exact(rows: np.ndarray) -> np.ndarray:
    """Whole float64 numbers as Python integers."""
    return np.array([[int(x) for x in row] for row in rows], object).reshape(rows.shape)


class Lists:
    """The rows of a block, by id, and their order in every dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.rows = ids[order], labels[order], rows[order]
        self.order = np.argsort(self.rows, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.rows, self.order, axis=0)

    def search(self, anchors: np.ndarray, allowed: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(row, score) of the ``k`` best allowed rows in each anchor's windows [low, high], row -1 where there are fewer; and how many rows were scored.

        ``allowed``: anchors x rows, ``low`` and ``high``: anchors x windows. Equal scores keep the order of ids.
        """
        width = max(anchors.shape[1], self.rows.shape[1])
        anchors, rows = widened(anchors, width), widened(self.rows, width)
        count, lists = len(rows), self.order.shape[1]
        reach = np.abs(anchors).max(initial=0) * np.abs(rows).max(initial=0) * max(width, 1)
        if reach >= EXACT:
            anchors, rows = exact(anchors), exact(rows)
        scores = np.full((len(anchors), count), -np.inf, anchors.dtype)
        met = np.zeros(count, bool)
        best = np.full((*low.shape, k), -np.inf, anchors.dtype)
        open_ = np.arange(len(anchors))
        depth, scored = 0, 0
        while len(open_) and depth < count:
            deeper = min(count, max(FIRST_DEPTH, 2 * depth))
            signed = anchors[open_, :lists]
            top, bottom = (signed > 0).any(axis=0), (signed < 0).any(axis=0)
            fresh = np.zeros(count, bool)
            fresh[self.order[count - deeper : count - depth, top].ravel()] = True
            fresh[self.order[depth:deeper, bottom].ravel()] = True
            if deeper == count:
                fresh[:] = True  # an anchor of zeros alone reads no list
            fresh &= ~met
            met |= fresh
            new = np.flatnonzero(fresh)
            depth = deeper
            if len(new):
                scored += len(new)
                got = anchors[open_] @ rows[new].T
                scores[np.ix_(open_, new)] = got
                got = np.where(allowed[np.ix_(open_, new)], got, -np.inf)
                for w in range(low.shape[1]):
                    inside = np.where((got >= low[open_, w, None]) & (got <= high[open_, w, None]), got, -np.inf)
                    both = np.concatenate((best[open_, w], inside), axis=1)
                    best[open_, w] = -np.partition(-both, k - 1, axis=1)[:, :k] if both.dtype != object else -np.sort(-both, axis=1)[:, :k]
            if depth < count:
                above = np.where(signed > 0, signed, 0) @ self._values(count - depth, signed.dtype)
                below = np.where(signed < 0, signed, 0) @ self._values(depth - 1, signed.dtype)
                threshold = above + below
                kth = best[open_].min(axis=2) if best.shape[1] else np.full((len(open_), 0), np.inf)
                needed = np.maximum(kth, low[open_])
                empty = low[open_] > high[open_]
                done = ((threshold[:, None] < needed) | empty).all(axis=1)
                open_ = open_[~done]
        found = np.full((*low.shape, k), -1, np.int64)
        values = np.zeros((*low.shape, k), scores.dtype)
        ok = np.where(allowed, scores, -np.inf)
        every = np.arange(len(anchors))
        for w in range(low.shape[1]):
            inside = np.where((ok >= low[:, w, None]) & (ok <= high[:, w, None]), ok, -np.inf)
            for place in range(min(k, count)):
                at = inside.argmax(axis=1)
                value = inside[every, at]
                there = value > -np.inf
                found[there, w, place] = at[there]
                values[there, w, place] = value[there]
                inside[every, at] = -np.inf
        return found, values, scored

    def _values(self, depth: int, kind: np.dtype) -> np.ndarray:
        values = self.sorted[depth]
        return values if kind != object else exact(values[None, :])[0]


def vectors_of(df: DataFrame, vec_id: str, vector: str, label: str, anchor: Column, scale: int) -> DataFrame:
    """(id, label, vector: whole numbers, anchor, block) of the rows that take part; stored."""
    broken = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    rows = df.where(~broken & F.col(label).isNotNull() & F.col(vec_id).isNotNull()).select(
        F.col(vec_id).cast("long").alias("id"), anchor.alias("anchor"),
        F.struct(
            F.col(label).cast("long").alias("label"), F.transform(vector, lambda x: F.rint(F.floor(F.lit(float(scale)) * x.cast("double")))).alias("vector")
        ).alias("row"),
    )
    single = stored(rows.groupBy("id").agg(F.min("row").alias("row"), F.max("anchor").alias("anchor")), "vectors")
    blocks = single.count() // BLOCK_ROWS + 1
    return single.select(
        "id", "row.label", "row.vector", F.coalesce("anchor", F.lit(False)).alias("anchor"),
        F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), F.lit(blocks).alias("blocks"),
    )


def _round(rows: DataFrame, asked: DataFrame, same_label: bool, k: int) -> DataFrame:
    """(anchor_id, window, other_id, score): the k best of every block for each window of ``asked`` (id, label, vector, blocks, low, high)."""
    blocks = rows.select("blocks").limit(1).collect()
    many = blocks[0][0] if blocks else 1
    none = F.array().cast("array<long>")
    held = rows.select("block", F.lit(0).alias("kind"), "id", "label", "vector", none.alias("low"), none.alias("high"))
    met = asked.select(
        F.explode(F.sequence(F.lit(0), F.lit(many - 1))).alias("block"), F.lit(1).alias("kind"), "id", "label", "vector", "low", "high"
    )
    parts = min(many, 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = held.unionByName(met).repartition(parts, "block").sortWithinPartitions("block", "kind", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts, lists = None, [], None

        def answer(group: pa.RecordBatch) -> pa.RecordBatch:
            ids, labels = group.column("id").to_numpy(), group.column("label").to_numpy()
            own = labels[:, None] == lists.labels[None, :]
            allowed = (own if same_label else ~own) & (ids[:, None] != lists.ids[None, :])
            windows = int(group.column("low").value_lengths().to_numpy().max(initial=0))
            low, high = np.full((len(ids), windows), np.inf), np.full((len(ids), windows), -np.inf)
            if not same_label:
                low, high = low.astype(object), high.astype(object)
            for side, name in ((low, "low"), (high, "high")):
                for row, values in enumerate(group.column(name).to_pylist()):
                    side[row, : len(values)] = values
            if same_label:
                low, high = np.full((len(ids), 1), -np.inf), np.full((len(ids), 1), np.inf)
            elif all(abs(x) < EXACT for side in (low, high) for x in side.ravel() if abs(x) != np.inf):
                low, high = low.astype(float), high.astype(float)
            found, values, _ = lists.search(matrix(group.column("vector")), allowed, low, high, k)
            row, window, place = np.nonzero(found >= 0)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids[row]), pa.array(window.astype(np.int32)), pa.array(lists.ids[found[row, window, place]]),
                 pa.array([int(x) for x in values[row, window, place]], pa.int64())],
                names=["anchor_id", "window", "other_id", "score"],
            )

        for batch in batches:
            at = batch.column("block").to_numpy()
            kind = batch.column("kind").to_numpy()
            cuts = np.flatnonzero((at[1:] != at[:-1]) | (kind[1:] != kind[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, len(at)], strict=True):
                if a == b:
                    continue
                if int(at[a]) != block:
                    block, parts, lists = int(at[a]), [], None
                if kind[a] == 0:
                    parts.append(batch.slice(a, b - a))
                    continue
                if lists is None and parts:
                    width = max(int(p.column("vector").value_lengths().to_numpy().max(initial=0)) for p in parts)
                    lists = Lists(
                        np.concatenate([p.column("id").to_numpy() for p in parts]), np.concatenate([p.column("label").to_numpy() for p in parts]),
                        np.concatenate([widened(matrix(p.column("vector")), width) for p in parts]),
                    )
                    parts = []
                for start in range(a, b, GROUP_ANCHORS):
                    if lists is not None:
                        yield answer(batch.slice(start, min(GROUP_ANCHORS, b - start)))

    return dealt.mapInArrow(run, "anchor_id long, window int, other_id long, score long")


def mine(
    df: DataFrame, anchor: Column, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", positives: int = POSITIVES,
    negatives: int = NEGATIVES, low_percent: int = LOW_PERCENT, high_percent: int = HIGH_PERCENT, scale: int = SCALE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows where ``anchor`` holds.

    Components become floor(scale x), a score is the inner product of two rows, a shorter vector ends in zeros. An anchor's
    positives are its first ``positives`` other rows of the same label, and each of them has the first
    ``negatives`` rows of other labels with low_percent positive_score <= 100 negative_score <= high_percent
    positive_score; higher scores come first, ties by smaller id. Rows with a NULL id, label or vector or with a NULL or
    non-finite component take no part. Of rows that repeat an id the one with the smallest (label, vector)
    takes part. Scores must fit 64 bits. Other columns are not looked at; an empty table gives no rows.
    """
    rows = vectors_of(df, vec_id, vector, label, anchor, scale)
    no_window = F.array().cast("array<long>")
    asked = rows.where("anchor").select("id", "label", "vector", no_window.alias("low"), no_window.alias("high"))
    first = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "other_id")
    near = _round(rows, asked, True, positives).withColumn("place", F.row_number().over(first)).where(F.col("place") <= positives)
    near = stored(near.select("anchor_id", "place", F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    score = F.col("positive_score").cast("decimal(20,0)")
    floor = lambda percent: F.floor(score * percent / F.lit(100).cast("decimal(3,0)"))
    bounds = near.select(
        "anchor_id", "place",
        (-F.floor(-score * low_percent / F.lit(100).cast("decimal(3,0)"))).cast("long").alias("low"), floor(high_percent).cast("long").alias("high"),
    )
    listed = bounds.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("place", "low", "high"))).alias("windows"))
    asked = listed.join(rows.select(F.col("id").alias("anchor_id"), "label", "vector"), "anchor_id").select(
        F.col("anchor_id").alias("id"), "label", "vector", F.col("windows.low").alias("low"), F.col("windows.high").alias("high")
    )
    ranked = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "other_id")
    far = _round(rows, stored(asked, "windows"), False, negatives).withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= negatives)
    far = far.withColumn("place", F.col("window") + 1).withColumnRenamed("other_id", "negative_id").withColumnRenamed("score", "negative_score")
    return far.join(near, ["anchor_id", "place"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", label), F.col("vec_id") % 50 == 0)


QUERIES["op11_hard_negatives"] = op11_hard_negatives
ORACLE["op11_hard_negatives"] = r"""
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)::INTEGER AS rank,
  s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""
