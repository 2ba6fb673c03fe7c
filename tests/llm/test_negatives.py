import math
import random

import numpy as np
from pyspark.sql import functions as F

from reviewlens.llm import negatives
from reviewlens.llm.negatives import Lists, mine

from .util import clashing, frame

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, positives=5, negatives_=3, low=50, high=95):
    kept = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = tuple(math.floor(256 * x) for x in v)
        kept[i] = min(kept.get(i, (label, whole)), (label, whole))
    out = []
    for a, (la, va) in kept.items():
        if a % 50:
            continue
        scores = sorted((-sum(x * y for x, y in zip(va, vb, strict=False)), b, lb) for b, (lb, vb) in kept.items() if b != a)
        for s, p, _ in [x for x in scores if x[2] == la][:positives]:
            window = [x for x in scores if x[2] != la and -low * s <= -100 * x[0] <= -high * s][:negatives_]
            out += [(a, p, rank, n, -s, -t) for rank, (t, n, _) in enumerate(window, 1)]
    return sorted(out)


def result(df, **options):
    return sorted(tuple(r) for r in mine(df, F.col("vec_id") % 50 == 0, **options).collect())


def vectors(seed, n, dims=6, labels=3, grain=4):
    rng = random.Random(seed)
    return [(i, [rng.randint(-grain, grain) / grain for _ in range(dims)], rng.randrange(labels)) for i in range(n)]


def test_matches_brute_force_with_ties(spark):
    rows = vectors(1, 400)
    rows += [
        (None, [1.0] * 6, 1), (1000, None, 1), (1001, [1.0, None] * 3, 1), (1002, [float("nan")] * 6, 1), (1003, [float("inf")] * 6, 1),
        (1050, [0.5] * 6, None), (1100, [], 1), (1150, [0.25] * 9, 2), (1200, [0.0] * 6, 0), (50, [1.0] * 6, 9), (50, [1.0] * 6, 9),
        (7, [0.5, 0.5], 0), (-50, [0.75] * 6, 1),
    ]
    got = result(frame(spark, rows, SCHEMA))
    assert got == brute(rows) and len(got) > 60
    assert {r[0] for r in got} >= {0, 100, 1150, -50}


def test_many_blocks(spark, monkeypatch):
    rows = vectors(2, 700, 5, 4, 9)
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 64)
    assert result(frame(spark, rows, SCHEMA), positives=2, negatives=4) == brute(rows, 2, 4)


def test_scores_beyond_float64(spark):
    rows = [(i, [x * 2.0**21 for x in v] + [2.0**-8], label) for i, v, label in vectors(3, 120, 4, 2, 50)]
    got = result(frame(spark, rows, SCHEMA))
    assert got == brute(rows) and max(abs(r[4]) for r in got) > 2**53


def test_empty_table_and_clashing_columns(spark):
    assert result(frame(spark, [], SCHEMA)) == []
    rows = vectors(4, 120)
    df = clashing(frame(spark, rows, SCHEMA))
    for name in ("anchor", "block", "blocks", "low", "high", "kind", "row", "vector", "other_id", "window", "place"):
        df = df.withColumn(name, F.lit(1))
    assert result(df) == brute(rows)


def test_search_stops_early():
    """Rows whose scores fall off fast: the threshold sinks below the kth score long before the lists end."""
    rng = np.random.default_rng(1)
    rows = np.floor(rng.exponential(1.0, (5000, 2)) ** 3 * 100)
    lists = Lists(np.arange(5000), np.zeros(5000, int), rows)
    anchors = np.array([[3.0, 2.0], [1.0, 5.0]])
    allowed, none = np.ones((2, 5000), bool), np.full((2, 1), -np.inf)
    found, values, scored = lists.search(anchors, allowed, none, -none, 5)
    want = -np.sort(-(anchors @ rows.T), axis=1)[:, :5]
    assert (values[:, 0] == want).all() and scored < 500
    high = want[:, 4:] - 1
    found, values, scored = lists.search(anchors, allowed, none, high, 3)
    inside = np.where(anchors @ rows.T <= high, anchors @ rows.T, -np.inf)
    assert (values[:, 0] == -np.sort(-inside, axis=1)[:, :3]).all() and scored < 1000
