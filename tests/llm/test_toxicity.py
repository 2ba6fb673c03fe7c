import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reviewlens.llm import toxicity
from reviewlens.llm.toxicity import fit, score, threshold

from .util import clashing, frame

SCHEMA = "doc_id long, text string, toxic int, held boolean"
BAD = ["zorgle", "blastik", "quavix"]


def words_of(text):
    return [w for w in re.split(r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").lower()) if w]


def pieces(word, order):
    spelt = " " * (order - 1) + word + " "
    return [spelt[i : i + order] for i in range(len(word) + 1)]


class Brute:
    """The same models over dictionaries."""

    def __init__(self, rows, order, d=0.75, big=toxicity.CLASS_DISCOUNT):
        self.order, self.d, self.big = order, d, big
        self.c = [Counter(), Counter()]
        for text, toxic in rows:
            for w in words_of(text):
                self.c[toxic].update(pieces(w, order))
        self.all, self.freed = [Counter(), Counter()], [Counter(), Counter()]
        for y in (0, 1):
            for g, n in self.c[y].items():
                self.all[y][g[:-1]] += n
                self.freed[y][g[:-1]] += min(n, big)
        self.both = self.c[0] + self.c[1]
        self.met = {}
        lower = set(self.both)
        for size in range(order - 1, 0, -1):
            self.met[size] = Counter(g[1:] for g in lower)
            lower = set(self.met[size])

    def below(self, g):
        table = self.met[len(g)]
        same = [k for k in table if k[:-1] == g[:-1]]
        lower = self.below(g[1:]) if len(g) > 1 else 1 / (len(same) + 1)
        return (max(table[g] - self.d, 0) + self.d * len(same) * lower) / sum(table[k] for k in same)

    def ratio(self, g):
        h, p, shared = g[:-1], [], 1.0
        if g in self.both:
            kinds = sum(k[:-1] == h for k in self.both)
            shared = (max(self.both[g] - self.d, 0) + self.d * kinds * self.below(g[1:])) / (self.all[0][h] + self.all[1][h])
        for y in (0, 1):
            total = self.all[y][h]
            own = max(self.c[y][g] - self.big, 0) / total if total else 0.0
            p.append(own + (self.freed[y][h] / total if total else 1.0) * shared)
        return math.log(p[1] / p[0])

    def raw(self, text):
        words = words_of(text)
        return sum(max(sum(self.ratio(g) for g in pieces(w, self.order)) - toxicity.MARGIN, 0) for w in words) / max(1, len(words))


def corpus(seed, n, share=0.3):
    rng = random.Random(seed)
    plain = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 8))) for _ in range(80)]
    rows = []
    for i in range(n):
        toxic = int(rng.random() < share)
        text = [rng.choice(plain) for _ in range(rng.randint(5, 60))]
        if toxic:
            text = [rng.choice(BAD) + rng.choice(["", "s", "ing"]) if rng.random() < 0.15 else w for w in text] + [rng.choice(BAD)]
        rows.append((i, " ".join(text) + ".", toxic, i % 4 == 3))
    return rows


def test_matches_brute_force(spark):
    rows = corpus(1, 120) + [(500, None, 1, False), (501, "", 0, False), (502, "Élan ÉLAN 漢字 x1", 1, False), (503, "a", None, False), (504, "b", 7, False)]
    model = fit(frame(spark, rows, SCHEMA))
    brute = Brute([(t, y) for _, t, y, held in rows if not held and y in (0, 1) and t is not None], toxicity.ORDER)
    texts = [(1, None), (2, ""), (3, "... !"), (4, "zorgles\x00 blast"), (5, "unmet wörds 漢字漢"), (6, "Élan " * 3000), *[(10 + r[0], r[1]) for r in rows[:10]]]
    got = {r.doc_id: r.raw for r in toxicity.raw_scores(frame(spark, texts), model, "text", ["doc_id"], "raw").collect()}
    for i, text in texts:
        assert got[i] == pytest.approx(brute.raw(text), abs=1e-4), text


def test_small_pieces_change_nothing(spark, monkeypatch):
    rows = frame(spark, corpus(5, 60), SCHEMA)
    texts = frame(spark, [(1, "zorgle " * 40 + "a" * 70 + " blastik"), (2, "b" * 200)])
    scores = lambda model: [r.raw for r in toxicity.raw_scores(texts, model, "text", ["doc_id"], "raw").collect()]
    model = fit(rows)
    whole = scores(model)
    monkeypatch.setattr(toxicity, "PIECE", 32)
    again = fit(rows)
    assert (model["met"] == again["met"]).sum() == (again["met"] == again["met"]).sum() and scores(model) == pytest.approx(whole)


def test_held_out_accuracy(spark):
    model = fit(frame(spark, corpus(2, 400), SCHEMA))
    fresh = corpus(2, 900)[400:]
    got = {r.doc_id: r.predicted for r in score(frame(spark, fresh, SCHEMA), model).collect()}
    right = sum(got[i] == toxic for i, _, toxic, _ in fresh)
    assert right >= 0.95 * len(fresh)


def test_odd_inputs(spark):
    rows = corpus(3, 80)
    model = fit(frame(spark, rows, SCHEMA))
    odd = [(1, None), (2, ""), (None, "zorgle zorgle"), (4, "zorgle zorgle"), (4, "zorgle zorgle"), (5, "stone " * 50_000)]
    df = clashing(frame(spark, odd)).withColumn("raw", F.lit("r")).withColumn("toxic", F.lit(9)).withColumn("predicted", F.lit("p"))
    got = [(r.doc_id, r.score, r.predicted, r.raw) for r in score(df, model).collect()]
    by = {}
    for i, s, p, raw in got:
        assert 0 <= s <= 1 and p == int(s >= 0.5) and raw == "r"
        by.setdefault(i, set()).add(s)
    assert len(got) == 6 and all(len(x) == 1 for x in by.values()) and by[1] == by[2] and by[None] == by[4]
    assert score(frame(spark, []), model).collect() == []


def test_without_labels(spark):
    assert fit(frame(spark, [], SCHEMA)) is None
    assert fit(frame(spark, [(1, "a b", 0, False), (2, "c", 1, True)], SCHEMA)) is None
    got = score(frame(spark, [(1, "a"), (2, None)]), None).collect()
    assert [(r.score, r.predicted) for r in got] == [(0.0, 0), (0.0, 0)]


def test_threshold_takes_the_middle():
    bins = [(2000, 0, 50), (2010, 0, 10), (2100, 1, 5), (2150, 1, 3)]
    at, width = threshold(bins)
    assert 2010 < at / toxicity.BIN_WIDTH <= 2100 and width > 0
    assert threshold([(5, 0, 3)]) == (toxicity.BINS * toxicity.BIN_WIDTH, 1.0)
