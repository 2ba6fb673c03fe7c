import re
from collections import Counter

import numpy as np

from reviewlens.llm import quality as Q

from .util import clashing, frame, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    repeated = {k for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for k in range(i, i + 8)}
    return (
        len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text),
        sum(x in lines[:i] for i, x in enumerate(lines)), len(repeated),
    )


def made():
    texts = [prose(i, 60 + i) for i in range(30)] + [prose(1, 30) * 3, "same line\nsame line\n \n \nsame line", "a b c d e f g h " * 5]
    texts += [None, "", " \n\t", "#*$ |<>& %", "é ü 漢字 x", "x" * 100_000, ("long text of words " * 9000), "one", "a\r\na\r\na\n"]
    return list(enumerate(texts)) + [(None, texts[2]), (3, texts[3])]


def test_statistics_match_brute_force(spark):
    rows = made()
    got = [tuple(r[k] for k in ("doc_id", *Q.STATISTICS)) for r in Q.measured(clashing(frame(spark, rows))).collect()]
    assert sorted(got, key=str) == sorted(((i, *brute(t)) for i, t in rows), key=str)


def test_forest_scores_outliers_highest():
    rng = np.random.default_rng(0)
    points = np.concatenate((rng.normal(0, 1, (500, 4)), rng.normal(9, 0.5, (20, 4))))
    score = Q.anomaly(points, Q.fit_forest(points))
    assert (score > 0).all() and (score < 1).all() and score[500:].min() > np.quantile(score[:500], 0.95)
    assert Q.anomaly(points, []).tolist() == [0.0] * 520


def test_judging_odd_tables(spark):
    labels = frame(spark, [(i, i % 2) for i in range(20)] + [(None, 1), (5, None)], "doc_id long, quality int")
    got = Q.judge_quality(frame(spark, made()), labels).collect()
    assert len(got) == len(made())
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)
    none = frame(spark, [], "doc_id long, quality int")
    assert all(r.kept != r.base_failed for r in Q.judge_quality(frame(spark, made()), none).collect())
    assert Q.judge_quality(frame(spark, []), labels).collect() == []


def test_labelled_rows_of_the_query(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    good = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = Q.op5_quality_rules(spark, sf).collect()
    assert {r.doc_id: tuple(r[k] for k in Q.STATISTICS) for r in got} == {i: brute(t) for i, t in texts.items()}
    kept = {q: [r.kept for r in got if good.get(r.doc_id) == q and not r.base_failed] for q in (0, 1)}
    assert np.mean(kept[1]) > 0.95 and np.mean(kept[0]) < 0.1
