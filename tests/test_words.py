import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reviewlens import schemas as S
from reviewlens.functions import patterns as P
from reviewlens.operators import sentiment, words


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, t string")


def test_stop_words_are_the_fixed_list():
    assert len(S.KEYWORD_STOP_WORDS) == len(set(S.KEYWORD_STOP_WORDS)) == 49


def test_tokens(spark):
    df = docs(spark, "很 好看, so 好 good!", "", None, "因为 good a")
    got = words.tokens(df, "t", "id", stop=S.KEYWORD_STOP_WORDS)
    assert sorted((r.id, r.token) for r in got.collect()) == [(0, "good"), (0, "so"), (0, "好看"), (3, "good")]


def test_split_pairs(spark):
    got = words.tokens(docs(spark, "好看电影good 影片"), "t", splitter=words.split_pairs)
    assert sorted(r.token for r in got.collect()) == sorted(["好看", "看电", "电影", "good", "影片"])


def test_longest_matches():
    known = frozenset(["霸王", "霸王别姬", "别姬", "电影"])
    assert words.longest_matches("看霸王别姬电影", known, 4) == ["看", "霸王别姬", "电影"]
    assert words.longest_matches("", known, 4) == []


def test_dictionary_splitter(spark):
    df = docs(spark, "看霸王别姬电影 good", "霸王", "", None)
    split = words.dictionary_splitter(df, ["霸王", "霸王别姬", "电影", "go"])
    got = words.tokens(df, "t", "id", splitter=split, min_len=1)
    assert sorted((r.id, r.token) for r in got.collect()) == sorted(
        [(0, "看"), (0, "霸王别姬"), (0, "电影"), (0, "go"), (0, "o"), (0, "d"), (1, "霸王")]
    )
    assert words.tokens(docs(spark, "", None), "t", splitter=split, min_len=1).count() == 0


def test_dictionary_bound(spark, monkeypatch):
    monkeypatch.setattr(words, "MAX_DICTIONARY_BYTES", 3)
    with pytest.raises(ValueError):
        words.dictionary_splitter(docs(spark, "a"), ["abcd"])


def test_bigrams_skip_stop_words(spark):
    got = words.term_bigrams(docs(spark, "aa the bb cc", "aa bb", "zz"), "t", stop=["the"])
    assert {(r.first, r.second): r.n for r in got.collect()} == {("aa", "bb"): 2, ("bb", "cc"): 1}


def test_term_counts_by_brute_force(spark):
    texts = ["aa bb aa cc", "bb", "aa bb", ""]
    want = Counter()
    for t in texts:
        tokens = t.split()
        want.update((w, None) for w in tokens)
        want.update(zip(tokens, tokens[1:]))
    got = words.term_counts(docs(spark, *texts), "t")
    assert {(r.first, r.second): r.n for r in got.collect()} == dict(want)


def test_cloud_terms_move_counts_to_collocations(spark):
    texts = ["new york"] * 40 + [f"w{i:03d} v{i:03d}" for i in range(400)] + ["new car", "old york"]
    got = {r.term: r.n for r in words.cloud_terms(docs(spark, *texts), "t", top=5).collect()}
    assert got["new york"] == 40 and got.get("new", 1) == 1


def test_keywords_without_table(spark):
    counts = words.value_counts(words.tokens(docs(spark, "aa bb aa"), "t"), "token")
    stop = spark.createDataFrame([("bb",)], "token string")
    assert [(r.token, r.n) for r in words.without(counts, stop).collect()] == [("aa", 2)]


TRAIN = [("好看 喜欢 good", 1), ("喜欢 喜欢 great", 1), ("难看 bad bad", 0), ("无聊 bad", 0), ("skip", None)]


def by_hand(text):
    """The same model in plain Python: per class one unit per token and one per distinct token."""
    counts = {1: Counter(), 0: Counter()}
    for t, label in TRAIN:
        if label is not None:
            counts[label].update(t.split())
    mass = {c: sum(n.values()) + len(n) for c, n in counts.items()}
    logs = {
        c: math.log(mass[c]) + sum(math.log((counts[c][w] + 1) / mass[c]) for w in text.split()) for c in (0, 1)
    }
    return 1 / (1 + math.exp(logs[0] - logs[1]))


@pytest.mark.parametrize("hot", [1000, 2, 0])
def test_naive_bayes(spark, hot):
    model = sentiment.fit_nb(spark.createDataFrame(TRAIN, "text string, label int"), "text", "label")
    texts = ["喜欢 good", "bad bad bad", "好看 bad 新词", "新词 新词", "喜欢"]
    df = docs(spark, *texts, "。。。", "", None)
    got = {r.id: r.probability for r in sentiment.score(df, model, "id", "t", hot_tokens=hot).collect()}
    assert set(got) == {0, 1, 2, 3, 4, 5}
    for i, text in enumerate(texts):
        assert math.isclose(got[i], by_hand(text), rel_tol=1e-9)
    assert got[5] == 0.5


def test_buckets_at_the_bounds(spark):
    df = spark.createDataFrame([(0.7,), (0.7001,), (0.3,), (0.2999,), (0.5,)], "probability double")
    got = [(r.sentiment, r.score) for r in sentiment.with_sentiment(df).collect()]
    assert got == [("中性", 0.7), ("正面", 0.7), ("中性", 0.3), ("负面", 0.3), ("中性", 0.5)]


def test_summary_and_average(spark):
    scored = sentiment.with_sentiment(spark.createDataFrame([(0.9,), (0.8,), (0.1,)], "probability double"))
    got = {r.sentiment: (r.n, r.percent) for r in sentiment.summary(scored).collect()}
    assert got == {"正面": (2, 66.7), "中性": (0, 0.0), "负面": (1, 33.3)}
    assert sentiment.average(scored).first().average == 0.6
    empty = scored.where("false")
    assert {(r.n, r.percent) for r in sentiment.summary(empty).collect()} == {(0, None)}
    assert sentiment.average(empty).first().average == 0.5


def test_weights(spark):
    got = words.term_weights(docs(spark, "aa aa bb"), "t", keep=P.KEEP_LATIN).collect()
    assert [(r.token, r.rank, r.weight) for r in got] == [("aa", 1, 1.0), ("bb", 2, 0.5)]


def routes(run, words, total):
    """Every cut of ``run``: (product of frequencies as a logarithm, sizes from the left)."""
    if not run:
        return [(0.0, ())]
    out = []
    for size in range(1, len(run) + 1):
        if size == 1 or run[:size] in words:
            weight = math.log(max(words.get(run[:size], 1.0), 1.0) / total)
            out += [(weight + rest, (size, *sizes)) for rest, sizes in routes(run[size:], words, total)]
    return out


def test_best_routes_match_brute_force(spark):
    rng = random.Random(5)
    runs = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(60)] + ["zz", "a" * 9]
    rows = [("".join(rng.choice("abc") for _ in range(rng.randint(1, 4))), rng.randint(1, 50)) for _ in range(40)] + [("ab", 7), ("ab", 5)]
    dictionary = spark.createDataFrame(rows, "word string, n long")
    known = {}
    for word, n in rows:
        known[word] = known.get(word, 0.0) + n
    total = sum(known.values())
    got = {r.run: r.words for r in words.run_words(spark.createDataFrame([(r,) for r in [*runs, "", None]], "run string"), dictionary).collect()}
    assert set(got) == set(runs)
    for run, cut in got.items():
        best = max(w for w, _ in routes(run, known, total))
        mine = sum(math.log(max(known.get(x, 1.0), 1.0) / total) for x in cut)
        assert "".join(cut) == run and mine == pytest.approx(best)
        assert all(len(x) == 1 or x in known for x in cut)


def test_dictionary_tokens_without_words_and_plan(spark):
    df = spark.createDataFrame([(1, "abab ccc"), (2, None), (3, "")], "i int, x string")
    empty = spark.createDataFrame([], "word string, n long")
    assert words.dictionary_tokens(df, "x", empty, "i", min_len=1).count() == 7
    made = words.dictionary_tokens(df, "x", spark.createDataFrame([("ab", 3), ("cc", 2)], "word string, n long"), "i")
    assert sorted((r.i, r.token) for r in made.collect()) == [(1, "ab"), (1, "ab"), (1, "cc")]


def test_texts_are_cut_a_slice_at_a_time_and_long_runs_are_not_remembered(spark, monkeypatch):
    sizes = [len(s) for s in words.text_slices(pa.array(["a" * 10, None, "b" * 10, "c" * 50, "", "d"]), 20)]
    assert sizes == [3, 1, 2] and list(words.text_slices(pa.array([], pa.string()))) == []
    monkeypatch.setattr(words, "SLICE_BYTES", 30)
    texts = ["电影" * 40 + " go 霸王别姬", "", None, "电影x", "霸王" * 100] * 3
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string").coalesce(1)
    split = words.dictionary_splitter(df, ["霸王", "霸王别姬", "电影", "go"])
    got = [r.t for r in df.select("i", split(F.col("x")).alias("t")).orderBy("i").collect()]
    assert got == [["电影"] * 40 + ["go", "霸王别姬"], [""], None, ["电影", "x"], ["霸王"] * 100] * 3


def test_dictionary_tokens_read_the_texts_once_and_repeat_counted_runs(spark, monkeypatch):
    monkeypatch.setattr(words, "REPEATS", 3)
    seen = spark.sparkContext.accumulator(0)

    def passed(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.createDataFrame([(1, "abab cc"), (1, "abab"), (None, "abab x"), (2, None)] * 7, "i int, x string").mapInArrow(passed, "i int, x string")
    made = words.dictionary_tokens(df, "x", spark.createDataFrame([("ab", 3), ("cc", 2)], "word string, n long"), "i", min_len=1)
    got = Counter((r.i, r.token) for r in made.collect())
    assert got == {(1, "ab"): 28, (1, "cc"): 7, (None, "ab"): 14, (None, "x"): 7}
    assert seen.value == 28


def test_routes_of_many_runs_at_once():
    log = [math.log(x) for x in (0.5, 0.2, 0.1)]
    # "abc" with b (0.5), ab (0.2), bc (0.1); "d" without words; "ab" where the longer word ties with its parts
    first, step = words.best_routes(
        np.array([3, 1, 2]), np.array([0, 0, 0, 2]), np.array([1, 0, 1, 0]), np.array([1, 2, 2, 2]),
        np.array([*log, 2 * math.log(0.01)]), math.log(0.01),
    )
    assert first.tolist() == [0, 4, 6, 9]
    assert step[[3, 1]].tolist() == [2, 1] and step[5] == 1 and step[8] == 2
