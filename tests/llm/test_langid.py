import random

import numpy as np

from reviewlens.llm import langid

from .util import SCHEMA, clashing, frame


def brute_phrases(symbols, training):
    """Greedy longest pieces that the training text holds, block by block."""
    count = 0
    for b in range(0, len(symbols), langid.BLOCK):
        block = bytes(symbols[b : b + langid.BLOCK])
        i, open_ = 0, b""
        for c in block:
            if open_ + bytes([c]) in training:
                open_ += bytes([c])
            else:
                count += 1
                open_ = bytes([c]) if bytes([c]) in training else b""
            i += 1
    return count


def test_phrases_match_plain_parsing():
    rng = np.random.default_rng(3)
    training = rng.integers(0, 4, 500).astype(np.uint8)
    walk = langid.walk_table(langid.suffix_automaton(training, 6))
    texts = [rng.integers(0, 6, n).astype(np.uint8) for n in (0, 1, 7, 300, 1024, 2500)]
    starts = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    got = langid.count_phrases(np.concatenate(texts), starts, [walk, walk])
    assert got[:, 0].tolist() == [brute_phrases(t.tolist(), training.tobytes()) for t in texts]
    assert (got[:, 0] == got[:, 1]).all()


def invented(seed, syllables, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n))


A, B = ["ka", "to", "mi", "re"], ["schn", "ür", "og", "pfl"]


def test_predicts_and_handles_odd_rows(spark):
    rows = [(i, invented(i, A if i % 2 else B, 40), "aa" if i % 2 else "bb", None, None) for i in range(60)]
    rows += [
        (100, None, "aa", None, None), (101, "", None, None, None), (102, "123 !!", "bb", None, None),
        (None, invented(7, A, 30), None, None, None), (103, invented(8, B, 20_000), None, None, None),
        (104, "漢字かな", None, None, None), (105, invented(9, A, 30).upper(), "bb", None, None), (1, rows[1][1], "aa", None, None),
    ]
    docs = frame(spark, rows, SCHEMA)
    model = langid.fit(docs.where(langid.learned_from("doc_id")), sample_chars=4000)
    got = langid.identify(clashing(docs), model).collect()
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert all(by_id[i][0][0] == ("aa" if i % 2 else "bb") for i in range(60))
    assert [by_id[i][0][0] for i in (100, 101, 102)] == ["und"] * 3
    assert by_id[None][0][0] == "aa" and by_id[103][0][0] == "bb" and by_id[105][0][0] == "aa"
    assert by_id[104][0] == ("aa", 0.0) and len(set(by_id[1])) == 1
    kept = {r.doc_id for r in langid.keep_identified(spark, docs, "").collect()}
    assert kept == {r[0] for r in rows} - {100, 101, 102}


def test_empty_tables(spark):
    empty = frame(spark, [], SCHEMA)
    model = langid.fit(empty)
    assert langid.identify(empty, model).collect() == []
    one = frame(spark, [(1, "some text", None, None, None)], SCHEMA)
    assert [(r.lang_pred, r.score) for r in langid.identify(one, model).collect()] == [("und", 0.0)]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.op7_language_id(spark, "/root/testdata/sf0.01").where("held_out").join(docs, "doc_id")
    rows = [(r.lang, r.lang_pred) for r in got.where("lang is not null").collect()]
    assert sum(a == b for a, b in rows) >= 0.98 * len(rows) > 200


def test_phrases_of_many_symbols():
    rng = np.random.default_rng(4)
    training = (rng.integers(0, 3000, 4000) ** 2 // 3000).astype(np.uint32)
    walk = langid.walk_table(langid.suffix_automaton(training, 3002))
    texts = [(rng.integers(0, 3002, n) ** 2 // 3002).astype(np.uint32) for n in (1, 40, 900, 1024)] + [training[700:1500]]
    starts = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    plain = "".join(map(chr, training.tolist()))
    want = []
    for text in texts:
        count, held = 0, ""
        for c in map(chr, text.tolist()):
            if held + c in plain:
                held += c
            else:
                count, held = count + 1, c if c in plain else ""
        want.append(count)
    assert langid.count_phrases(np.concatenate(texts), starts, [walk])[:, 0].tolist() == want


def test_tells_languages_of_many_letters(spark):
    """Three scripts of 700 letters each, far more than the first few hundred letters there are."""
    kinds = {"de": 0x1400, "ko": 0xAC00, "zh": 0x4E00}  # 'de' has one letter in four from Latin

    def text(kind, seed):
        rng = random.Random(seed)
        pairs = [chr(kinds[kind] + random.Random(k).randrange(700)) + chr(kinds[kind] + random.Random(-k - 1).randrange(500)) for k in range(900)]
        return " ".join("a" * (kind == "de") + rng.choice(pairs) + rng.choice(pairs) for _ in range(60))

    names = sorted(kinds)
    rows = [(i, text(names[i % 3], i), names[i % 3], None, None) for i in range(90)]
    docs = frame(spark, rows, SCHEMA)
    model = langid.fit(docs.where(langid.learned_from("doc_id")))
    got = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    assert [got[r[0]].lang_pred for r in rows] == [r[2] for r in rows]
    assert min(r.score for r in got.values()) > 0.1
