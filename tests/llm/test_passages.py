import hashlib
import os
import random

import numpy as np
from pyspark.sql import functions as F

from reviewlens.llm import passages as P

from .util import clashing, frame, prose


def brute(rows, length):
    """Rows in the order of their ids, NULL last; every window against all earlier ones."""
    seen, out = set(), {}
    for i, text in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for a in range(len(data) - length + 1):
            window = data[a : a + length]
            if window in seen:
                gone[a : a + length] = b"\x01" * length
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[i, text] = (i, len(data), sum(gone), spans, kept)
    return [out[r] for r in rows]


def made():
    rng = random.Random(8)
    passage, other = prose(50, 60, 800), prose(51, 25, 800)
    rows = []
    for i in range(60):
        text = prose(i, 60, 800)
        if i % 3 == 0:
            cut = rng.randrange(len(text))
            text = text[:cut] + passage + text[cut:]
        if i % 4 == 0:
            text = other[rng.randrange(20) :] + text
        if i % 7 == 0:
            text = text + " " + text[: rng.randrange(40, 300)]
        rows.append((100 - i, text))
    rows += [(200, None), (201, ""), (202, "short"), (203, "a" * 700), (204, "ab" * 400), (205, "a" * 99), (206, "é漢" * 120)]
    rows += [(None, passage), (207, rows[5][1]), (208, rows[5][1]), (207, rows[5][1]), (209, rows[9][1][:150] + "x" + rows[9][1][150:])]
    rows += [(210, prose(77, 4000, 40)), (300, (passage + "\n") * 30), (None, passage)]
    rows += [(401, prose(401, 80, 800)), (401, prose(401, 80, 800)), (402, passage[5:] + prose(402, 40)), (402, passage[5:] + prose(402, 40))]
    return rows


def check(got, rows, length):
    plain = lambda rs: sorted(rs, key=lambda r: tuple((x is None, x) for x in r))
    assert plain([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got]) == plain(brute(rows, length))


def test_matches_brute_force(spark):
    rows = made()
    check(P.remove_passages(clashing(frame(spark, rows))).collect(), rows, 100)


def test_other_lengths_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(P, "BLOCK_BYTES", 4000)
    rows = made()[:40] + made()[-18:]
    check(P.remove_passages(frame(spark, rows), length=30, gram=12).collect(), rows, 30)


def test_empty_table(spark):
    assert P.remove_passages(frame(spark, [])).collect() == []


def test_window_minima():
    rng = np.random.default_rng(1)
    for width in (1, 2, 7, 81):
        values = rng.integers(0, 30, 300)
        want = [i + int(np.argmin(values[i : i + width])) for i in range(300 - width + 1)]
        assert P.window_minima(values, width).tolist() == want


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = {(*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in brute(rows, 100)}
    assert {tuple(r) for r in P.op2_passage_dedup(spark, sf).collect()} == want and any(r[2] for r in want)


def test_rows_whose_texts_share_thirty_bits(spark):
    """Texts of NULL ids and of one id that a 32-bit hash cannot tell apart are documents of their own."""
    passage = prose(90, 40, 800)
    tail = F.concat(F.lit(passage), F.when(F.col("id") % 2 == 0, F.lit("")).otherwise(F.lit("0123456789" * 40)))
    made = spark.range(120_000).select(F.concat(F.format_string("%07d ", "id"), tail).alias("text"))
    alike = made.groupBy(F.hash("text").bitwiseAND(F.lit((1 << 30) - 1))).agg(F.sort_array(F.collect_list("text")).alias("t")).where("size(t) = 2")
    pairs = [r.t for r in alike.collect()]
    assert len(pairs) > 1
    for name in (None, 7):
        for pair in pairs[:2]:
            got = P.remove_passages(frame(spark, [(name, t) for t in pair])).collect()
            # which of the two comes first is up to their digests
            either = [sorted(r[1:] for r in brute(list(enumerate(order)), 100)) for order in (pair, pair[::-1])]
            assert sorted((r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) in either
            assert [r.doc_id for r in got] == [name] * 2


def around(passage, n):
    """``passage`` in ``n`` texts, each time between other words."""
    return [(i, prose(1000 + i, 40, 800) + passage + prose(5000 + i, 40, 800)) for i in range(n)]


def test_triggers_beyond_a_block_make_no_row_per_window(spark, monkeypatch):
    """A passage in very many texts: phrases at its ends differ, share a trigger and do not fit into one block."""
    counts = []

    def counted(df, label, stored=P.stored):
        out = stored(df, label)
        counts.append((label, out.count()))
        return out

    monkeypatch.setattr(P, "stored", counted)
    rows = around(prose(9, 60, 800), 300)
    for block in (4 << 20, 40_000, 2_000):
        counts.clear()
        monkeypatch.setattr(P, "BLOCK_BYTES", block)
        check(P.remove_passages(frame(spark, rows)).collect(), rows, 100)
        assert sum(n for _, n in counts) < 30 * len(rows)


def test_frequent_triggers_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(P, "FREQUENT_PART", 1)
    monkeypatch.setattr(P, "FREQUENT_LEAST", 2)
    rows = made() + around(prose(9, 60, 800), 20)
    for block in (P.BLOCK_BYTES, 4000):
        monkeypatch.setattr(P, "BLOCK_BYTES", block)
        check(P.remove_passages(frame(spark, rows)).collect(), rows, 100)


def test_texts_are_parsed_once(spark, monkeypatch, tmp_path):
    class Noted(P.Parser):
        def phrases(self, data, offsets):
            with open(f"{folder}/{os.getpid()}", "a") as out:
                out.write(f"{len(data)}\n")
            return super().phrases(data, offsets)

    folder = str(tmp_path)
    monkeypatch.setattr(P, "Parser", Noted)
    rows = [(i, prose(i, 200, 800)) for i in range(200)]
    check(P.remove_passages(frame(spark, rows)).collect(), rows, 100)
    parsed = sum(int(line) for file in tmp_path.iterdir() for line in file.read_text().split())
    assert parsed < 1.25 * sum(len(text.encode()) for _, text in rows)
