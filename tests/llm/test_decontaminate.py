import hashlib
import re

import numpy as np

from reviewlens.llm import decontaminate as D
from reviewlens.llm import fmindex

from .util import clashing, frame, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(x):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x)


def brute(rows, items, width=13):
    windows = {}
    for name, text in items:
        w = WORD.findall(lower(text or ""))
        k = min(width, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            windows.setdefault(tuple(w[i : i + k]), set()).add("" if name is None else str(name))
    sizes = {len(w) for w in windows}
    out = []
    for i, text in rows:
        w = WORD.findall(lower(text or ""))
        hit, found = set(), set()
        for k in sizes:
            for a in range(len(w) - k + 1):
                if tuple(w[a : a + k]) in windows:
                    hit.update(range(a, a + k))
                    found |= windows[tuple(w[a : a + k])]
        out.append((i, len(w), len(hit), len(found), ",".join(sorted(found)), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def key(r):
    return tuple((x is None, x) for x in r)


def test_index_counts_and_locates():
    rng = np.random.default_rng(5)
    for n in (1, 2, 50, 700):
        text = rng.integers(0, 4, n)
        text[-1] = 0
        index = fmindex.FMIndex(text, 4)
        patterns = rng.integers(1, 4, (40, 3))
        low, high = index.search(patterns)
        for p, a, b in zip(patterns, low, high, strict=True):
            want = [i for i in range(n - 2) if (text[i : i + 3] == p).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_matches_brute_force(spark):
    items = [(k, prose(100 + k, 30, 500)) for k in range(8)]
    items += [(20, "Three Word Item"), (21, "one"), (22, "..."), (23, None), (None, prose(300, 20, 500)), (3, items[3][1])]
    rows = [(i, prose(i, 80, 500)) for i in range(10)]
    rows += [
        (50, "x " + items[2][1].upper() + " y"), (51, items[4][1][: len(items[4][1]) // 2] + prose(9, 400, 500)),
        (52, "THREE, word; item"), (53, None), (54, ""), (55, "!!"), (None, items[0][1]), (56, "é" + items[5][1]),
        (50, "x " + items[2][1].upper() + " y"), (57, "one " * 3000), (58, (items[6][1] + " ") * 40), (59, "three word one item"),
    ]
    bench = frame(spark, items, "item_id long, text string")
    for size in (D.BLOCK_BYTES, 400):
        got = D.search(clashing(frame(spark, rows)), bench, block_bytes=size).collect()
        mine = [(r.doc_id, r.n_words, r.n_hit, r.n_items, ",".join(r["items"]), r.contaminated) for r in got]
        assert sorted(mine, key=key) == sorted(brute(rows, items), key=key)
    spans = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in got}
    assert spans[52] == [(0, 17)] and spans[59] == [(11, 14)] and spans[53] == []


def test_empty_tables(spark):
    docs, none = frame(spark, [(1, "a b c")]), frame(spark, [], "item_id long, text string")
    assert [tuple(r) for r in D.search(docs, none).select("n_words", "n_hit", "contaminated").collect()] == [(3, 0, False)]
    assert D.search(frame(spark, []), none).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    want = {(*r[:4], hashlib.sha256(r[4].encode()).hexdigest(), r[5]) for r in brute(docs, items)}
    got = {tuple(r) for r in D.op8_decontaminate(spark, sf).collect()}
    assert got == want and any(r[5] for r in got)
