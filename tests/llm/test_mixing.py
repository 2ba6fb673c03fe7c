import random
import re

from reviewlens.llm.mixing import mix_sources

from .util import SCHEMA, clashing, frame


def fill(sizes, weights=(1, 2, 3), most=3):
    """Targets by repeated resharing of what the capped sources leave."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        free = [s for s in names if s not in capped]
        unit = left / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if unit * weight[s] > most * sizes[s]]
        if not over:
            return {s: most * sizes[s] if s in capped else unit * weight[s] for s in names}
        capped |= set(over)


def check(rows, got):
    size = {}
    for i, text, _, source, _ in rows:
        size[source] = size.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    target = fill(size)
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == size[r.source] and abs(r.target - target[r.source]) < 1e-6 * max(1, r.target)
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r["size"]
    for s in size:
        own = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in own) - target[s]) <= 3 * max(r["size"] for r in own) + 1


def test_targets_and_copies(spark):
    rng = random.Random(2)
    rows = []
    for i in range(900):
        source = rng.choice(["a", "a", "a", "b", "c", "tiny", None] if i % 50 else ["rare"])
        rows.append((i, " ".join(["w"] * int(rng.paretovariate(1.2) * 5)), None, source, None))
    rows += [(1000, None, None, "a", None), (1001, "", None, "void", None), (None, "x y", None, "b", None)] * 2
    rows += [(1002, "w " * 30_000, None, "c", None), (1003, " \t\n", None, "void", None), (1, rows[1][1], None, rows[1][3], None)]
    docs = frame(spark, rows, SCHEMA)
    got = mix_sources(clashing(docs)).collect()
    check(rows, got)
    again = mix_sources(docs.repartition(5)).collect()
    plain = lambda rs: sorted((str(r.doc_id), str(r.source), r["size"], r.copies) for r in rs)
    assert plain(got) == plain(again)


def test_one_source_and_none(spark):
    assert mix_sources(frame(spark, [], SCHEMA)).collect() == []
    rows = [(i, "a b c", None, "s", None) for i in range(10)]
    assert [r.copies for r in mix_sources(frame(spark, rows, SCHEMA)).collect()] == [1] * 10
    empty = [(1, None, None, None, None), (2, "", None, "s", None)]
    assert {(r["size"], r.target, r.taken) for r in mix_sources(frame(spark, empty, SCHEMA)).collect()} == {(0, 0.0, 0)}
