import random
import re

from reviewlens.llm import components as components_module
from reviewlens.llm import jaccard
from reviewlens.llm.common import join_hot, stored
from reviewlens.llm.components import components, joined_components
from reviewlens.llm.jaccard import jaccard_classes, keep_one
from reviewlens.session import settings_of

from .util import SCHEMA, clashing, frame


def lower(x):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x)


def shingles(text, n=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def brute(rows, percent=80):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(d)
    least = {g: min((d for d in ds if d is not None), default=None) for g, ds in groups.items()}
    return [(d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows)]


def key(r):
    return tuple((x is None, x) for x in r)


def made():
    rng = random.Random(11)
    words = [f"w{i}" for i in range(3000)]
    rows, number = [], iter(rng.sample(range(10_000), 4000))
    passage = " ".join(rng.choice(words) for _ in range(30))
    for group in range(40):
        base = [rng.choice(words) for _ in range(rng.choice([4, 6, 12, 40, 150, 400]))]
        for _ in range(rng.choice([1, 1, 2, 5, 20])):
            copy = list(base)
            for _ in range(int(len(base) * rng.choice([0, 0.005, 0.01, 0.02, 0.03]))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            text = " ".join(copy)
            if group % 3 == 0:
                text = passage + " " + text
            rows.append((next(number), text))
    chain = [rng.choice(words) for _ in range(200)]
    for step in range(12):  # neighbours link, ends do not
        rows.append((next(number), " ".join(chain[step * 12 :] + [f"tail{k}" for k in range(step * 12)])))
    rows += [(20_000, None), (20_001, ""), (20_002, " \t"), (None, rows[3][1]), (20_003, "A b"), (20_004, "a B"), (20_005, "b a")]
    rows += [(20_006, "the " * 300), (20_007, "the the the the the"), rows[5], (20_008, " ".join(words * 4)), (None, "alone here")]
    return rows


def test_matches_brute_force(spark):
    rows = made()
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_classes(clashing(frame(spark, rows))).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)
    assert len({r[2] for r in got}) < len(rows) - 50


def test_large_group_and_common_passage(spark):
    rng = random.Random(4)
    base = [f"b{i}" for i in range(120)]
    common = " ".join(f"c{i}" for i in range(12))
    rows = []
    for i in range(300):
        copy = list(base)
        copy[rng.randrange(120)] = f"x{i}"
        rows.append((i, " ".join(copy)))
    rows += [(1000 + i, common + " " + " ".join(f"y{i}_{k}" for k in range(8))) for i in range(200)]
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_classes(frame(spark, rows)).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_stage_keeps_one_of_each_group(spark):
    rows = [(i, t, None, None, None) for i, t in made()]
    kept = [(r.doc_id, r.text) for r in keep_one(spark, frame(spark, rows, SCHEMA), "").collect()]
    want = {d for d, _, c in brute([r[:2] for r in rows]) if d == c}
    assert len(kept) == len(set(kept)) and {d for d, _ in kept} == want


def test_empty_table(spark):
    assert jaccard_classes(frame(spark, [])).collect() == []
    assert keep_one(spark, frame(spark, [], SCHEMA), "").collect() == []


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 140)] + [(200, 201), (201, 200), (300, 300)]
    got = {r.node: r.root for r in components(frame(spark, links, "a long, b long")).collect()}
    want = {i: 0 for i in range(61)} | {k: 100 for k in range(100, 140)} | {200: 200, 201: 200}
    assert got == want


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {tuple(r) for r in jaccard.op9_jaccard_join(spark, sf).collect()}
    assert got == set(brute(rows))


def test_no_broadcast_without_hot_keys(spark):
    rows = frame(spark, [(i % 9, i) for i in range(18)], "k long, v long")
    for n, hot in ((1, False), (3, True)):
        keys = frame(spark, [(i, n) for i in range(6)], "k long, n long")
        with settings_of(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
            joined = join_hot(rows, keys, ["k"], "n", "v")
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert joined.columns == ["k", "v", "n"] and ("BroadcastExchange" in plan) == hot
            assert sorted(map(tuple, joined.collect())) == sorted((i % 9, i, n) for i in range(18) if i % 9 < 6)


def test_more_links_join_components(spark):
    rng = random.Random(2)
    first = [(rng.randrange(400), rng.randrange(400)) for _ in range(150)]
    more = [(rng.randrange(500), rng.randrange(500)) for _ in range(40)] + [(600, 601), (601, 601), (602, 602)]
    found = components(frame(spark, first, "a long, b long"))
    for links in (more, []):
        got = joined_components(found, frame(spark, links, "a long, b long")).collect()
        want = components(frame(spark, first + links, "a long, b long")).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_components_are_not_made_twice(spark, monkeypatch):
    """Sets that one pivot links leave no further pairs, so no link is followed after the first components."""
    made = []
    monkeypatch.setattr(components_module, "stored", lambda df, label: made.append(label) or stored(df, label))
    base = [f"b{i}" for i in range(60)]
    rows = [(i, " ".join([*base, *(f"x{i}_{k}" for k in range(i % 3))])) for i in range(30)]
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_classes(frame(spark, rows)).collect()]
    assert sorted(got) == sorted(brute(rows))
    assert "roots" in made and "roots" not in made[made.index("labels") :]
