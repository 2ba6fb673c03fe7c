import re
from collections import Counter
from fractions import Fraction

from pyspark.sql import functions as F

from reviewlens.llm import collocation
from reviewlens.llm.collocation import collocations

from .util import clashing, frame, prose

SCHEMA = "doc_id long, text string, lang string"


def lower(x):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x)


def brute(rows, longest=3, least=10, inside=50, top=2000):
    counts, totals = {}, Counter()
    for _, text, lang in rows:
        lang = lang or "und" if lang != "" else ""
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lower(text or "")):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            totals[lang] += len(words)
            for i in range(len(words)):
                for size in range(1, longest + 1):
                    if i + size <= len(words):
                        counts.setdefault(lang, Counter())[tuple(words[i : i + size])] += 1
    out = []
    for lang, f in counts.items():
        cands = {p: a for p, a in f.items() if len(p) >= 2 and a >= least}
        rows_ = []
        for p, a in cands.items():
            cuts = [(Fraction(10**6 * a * a, f[p[:k]] * f[p[k:]]).__floor__(), k) for k in range(1, len(p))]
            score, k = min(cuts)
            within = any(
                100 * b >= inside * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in cands.items() if len(q) > len(p)
            )
            if not within:
                rows_.append((-score, -a, " ".join(p).encode(), " ".join(p), f[p[:k]], f[p[k:]]))
        for rank, (s, a, _, p, left, right) in enumerate(sorted(rows_)[:top], 1):
            out.append((lang, rank, p, -a, left, right, totals[lang], -s))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def corpus():
    rows = [(i, prose(i % 5, 120, 9), ["en", "de", None][i % 3]) for i in range(24)]
    rows += [
        (100, None, "en"), (101, "", None), (102, "New York. new YORK,new york\nnew york" * 5, "en"), (103, "é ß\tÉ ß " * 20, "de"),
        (103, "é ß\tÉ ß " * 20, "de"), (104, "a " * 3000, "en"), (105, "a b c " * 400, ""), (None, "only here", "xx"), (106, "...", "yy"),
        (107, "nul\x00 byte " * 11, "en"),
    ]
    return rows


def test_matches_brute_force(spark):
    rows = corpus()
    got = rows_of(collocations(frame(spark, rows, SCHEMA)))
    assert got == brute(rows) and len(got) > 10
    assert any(" " in r[2] and r[2].count(" ") == 2 for r in got)


def test_small_slices_hot_prefixes_and_limits(spark, monkeypatch):
    rows = corpus()
    df = frame(spark, rows, SCHEMA).repartition(5)
    monkeypatch.setattr(collocation, "SLICE", 300)
    assert rows_of(collocations(df, least=4, top=7)) == brute(rows, least=4, top=7)
    assert rows_of(collocations(df, longest=4, inside_percent=80)) == brute(rows, longest=4, inside=80)


def test_empty_table_and_clashing_columns(spark):
    assert rows_of(collocations(frame(spark, [], SCHEMA))) == []
    rows = corpus()[:9]
    df = clashing(frame(spark, rows, SCHEMA)).withColumn("w1", F.lit("x")).withColumn("phrase", F.lit("y")).withColumn("salt", F.lit(3))
    assert rows_of(collocations(df, least=3)) == brute(rows, least=3)


def test_counts_may_pass_64_bits(spark):
    a, left, right = 9_000_000_000_000, 9_000_000_000_001, 9_100_000_000_000
    row = spark.range(1).select(*(F.lit(x).cast("long").alias(n) for n, x in (("a", a), ("l", left), ("r", right))))
    got = row.select(collocation._exact_score(F.col("a"), F.col("l"), F.col("r")).alias("s")).first().s
    assert got == 10**6 * a * a // (left * right)
