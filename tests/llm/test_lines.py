import hashlib
import time

from reviewlens.llm.lines import dedup_lines

from .util import clashing, frame, prose

BLANK = " \t\n\x0b\x0c\r"


def lower(x):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x)


def brute(rows, least=10):
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(lower(line).strip(BLANK), set()).add((i is None, i))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            key = lower(line).strip(BLANK)
            shared = len(key) >= least and len(holders[key]) >= 2
            if not shared or min(holders[key], key=lambda x: (x[0], x[1] or 0))[1] == i:
                kept.append(line)
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def key(r):
    return tuple((x is None, x) for x in r)


def test_matches_brute_force(spark):
    shared = "A Line That Documents Share"
    rows = [
        (1, f"{shared}\nown line number one\n{shared.lower()}  "),
        (2, f"\t{shared.upper()} \r\nown line number two\n\nshort"),
        (3, None), (4, ""), (None, f"{shared}\nonly here it is"), (None, None),
        (5, "short\nÉCOLE é longue ligne"), (6, "école é longue ligne\nshort"), (2, f"\t{shared.upper()} \r\nown line number two\n\nshort"),
        (7, "x" * 50_000 + "\n" + shared), (8, "\n".join([shared] * 2000)), (9, "\n"),
    ]
    rows += [(20 + i, prose(i % 4, 40)) for i in range(12)]
    got = [(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in dedup_lines(frame(spark, rows)).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)
    assert sum(r[3] for r in got) > 2000


def test_empty_table_and_clashing_columns(spark):
    assert dedup_lines(frame(spark, [])).collect() == []
    df = clashing(frame(spark, [(1, "one line for both\nb"), (2, "one line for both\nc")]))
    got = {r.doc_id: (r.text, r.n_dropped, r.key) for r in dedup_lines(df).collect()}
    assert got == {1: ("one line for both\nb", 0, None), 2: ("c", 1, None)}


def test_query_digests(spark):
    from reviewlens.llm.lines import op4_line_dedup

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    want = {(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, t, n, d in brute([(r.doc_id, r.text) for r in docs])}
    got = {(r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in op4_line_dedup(spark, "/root/testdata/sf0.001").collect()}
    assert got == want


def test_a_document_of_very_many_lines(spark):
    """The text is split once and not once per line: 100,000 lines take seconds."""
    shared = "a line that both documents hold"
    own = [f"own line {i} of the long one" if i % 1000 else shared for i in range(100_000)]
    began = time.perf_counter()
    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in dedup_lines(frame(spark, [(1, shared), (2, "\n".join(own))])).collect()}
    assert time.perf_counter() - began < 60
    assert got[2] == ("\n".join(x for x in own if x != shared), 100_000, 100) and got[1] == (shared, 1, 0)
