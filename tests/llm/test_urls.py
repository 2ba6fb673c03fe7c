import math
import random
import re
from collections import Counter, defaultdict

from reviewlens.llm import urls as U

from .util import clashing, frame

SCHEMA = "page_id long, url string, bad int"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def brute(rows, support, strength=5.0, z=U.Z, depth=U.DEPTH):
    out, rules = [], sorted(U.RULES, key=lambda r: -len(r[1]))
    split = [(*parts(u), b) for _, u, b in rows]
    paths = [[s for s in p.split("/") if s] for _, p, _ in split]
    template = [""] * len(rows)
    for k in range(depth):
        n, lab, bad = Counter(), Counter(), Counter()
        keys = [(split[i][0], template[i], paths[i][k]) if len(paths[i]) > k else None for i in range(len(rows))]
        for key, (_, _, b) in zip(keys, split, strict=True):
            if key:
                n[key] += 1
                lab[key] += b is not None
                bad[key] += b or 0
        nodes = defaultdict(lambda: [0, 0])
        for key in n:
            nodes[key[:2]][0] += lab[key]
            nodes[key[:2]][1] += bad[key]
        for i, key in enumerate(keys):
            if key:
                share = nodes[key[:2]][1] / max(nodes[key[:2]][0], 1)
                own = n[key] >= support and lab[key] and abs(bad[key] / lab[key] - share) > z * math.sqrt(share * (1 - share) / lab[key])
                template[i] += "/" + (key[2] if own else "*")
    leaf, host, total = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0]), [0, 0]
    for i, (h, _, b) in enumerate(split):
        template[i] += "/**" if len(paths[i]) > depth else ""
        for c in (leaf[h, template[i]], host[h], total):
            c[0] += b is not None
            c[1] += b or 0
    for i, (h, p, _) in enumerate(split):
        prior = total[1] / total[0] if total[0] else 0.0
        of_host = (host[h][1] + strength * prior) / (host[h][0] + strength)
        share = (leaf[h, template[i]][1] + strength * of_host) / (leaf[h, template[i]][0] + strength)
        rule = next(((a, r) for a, r in rules if (h == r.partition("/")[0] or h.endswith("." + r.partition("/")[0])) and p.startswith("/" + r.partition("/")[2])), None)
        out.append((rows[i][0], h, p, rule and rule[1], rule[0] if rule else "block" if share > 0.5 else "allow", template[i]))
    return out


def made():
    rng = random.Random(6)
    rows = []
    for i in range(600):
        kind = rng.choice(["news", "spam", "shop"])
        bad = None if rng.random() < 0.4 else int(rng.random() < (0.9 if kind == "spam" else 0.1))
        rows.append((i, f"https://Host{i % 2}.example.io/{kind}/{i}/page.html?x=/de/#y", bad))
    rows += [(1000 + i, u, None) for i, u in enumerate([
        None, "", "no scheme", "http://", "HTTP://A.NET", "http://a.net/", "http://example.net/en/5", "http://Xexample.net/en/5",
        "http://x.example.net/english", "http://example.com/de/", "http://example.com/de", "http://b.org/fr/x?y", "ftp://net/x://y/",
        "http://a.org/" + "/s" * 500, "x" * 50_000, "http://q.com?a/b", "http://q.com#a/b", "a\nb://c.net/x\ny",
    ])]
    return rows + [(None, "https://host0.example.io/spam/7/page.html", 1), rows[3], rows[3]]


def test_matches_brute_force(spark):
    rows = made()
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict, r.template) for r in U.judge_urls(clashing(frame(spark, rows, SCHEMA))).collect()]
    want = brute(rows, U.SUPPORT)
    assert sorted(got, key=str) == sorted(want, key=str)
    assert {(r[4], r[5]) for r in want if r[1] == "host0.example.io"} >= {("block", "/spam/*/*")}


def test_no_labels_and_no_rows(spark):
    rows = [(i, u, None) for i, u, _ in made()]
    assert {r.verdict for r in U.judge_urls(frame(spark, rows, SCHEMA)).where("rule is null").collect()} == {"allow"}
    assert U.judge_urls(frame(spark, [], SCHEMA)).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: int(r.quality == 0 or r.toxic == 1) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = []
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        number = re.search(r"/(\d{1,18})(?:[/.]|$)", parts(r.url)[1])
        rows.append((r.page_id, r.url, labels.get(int(number[1])) if number else None))
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict, r.template) for r in U.op6_url_filter(spark, sf).collect()]
    assert sorted(got) == sorted(brute(rows, U.SUPPORT)) and len({r[4] for r in got}) == 2


def test_parts_that_differ_far_down(spark):
    """Good and bad sections that part at the fifth, sixth and tenth segment, below equal ones."""
    rng = random.Random(9)
    rows = []
    for host, above in (("five.example.io", 4), ("six.example.io", 5), ("ten.example.io", 9)):
        for i in range(400):
            kind = rng.choice(["news", "spam"])
            bad = None if rng.random() < 0.4 else int(rng.random() < (0.95 if kind == "spam" else 0.05))
            rows.append((len(rows), f"http://{host}/" + "s/" * above + f"{kind}/{i}/p", bad))
    got = {r.page_id: r for r in U.judge_urls(frame(spark, rows, SCHEMA)).collect()}
    want = {r[0]: r for r in brute(rows, U.SUPPORT, depth=15)}
    assert {i: (r.verdict, r.template) for i, r in got.items()} == {i: (r[4], r[5]) for i, r in want.items()}
    assert all((got[i].verdict == "block") == ("/spam/" in u) for i, u, _ in rows)


def test_thin_parts_far_down_and_literal_stars(spark):
    rows = [(i, f"http://a.io/1/2/3/4/5/6/{i}/x", i % 2) for i in range(19)]
    rows += [(200 + i, f"http://c.io/1/2/3/4/5/6/{'**' if i % 2 else 'x'}/{'y' if i % 3 else 'z'}/{i}", i % 2) for i in range(90)] + [(100 + i, f"http://b.io/1/2/3/4/5/6/**/{i % 2}/{i}", i % 2) for i in range(90)]
    got = [(r.page_id, r.template, r.verdict) for r in U.judge_urls(frame(spark, rows, SCHEMA), most_bad=0.6).collect()]
    assert {t for i, t, _ in got if i < 100} == {"/*/*/*/*/*/*/**"}
    assert sorted((i, t, v) for i, t, v in got if 100 <= i < 200) == [(100 + i, f"/*/*/*/*/*/*/*/{i % 2}/*", "block" if i % 2 else "allow") for i in range(90)]
    assert {(i, t) for i, t, _ in got if i >= 200} == {(200 + i, f"/*/*/*/*/*/*/{'**' if i % 2 else 'x'}/*/*") for i in range(90)}
