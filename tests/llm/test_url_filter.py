"""URL filter against plain Python: parts of a url, fixed rules, mined rules by full enumeration, odd rows."""

import itertools
import random
import re

from pyspark.sql import functions as F

from tripwire.llm import url_filter as u

SF = "/root/testdata/sf0.01"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    m = re.match(r"(?s)([^/?#]*)([^?#]*)", rest)
    return m[1].translate(str.maketrans(u.UPPER, u.LOWER)), m[2]


def fixed(url):
    h, p = parts(url)
    fits = [(rh + rp, v) for v, rh, rp in u.RULES if (h == rh or h.endswith("." + rh)) and p.startswith(rp)]
    return max(fits, key=lambda x: len(x[0]), default=(None, None))


def toks(url):
    if url is None or "://" not in url:
        return set()
    h, p = parts(url)
    labels = [x for x in h.split(".") if x]
    out = {"scheme=" + url.split("://", 1)[0]} | {"host=" + ".".join(labels[i:]) for i in range(len(labels))}
    out |= {"path=" + re.sub("[0-9]+", "#", x) for x in p.split("/") if x}
    out |= {"query=" + x for x in re.findall(r"[?&]([^=&#?]+)", url)}
    return out | ({"fragment"} if "#" in url else set())


def brute_rules(rows, support, confidence):
    n = len([1 for t, _ in rows if t])
    seen, bad = {}, {}
    for t, b in rows:
        for k in range(1, len(t) + 1):
            for c in itertools.combinations(sorted(t), k):
                seen[c] = seen.get(c, 0) + 1
                bad[c] = bad.get(c, 0) + b
    rules = {c: bad[c] / seen[c] for c in seen if bad[c] and bad[c] >= support * n and bad[c] / seen[c] >= confidence}
    return {c: v for c, v in rules.items() if not any(set(o) < set(c) for o in rules)}


def spelled(rules, classes):
    """Rules with every choice of tokens for their items, and their confidence."""
    of = {}
    for r in classes.collect():
        of.setdefault(r.cls, []).append(r.token)
    return {tuple(sorted(c)): r.confidence for r in rules.collect() for c in itertools.product(*(of[t] for t in r.tokens)) if r.key in r.tokens}


URLS = [None, "", "no scheme", "HTTP://Ex.ORG/Es/a", "http://example.org", "http://example.org/es/", "x://a.example.org/en/17?q#f", "http://a.com/de/1",
        "http://com/de/", "http://xcom/de/", "http://a.com/fr/?x://b", "http://b.net?k=1&j=2#z", "a://b://c/d", "http://é.com/dé/1", "http://h#f", "://x.org/y",
        "http://x.example.org/es/" + "a" * 50_000]


def test_parts_rules_and_tokens(spark):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(URLS)], "page_id long, url string")
    got = df.select("url", u.host(F.col("url")).alias("h"), u.path(F.col("url")).alias("p"), u.fixed_rule(u.host(F.col("url")), u.path(F.col("url"))).alias("f"),
                    u.tokens(F.col("url")).alias("t")).collect()
    for r in got:
        assert (r.h, r.p) == parts(r.url)
        assert (tuple(r.f) if r.f else (None, None)) == fixed(r.url)
        assert len(r.t) == len(set(r.t)) and set(r.t) == toks(r.url)


def test_mined_rules_and_verdicts(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        h = rng.choice(["a", "ads", "m.b"]) + "." + rng.choice(["x.net", "y.net"])
        url = f"http://{h}/{rng.choice(['en', 'it', 'track'])}/{rng.randrange(99)}{rng.choice(['', '?utm=1', '#top'])}"
        bad = ("ads" in url and "utm" in url) or "track" in url and rng.random() < 0.9 or rng.random() < 0.05
        rows.append((i, url, bad, "x"))
    lab = spark.createDataFrame([(x, b) for _, x, b, _ in rows] + [(None, True), ("nothing", True), ("http://a.x.net/", None)], "url string, blocked boolean")
    want = brute_rules([(toks(x), b) for _, x, b, _ in rows], 0.02, 0.8)
    got = spelled(*u.mine(lab, 0.02, 0.8))
    assert set(got) == set(want) and len(want) > 1
    assert all(abs(got[c] - want[c]) < 1e-12 for c in want)
    pages = spark.createDataFrame([(i, x, "k", "v") for i, x, _, _ in rows] + [(None, rows[0][1], "k", "v"), (3, rows[3][1], "k", "v")]
                                  + [(1000 + i, x, "k", "v") for i, x in enumerate(URLS)], "page_id long, url string, key string, verdict string")
    out = u.judge(pages, lab, min_support=0.02, min_confidence=0.8).collect()
    assert len(out) == len(rows) + 2 + len(URLS)
    url_of = {r.page_id: r.url for r in pages.collect() if r.page_id is not None}
    for r in out:
        url = url_of.get(r.page_id, rows[0][1])
        rule, verdict = fixed(url)
        mined = any(set(c) <= toks(url) for c in want)
        assert (r.rule, r.verdict) == (rule, verdict or ("block" if mined else "allow"))
    assert u.judge(pages.limit(0), lab).count() == 0
    assert u.judge(pages, lab.limit(0)).count() == pages.count()


def test_rules_of_four_tokens_and_tokens_that_come_together(spark):
    """Pages blocked only where four tokens meet are blocked; twenty query keys that always come together are one item."""
    rng = random.Random(5)
    urls = [f"http://{h}.net/{a}/{b}?{q}=1" for h in "ab" for a in ("c", "d") for b in ("e", "f") for q in ("g", "h") for _ in range(30)]
    rows = [(x, x == "http://a.net/c/e?g=1" or rng.random() < 0.02) for x in urls]
    lab = spark.createDataFrame(rows, "url string, blocked boolean")
    want = brute_rules([(toks(x), b) for x, b in rows], 0.02, 0.8)
    assert any(len(c) >= 4 for c in want)
    assert set(spelled(*u.mine(lab, 0.02, 0.8))) == set(want)
    pages = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(rows)], "page_id long, url string")
    out = u.judge(pages, lab, rules=(), min_support=0.02, min_confidence=0.8).collect()
    assert {r.page_id for r in out if r.verdict == "block"} == {i for i, (x, _) in enumerate(rows) if any(set(c) <= toks(x) for c in want)}
    many = "http://x.net/p?" + "&".join(f"k{i}=1" for i in range(24))
    lab = spark.createDataFrame([(many, True)] * 50 + [(f"http://x.net/q{i}z", False) for i in range(50)], "url string, blocked boolean")
    rules, classes = u.mine(lab, 0.02, 0.8)
    assert rules.count() == 1 and classes.where("cls = 'path=p'").count() == 25
    page = spark.createDataFrame([(1, "http://y.net/?k7=2"), (2, "http://y.net/?k77=2")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in u.judge(page, lab, rules=()).collect()} == {1: "block", 2: "allow"}


def test_query_covers_all_pages(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = u.query(spark, SF).collect()
    assert sorted(r.page_id for r in got) == sorted(pages)
    for r in got:
        assert (r.host, r.path) == parts(pages[r.page_id])
        assert r.rule is None or (r.rule, r.verdict) == fixed(pages[r.page_id])
