"""Quality rules against plain Python."""

import random
import re
from collections import Counter, defaultdict

from tripwire.llm import line_quality as lq

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", "abcdefghijklmnopqrstuvwxyz000000000")


def normal(line):
    return " ".join(WORD.findall(line.translate(LOWER)))


def brute(docs, max_docs=lq.MAX_DOCS, max_share=lq.MAX_SHARE, left_share=lq.LEFT_SHARE):
    """(counts, verdict, text without common lines) of each (host, text)."""
    texts = defaultdict(set)
    for host, text in docs:
        texts[host].add(text or "")
    holders = Counter((h, n) for h, ts in texts.items() for t in ts for n in {normal(x) for x in t.split("\n")} if n)
    common = {(h, n) for (h, n), k in holders.items() if k > max_docs and k > max_share * len(texts[h])}
    out = []
    for host, text in docs:
        text = text or ""
        words = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
        n = Counter(windows)
        rep = {i + k for i, g in enumerate(windows) if n[g] > 1 for k in range(3)}
        cut = [x for x in lines if (host, normal(x)) in common]
        gone = sum(len(WORD.findall(x)) for x in cut)
        counts = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(rep))
        failed = len(words) < 50 or 100 * len(rep) > 50 * len(words)
        kept = not failed and len(words) - gone >= left_share * len(words)
        left = "\n".join(x for x in text.split("\n") if not WORD.search(x) or (host, normal(x)) not in common)
        out.append((counts, (failed, len(cut), gone, kept), left))
    return out


def world():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)] + ["é😀", "#tag", "a|b", " ", "100%"]

    def line():
        return " ".join(rng.choices(words, k=rng.randrange(0, 14)))
    footer = ["Copyright 2019 | All rights", "copyright  1980 | all RIGHTS", "Share this\t" + " ".join(f"f{i}" for i in range(60))]
    docs = []
    for _ in range(500):
        host = rng.choice(["a.org"] * 10 + ["b.org", "c.org", None])
        body = [line() for _ in range(rng.randrange(0, 12))]
        body += rng.choices(footer, k=rng.randrange(0, 5)) if host in ("a.org", None) else []
        rng.shuffle(body)
        docs.append((host, "\n".join(body)))
    docs += [("a.org", docs[0][1])] * 200  # copies condemn no line
    docs += [("a.org", None), (None, None), ("b.org", ""), ("b.org", "\n\n \n"), ("b.org", "same words again " * 40),
             ("c.org", " ".join(f"u{i}" for i in range(60_000))), ("c.org", "x\n" * 20_000), ("c.org", "y" * 100_000)]
    return docs


def test_against_brute_force(spark):
    docs = world()
    rows = [(i if i % 9 else None, h, t, -1, False, "k") for i, (h, t) in enumerate(docs)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, n_words long, kept boolean, _cut string").repartition(6)
    want = brute(docs)
    assert any(v[1] and not v[3] and not v[0] for _, v, _ in want) and any(v[1] and v[3] for _, v, _ in want)
    cols = [*lq.COUNTS, *lq.VERDICT]
    got = sorted(((r.doc_id, r.source, *(r[c] for c in cols)) for r in lq.judge(df.drop("_cut")).collect()), key=repr)
    assert got == sorted(((r[0], r[1], *c, *v) for r, (c, v, _) in zip(rows, want, strict=True)), key=repr)
    clean = sorted(((r.doc_id, r.text) for r in lq.clean(df.select("doc_id", "source", "text")).collect()), key=repr)
    assert clean == sorted(((r[0], t) for r, (_, v, t) in zip(rows, want, strict=True) if v[3]), key=repr)


def test_plain_join(spark, monkeypatch):
    monkeypatch.setattr(lq, "BROADCAST_LINES", 0)
    docs = world()[:300]
    df = spark.createDataFrame([(i, h, t) for i, (h, t) in enumerate(docs)], "doc_id long, source string, text string")
    got = {r.doc_id: tuple(r[c] for c in lq.VERDICT) for r in lq.judge(df).collect()}
    assert got == {i: v for i, (_, v, _) in enumerate(brute(docs))}


def test_repeated_words_of_large_vocabularies(monkeypatch):
    words = [b"a", b"b", b"c", b"d", b"a", b"b", b"c", b"a", b"b"]
    assert lq.repeated_words(words) == 6
    many = [b"%d" % i for i in range((1 << 20) + 5)] + [b"1", b"2", b"3", b"1", b"2"]
    assert lq.repeated_words(many) == 6
    assert lq.repeated_words([b"x"] * 4) == 4 and lq.repeated_words([b"x"] * 3) == 0


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, source string, text string")
    assert lq.judge(df).count() == 0 and lq.clean(df).columns == df.columns
