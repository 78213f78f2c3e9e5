"""Spaced seeds: lossless masks, brute force over all alignments, odd rows."""

import itertools
import random
import re

from tripwire.llm import decontaminate as d


def toks(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def brute(docs, items, sim=0.8):
    out = {}
    for key, text in docs:
        w = toks(text)
        for item, passage in items:
            p = toks(passage)
            if len(p) < 4:
                continue
            best = max(((sum(0 <= s + i < len(w) and w[s + i] == x for i, x in enumerate(p)), -s)
                        for s in range(-len(p) + 1, len(w))), default=(0, 0))
            if best[0] >= sim * len(p):
                out[(key, item)] = (-best[1], len(p), best[0])
    return out


def test_masks_hit_every_fifth_substituted():
    for n in range(6, 26):
        for subs in itertools.combinations(range(n), n // 5):
            assert any(all(c == "0" or o + i not in subs for i, c in enumerate(m))
                       for m in d.MASKS for o in range(n - len(m) + 1)), (n, subs)


def test_against_brute_force(spark):
    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.randrange(3, 40)))) for i in range(25)] + [(90, None), (91, ""), (92, "a b c")]
    docs = []
    for k in range(80):
        w = rng.choices(vocab, k=rng.randrange(0, 120))
        if k % 2:
            p = toks(items[rng.randrange(25)][1])
            for at in rng.sample(range(len(p)), rng.randrange(0, max(1, len(p) // 4 + 1))):
                p[at] = rng.choice(vocab)
            s = rng.randrange(len(w) + 1)
            w = (w[:s] + p + w[s:]) if k % 4 == 1 else (p[2:] + w)
        docs.append((k, ", ".join(w).upper()))
    docs += [(500, None), (501, ""), (None, docs[1][1]), (7, docs[7][1])]
    df = spark.createDataFrame([(k, t, k) for k, t in docs], "doc_id long, text string, item_id long")
    bench = spark.createDataFrame([(i, t, t) for i, t in items], "item_id long, text string, passage string")
    want = brute(docs, items)
    want = {k: v for k, v in want.items() if v[1] >= 6}
    for at_once in (d.SEEDS_AT_ONCE, 300):
        got = {(r.doc_id, r.item_id): (r.start, r.n_tokens, r.matched) for r in d.leaks(df, bench, at_once=at_once).collect()}
        assert {k: v for k, v in got.items() if v[1] >= 6} == want
    kept = d.decontaminate(df, bench)
    assert kept.columns == df.columns
    flagged = {t for t in {t for _, t in docs} if any(k == "x" for k, _ in brute([("x", t)], items))}
    left = [r.text for r in kept.collect()]
    assert not flagged & set(left) and None in left and "" in left
    assert d.leaks(df.limit(0), bench).count() == 0 and d.leaks(df, bench.limit(0)).count() == 0


def test_long_items_are_cut(spark):
    words = [f"t{i}" for i in range(300)]
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    df = spark.createDataFrame([(1, "x y " + " ".join(words[100:230])), (2, " ".join(words[:20]))], "doc_id long, text string")
    assert [r.doc_id for r in d.leaks(df, bench).collect()] == [1]
