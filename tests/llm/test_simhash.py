"""SimHash groups against brute force, on small tables with odd rows."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from tripwire.llm import simhash
from tripwire.llm.shared import connected


def brute_fp(text, k=3):
    w = (text or "").encode().lower().split()
    sh = [b" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else ([b" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(nodes, linked):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    nodes = sorted(nodes)
    for i, x in enumerate(nodes):
        for y in nodes[i + 1:]:
            if linked(x, y):
                a, b = sorted((find(x), find(y)))
                root[b] = a
    return {x: find(x) for x in nodes}


def test_fingerprint_matches_definition(spark):
    texts = [None, "", "  \n", "One", "one two", "A b C d", "a b c d", "x y z w É é", "w " * 70000, "tail\x0bsep\x0cof words"]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select(
        "i", F.lower(F.lpad(F.hex(simhash.fingerprint(F.col("text"))), 16, "0")).alias("fp")).collect()
    assert {r.i: r.fp for r in got} == {i: f"{brute_fp(t):016x}" for i, t in enumerate(texts)}


@pytest.mark.parametrize("bits,hot", [(4, 50_000), (2, 50_000), (4, 40)])
def test_links_are_exact(spark, bits, hot):
    rng = random.Random(5)
    fps = {0, (1 << 64) - 1}
    for _ in range(120):
        x = rng.getrandbits(64)
        fps.add(x)
        for _ in range(rng.randrange(4)):  # chains of near ones
            for b in rng.sample(range(64), rng.randrange(1, 6)):
                x ^= 1 << b
            fps.add(x)
    centre = rng.getrandbits(64)
    fps |= {centre ^ sum(1 << b for b in rng.sample(range(64), 2)) for _ in range(60)}
    signed = {x - (1 << 64) if x >> 63 else x for x in fps}
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    got = {r.node: r.root for r in connected(simhash.link_fingerprints(df, 3, bits, hot)).collect()}
    want = brute_components(signed, lambda x, y: ((x ^ y) & (1 << 64) - 1).bit_count() <= 3)
    assert {x: got.get(x, x) for x in signed} == want


def test_components_with_odd_rows(spark):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(5, base, "a"), (3, base.replace("w7 ", "x7 "), "b"), (9, base.upper(), "c"), (None, base, "d"),
            (4, None, None), (8, "", "e"), (7, "quite different words here", "f"), (7, "quite different words here", "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = {(r.doc_id, r.component_id) for r in simhash.simhash_components(df).collect()}
    fp = {i: brute_fp(t) for i, (_, t, _) in enumerate(rows)}
    root = brute_components(set(fp.values()), lambda x, y: (x ^ y).bit_count() <= 3)
    want = set()
    for i, (d, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in fp if root[fp[j]] == root[fp[i]] and rows[j][0] is not None]
        want.add((d, min(ids, default=None)))
    assert got == want
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=lambda x: (x is None, x))
    assert ids == sorted({c for _, c in want}) + [None]


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_components(df).count() == 0
    assert simhash.drop_near_duplicates(df).count() == 0
