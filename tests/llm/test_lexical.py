"""Ranked lexical search against plain Python integers."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tripwire.llm import lexical as lx

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=10):
    """(item, rank, doc_id, score) by going through every pair."""
    words = [(d, split(t)) for d, t in docs]
    words = [(d, Counter(w), len(w)) for d, w in words if w]
    n_all, l_all = len(words), sum(n for *_, n in words)
    df = Counter(t for _, c, _ in words for t in c)
    out = []
    for item, text in items:
        found = []
        for d, c, n in words:
            m = 100 - 75 + (75 * n * n_all) // l_all
            s = sum(k * math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
                    for t, k in Counter(split(text)).items() if t in c)
            if s > 0:
                found.append((-s, d is None, d or 0))
        out += [(item, i + 1, None if none else d, -s) for i, (s, none, d) in enumerate(sorted(found)[:top])]
    return out


def world(seed=3, n=260):
    rng = random.Random(seed)
    words = ["The", "the", "été", "ÉTÉ", "中文", "x1", "a_b", "don't", "😀", "zebra", "rare"] + [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(rng.choices(words, [20] * 3 + [1] * (len(words) - 3), k=rng.randrange(0, 40)))) for i in range(n)]
    docs += [(None, "zebra rare"), (9, None), (10, ""), (11, "... --- !!!"), (500, "zebra " * 30_000), (501, "w" * 50_000), (5, docs[5][1])]
    docs += [(1000 + i, "zebra w7 tie") for i in range(60)]  # more ties than places
    items = [(1, "Zebra w7 tie"), (2, None), (3, ""), (4, "the the été"), (None, "rare"), (6, "nowhere to find"), (1, "Zebra w7 tie"),
             (7, "w7 " * 5000)] + [(100 + i, " ".join(rng.choices(words, k=rng.randrange(1, 30)))) for i in range(30)]
    return docs, items


@pytest.mark.parametrize("block_bytes, item_tile, doc_tile, term_tile", [(1 << 22, 512, 512, 4096), (20_000, 7, 16, 5)])
def test_against_brute_force(spark, monkeypatch, block_bytes, item_tile, doc_tile, term_tile):
    for name, value in (("ITEM_TILE", item_tile), ("DOC_TILE", doc_tile), ("TERM_TILE", term_tile)):
        monkeypatch.setattr(lx, name, value)
    docs, items = world()
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, score long, item_id string").repartition(5)
    it = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = lx.search(df, it, block_bytes=block_bytes)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute(docs, items), key=repr)


def test_sums_stay_exact(monkeypatch):
    """Tiles are cut before a sum could lose its last digit; a term too heavy for any tile is refused."""
    weight = np.full(6, 20_000.0)
    counts = [Counter({t: 60_000 for t in range(6)}), Counter({3: 1})]
    tile = lx.ItemTile(counts, weight, 1_000_000)
    assert len(tile.cuts) - 1 == 1
    counts = [Counter({t: 300_000 for t in range(6)}), Counter({3: 1})]
    tile = lx.ItemTile(counts, weight, 1_000_000)
    assert len(tile.cuts) - 1 == 6
    row, term = np.zeros(6, np.int64), np.arange(6)
    got = tile.scores(row, term, np.full(6, 999_999.0), 1)
    assert got.tolist() == [[6 * 300_000 * 20_000 * 999_999, 20_000 * 999_999]]
    with pytest.raises(ValueError):
        lx.ItemTile([Counter({0: 500_000})], weight, 1_000_000)


def test_ties_of_a_tile_are_not_cut():
    scores = np.array([[5], [7], [5], [5], [0]])
    item, doc = lx.best_of_tile(scores, np.array([40, 1, 30, 20, 2]), np.zeros(5, bool), 2)
    assert (item.tolist(), doc.tolist()) == ([0, 0], [1, 3])


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lx.search(docs, items).count() == 0
    assert lx.search(spark.createDataFrame([(1, "a")], "doc_id long, text string"), items.limit(0)).count() == 0
