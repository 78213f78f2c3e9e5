"""Nearest neighbours: the curve, recall against brute force, copies and odd rows."""

import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tripwire.llm import neighbours as nb

SF = "/root/testdata/sf0.1"


def brute(rows, ids, k=10):
    out = {}
    at = np.array([r[0] for r in rows])
    v = np.array([r[1] for r in rows], np.float64)
    for q in ids:
        w = v[list(at).index(q)]
        d = np.sqrt(((v - w) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((at, d)) if at[i] != q][:k]
        out[q] = [(int(at[i]), float(d[i])) for i in order]
    return out


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (4, 2), (2, 5)])
def test_hilbert_is_a_path(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = nb.hilbert_keys(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_recall(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = brute(rows, [i for i, _ in rows if i % 100 == 0])
    got = {}
    for r in nb.query(spark, SF).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    assert set(got) == set(want)
    vecs = dict(rows)
    hits = 0
    for q, found in got.items():
        assert len(found) == 10 and found == sorted(found, key=lambda x: (x[1], x[0]))
        for i, s in found:
            assert s == pytest.approx(np.linalg.norm(np.array(vecs[i], float) - np.array(vecs[q], float)), abs=1e-12)
        hits += len({i for i, _ in found} & {i for i, _ in want[q]})
    assert hits / (10 * len(want)) >= 0.9


@pytest.mark.parametrize("noise", [0.001, 0.01, 0.05])
def test_recall_among_near_copies(spark, noise):
    rng = np.random.default_rng(6)
    v = rng.standard_normal((21_000, 32))
    near = rng.random(len(v)) < 1 / 3  # a third of all rows: one vector, hardly changed
    v[near] = v[0] + noise * rng.standard_normal((near.sum(), 32))
    ids = np.arange(0, len(v), 100)
    df = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(len(v)), "embedding": list(v)}))
    got = {}
    for r in nb.nearest(df, F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = {True: [], False: []}
    for q in ids:
        d = ((v - v[q]) ** 2).sum(axis=1)
        d[q] = np.inf
        hits[bool(near[q])].append(len(got[q] & set(np.argsort(d)[:10].tolist())) / 10)
    print(noise, np.mean(hits[True]), np.mean(hits[False]))
    assert np.mean(hits[True]) >= 0.9 and np.mean(hits[False]) >= 0.9


def test_copies_and_odd_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.standard_normal(5)], "x") for i in range(60)]
    rows += [(i, rows[3][1], "x") for i in range(100, 140)]  # a hot vector with query ids 100, 110, ..
    bad = [(200, None, "x"), (210, [0.0] * 5, "x"), (220, [1.0, None, 0.0, 0.0, 0.0], "x"), (230, [float("nan")] * 5, "x"),
           (240, [float("inf")] * 5, "x"), (250, [], "x"), (260, [1.0, 2.0], "x"), (None, rows[0][1], "x"), rows[7]]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, score string")
    got = {}
    for r in nb.nearest(df, F.col("vec_id") % 10 == 0, block_rows=1000).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, pytest.approx(r.score)))
    want = brute(rows, [i for i, _, _ in rows if i % 10 == 0])
    assert got == want
    few = df.where("vec_id < 4")
    assert nb.nearest(few, F.col("vec_id") == 0).count() == 3
    assert nb.nearest(df.limit(0), F.lit(True)).count() == 0
    assert nb.nearest(df, F.lit(False)).count() == 0
