"""Mixing: targets, schedule and blocks against plain Python; odd rows; the SQL."""

import hashlib
import re

import duckdb
import pytest

from tripwire.llm import mixing

SF = "/root/testdata/sf0.001"


def fill(sizes, weights=(5, 2, 1), most=3):
    names = sorted((n for n in sizes if n is not None)) + [n for n in sizes if n is None]
    w = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    total, full, target = sum(sizes.values()), set(), {}
    while True:
        left = total - sum(most * sizes[n] for n in full)
        ws = sum(w[n] for n in names if n not in full)
        target = {n: most * sizes[n] if n in full else left * w[n] / ws for n in names}
        over = {n for n in names if n not in full and target[n] > most * sizes[n]}
        if not over:
            return target
        full |= over


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 500, "c": 90, None: 7}, {"a": 0, "b": 0}, {"x": 5}, {"a": 1, "b": 1000, "c": 1},
                                   {"a": 3, "b": 3, "c": 3, "d": 0, "é": 2, "z": 900}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    assert got == pytest.approx(fill(sizes))


def test_schedule_follows_the_points(spark):
    per = spark.createDataFrame([(1, 700.0), (2, 200.0), (3, 99.5), (4, 1.0), (5, 0.2)], "source_no long, target double")
    got = mixing.schedule(per, 8).collect()
    m = 7
    owner = {}
    for r in got:
        owner.setdefault(r.slot, []).append(r.source_no)
    edges = [0, 700, 900, 999.5, 1000.5]
    for k in range(1 << m):
        u = int(f"{k:0{m}b}"[::-1], 2) / (1 << m) * 1000.5
        want = next(i + 1 for i in range(4) if edges[i] <= u < edges[i + 1])
        assert want in owner[k]
    for s in range(1, 5):
        mine = sorted(r.slot for r in got if r.source_no == s)
        assert mine and {r.slot: r.rank for r in got if r.source_no == s} == {k: i for i, k in enumerate(mine)}
        assert {r.slots for r in got if r.source_no == s} == {len(mine)}
    assert all(r.source_no != 5 for r in got)


def rows():
    out = [(i, " ".join(["w"] * (i % 37)), f"s{i % 3}" if i % 5 else None, "x") for i in range(90)]
    return out + [(None, "a b c", "s0", "x"), (4, out[4][1], out[4][2], "x"), (4, out[4][1], out[4][2], "x"), (900, None, "s1", "x"),
                  (901, "", "zero", "x"), (902, "one", "tiny", "x"), (903, "long " * 5000, "s2", "x")]


@pytest.mark.parametrize("block", [1, 7, 512])
def test_mixture_takes_the_targets(spark, block):
    df = spark.createDataFrame(rows(), "doc_id long, text string, source string, size string")
    got = mixing.mixture(df, block_tokens=block).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert len(got) == len(rows())
    sizes = {}
    for _, t, s, _ in rows():
        sizes[s] = sizes.get(s, 0) + size(t)
    want = fill(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r["size"] and r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
    assert taken == {s: int(want[s] + 1e-9) for s in sizes}
    # the documents of a source in order of md5 fill the goal
    for s in sizes:
        mine = sorted([(hashlib.md5(str("" if d is None else d).encode()).hexdigest(), d or -1, size(t)) for d, t, q, _ in rows() if q == s])
        left, out = taken[s], {}
        while left > 0:
            for k, (_, d, n) in enumerate(mine):
                out[k] = out.get(k, 0) + min(n, left)
                left -= min(n, left)
        assert sorted(out.get(k, 0) for k in range(len(mine))) == sorted(r.taken for r in got if r.source == s)


def test_mix_fills_each_slot(spark):
    df = spark.createDataFrame(rows(), "doc_id long, text string, source string, size string")
    placed, per = mixing.streams(df)
    spans = mixing.mix(placed, per, 16).collect()
    slots = {}
    for r in spans:
        slots[(r.source_no, r.slot)] = slots.get((r.source_no, r.slot), 0) + r.words
    for s in {k[0] for k in slots}:
        lens = [n for (q, _), n in slots.items() if q == s]
        assert max(lens) - min(lens) <= 1
    assert len(slots) == mixing.schedule(per, 16).count()


def test_empty(spark):
    assert mixing.mixture(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0


def test_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = sorted(con.execute(mixing.ORACLE).fetchall())
    got = sorted(tuple(r[c] for c in ("doc_id", "size", "source_size", "target", "taken")) for r in mixing.query(spark, SF).collect())
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g == pytest.approx(w)
