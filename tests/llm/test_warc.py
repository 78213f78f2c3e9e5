"""Revisit resolution against plain Python and its SQL; hot urls, odd rows."""

import random

import duckdb
from pyspark.sql import functions as F

from tripwire.llm import warc

SF = "/root/testdata/sf0.01"
SCHEMA = "record_id long, url string, ts long, kind string, status int, headers map<string,string>, base string"


def test_canonical(spark):
    cases = {"HTTP://WWW.Ex.com:80/A/?b=2&a=1&utm_x=3#f": "ex.com/A?a=1&b=2", "https://ex.com/A?a=1&b=2": "ex.com/A?a=1&b=2", "ex.com": "ex.com",
             "http://ex.com/": "ex.com", "": "", "http://ex.com?utm_a=1": "ex.com", None: None, "x://h:8080/p//": "h:8080/p"}
    df = spark.createDataFrame([(k,) for k in cases], "u string")
    assert {r.u: r.c for r in df.select("u", warc.canonical_url(F.col("u")).alias("c")).collect()} == cases


def brute(rows):
    out = []
    for rid, url, ts, kind, status, headers, _ in rows:
        if kind != "revisit":
            continue
        low = lambda h: {k.lower(): v for k, v in (h or {}).items() if v is not None}
        mine = low(headers)
        bases = [r for r in rows if url and ts is not None and r[1] == url and r[2] is not None and r[3] == "response" and r[4] == 200
                 and (r[2], r[0]) < (ts, rid)]
        if not bases:
            out.append((rid, None, "orphan", None))
            continue
        b = max(bases, key=lambda r: (r[2], r[0]))
        theirs = low(b[5])
        weak = lambda h: h["etag"].removeprefix("W/") if "etag" in h else None
        same = None
        if weak(mine) is not None and weak(theirs) is not None:
            same = weak(mine) == weak(theirs)
        elif "last-modified" in mine and "last-modified" in theirs:
            same = mine["last-modified"] == theirs["last-modified"]
        outcome = {None: "unverified", True: "resolved", False: "mismatch"}[same]
        merged = None if same is False else theirs | {k: v for k, v in mine.items() if k in warc.PERMITTED}
        out.append((rid, b[0], outcome, merged))
    return sorted(out, key=repr)


def records():
    rng = random.Random(8)
    rows = []
    for i in range(1, 700):
        url = "hot.com/a" if rng.random() < 0.4 else f"u{rng.randrange(40)}.com/x"
        h = {}
        if rng.random() < 0.7:
            h["ETag"] = rng.choice(["", "W/"]) + rng.choice(["a", "b"])
        if rng.random() < 0.7:
            h["Last-Modified"] = rng.choice(["m1", "m2"])
        h["Cache-Control"], h["Content-Length"] = rng.choice([None, "no"]), str(i)
        rows.append((i, url, rng.randrange(300), rng.choice(["response", "revisit"]), rng.choice([200, 200, 404, 304]), rng.choice([h, h, None, {}]), "z"))
    return rows + [(9001, None, 5, "revisit", 304, {}, "z"), (9002, "hot.com/a", None, "revisit", 304, {}, "z"), (9003, "", 5, "revisit", 304, {"a": "b"}, "z"),
                   (9004, "hot.com/a", 9999, None, None, None, "z"), rows[5]]


def test_against_brute_force(spark):
    rows = records()
    df = spark.createDataFrame(rows, SCHEMA).repartition(8)
    got = sorted(((r.record_id, r.base_id, r.outcome, r.headers) for r in warc.resolve(df).collect()), key=repr)
    assert [g[:3] for g in got] == [w[:3] for w in brute(rows)]
    assert {(g[0], str(sorted((g[3] or {}).items()))) for g in got} == {(w[0], str(sorted((w[3] or {}).items()))) for w in brute(rows)}
    assert warc.resolve(df.limit(0)).count() == 0


def test_headers_that_fall_together(spark):
    df = spark.createDataFrame([({"Vary": "a", "vary ": "b", "X": None},), (None,)], "h map<string,string>")
    assert [r.h for r in df.select(warc.lower_headers(F.col("h")).alias("h")).collect()] == [{"vary": "a, b"}, {}]


def test_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF}/pages.parquet')")
    want = sorted(con.execute(warc.ORACLE).fetchall(), key=repr)
    got = sorted((tuple(r) for r in warc.query(spark, SF).collect()), key=repr)
    assert got == want and {r[4] for r in got} == {"resolved", "unverified", "mismatch"}
