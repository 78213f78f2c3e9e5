"""Windows that keep late rows, records out of order, running profiles, lookups and sketches of streams."""

import json
import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tripwire.operators import detectors as D
from tripwire.operators import plugin as PL
from tripwire.operators import profile as PR
from tripwire.schema import columns
from tripwire.session import rocksdb_state
from tripwire.sources.tables import transactions
from tripwire.sources.versioned import VersionedTable
from tripwire.streaming import buffers as B
from tripwire.streaming import profiles as SPR
from util import scores, txns

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the function below reaches the workers without being installed there
OUT = columns("k string, start long, n long, total long")


def totals(key, begin, rows):
    """A user's own whole-window function."""
    return [{"k": key[0], "start": begin, "n": len(rows), "total": sum(r["v"] for r in rows)}]


def _run(spark, scratch, drops, schema, build, runs=1):
    for n, drop in enumerate(drops):
        spark.createDataFrame(drop, schema).coalesce(1).write.mode("append").parquet(f"{scratch}/topic")
        out = build(spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(f"{scratch}/topic"))
        for _ in range(runs):  # a restart each time
            writer = B.two_outputs(lambda df, k: df.write.mode("overwrite").json(f"{scratch}/out/batch={k}"),
                                   lambda df, k: df.write.mode("overwrite").json(f"{scratch}/late/batch={k}"))
            (out.writeStream.foreachBatch(writer).option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start().awaitTermination())


def test_late_rows_are_an_output(spark, scratch):
    """Windows and late rows together hold every row, by key and by buckets, over restarts."""
    drops = [[("a", 1, 1), ("a", 2, 2), ("b", 3, 4), ("a", 11, 8)], [("a", 8, 16), ("b", 35, 32)], [("a", 4, 64), ("b", 38, 128), ("b", 9, 256)],
             [("z", 1000, 512)], [("a", 12, 1024), ("z", 1001, 2048)]]
    for buckets in (None, 2):
        at = f"{scratch}/{buckets}"
        _run(spark, at, drops, columns("k string, t long, v long"),
             lambda df: B.window_stream(df, ["k"], F.timestamp_seconds("t"), 10, "5 seconds", totals, OUT, buckets=buckets), runs=2)
        got = {(r.k, r.start): (r.n, r.total) for r in spark.read.schema(OUT).json(f"{at}/out").collect()}
        late = sorted((r.k, r.t, r.v) for r in spark.read.schema("k string, t long, v long").json(f"{at}/late").collect())
        assert got == {("a", 0): (3, 19), ("a", 10): (1, 8), ("b", 0): (1, 4), ("b", 30): (2, 160)}
        assert late == [("a", 4, 64), ("a", 12, 1024), ("b", 9, 256)]
        open_rows = {512, 2048}  # the last window has not ended
        assert sum(t for _, t in got.values()) + sum(v for *_, v in late) + sum(open_rows) == 4095


def test_interleaved_partitions_give_the_scores_of_one(spark, scratch):
    tx = [(i, "u" if i % 3 else "v", 10 * i, [5.0, 40.0, 7.0, None, float("nan"), 1e40][i % 6], "VN" if i % 5 else None) for i in range(40)]
    want = scores(PL.score_with(txns(spark, tx), PL.standard()))
    rows = [(*r.asDict().values(), r.seq % 2) for r in txns(spark, tx).collect()]
    schema = txns(spark, tx).withColumn("partition", F.lit(0).cast("long")).schema
    # partition 1 lags 10 records behind; the first record comes once more when all is folded
    drops = [[r for r in rows if (r[0] + 10 * (r[-1] == 1)) // 15 == k] for k in range(4)]
    end = (10_000, "txn-end", "end", 0, 1.0, "x", "Normal", 0)
    _run(spark, scratch, [*drops, [end], [rows[0]]], schema,
         lambda df: B.in_order(df, PL.standard(), F.timestamp_seconds("seq"), ["partition", "seq"], "20 seconds"), runs=2)
    out = spark.read.schema("seq long, user_id string, amount double, amount_score int, velocity_score int, location_score int").json(f"{scratch}/out")
    assert scores(out.filter("user_id != 'end'")) == want
    assert {r.seq: r.amount for r in out.collect() if r.seq in (0, 1, 5)} == {0: 5.0, 1: 40.0, 5: 1e40}
    late = spark.read.schema("seq long").json(f"{scratch}/late").collect()
    assert [r.seq for r in late] == [0]


def test_running_profile_of_a_stream(spark, scratch):
    tx = transactions(spark, SF_SMALL, "orders").withColumn("amount", F.when(F.col("seq") % 7 != 0, F.col("amount")).when(F.col("seq") % 2 == 0, 1e33))
    want = {tuple(r) for r in PR.profile_running(tx).drop("amount").collect()}
    lo, hi = tx.agg(F.min("seq"), F.max("seq")).first()
    for k in range(3):
        step = (hi - lo) // 3 + 1
        tx.filter((F.col("seq") >= lo + k * step) & (F.col("seq") < lo + (k + 1) * step)).repartition(3).write.mode("append").parquet(f"{scratch}/topic")
        src = spark.readStream.schema(tx.schema).parquet(f"{scratch}/topic")
        (SPR.running_profile_stream(src).writeStream.format("parquet").option("path", f"{scratch}/out").option("checkpointLocation", f"{scratch}/ck")
         .trigger(availableNow=True).start().awaitTermination())
    got = spark.read.parquet(f"{scratch}/out").select(PR.profile_running(tx).drop("amount").columns)
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)


def test_profiles_do_not_fail_on_amounts(spark):
    rows = [(1, "u", 1, 1, "VN"), (2, "u", 2, None, "VN"), (3, "u", 3, 2, "VN"), (4, "u", 4, float("nan"), "VN"), (5, "u", 5, 1e40, "VN"),
            (6, "w", 1, None, "VN"), (7, "w", 2, 4, "VN")] + [(10 + i, "big", i, 9e31, "VN") for i in range(3)]
    tx = txns(spark, rows)
    got = {r.user_id: (r.txn_count, r.total_amt, r.average_amt) for r in PR.user_profile(tx).collect()}
    assert got["u"] == (5, 3, 1.5) and got["w"] == (2, 4, 4.0) and got["big"] == (3, None, None)
    run = {r.seq: (r.total_amt_before, r.average_amt_before, r.total_amt, r.average_amt) for r in PR.profile_running(tx).collect()}
    assert run[2] == (1, 1.0, 1, 1.0) and run[3] == (1, 1.0, 3, 1.5) and run[5] == (3, 1.5, 3, 1.5) and run[7] == (0, None, 4, 4.0)
    assert run == {r.seq: (r.total_amt_before, r.average_amt_before, r.total_amt, r.average_amt) for r in PR.profile_running(tx, rows_per_block=1).collect()}
    assert {r.seq for r in PR.amount_rejects(tx).collect()} == {2, 4, 5, 6}
    halves = [PR.profile_deltas(tx.filter(c)) for c in ("seq <= 10", "seq > 10")]
    merged = {r.user_id: (r.txn_count, r.total_amt, r.average_amt) for r in PR.merge_profiles(halves[0].unionByName(halves[1])).collect()}
    assert merged == got


def test_lookup_reads_one_version(spark, scratch):
    writer = SPR.profile_delta_writer(f"{scratch}/profiles", compact_every=1)
    seen = []
    lookup = SPR.lookup_writer(f"{scratch}/profiles", lambda df, k: seen.append((json.loads(df.first().profile_version), {r.user_id: r.txn_count for r in df.collect()})))
    ids = spark.createDataFrame([("a",), ("x",), (None,)], "user_id string")
    lookup(ids, 0)
    for k in range(2):
        writer(txns(spark, [(k, "a", 1, 1.0, "VN")]), k)
        writer(txns(spark, [(k, "a", 1, 1.0, "VN")]), k)  # a replay counts once
        lookup(ids, k + 1)
    assert seen == [({}, {"a": None, "x": None, None: None}), ({"batch": 0}, {"a": 1, "x": None, None: None}), ({"batch": 1}, {"a": 2, "x": None, None: None})]


def test_files_stay_bounded(spark, scratch):
    """As many files after many micro-batches as after few; merges keep what readers of the last versions need."""
    table = VersionedTable(spark, f"{scratch}/t", lambda rows: rows.groupBy("k").agg(F.sum("n").alias("n")), compact_every=10, keep=3)
    one = spark.createDataFrame([(1, 1)], "k long, n long").coalesce(1)
    most = 0
    for v in range(60):
        table.commit(v, one)
        most = max(most, len(table.folder.names("data")))
    assert most <= 10 + 3 + 1 and table.read().first().n == 60 and len(table.versions()) == 3


def test_distinct_users_in_any_split(spark):
    ids = spark.range(60_000).select(F.col("id").cast("string").alias("user_id"))
    whole = SPR.user_sketch(ids)
    exact = SPR.sketch_estimate(whole).first().user_count
    assert abs(exact - 60_000) <= 0.03 * 60_000
    for cut in (3, 50_000):
        parts = [SPR.user_sketch(ids.filter(c)) for c in (F.col("user_id").cast("long") < cut, F.col("user_id").cast("long") >= cut - 1)]
        merged = SPR.merge_sketches(parts[0].unionByName(parts[1]))
        assert SPR.sketch_estimate(merged).first().user_count == exact
    few = SPR.sketch_estimate(SPR.user_sketch(ids.limit(100))).first().user_count
    assert abs(few - 100) <= 2 and SPR.sketch_estimate(SPR.user_sketch(ids.limit(0))).first().user_count == 0


def test_order_by_buckets_of_users(spark, scratch):
    """Users that share a bucket, the null user too, have the scores, the late rows and the states of their own."""
    tx = transactions(spark, SF_SMALL, "events").filter("seq < 300")
    tx = tx.withColumn("user_id", F.when(F.col("seq") % 7 == 0, None).otherwise(F.col("user_id")))
    want = {r.seq: tuple(r[f"{d}_score"] for d in ("amount", "velocity", "location")) for r in D.score_all(tx).collect()}
    rows, late = {}, []
    writer = B.two_outputs(lambda df, k: rows.update({r.seq: tuple(r[f"{d}_score"] for d in ("amount", "velocity", "location")) for r in df.collect()}),
                           lambda df, k: late.extend(r.seq for r in df.collect()))
    closing = tx.limit(1).withColumns({"user_id": F.lit("closing"), "seq": F.lit(10_000).cast("long")})
    parts = [tx.filter("seq < 100 and seq % 2 = 0"), tx.filter("seq < 100 and seq % 2 = 1"), tx.filter("seq >= 100"), closing, tx.filter("seq in (20, 21)")]
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(f"{scratch}/topic")
        source = spark.readStream.schema(tx.schema).parquet(f"{scratch}/topic")
        out = B.in_order(source, PL.standard(), F.timestamp_seconds("seq"), ["seq"], "100 seconds", buckets=3)
        for _ in range(1 + (part is closing)):
            with rocksdb_state(spark):
                q = out.writeStream.foreachBatch(writer).option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start()
            q.awaitTermination()
    assert {k: v for k, v in rows.items() if k < 10_000} == want and sorted(late) == [20, 21]


def test_buckets_and_state_memory_are_bounded(spark):
    """Rows of a bucket do not grow with the stream; RocksDB's memory is bounded for a query started within, and the settings are put back."""
    from tripwire import session
    from tripwire.plans import catalog_streams as C
    assert C._buckets(100) == 64 and 108_000_000 / C._buckets(108_000_000) <= 2 * C.ROWS_PER_BUCKET
    before = spark.conf.get(session.STATE_MEMORY_CONF, None)
    with rocksdb_state(spark):
        assert spark.conf.get(session.STATE_MEMORY_CONF) == "true"
    assert spark.conf.get(session.STATE_MEMORY_CONF, None) == before
