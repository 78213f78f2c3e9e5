"""Batch = stream, across micro-batches and restarts; roll-up windows on streams."""

import time

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tripwire.operators import detectors as D
from tripwire.schema import PAYLOAD
from tripwire.sources.tables import transactions
from tripwire.streaming import profiles as SPR
from tripwire.streaming import stages as SP
from util import scores, txns

WIDE = "transaction_id string, user_id string, txn_time long, amount double, location string, " \
       "transaction_type string, amount_score int, velocity_score int, location_score int"


def _read_wide(spark, path):
    raw = spark.read.schema(SP.FILE_RECORD).json(path)
    return raw.select("seq", F.from_json("value", WIDE).alias("r")).select("seq", "r.*")


def test_stream_equals_batch_with_restarts(spark, scratch):
    topic, out, ckpt = f"{scratch}/topic", f"{scratch}/out", f"{scratch}/ckpt"
    tx = transactions(spark, SF_SMALL, "events")
    recs = SP.as_records(tx, PAYLOAD)
    cuts = [0, 300, 700, 10**9]
    for lo, hi in zip(cuts, cuts[1:]):
        recs.filter((F.col("seq") >= lo) & (F.col("seq") < hi)).coalesce(1).write.mode("append").json(topic)
        wide = SP.detector_stream(SP.read_topic(spark, topic))
        cols = PAYLOAD + ["amount_score", "velocity_score", "location_score"]
        SP.write_topic(SP.as_records(wide, cols), out, ckpt).awaitTermination()
    got = _read_wide(spark, out)
    assert got.count() == tx.count()
    assert scores(got) == scores(D.score_all(tx))



@pytest.mark.parametrize("api", ["group_state", "transform"])
def test_t1_two_micro_batches(spark, scratch, api):
    topic, out, ckpt = f"{scratch}/topic", f"{scratch}/out", f"{scratch}/ckpt"
    rows = [(1, "u1", 100, 10, "VN"), (2, "u1", 130, 31, "US"), (3, "u1", 140, 12, "US"), (4, "u1", 90, 11, "VN")]
    recs = SP.as_records(txns(spark, rows), PAYLOAD)
    cols = PAYLOAD + ["amount_score", "velocity_score", "location_score"]
    for part in ([1, 2], [3, 4]):
        recs.filter(F.col("seq").isin(part)).coalesce(1).write.mode("append").json(topic)
        wide = SP.detector_stream(SP.read_topic(spark, topic), api=api)
        SP.write_topic(SP.as_records(wide, cols), out, ckpt).awaitTermination()
    assert scores(_read_wide(spark, out)) == {1: (0, 0, 0), 2: (1, 0, 1), 3: (0, 1, 1), 4: (0, 1, 0)}


def test_rollup_stream_event_time_and_dedup(spark, scratch):
    topic = f"{scratch}/scored"
    long = spark.createDataFrame(
        [(1, "t1", "u", 5, 1.0, "VN", "Normal", "amount", 1),
         (1, "t1", "u", 5, 1.0, "VN", "Normal", "velocity", 1),
         (1, "t1", "u", 5, 1.0, "VN", "Normal", "location", 0),
         (1, "t1", "u", 5, 1.0, "VN", "Normal", "amount", 1),
         (2, "t2", "u", 6, 1.0, "VN", "Normal", "amount", 0),
         (3, "close", "u", 100, 1.0, "VN", "Normal", "amount", 0)],  # moves the watermark past t1/t2
        "seq long, transaction_id string, user_id string, txn_time long, amount double, location string, "
        "transaction_type string, detector string, fraud_score int")
    SP.as_records(long, PAYLOAD + ["fraud_score", "detector"]).coalesce(1).write.json(topic)
    results = {}
    for dedup in (False, True):
        out, ck = f"{scratch}/out{int(dedup)}", f"{scratch}/ck{int(dedup)}"
        # Two runs: the second (no new data) lets the advanced watermark close the windows.
        for _ in range(2):
            q = (SP.rollup_stream(SP.parse_scored(SP.read_topic(spark, topic)), window="tumbling", dedup=dedup, watermark="0 seconds")
                 .writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
                 .trigger(availableNow=True).start())
            q.awaitTermination()
        rows = spark.read.parquet(out).collect()
        results[dedup] = {r["transaction_id"]: (r["fraud_score"], r["transaction_type"]) for r in rows}
    assert results[False]["t1"] == (3, "Fraud") and results[False]["t2"] == (0, "Normal")
    assert results[True]["t1"] == (2, "Fraud")


def test_processing_time_window_invariant(spark, scratch):
    """Processing-time windows are not reproducible; their scores still sum to the whole."""
    topic = f"{scratch}/scored"
    tx = transactions(spark, SF_SMALL, "events")
    from tripwire.operators.rollup import scored_long
    long = scored_long(D.score_all(tx))
    SP.as_records(long, PAYLOAD + ["fraud_score", "detector"]).coalesce(2).write.json(topic)
    q = (SP.rollup_stream(SP.parse_scored(SP.read_topic(spark, topic)), window="processing")
         .writeStream.format("memory").queryName("proc_win").option("checkpointLocation", f"{scratch}/ck")
         .trigger(processingTime="1 second").start())
    try:
        deadline = time.time() + 60
        expected = long.agg(F.sum("fraud_score")).first()[0]
        got = 0
        q.processAllAvailable()
        time.sleep(1.5)
        # A later record moves the (processing-time) watermark past the open windows.
        closing = long.limit(1).withColumn("transaction_id", F.lit("closing")).withColumn("fraud_score", F.lit(0))
        SP.as_records(closing, PAYLOAD + ["fraud_score", "detector"]).write.mode("append").json(topic)
        while time.time() < deadline:
            time.sleep(2)
            got = spark.table("proc_win").agg(F.sum("fraud_score")).first()[0] or 0
            if got == expected:
                break
        assert got == expected
    finally:
        q.stop()


def test_final_stream_one_query(spark, scratch):
    topic, out = f"{scratch}/topic", f"{scratch}/final"
    tx = transactions(spark, SF_SMALL, "orders")
    SP.as_records(tx, PAYLOAD).coalesce(1).write.json(topic)
    final = SP.final_stream(SP.detector_stream(SP.read_topic(spark, topic)))
    q = (final.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{scratch}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    from tripwire.operators.rollup import score_and_label
    a = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    b = sorted(tuple(r) for r in score_and_label(tx).collect())
    assert a == b


def test_profile_deltas_stream_equals_batch(spark, scratch):
    from tripwire.operators.profile import user_profile
    topic, deltas, ckpt = f"{scratch}/topic", f"{scratch}/deltas", f"{scratch}/ckpt"
    tx = transactions(spark, SF_SMALL, "orders")
    recs = SP.as_records(tx, PAYLOAD)
    writer = SPR.profile_delta_writer(deltas, compact_every=1)
    for lo, hi in ((0, 600), (600, 10**9)):
        recs.filter((F.col("seq") >= lo) & (F.col("seq") < hi)).coalesce(1).write.mode("append").json(topic)
        from tripwire.functions.parse import parse_transactions
        parsed = parse_transactions(SP.read_topic(spark, topic), keep=["seq"])
        q = (parsed.writeStream.foreachBatch(writer).option("checkpointLocation", ckpt)
             .trigger(availableNow=True).start())
        q.awaitTermination()
    got = sorted(tuple(r) for r in SPR.read_profiles(spark, deltas).collect())
    exp = sorted(tuple(r) for r in user_profile(tx).collect())
    assert got == exp


def test_stream_static_profile_lookup(spark, scratch):
    """F4 on a stream: each arriving transaction joined with the static profiles."""
    from tripwire.functions.parse import parse_transactions
    from tripwire.operators.profile import profile_lookup, user_profile
    topic, out = f"{scratch}/topic", f"{scratch}/out"
    tx = transactions(spark, SF_SMALL, "events")
    SP.as_records(tx, PAYLOAD).coalesce(1).write.json(topic)
    profiles = user_profile(transactions(spark, SF_SMALL, "events").filter(F.col("seq") < 500))
    parsed = parse_transactions(SP.read_topic(spark, topic), keep=["seq"]).select("seq", "user_id")
    joined = profile_lookup(parsed, profiles)
    q = (joined.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{scratch}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == tx.count()
    exp = tx.select("seq", "user_id").join(profiles, "user_id", "left")
    assert got.filter(F.col("txn_count").isNull()).count() == exp.filter(F.col("txn_count").isNull()).count()


def test_rollup_stream_session(spark, scratch):
    topic, out, ck = f"{scratch}/scored", f"{scratch}/out", f"{scratch}/ck"
    long = spark.createDataFrame(
        [(i, "t1", "u", t, 1.0, "VN", "Normal", "amount", 1) for i, t in enumerate([100, 120, 141])]
        + [(9, "closing", "u", 10_000, 1.0, "VN", "Normal", "amount", 0)],
        "seq long, transaction_id string, user_id string, txn_time long, amount double, location string, "
        "transaction_type string, detector string, fraud_score int")
    SP.as_records(long, PAYLOAD + ["fraud_score", "detector"]).coalesce(1).write.json(topic)
    for _ in range(2):
        q = (SP.rollup_stream(SP.parse_scored(SP.read_topic(spark, topic)), window="session", gap_seconds=20, watermark="0 seconds")
             .writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
             .trigger(availableNow=True).start())
        q.awaitTermination()
    got = sorted((r["window_start"], r["fraud_score"]) for r in spark.read.parquet(out).collect()
                 if r["transaction_id"] == "t1")
    assert got == [(100, 2), (141, 1)]


def test_null_user_stream(spark, scratch):
    topic, out, ckpt = f"{scratch}/topic", f"{scratch}/out", f"{scratch}/ckpt"
    rows = [(1, None, 100, 10, "VN"), (2, None, 110, 40, "US"), (3, "u", 100, 5, "VN"), (4, None, 200, 12, "VN")]
    SP.as_records(txns(spark, rows), PAYLOAD).coalesce(1).write.json(topic)
    cols = PAYLOAD + ["amount_score", "velocity_score", "location_score"]
    SP.write_topic(SP.as_records(SP.detector_stream(SP.read_topic(spark, topic)), cols), out, ckpt).awaitTermination()
    assert scores(_read_wide(spark, out)) == {1: (0, 0, 0), 2: (1, 1, 1), 3: (0, 0, 0), 4: (0, 0, 0)}



def test_state_ttl(spark, scratch):
    """A user idle for longer than the TTL starts fresh (first row again).

    TTL needs a continuously running query: timeouts fire in micro-batches
    without data, so the query never goes idle and the sink is polled instead.
    """
    topic, out, ckpt = f"{scratch}/topic", f"{scratch}/out", f"{scratch}/ckpt"
    cols = PAYLOAD + ["amount_score", "velocity_score", "location_score"]

    def wait_for(seq, deadline=60):
        t0 = time.time()
        while time.time() - t0 < deadline:
            time.sleep(1)
            try:
                got = scores(_read_wide(spark, out))
            except Exception:  # no output file yet
                continue
            if seq in got:
                return got
        raise AssertionError(f"row {seq} not written")

    SP.as_records(txns(spark, [(1, "u", 100, 10, "VN")]), PAYLOAD).coalesce(1).write.json(topic)
    wide = SP.detector_stream(SP.read_topic(spark, topic), ttl_ms=1000)
    q = SP.write_topic(SP.as_records(wide, cols), out, ckpt, trigger={"processingTime": "500 milliseconds"})
    try:
        wait_for(1)
        time.sleep(3)  # u's state times out meanwhile
        SP.as_records(txns(spark, [(3, "u", 105, 100, "US")]), PAYLOAD).coalesce(1).write.mode("append").json(topic)
        got = wait_for(3)
    finally:
        q.stop()
    assert got[3] == (0, 0, 0)  # without the TTL it would be (1, 1, 1)


SCORED = "seq long, transaction_id string, user_id string, txn_time long, amount double, location string, " \
         "transaction_type string, detector string, fraud_score int"


def _scored_drop(spark, topic, rows):
    long = spark.createDataFrame([(s, t, "u", at, 1.0, "VN", "Normal", det, score) for s, t, at, det, score in rows], SCORED)
    SP.as_records(long, PAYLOAD + ["fraud_score", "detector"]).coalesce(1).write.mode("append").json(topic)


def _rolled(spark, topic, base, **kw):
    q = (SP.rollup_stream(SP.parse_scored(SP.read_topic(spark, topic)), window="tumbling", **kw)
         .writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def test_out_of_order_record_and_late_one(spark, scratch):
    """A record behind the latest time by less than the watermark counts; one behind by more is counted as late, not lost unseen."""
    topic = f"{scratch}/topic"
    _scored_drop(spark, topic, [(1, "t1", 100, "amount", 1)])
    _rolled(spark, topic, scratch, watermark="60 seconds")
    _scored_drop(spark, topic, [(2, "t2", 50, "amount", 1)])
    _rolled(spark, topic, scratch, watermark="60 seconds")
    _scored_drop(spark, topic, [(3, "end", 10_000, "amount", 0)])
    _rolled(spark, topic, scratch, watermark="60 seconds")
    _rolled(spark, topic, scratch, watermark="60 seconds")
    _scored_drop(spark, topic, [(4, "t3", 20, "amount", 1)])
    q = _rolled(spark, topic, scratch, watermark="60 seconds")
    got = {r["transaction_id"] for r in spark.read.parquet(f"{scratch}/out").collect()}
    assert got == {"t1", "t2"} and SP.late_records(q) == 1


def test_event_windows_need_a_watermark(spark, scratch):
    _scored_drop(spark, f"{scratch}/topic", [(1, "t1", 100, "amount", 1)])
    with pytest.raises(ValueError):
        SP.rollup_stream(SP.parse_scored(SP.read_topic(spark, f"{scratch}/topic")), window="session")


def test_dedup_across_micro_batches(spark, scratch):
    topic = f"{scratch}/topic"
    for rows in ([(1, "t1", 100, "amount", 1)], [(5, "t1", 100, "amount", 1)], [(6, "t1", 100, "location", 1)], [(9, "end", 10**6, "amount", 0)]):
        _scored_drop(spark, topic, rows)
        _rolled(spark, topic, scratch, watermark="1 hour", dedup=True)
    _rolled(spark, topic, scratch, watermark="1 hour", dedup=True)
    got = [(r["transaction_id"], r["fraud_score"]) for r in spark.read.parquet(f"{scratch}/out").collect()]
    assert got == [("t1", 2)]


def test_user_in_many_chunks():
    """One user in several out-of-order chunks, and by (partition, offset) where records have a partition."""
    import pandas as pd
    from tripwire.streaming.processor import fold_user
    rows = [(i, f"t{i}", "u", 100 * i, 0.1 if i < 10 else 0.3, "VN", "Normal", None) for i in range(11)]
    cols = ["seq", "transaction_id", "user_id", "txn_time", "amount", "location", "transaction_type", "extras"]
    pdf = pd.DataFrame(rows, columns=cols)
    chunks, state = fold_user([pdf[7:], pdf[:3], pdf[3:7]], None, 3.0, 20)
    assert [len(c) for c in chunks] == [4, 3, 4]
    got = pd.concat(chunks).sort_values("seq")
    assert got["amount_score"].tolist() == [0] * 10 + [1] and int(state[0]) == 1_000_000 and state[1] == 10
    two = pdf.assign(partition=[1, 0] * 5 + [0], seq=[i // 2 for i in range(11)])
    first = fold_user([two], None, 3.0, 10**9)[0][0].assign(partition=two["partition"])
    assert first[first["velocity_score"] == 0].index.tolist() == [1]  # the first of partition 0 comes first


def test_unknown_fields_reach_the_final_topic(spark, scratch):
    spark.createDataFrame([(1, '{"transaction_id":"t","user_id":"u","txn_time":1,"amount":2,"location":"VN","transaction_type":"Normal","note":{"a":[1]}}')],
                          "seq long, value string").coalesce(1).write.json(f"{scratch}/txn")
    scored = SP.scored_records(SP.detector_stream(SP.read_topic(spark, f"{scratch}/txn")))
    SP.write_topic(scored, f"{scratch}/scored", f"{scratch}/ck").awaitTermination()
    rows = spark.read.schema(SP.FILE_RECORD).json(f"{scratch}/scored")
    assert rows.count() == 3 and {r["key"] for r in rows.collect()} == {"u"}
    from tripwire.operators.rollup import final_scores
    final = SP.as_records(final_scores(SP.parse_scored(rows)).withColumn("seq", F.lit(1)), PAYLOAD + ["fraud_score"])
    assert [r[0] for r in final.select(F.get_json_object("value", "$.note.a[0]")).collect()] == ["1"]


def test_rejects_of_amounts(spark, scratch):
    from tripwire.operators.rollup import total_score
    topic = f"{scratch}/topic"
    SP.as_records(txns(spark, [(1, "u", 1, 5, "VN"), (2, "u", 99, 2e7, "VN")]), PAYLOAD).coalesce(1).write.json(topic)
    writer = SP.split_writer(lambda df, i: df.write.mode("append").parquet(f"{scratch}/rows"), f"{scratch}/rejects")
    (total_score(SP.detector_stream(SP.read_topic(spark, topic))).writeStream.foreachBatch(writer).option("checkpointLocation", f"{scratch}/ck")
     .trigger(availableNow=True).start().awaitTermination())
    assert [r["transaction_id"] for r in spark.read.parquet(f"{scratch}/rows").collect()] == ["txn-1"]
    assert [r["transaction_id"] for r in spark.read.json(f"{scratch}/rejects").collect()] == ["txn-2"]
