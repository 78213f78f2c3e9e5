"""Scalar helpers (C1-C8) and the progress counter."""

import datetime as dt

from pyspark.sql import functions as F

from tripwire.functions import scalar as S
from tripwire.schema import PAYLOAD
from tripwire.streaming import stages as SP
from util import txns


def test_frac_uniform_ranges(spark):
    df = spark.range(2000).select(
        S.frac(F.col("id"), "x").alias("f"), S.uniform(0.8, 1.2, F.col("id"), "n").alias("u"),
        S.uniform_int(1, 3, F.col("id"), "k").alias("k"))
    r = df.agg(F.min("f"), F.max("f"), F.min("u"), F.max("u"), F.min("k"), F.max("k")).first()
    assert 0 <= r[0] and r[1] < 1 and 0.8 <= r[2] and r[3] <= 1.2 and r[4] == 1 and r[5] == 3
    assert df.collect() == df.collect()  # repeatable


def test_seconds_of_day_gap(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 0), dt.datetime(2024, 1, 1, 0, 16, 40))], "a timestamp, b timestamp")
    r = df.select(S.seconds_of_day_gap("a", "b").alias("g"), S.seconds_of_day_gap("b", "a").alias("h")).first()
    assert r["g"] == 86400 - 1000 and r["h"] == 1000


def test_add_time_and_ids(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 0), 7)], "t timestamp, k long")
    r = df.select(S.add_seconds("t", F.lit(30)).alias("s"), S.add_millis("t", F.lit(1500)).alias("m"),
                  S.surrogate_id("txn-", F.col("k")).alias("id"), S.location_eq_ci(F.lit("VN"), F.lit("vn")).alias("ci"),
                  S.location_differs(F.lit(None).cast("string"), F.lit(None).cast("string")).alias("ne")).first()
    assert r["s"] == dt.datetime(2024, 1, 1, 0, 0, 30) and r["m"] == dt.datetime(2024, 1, 1, 0, 0, 1, 500000)
    assert r["id"].startswith("txn-7") and len(r["id"]) == len("txn-7") + 8
    assert r["ci"] is True and r["ne"] is False


def test_progress_counter(spark, scratch):
    topic = f"{scratch}/topic"
    SP.as_records(txns(spark, [(i, "u", i, 1, "VN") for i in range(12)]), PAYLOAD).coalesce(1).write.json(topic)
    q = SP.write_topic(SP.with_progress_count(SP.read_topic(spark, topic)), f"{scratch}/out", f"{scratch}/ck")
    q.awaitTermination()
    assert q.lastProgress["observedMetrics"]["messages"]["n"] == 12


def test_flatten_nested_transaction(spark):
    from tripwire.functions.parse import flatten_transaction
    from tripwire.schema import NESTED_TRANSACTION
    nested = spark.createDataFrame(
        [("txn-1", "user-1", 12.5, dt.datetime(2024, 1, 1, 0, 0, 7, 900000), ("Vietnam",), "Normal")], NESTED_TRANSACTION)
    r = flatten_transaction(nested).first()
    assert (r["txn_time"], r["location"], r["amount"]) == (1704067207, "Vietnam", 12.5)


def test_kafka_options_and_app_args():
    from tripwire.streaming import app
    opts = SP.kafka_options("broker:9092", "transaction")
    assert opts["subscribe"] == "transaction" and opts["startingOffsets"] == "earliest"
    assert opts["kafka.bootstrap.servers"] == "broker:9092" and int(opts["maxOffsetsPerTrigger"]) > 0
    a = app._args(["aggregate", "--source", "s", "--target", "t", "--checkpoint", "c", "--window", "session",
                   "--dedup", "--trigger", "once"])
    assert (a.mode, a.window, a.dedup, app._trigger(a)) == ("aggregate", "session", True, {"availableNow": True})
    assert app._trigger(app._args(["all", "--source", "s", "--checkpoint", "c"])) == {"processingTime": "5 seconds"}
