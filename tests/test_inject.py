"""Bounds of the injected behaviours (as asserted by the reference's own tests)."""

from pyspark.sql import functions as F

from conftest import SF_MID
from tripwire.functions.scalar import seconds_of_day_gap
from tripwire.operators import inject as I
from tripwire.sources.tables import transactions


def _with_before(spark, name, table="events"):
    tx = transactions(spark, SF_MID, table)
    h = I.with_history(tx).filter(~F.col("is_first"))
    out = I.apply_behaviour(tx, name)
    return h.select("seq", "avg_before", "last_time", "main_location").join(out, "seq")


def test_close_time_within_20_seconds(spark):
    df = _with_before(spark, I.TIME)
    gap = seconds_of_day_gap(F.timestamp_seconds("txn_time"), F.timestamp_seconds("last_time"))
    assert df.filter(gap > 20).count() == 0


def test_location_differs_from_main(spark):
    df = _with_before(spark, I.PROXIMITY)
    assert df.filter(F.lower("location") == F.lower("main_location")).count() == 0
    assert df.filter((F.col("txn_time") - F.col("last_time") < 1) | (F.col("txn_time") - F.col("last_time") > 600)).count() == 0


def test_high_amount_at_least_three_times(spark):
    df = _with_before(spark, I.HIGH_VALUE)
    assert df.filter(F.col("amount") / F.col("avg_before") < 3).count() == 0


def test_pick_counts(spark):
    tx = transactions(spark, SF_MID, "events")
    picked = I.pick_rows(tx)
    per_block = picked.groupBy("block").agg(F.count(F.lit(1)).alias("c"), F.max("n").alias("n")).collect()
    assert all(r["c"] <= r["n"] <= 20 for r in per_block)
    assert picked.select("seq").distinct().count() == picked.count()


def test_inject_all_labels_and_first_rows(spark):
    tx = transactions(spark, SF_MID, "events")
    inj = I.inject_all(tx)
    h = I.with_history(tx).select("seq", "is_first")
    j = inj.join(h, "seq")
    assert j.filter(F.col("is_first") & F.col("fraud_types").isNotNull()).count() == 0
    assert j.filter(F.col("fraud_types").isNotNull() & (F.col("transaction_type") != "Fraud")).count() == 0
    assert inj.count() == tx.count()


def test_pick_counts_for_other_intervals(spark):
    """n rows of every full block are picked whatever the interval."""
    for interval in (1, 7, 1008, 2000):
        df = I.pick_flags(spark.range(interval * 12).select(F.col("id").alias("seq")), interval)
        for r in df.groupBy("block").agg(F.sum(F.col("picked").cast("int")).alias("c"), F.max("n").alias("n")).collect():
            assert min(r["n"], interval + 1) - 1 <= r["c"] <= r["n"], (interval, r)


def test_numbered_locations(spark):
    df = spark.createDataFrame([(f"L{i % 700}",) for i in range(2000)] + [("l5",), (None,)], "location string")
    got = I.numbered_locations(df).collect()
    assert sorted(r["idx"] for r in got) == list(range(700)) and {r["m"] for r in got} == {700}
