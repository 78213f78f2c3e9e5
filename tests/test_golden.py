"""Golden micro traces and edge cases (FIXTURES.md sections 3, T1-T3)."""

import pytest
from pyspark.sql import functions as F

from tripwire.functions.parse import final_projection, final_rejects, parse_transactions
from tripwire.operators import detectors as D
from tripwire.operators import rollup as R
from tripwire.streaming.processor import score_with_state
from util import scores, txns

T1 = [(1, "u1", 100, 10, "VN"), (2, "u1", 130, 31, "US"), (3, "u1", 140, 12, "US"), (4, "u1", 90, 11, "VN")]
T1_EXPECTED = {1: (0, 0, 0), 2: (1, 0, 1), 3: (0, 1, 1), 4: (0, 1, 0)}


@pytest.mark.parametrize("rpb", [None, 1, 2])
def test_t1_all_detectors_batch(spark, rpb):
    got = scores(D.score_all(txns(spark, T1), rows_per_block=rpb))
    assert got == T1_EXPECTED


def test_t1_final_labels(spark):
    out = {r["transaction_id"]: (r["fraud_score"], r["transaction_type"])
           for r in R.score_and_label(txns(spark, T1)).collect()}
    assert out == {"txn-1": (0, "Normal"), "txn-2": (2, "Fraud"), "txn-3": (2, "Fraud"), "txn-4": (1, "Normal")}


def test_t1_stateful_processor_batch(spark):
    assert scores(score_with_state(txns(spark, T1))) == T1_EXPECTED


@pytest.mark.parametrize("amounts,expected", [
    ([10, 30], [0, 1]),            # exactly 3x
    ([10, 29.999], [0, 0]),        # just under
    ([0, 0, 5], [0, 1, 1]),        # zero start: the average stays 0, everything is flagged
])
def test_amount_edges(spark, amounts, expected):
    rows = [(i, "u", 1000 * i, a, "VN") for i, a in enumerate(amounts)]
    got = scores(D.detect_amount(txns(spark, rows)), ("fraud_score",))
    assert [got[i][0] for i in range(len(amounts))] == expected


def test_velocity_exact_gap(spark):
    rows = [(0, "u", 100, 1, "A"), (1, "u", 120, 1, "A"), (2, "u", 141, 1, "A")]
    got = scores(D.detect_velocity(txns(spark, rows)), ("fraud_score",))
    assert [got[i][0] for i in range(3)] == [0, 1, 0]


def test_location_null_and_case(spark):
    rows = [(0, "u", 0, 1, None), (1, "u", 100, 1, None), (2, "u", 200, 1, "VN")]
    got = scores(D.detect_location(txns(spark, rows)), ("fraud_score",))
    assert [got[i][0] for i in range(3)] == [0, 0, 1]
    rows = [(0, "v", 0, 1, "VN"), (1, "v", 100, 1, "vn")]
    got = scores(D.detect_location(txns(spark, rows)), ("fraud_score",))
    assert [got[i][0] for i in range(2)] == [0, 1]


def test_label_kept(spark):
    rows = [(0, "u", 0, 10, "VN", "Fraud")]
    out = R.total_score(D.score_all(txns(spark, rows))).collect()[0]
    assert out["transaction_type"] == "Fraud" and out["detected"] is False


def test_t2_rollup_and_dedup(spark):
    long = spark.createDataFrame(
        [(1, "t1", "u", 5, 1.0, "VN", "Normal", "amount", 1),
         (1, "t1", "u", 5, 1.0, "VN", "Normal", "velocity", 1),
         (1, "t1", "u", 5, 1.0, "VN", "Normal", "location", 0),
         (1, "t1", "u", 5, 1.0, "VN", "Normal", "amount", 1),  # redelivered
         (2, "t2", "u", 6, 1.0, "VN", "Normal", "amount", 0)],
        "seq long, transaction_id string, user_id string, txn_time long, amount double, location string, "
        "transaction_type string, detector string, fraud_score int")
    got = {r["transaction_id"]: (r["fraud_score"], r["transaction_type"]) for r in R.final_scores(long).collect()}
    assert got == {"t1": (3, "Fraud"), "t2": (0, "Normal")}
    got = {r["transaction_id"]: r["fraud_score"] for r in R.final_scores(long, dedup=True).collect()}
    assert got == {"t1": 2, "t2": 0}


def test_session_at_gap(spark):
    long = spark.createDataFrame(
        [(i, "t1", "u", t, 1.0, "VN", "Normal", "amount", 1) for i, t in enumerate([100, 120, 141])],
        "seq long, transaction_id string, user_id string, txn_time long, amount double, location string, "
        "transaction_type string, detector string, fraud_score int")
    got = sorted((r["session_start"], r["fraud_score"]) for r in R.final_scores_session(long, 20).collect())
    assert got == [(100, 2), (141, 1)]


def test_amount_too_big(spark):
    df = txns(spark, [(0, "u", 0, 10_000_000, "VN")]).withColumn("fraud_score", F.lit(0))
    with pytest.raises(Exception):
        final_projection(df).collect()
    assert final_projection(df, safe=True).count() == 0
    assert [r["amount"] for r in final_rejects(df).collect()] == [10_000_000]


def test_malformed_json(spark):
    raw = spark.createDataFrame([("{bad",), ('{"transaction_id":"t","amount":"1.5","txn_time":7}',)], "value string")
    with pytest.raises(Exception):
        parse_transactions(raw, mode="FAILFAST").collect()
    rows = parse_transactions(raw, mode="PERMISSIVE").collect()
    bad = [r for r in rows if r["_corrupt"] is not None]
    good = [r for r in rows if r["_corrupt"] is None]
    assert len(bad) == 1 and bad[0]["_corrupt"] == "{bad"
    assert good[0]["amount"] == 1.5 and good[0]["txn_time"] == 7


NULL_USER = [(1, None, 100, 10, "VN"), (2, None, 110, 40, "US"), (3, "u", 100, 5, "VN"), (4, None, 200, 12, "VN")]
NULL_EXPECTED = {1: (0, 0, 0), 2: (1, 1, 1), 3: (0, 0, 0), 4: (0, 0, 0)}


@pytest.mark.parametrize("rpb", [None, 1])
def test_null_user_is_one_group(spark, rpb):
    assert scores(D.score_all(txns(spark, NULL_USER), rows_per_block=rpb)) == NULL_EXPECTED


def test_null_user_with_state(spark):
    from tripwire.streaming.processor import score_with_state
    assert scores(score_with_state(txns(spark, NULL_USER))) == NULL_EXPECTED
