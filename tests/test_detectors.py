"""Detectors against a plain-Python brute force, with and without hot-user blocks."""

import random

import pytest
from pyspark.sql import functions as F

from brute import brute_scores
from conftest import SF_SMALL
from tripwire.operators import detectors as D
from tripwire.operators import profile as PR
from tripwire.sources.tables import transactions
from util import scores, txns


@pytest.mark.parametrize("table", ["events", "orders"])
@pytest.mark.parametrize("rpb", [None, 3])
def test_score_all_matches_brute_force(spark, table, rpb):
    tx = transactions(spark, SF_SMALL, table)
    exp = brute_scores([r.asDict() for r in tx.collect()])
    assert scores(D.score_all(tx, rows_per_block=rpb)) == exp


def test_wide_gap(spark):
    tx = transactions(spark, SF_SMALL, "events")
    exp = brute_scores([r.asDict() for r in tx.collect()], max_gap=1200)
    got = scores(D.detect_velocity(tx, max_gap=1200), ("fraud_score",))
    assert {k: v[0] for k, v in got.items()} == {k: v[1] for k, v in exp.items()}


def test_order_of_input_rows_does_not_matter(spark):
    tx = transactions(spark, SF_SMALL, "events")
    rows = tx.collect()
    random.Random(7).shuffle(rows)
    shuffled = spark.createDataFrame(rows, tx.schema).repartition(5)
    assert scores(D.score_all(shuffled)) == scores(D.score_all(tx))


def test_one_hot_user_holding_a_third(spark):
    """A user with a third of all rows is cut into blocks; the results do not change."""
    tx = transactions(spark, SF_SMALL, "events")
    hot = tx.withColumn("user_id", F.when(F.col("seq") % 3 == 0, F.lit("user-hot")).otherwise(F.col("user_id")))
    exp = brute_scores([r.asDict() for r in hot.collect()])
    assert scores(D.score_all(hot, rows_per_block=50)) == exp


@pytest.mark.parametrize("rpb", [None, 4])
def test_running_profile_blocks(spark, rpb):
    tx = transactions(spark, SF_SMALL, "orders")
    cols = ["txn_count", "total_amt", "average_amt", "main_location", "last_txn_time_before", "average_amt_before"]
    a = {r["seq"]: tuple(r[c] for c in cols) for r in PR.profile_running(tx, rows_per_block=rpb).collect()}
    b = {r["seq"]: tuple(r[c] for c in cols) for r in PR.profile_running(tx, rows_per_block=10**9).collect()}
    assert a == b


def test_variants_with_blocks(spark):
    tx = transactions(spark, SF_SMALL, "events")
    for fn in (D.detect_amount_all, D.detect_location_prev):
        a = scores(fn(tx, rows_per_block=5), ("fraud_score",))
        b = scores(fn(tx), ("fraud_score",))
        assert a == b


@pytest.mark.parametrize("rpb", [None, 1, 2, 5])
def test_exact_totals_do_not_depend_on_blocks(spark, rpb):
    """Ten amounts of 0.1, then 0.3 (exactly three times the average) and one just under."""
    rows = [(i, "u", 1000 * i, 0.1, "VN") for i in range(10)] + [(10, "u", 20000, 0.3, "VN"), (11, "u", 30000, 0.299999, "VN")]
    got = scores(D.score_all(txns(spark, rows), rows_per_block=rpb))
    assert [got[i][0] for i in range(12)] == [0] * 10 + [1, 0]
    assert {k: v[0] for k, v in scores(D.detect_amount(txns(spark, rows), rows_per_block=rpb), ("fraud_score",)).items()} == \
        {k: v[0] for k, v in got.items()}
    every = scores(D.detect_amount_all(txns(spark, rows), rows_per_block=rpb), ("fraud_score",))
    assert every[10] == (1,) and every[11] == (0,)


@pytest.mark.parametrize("first", [0.0, 1.0])
def test_flagged_for_ever_settles_in_few_rounds(spark, first):
    from tripwire.operators.sequence import BLK, cut_blocks
    from tripwire.operators.amount import micro_units
    rows = [(0, "u", 0, first, "VN")] + [(i, "u", 100 * i, 5.0, "VN") for i in range(1, 120)]
    tx = txns(spark, rows)
    blocks = cut_blocks(tx, rows_per_block=10)
    narrow = blocks.df.select("user_id", BLK, "seq", micro_units("amount").alias("_u"), "amount")
    entries, rounds = D.block_entries(narrow, "user_id", "seq", 3.0)
    assert entries.count() >= 12 and rounds <= 2
    assert scores(D.score_all(tx, rows_per_block=10)) == brute_scores([r.asDict() for r in tx.collect()])


def test_burst_and_null_user_are_cut(spark):
    from tripwire.operators.sequence import BLK, cut_blocks
    burst = [(0, "u", 0, 1.0, "VN")] + [(s, "u", s, 1.0, "VN") for s in range(9001, 10001)]
    for rows in (burst, [(s, None, t, a, loc) for s, _, t, a, loc in burst], [(s if s else -10**15, u, t, a, loc) for s, u, t, a, loc in burst]):
        blocks = cut_blocks(txns(spark, rows), rows_per_block=100)
        sizes = [r["count"] for r in blocks.df.groupBy(BLK).count().collect()]
        assert sum(sizes) == 1001 and max(sizes) <= 200
        got = blocks.df.orderBy("seq").select(BLK).collect()
        assert [r[BLK] for r in got] == sorted(r[BLK] for r in got)


def test_null_hot_user_scores(spark):
    import random as rnd
    g = rnd.Random(4)
    rows = [(i, None if i % 2 else "u", g.randrange(5000), g.choice([0.1, 0.2, 0.3, 1.1, 4.0]), g.choice(["VN", "US"])) for i in range(400)]
    tx = txns(spark, rows)
    exp = brute_scores([r.asDict() for r in tx.collect()])
    assert scores(D.score_all(tx, rows_per_block=20)) == exp


def test_amounts_beyond_a_long_and_none(spark):
    rows = [(0, "u", 0, 1e20, "VN"), (1, "u", 1, None, "VN"), (2, "u", 2, float("nan"), "VN"), (3, "u", 3, 3e20, "VN"), (4, "u", 4, 2e20, "VN")]
    for rpb in (None, 2):
        got = scores(D.score_all(txns(spark, rows), rows_per_block=rpb))
        assert [got[i][0] for i in range(5)] == [0, 0, 0, 1, 0]


def test_tables_of_blocks_do_not_go_to_the_driver(spark):
    """Tables with a row for each block are joined by shuffles, whatever their size; the scores are those of a whole user."""
    tx = spark.range(400).selectExpr("id AS seq", "concat('t', id) AS transaction_id", "if(id % 2 = 0, 'hot', null) AS user_id", "id * 30 AS txn_time",
                                     "double(id % 17) AS amount", "string(id % 3) AS location", "'Normal' AS transaction_type")
    out = D.score_all(tx, rows_per_block=20)
    assert out._jdf.queryExecution().analyzed().toString().count("(strategy=merge)") + out._jdf.queryExecution().optimizedPlan().toString().count("strategy=merge") >= 2
    cols = ["seq", "amount_score", "velocity_score", "location_score"]
    assert sorted(out.select(cols).collect()) == sorted(D.score_all(tx).select(cols).collect())
