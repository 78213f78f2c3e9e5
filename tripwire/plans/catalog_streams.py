"""Registered queries: plug-in detectors, amounts of any size, and the streaming operators with state of their own."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalar as S
from ..functions.parse import LABEL_THRESHOLD, parse_transactions
from ..operators import detectors as D
from ..operators import plugin as PL
from ..operators import profile as PR
from ..operators import rollup as R
from ..schema import CANONICAL, PAYLOAD, columns
from ..session import rocksdb_state, scratch_folder
from ..sources import topic
from ..sources.tables import read_table, transactions
from ..streaming import buffers as B
from ..streaming import detect as DT
from ..streaming import profiles as SPR
from ..streaming import stages as SP
from . import oracle as O

LARGE = 1e9  # units of such amounts do not fit a long
HOT_USER = "user-hot"
#: Rows of a stream for each bucket of keys that holds open rows: a task reads those of one bucket at a time.
ROWS_PER_BUCKET = 20_000


def _buckets(rows: int) -> int:
    return max(64, rows // ROWS_PER_BUCKET)



def _drain(stream, checkpoint: str) -> None:
    with rocksdb_state(SparkSession.active()):
        query = stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def _to_files(df: DataFrame, out: str, checkpoint: str) -> None:
    _drain(df.writeStream.format("parquet").option("path", out), checkpoint)


def _files(spark, schema: T.StructType, path: str, per_batch: int = 100_000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", str(per_batch)).parquet(path)


def _hot(spark, sf) -> DataFrame:
    tx = transactions(spark, sf, "events")
    return tx.withColumn("user_id", F.when(F.col("seq") % 3 == 0, F.lit(HOT_USER)).otherwise(F.col("user_id")))


def _each_drop(df: DataFrame, path: str, drops: int) -> Iterator[int]:
    """Rows in arrival order in ``drops`` writes of as many files as there are tasks; a stream drained after each has it as a micro-batch."""
    lo, hi = df.agg(F.min("seq"), F.max("seq")).first()
    step = (hi - lo) // drops + 1
    for k in range(drops):
        df.filter(F.floor((F.col("seq") - lo) / step) == k).write.mode("append").parquet(path)
        yield k


def _in_drops(df: DataFrame, path: str, drops: int) -> None:
    """All drops of ``_each_drop``, one after another."""
    for _ in _each_drop(df, path, drops):
        pass


class StreakDetector(PL.Detector):
    """1 from the third transaction in a row at one location on: a detector beside the reference's three."""

    name = "streak"

    def inputs(self):
        return {"location": F.col("location")}

    def init(self):
        return [None, 0]

    def step(self, state, rows):
        scores, (last, n) = [], state
        for x in rows["location"]:
            last, n = x, n + 1 if n and x == last else 1
            scores.append(int(n >= 3))
        return scores, [last, n]


# ------------------------------------------------------------------ detectors

def score_all_large_amounts(spark, sf):
    """D1-D4 on amounts beyond a long of micro-units, a hot user in blocks of 500 rows."""
    return D.score_all(_hot(spark, sf).withColumn("amount", F.floor("amount").cast("double") * LARGE), rows_per_block=500)


def detect_plugins(spark, sf):
    """H2: the three detectors as plug-ins, a hot user in blocks of 500 rows."""
    return PL.score_with(_hot(spark, sf), PL.standard(), rows_per_block=500)


def detect_streak(spark, sf):
    """H2: a fourth detector."""
    return PL.score_with(transactions(spark, sf, "events"), [StreakDetector()])


def stream_hot_user(spark, sf):
    """A stream with one user that has a third of the rows, over four micro-batches with restarts, states in a versioned table."""
    base = scratch_folder(spark, "stream_hot_user")
    tx = _hot(spark, sf)
    per_block = max(50, tx.count() // 100)
    for _ in chain(_each_drop(tx, f"{base}/topic", 4), [None]):  # the last run finds everything committed
        scorer = DT.TableScorer(spark, f"{base}/out", PL.standard(), rows_per_block=per_block, compact_every=2)
        _drain(_files(spark, tx.schema, f"{base}/topic").writeStream.foreachBatch(scorer), f"{base}/ck")
    return scorer.scored()


def stream_from_history(spark, sf):
    """The first half of the events scored as a table, the second as a stream that starts from its end states."""
    base = scratch_folder(spark, "stream_from_history")
    tx = transactions(spark, sf, "events")
    lo, hi = tx.agg(F.min("seq"), F.max("seq")).first()
    first, rest = tx.filter(F.col("seq") <= (lo + hi) // 2), tx.filter(F.col("seq") > (lo + hi) // 2)
    PL.score_with(first, PL.standard(), keep_state=True).write.parquet(f"{base}/first")
    done = spark.read.parquet(f"{base}/first")
    PL.last_states(done).write.parquet(f"{base}/states")
    for _ in _each_drop(rest, f"{base}/topic", 2):
        scored = DT.score_stream(_files(spark, tx.schema, f"{base}/topic"), PL.standard(), initial=spark.read.parquet(f"{base}/states"))
        _to_files(scored, f"{base}/rest", f"{base}/ck")
    return done.drop("_state", "blk").unionByName(spark.read.parquet(f"{base}/rest"))


# ------------------------------------------------------------------ windows, order

SCORED_SCHEMA = columns(
    "seq long, transaction_id string, user_id string, txn_time long, amount double, location string, transaction_type string, "
    "fraud_score int, detector string")
WINDOW_SCHEMA = columns(
    "transaction_id string, window_start long, user_id string, txn_time long, amount double, location string, transaction_type string, "
    "fraud_score int, detected boolean")


def stream_late_windows(spark, sf):
    """One-second windows of a transaction by a whole-window function; what comes after its window is kept apart.

    The records of error events are sent again once all windows are closed. Rows of kind ``window`` and ``late`` hold every record.
    """
    base = scratch_folder(spark, "stream_late_windows")
    R.scored_long(D.score_all(transactions(spark, sf, "events"))).select(*SCORED_SCHEMA.fieldNames()).write.parquet(f"{base}/scored")
    long = spark.read.schema(SCORED_SCHEMA).parquet(f"{base}/scored")
    buckets = _buckets(long.count())
    closing = long.limit(1).withColumns({"transaction_id": F.lit("closing"), "txn_time": F.lit(4_000_000_000).cast("long")})
    for n, drop in enumerate((long, closing, long.filter("location = 'error'"))):
        drop.write.mode("append").parquet(f"{base}/topic")
        out = B.window_stream(_files(spark, SCORED_SCHEMA, f"{base}/topic", 1000), ["transaction_id"], F.timestamp_seconds("txn_time"), 1,
                              "3650 days", B.sum_scores(LABEL_THRESHOLD), WINDOW_SCHEMA, buckets=buckets)
        writer = B.two_outputs(lambda df, k: df.write.mode("overwrite").parquet(f"{base}/windows/batch={k}"),
                               lambda df, k: df.write.mode("overwrite").parquet(f"{base}/late/batch={k}"))
        for _ in range(1 + (n == 1)):  # once more, so that the closing record's time closes the windows
            _drain(out.writeStream.foreachBatch(writer), f"{base}/ck")
    windows = spark.read.parquet(f"{base}/windows").filter("transaction_id != 'closing'")
    late = spark.read.parquet(f"{base}/late")
    cols = ["transaction_id", "window_start", "user_id", "amount", "location", "transaction_type", "fraud_score"]
    return (windows.withColumn("kind", F.lit("window")).select("kind", *cols, F.lit(None).cast("string").alias("detector"))
            .unionByName(late.withColumns({"kind": F.lit("late"), "window_start": F.col("txn_time")}).select("kind", *cols, "detector")))


def stream_in_order(spark, sf):
    """A user's records come through two partitions, one of which lags behind; scores are those of the arrival order.

    Arrival is counted in seconds by seq. Every micro-batch has the even records of a stretch and the odd ones of the stretch before.
    """
    base = scratch_folder(spark, "stream_in_order")
    tx = transactions(spark, sf, "events")
    lo, hi, rows = tx.agg(F.min("seq"), F.max("seq"), F.count("seq")).first()
    step = (hi - lo) // 4 + 1
    drop = F.floor((F.col("seq") - lo) / step) + F.col("seq") % 2
    closing = tx.limit(1).withColumns({"user_id": F.lit("closing"), "seq": F.lit(lo + 100 * step).cast("long")})
    schema = T.StructType([*tx.schema.fields, T.StructField("partition", T.LongType())])
    for k in range(6):
        part = tx.filter(drop == k) if k < 5 else closing
        part.withColumn("partition", F.col("seq") % 2).write.mode("append").parquet(f"{base}/topic")
        out = B.in_order(_files(spark, schema, f"{base}/topic", 1000), PL.standard(), F.timestamp_seconds("seq"), ["partition", "seq"],
                         f"{2 * step} seconds", buckets=_buckets(rows))
        writer = B.two_outputs(lambda df, b: df.write.mode("overwrite").parquet(f"{base}/out/batch={b}"),
                               lambda df, b: df.write.mode("overwrite").parquet(f"{base}/late/batch={b}"))
        for _ in range(1 + (k == 5)):
            _drain(out.writeStream.foreachBatch(writer), f"{base}/ck")
    late = spark.read.parquet(f"{base}/late").select(*CANONICAL, *(F.lit(-1).alias(f"{d.name}_score") for d in PL.standard()))
    rows = spark.read.parquet(f"{base}/out").drop("batch", "partition").filter("user_id != 'closing'")
    return rows.select(*late.columns).unionByName(late)


# ------------------------------------------------------------------ topics

PARTITIONS = 4


def _publish(spark, df: DataFrame, path: str, checkpoint: str, partitions: int = PARTITIONS) -> None:
    """A stream of (key, value) rows of a table into a folder topic."""
    df.write.parquet(f"{path}-rows")
    rows = spark.readStream.schema(df.schema).parquet(f"{path}-rows")
    _drain(rows.writeStream.format(topic.register(spark)).option("path", path).option("partitions", str(partitions)), checkpoint)


def topic_partitions(spark, sf):
    """A1, A4, A5: events published by user to a topic of four partitions and read by a stream: rows, offsets and users of each partition."""
    base = scratch_folder(spark, "topic_partitions")
    tx = transactions(spark, sf, "events")
    _publish(spark, SP.as_records(tx, CANONICAL[1:]).select("key", "value"), f"{base}/topic", f"{base}/ck1")
    records = SP.read_topic(spark, f"{base}/topic", fmt="log", partitions=PARTITIONS)
    _to_files(parse_transactions(records, keep=["partition", "seq"]), f"{base}/parsed", f"{base}/ck2")
    return spark.read.parquet(f"{base}/parsed").groupBy("partition").agg(
        F.count(F.lit(1)).alias("n"), F.min("seq").alias("first_offset"), F.max("seq").alias("last_offset"),
        F.countDistinct("seq").alias("offsets"), F.countDistinct("user_id").alias("users"),
        F.sum(F.col("amount").cast("decimal(38,2)")).cast("double").alias("amount"))


def source_latest(spark, sf):
    """A3: final records in two drops; a reader that starts at the latest offset between them sees the second alone."""
    base = scratch_folder(spark, "source_latest")
    rows = R.total_score(D.score_all(transactions(spark, sf, "events")))
    records = SP.as_records(rows, [*CANONICAL[1:], "fraud_score"])
    at = rows.agg(F.expr("(min(seq) + max(seq)) div 2")).first()[0]
    for k, part in enumerate((records.filter(F.col("seq") <= at), records.filter(F.col("seq") > at))):
        _publish(spark, part.select("key", "value"), f"{base}/topic", f"{base}/ck-{k}") if k == 0 else _append(spark, part, base)
        final = SP.parse_final(SP.read_topic(spark, f"{base}/topic", fmt="log", partitions=PARTITIONS, starting="latest"))
        _to_files(final, f"{base}/parsed", f"{base}/ck")
    return spark.read.schema(final.schema).parquet(f"{base}/parsed").select(*PAYLOAD, "fraud_score")


def _append(spark, part: DataFrame, base: str) -> None:
    """The second drop of the same publishing query."""
    part.select("key", "value").write.mode("append").parquet(f"{base}/topic-rows")
    rows = spark.readStream.schema("key string, value string").parquet(f"{base}/topic-rows")
    _drain(rows.writeStream.format(topic.NAME).option("path", f"{base}/topic").option("partitions", str(PARTITIONS)), f"{base}/ck-0")


# ------------------------------------------------------------------ profiles

def profile_running_gaps(spark, sf):
    """error events without an amount, and some amounts that no total can hold."""
    tx = transactions(spark, sf, "events")
    amount = F.when(F.col("location") == "error", F.lit(None)).when(F.col("seq") % 11 == 0, F.lit(1e33)).otherwise(F.col("amount"))
    return PR.profile_running(tx.withColumn("amount", amount)).drop("amount")


def stream_running_profile(spark, sf):
    """F2 on a stream of orders, over four micro-batches."""
    base = scratch_folder(spark, "stream_running_profile")
    tx = transactions(spark, sf, "orders")
    for _ in _each_drop(tx, f"{base}/topic", 4):
        _to_files(SPR.running_profile_stream(_files(spark, tx.schema, f"{base}/topic")), f"{base}/out", f"{base}/ck")
    return spark.read.parquet(f"{base}/out")


def stream_lookup(spark, sf):
    """F4 on a stream: customers joined with the profiles that a stream of orders keeps; customers without orders have nulls."""
    base = scratch_folder(spark, "stream_lookup")
    tx = transactions(spark, sf, "orders")
    for _ in _each_drop(tx, f"{base}/topic", 3):
        _drain(_files(spark, tx.schema, f"{base}/topic").writeStream.foreachBatch(SPR.profile_delta_writer(f"{base}/profiles", compact_every=1)), f"{base}/ck1")
    ids = read_table(spark, sf, "customer").select(F.concat(F.lit("user-"), F.col("c_custkey").cast("string")).alias("user_id"))
    ids.repartition(2).write.parquet(f"{base}/ids")
    writer = SPR.lookup_writer(f"{base}/profiles", lambda df, k: df.write.mode("overwrite").parquet(f"{base}/out/batch={k}"))
    _drain(_files(spark, ids.schema, f"{base}/ids", 1).writeStream.foreachBatch(writer), f"{base}/ck2")
    return spark.read.parquet(f"{base}/out").drop("batch", "profile_version")


def stream_user_sketch(spark, sf):
    """distinct users of a stream of orders by mergeable registers, over three micro-batches."""
    base = scratch_folder(spark, "stream_user_sketch")
    tx = transactions(spark, sf, "orders")
    for _ in _each_drop(tx, f"{base}/topic", 3):
        _drain(_files(spark, tx.schema, f"{base}/topic").writeStream.foreachBatch(SPR.user_sketch_writer(f"{base}/sketch", compact_every=1)), f"{base}/ck")
    return SPR.sketch_estimate(SPR.read_user_sketch(spark, f"{base}/sketch"))


def round3_small(spark, sf):
    """Values with many binary ties at the third decimal, small ones and negative ones."""
    tx = transactions(spark, sf, "events")
    return tx.select("seq", S.round3(F.col("seq") / 16.0).alias("ties"), S.round3(-F.col("seq") / 2048.0).alias("negative"),
                     S.round3(F.col("amount") / 100_000.0).alias("small"), S.round3(F.col("amount") * 1e11).alias("large"))


QUERIES = {f.__name__: f for f in (
    score_all_large_amounts, detect_plugins, detect_streak, stream_hot_user, stream_from_history, stream_late_windows, stream_in_order,
    topic_partitions, source_latest, profile_running_gaps, stream_running_profile, stream_lookup, stream_user_sketch, round3_small)}


def oracles(running_sql, profile_sql) -> dict[str, str]:
    ev, orders = O.EVENTS_TXN, O.ORDERS_TXN
    hot = f"""SELECT seq, transaction_id, CASE WHEN seq % 3 = 0 THEN '{HOT_USER}' ELSE user_id END AS user_id,
       txn_time, amount, location, transaction_type FROM ({ev})"""
    third = lambda x: f"CAST(format('{{:.3f}}', {x}) AS DOUBLE)"
    return {
        "score_all_large_amounts": O.score_all_sql(
            source=f"SELECT * REPLACE (floor(amount) * 1e9 AS amount) FROM ({hot})").replace(
                O.UNITS, "CAST(amount / 1e9 AS HUGEINT) * 1000000000000000"),
        "detect_plugins": O.score_all_sql(source=hot),
        "detect_streak": f"""WITH t AS ({ev})
SELECT *, CAST(coalesce(row_number() OVER w >= 3 AND location IS NOT DISTINCT FROM lag(location) OVER w
                        AND location IS NOT DISTINCT FROM lag(location, 2) OVER w, false) AS INTEGER) AS streak_score
  FROM t WINDOW w AS (PARTITION BY user_id ORDER BY seq)""",
        "stream_hot_user": O.score_all_sql(source=hot),
        "stream_from_history": O.score_all_sql(),
        "stream_in_order": O.score_all_sql(),
        "stream_late_windows": f"""WITH {O.scores_ctes('events')}, l AS (
{O.scored_long_body()}),
fin AS ({O._rollup_select('(SELECT *, txn_time AS window_start FROM l)', keys='transaction_id, window_start')})
SELECT 'window' AS kind, transaction_id, window_start, user_id, amount, location, transaction_type, fraud_score, NULL AS detector FROM fin
UNION ALL
SELECT 'late', transaction_id, txn_time, user_id, amount, location, transaction_type, fraud_score, detector FROM l WHERE location = 'error'""",
        "topic_partitions": f"""WITH t AS ({ev}),
p AS (SELECT *, CAST(('0x' || substr(md5(user_id), 1, 8)) AS BIGINT) % {PARTITIONS} AS partition FROM t)
SELECT CAST(partition AS INTEGER) AS partition, count(*) AS n, CAST(0 AS BIGINT) AS first_offset, count(*) - 1 AS last_offset,
       count(*) AS offsets, count(DISTINCT user_id) AS users, CAST(sum(CAST(amount AS DECIMAL(38,2))) AS DOUBLE) AS amount
  FROM p GROUP BY partition""",
        "source_latest": f"""WITH {O.scores_ctes()}
SELECT transaction_id, user_id, txn_time, amount, location,
       CASE WHEN amount_score + velocity_score + location_score >= 2 THEN 'Fraud' ELSE transaction_type END AS transaction_type,
       CAST(amount_score + velocity_score + location_score AS INTEGER) AS fraud_score
  FROM s WHERE seq > (SELECT (min(seq) + max(seq)) // 2 FROM s)""",
        "profile_running_gaps": running_sql(f"""SELECT * REPLACE (
       CASE WHEN location = 'error' OR seq % 11 = 0 THEN NULL ELSE amount END AS amount) FROM ({ev})""").replace(
           "SELECT * FROM p", "SELECT * EXCLUDE (amount) FROM p"),
        "stream_running_profile": running_sql(orders),
        "stream_lookup": f"""WITH p AS ({profile_sql(orders)})
SELECT c.user_id, p.* EXCLUDE (user_id)
  FROM (SELECT 'user-' || CAST(c_custkey AS VARCHAR) AS user_id FROM customer) c LEFT JOIN p USING (user_id)""",
        "stream_user_sketch": f"""WITH t AS (SELECT DISTINCT md5(user_id) AS h FROM ({orders})),
b AS (SELECT CAST(('0x' || substr(h, 1, 4)) AS BIGINT) // 4 AS bucket, CAST(('0x' || substr(h, 5, 8)) AS BIGINT) AS bits FROM t),
r AS (SELECT bucket, max(CASE WHEN bits = 0 THEN 33 ELSE 32 - CAST(floor(log2(bits)) AS INT) END) AS rank FROM b GROUP BY bucket),
s AS (SELECT 16384 - count(*) AS empty, sum(pow(2, -rank)) AS z FROM r),
e AS (SELECT empty, {0.7213 / (1 + 1.079 / 16384) * 16384 * 16384} / (z + empty) AS raw FROM s)
SELECT CAST(round(CASE WHEN raw <= 40960 AND empty > 0 THEN 16384 * ln(16384 / empty) ELSE raw END) AS BIGINT) AS user_count FROM e""",
        "round3_small": f"""WITH t AS ({ev})
SELECT seq, {third("seq / 16.0::DOUBLE")} AS ties, {third("-seq / 2048.0::DOUBLE")} AS negative,
       {third("amount / 100000.0::DOUBLE")} AS small, {third("amount * 1e11::DOUBLE")} AS large FROM t""",
    }
