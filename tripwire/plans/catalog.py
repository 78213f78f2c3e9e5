"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the given tables (events and orders stand in for the
transaction topic, see README) over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parse as P
from ..functions import scalar as S
from ..operators import detectors as D
from ..operators import inject as I
from ..operators import profile as PR
from ..operators import rollup as R
from ..operators.sequence import hot_keys
from ..schema import CANONICAL
from ..session import scratch_folder
from ..sources.tables import TRANSACTION_TABLES, read_table, transactions
from ..streaming import profiles as SPR
from ..streaming import stages as SP
from . import oracle as O
from . import oracle_inject as OI

Query = Callable[[SparkSession, str], DataFrame]


def _ev(spark: SparkSession, sf: str) -> DataFrame:
    return transactions(spark, sf, "events")


def _or(spark: SparkSession, sf: str) -> DataFrame:
    return transactions(spark, sf, "orders")


def transactions_with(spark: SparkSession, sf: str, table: str, extra: tuple[str, ...]) -> DataFrame:
    return TRANSACTION_TABLES[table](spark, sf, extra)


# ----------------------------------------------------------- sources / parsing

def publish_transactions(spark, sf):
    """A5: transactions as (key, value) records for the topic, keyed by user."""
    tx = _ev(spark, sf)
    return tx.select("seq", F.col("user_id").alias("key"),
                     F.to_json(F.struct(*CANONICAL[1:]), {"ignoreNullFields": "false"}).alias("value"))


def parse_json(spark, sf):
    """A1/B1: the published JSON read back into typed columns (FAILFAST)."""
    pub = publish_transactions(spark, sf)
    return P.parse_transactions(pub, keep=["seq"]).select(*CANONICAL)


def parse_coerce(spark, sf):
    """Numbers sent as quoted strings still parse."""
    tx = _ev(spark, sf)
    quoted = tx.select("seq", F.to_json(F.struct(
        "transaction_id", "user_id", F.col("txn_time").cast("string").alias("txn_time"),
        F.col("amount").cast("string").alias("amount"), "location", "transaction_type")).alias("value"))
    return P.parse_transactions(quoted, keep=["seq"]).select(*CANONICAL)


def to_json_roundtrip(spark, sf):
    """B2: serialise with null fields kept, parse back (orders; status P has no location)."""
    tx = transactions_with(spark, sf, "orders", ("o_orderstatus",))
    tx = tx.withColumn("location", F.when(F.col("o_orderstatus") != "P", F.col("location")))
    raw = tx.select("seq", F.to_json(F.struct(*CANONICAL[1:]), {"ignoreNullFields": "false"}).alias("value"))
    return P.parse_transactions(raw, keep=["seq"]).select(*CANONICAL)


def filter_null(spark, sf):
    """PERMISSIVE parse, unreadable records (error events sent as '{bad') dropped."""
    tx = _ev(spark, sf)
    raw = tx.select("seq", F.when(F.col("location") == "error", F.lit("{bad")).otherwise(
        F.to_json(F.struct(*CANONICAL[1:]))).alias("value"))
    parsed = P.parse_transactions(raw, mode="PERMISSIVE", keep=["seq"])
    return P.filter_null(parsed).select(*CANONICAL)


def parse_rejects(spark, sf):
    """What a PERMISSIVE parse rejects (broken text, an amount or time that is no number) and a whole number above 2^53 that it keeps exactly."""
    tx = _ev(spark, sf)
    n, good = F.pmod("seq", F.lit(7)), F.to_json(F.struct(*CANONICAL[1:]))
    fields = ["transaction_id", "user_id", "location", "transaction_type"]
    raw = tx.select("seq", F.when(n == 1, F.lit("{bad")).when(
        n == 2, F.to_json(F.struct(*fields, "txn_time", F.lit("abc").alias("amount")))).when(
        n == 3, F.to_json(F.struct(*fields, "amount", F.lit("12.5").alias("txn_time")))).when(
        n == 4, F.to_json(F.struct(*fields, "amount", (F.col("txn_time") + (1 << 53)).alias("txn_time")))).otherwise(good).alias("value"))
    parsed = P.parse_transactions(raw, mode="PERMISSIVE", keep=["seq"])
    kind = F.when(F.col("_corrupt") == "{bad", "text").when(F.col("txn_time").isNull(), "time").otherwise("amount")
    return (P.rejects(parsed).select("seq", kind.alias("kind"), "txn_time")
            .unionByName(parsed.filter("_corrupt is null and txn_time > 9007199254740992").select("seq", F.lit("kept").alias("kind"), "txn_time")))


def final_rejects(spark, sf):
    """A PERMISSIVE parse, then the rows whose amount the final table can't hold."""
    tx = _ev(spark, sf).withColumn("amount", F.when(F.pmod("seq", F.lit(5)) == 0, F.col("amount") + 1e7).otherwise(F.col("amount")))
    parsed = P.filter_null(P.parse_transactions(SP.as_records(tx, CANONICAL[1:]), mode="PERMISSIVE", keep=["seq"]))
    return P.final_rejects(parsed).select("seq", "amount")


def unknown_fields(spark, sf):
    """B1, B2: fields the schema does not know go through parse and serialise."""
    tx = transactions_with(spark, sf, "events", ("props",))
    raw = tx.select("seq", F.to_json(F.struct(*CANONICAL[1:], F.struct("props").alias("more"))).alias("value"))
    parsed = P.parse_transactions(raw, keep=["seq"], extras=True)
    return parsed.select("seq", F.get_json_object(P.as_json(CANONICAL[1:], "extras"), "$.more.props").alias("props"))


def add_time(spark, sf):
    """A time moved by 30 seconds and by 1500 milliseconds."""
    ts = F.timestamp_seconds("txn_time")
    return _ev(spark, sf).select("seq", F.unix_millis(S.add_seconds(ts, F.lit(30))).alias("plus_seconds"),
                                 F.unix_millis(S.add_millis(ts, F.lit(1500))).alias("plus_millis"))


def flatten_transaction(spark, sf):
    """Nested (timestamp, location struct) to the wire form."""
    ev = read_table(spark, sf, "events")
    nested = ev.select(
        F.concat(F.lit("txn-"), F.col("event_id").cast("string")).alias("transaction_id"),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("user_id"),
        F.col("value").alias("amount"), S.ntz_as_utc("ts").alias("timestamp"),
        F.struct(F.col("event_type").alias("country")).alias("location"),
        F.lit("Normal").alias("transaction_type"))
    return P.flatten_transaction(nested)


def quality_rules(spark, sf):
    """Violations per rule over both transaction tables."""
    both = _ev(spark, sf).unionByName(_or(spark, sf))
    return P.quality_counts(both)


def sampled_offsets(spark, sf):
    """Every 10th offset of the published records."""
    return publish_transactions(spark, sf).filter(F.col("seq") % 10 == 0)


def final_count(spark, sf):
    """Rows in the final table."""
    return R.score_and_label(_ev(spark, sf)).agg(F.count(F.lit(1)).alias("n"))


# -------------------------------------------------------------------- scalars

def round3(spark, sf):
    """A third of each amount, rounded to 3 decimals."""
    return _ev(spark, sf).select("seq", S.round3(F.col("amount") / 3).alias("amount_third"))


def location_ci(spark, sf):
    """Each row's location against its user's main location."""
    tx = _ev(spark, sf)
    prof = PR.user_profile(tx).select(F.col("user_id").alias("_u"), "main_location")
    j = tx.join(prof, F.col("user_id").eqNullSafe(F.col("_u")), "left")
    return j.select("seq", "location", "main_location",
                    S.location_eq_ci("location", F.upper("main_location")).alias("same_ci"),
                    S.location_differs("location", F.upper("main_location")).alias("differs_cs"))


def seconds_of_day_gap(spark, sf):
    """`.seconds` of the gap to the user's previous order (orders: gaps go negative)."""
    run = PR.profile_running(_or(spark, sf))
    cur = F.timestamp_seconds("txn_time")
    prev = F.timestamp_seconds("last_txn_time_before")
    return run.select("seq", S.seconds_of_day_gap(cur, prev).alias("gap_seconds"))


def surrogate_id(spark, sf):
    """Prefixed ids with a repeatable suffix."""
    return _ev(spark, sf).select("seq", S.surrogate_id("txn-", F.col("seq")).alias("surrogate_id"))


# ------------------------------------------------------------------ detectors

def detect_amount(spark, sf):
    return D.detect_amount(_ev(spark, sf))


def detect_amount_orders(spark, sf):
    return D.detect_amount(_or(spark, sf))


def detect_velocity(spark, sf):
    return D.detect_velocity(_ev(spark, sf))


def detect_velocity_wide(spark, sf):
    return D.detect_velocity(_ev(spark, sf), max_gap=300)


def detect_velocity_orders(spark, sf):
    return D.detect_velocity(_or(spark, sf))


def detect_location(spark, sf):
    return D.detect_location(_ev(spark, sf))


def detect_location_prev(spark, sf):
    return D.detect_location_prev(_ev(spark, sf))


def detect_amount_all(spark, sf):
    return D.detect_amount_all(_ev(spark, sf))


def score_all(spark, sf):
    return D.score_all(_ev(spark, sf))


def score_all_orders(spark, sf):
    return D.score_all(_or(spark, sf))


HOT_USER = "user-hot"  # a third of the events re-keyed to one user (the skew to design for)


def _ev_hot(spark, sf):
    tx = _ev(spark, sf)
    return tx.withColumn("user_id", F.when(F.col("seq") % 3 == 0, F.lit(HOT_USER)).otherwise(F.col("user_id")))


def score_all_hot_user(spark, sf):
    """D1-D4 with one user holding a third of all rows, cut into blocks of 500 rows:
    the carries and the amount fold's fixed point against the sequential oracle."""
    return D.score_all(_ev_hot(spark, sf), rows_per_block=500)


def score_all_burst_user(spark, sf):
    """D1-D4 with a third of the rows on one user whose first row lies far before a burst, and a null user with as many."""
    tx = _ev(spark, sf)
    n = F.pmod("seq", F.lit(3))
    user = F.when(n == 0, F.lit(HOT_USER)).when(n == 1, F.lit(None)).otherwise(F.col("user_id"))
    first = F.col("seq") < 3
    return D.score_all(tx.withColumn("user_id", user).withColumn("seq", F.when(first, F.col("seq") - 10**12).otherwise(F.col("seq"))), rows_per_block=400)


def score_all_zero_start(spark, sf):
    """D1-D4 with a hot user whose first amounts are 0, so that all later ones are flagged."""
    tx = _ev_hot(spark, sf)
    return D.score_all(tx.withColumn("amount", F.when((F.col("user_id") == HOT_USER) & (F.col("seq") < 6), 0.0).otherwise(F.col("amount"))), rows_per_block=500)


# --------------------------------------------------------------------- roll-up

def scored_long(spark, sf):
    return R.scored_long(D.score_all(_ev(spark, sf)))


def final_scores(spark, sf):
    return R.final_scores(R.scored_long(D.score_all(_ev(spark, sf))))


def _redelivered(spark, sf):
    """The scored topic with the records of error events delivered twice (one pass, no self-union)."""
    long = R.scored_long(D.score_all(_ev(spark, sf)))
    copies = F.when(F.col("location") == "error", 2).otherwise(1)
    return long.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")


def final_scores_redelivered(spark, sf):
    return R.final_scores(_redelivered(spark, sf))


def final_scores_dedup(spark, sf):
    return R.final_scores(_redelivered(spark, sf), dedup=True)


def final_scores_tumbling(spark, sf):
    """Error events are delivered again a second later, so their transactions fall in two windows."""
    long = R.scored_long(D.score_all(_ev(spark, sf)))
    copies = F.when(F.col("location") == "error", 1).otherwise(0)
    late = long.withColumn("_late", F.explode(F.sequence(F.lit(0), copies)))
    return R.final_scores_tumbling(late.withColumn("txn_time", F.col("txn_time") + F.col("_late")).drop("_late"), seconds=1)


def final_scores_session(spark, sf):
    """Sessions of a user, up to an hour between transactions."""
    return R.final_scores_session(R.scored_long(D.score_all(_ev(spark, sf))), gap_seconds=3600, key="user_id")


def end_to_end(spark, sf):
    return R.score_and_label(_ev(spark, sf))


def end_to_end_orders(spark, sf):
    return R.score_and_label(_or(spark, sf))


# -------------------------------------------------------------------- profiles

def user_profile(spark, sf):
    return PR.user_profile(_ev(spark, sf))


def profile_running(spark, sf):
    return PR.profile_running(_ev(spark, sf))


def profile_upsert(spark, sf):
    run = PR.profile_running(_or(spark, sf)).select(
        "seq", "user_id", "txn_count", "total_amt", "average_amt", "main_location",
        F.col("txn_time").alias("last_txn_time"), F.col("location").alias("last_location"))
    return PR.profile_upsert(run)


def user_count(spark, sf):
    return PR.user_count(_or(spark, sf))


def profile_lookup(spark, sf):
    ids = read_table(spark, sf, "customer").select(
        F.concat(F.lit("user-"), F.col("c_custkey").cast("string")).alias("user_id"))
    return PR.profile_lookup(ids, PR.user_profile(_or(spark, sf)))


def first_transactions(spark, sf):
    return PR.first_transactions(_ev(spark, sf))


def sample_users(spark, sf):
    return PR.sample_users(PR.user_profile(_ev(spark, sf)), 25)


# ------------------------------------------------------------------ injection

def inject_pick_rows(spark, sf):
    return I.pick_rows(_ev(spark, sf))


def inject_pick_types(spark, sf):
    return I.pick_types(I.pick_rows(_ev(spark, sf)).select("seq"))


def inject_high_amount(spark, sf):
    return I.apply_behaviour(_ev(spark, sf), I.HIGH_VALUE)


def inject_location(spark, sf):
    return I.apply_behaviour(_ev(spark, sf), I.PROXIMITY)


def inject_close_time(spark, sf):
    return I.apply_behaviour(_ev(spark, sf), I.TIME)


def inject_all(spark, sf):
    return I.inject_all(_ev(spark, sf))


def inject_backtest(spark, sf):
    """Detectors run on injected rows: per fraud-type list, how many were detected."""
    tx = _ev(spark, sf)
    hot = hot_keys(tx)  # the users stay the same, so they are counted once
    j = R.total_score(D.score_all(I.inject_all(tx, hot=hot), hot=hot))  # fraud_types rides along through the detectors
    return j.groupBy(F.coalesce("fraud_types", F.lit("none")).alias("fraud_types")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("detected"), 1)).alias("n_detected"),
        F.sum("fraud_score").cast("long").alias("score_sum"))


# ------------------------------------------------------------------ streaming

def stream_end_to_end(spark, sf, chunks: int = 2):
    """A1, A4, A11, E8 as a stream: the events published as topic files in `chunks`
    arrival-ordered drops; after each drop the stateful detector query restarts
    from its checkpoint and appends final rows; the sink is read back."""
    base = scratch_folder(spark, "stream_end_to_end")
    topic, out, ckpt = f"{base}/topic", f"{base}/final", f"{base}/checkpoint"
    tx = _ev(spark, sf)
    lo, hi = tx.agg(F.min("seq"), F.max("seq")).first()
    step = (hi - lo) // chunks + 1
    recs = SP.as_records(tx, CANONICAL[1:])
    for i in range(chunks):
        part = recs.filter((F.col("seq") >= lo + i * step) & (F.col("seq") < lo + (i + 1) * step))
        part.write.mode("append").json(topic)
        final = SP.final_stream(SP.detector_stream(SP.read_topic(spark, topic)))
        q = (final.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
             .trigger(availableNow=True).start())
        q.awaitTermination()
    return spark.read.parquet(out)


def _drain(df: DataFrame, out: str, checkpoint: str, mode: str = "append") -> None:
    """Run a stream over what its source holds now and write its rows."""
    (df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode(mode)
     .trigger(availableNow=True).start().awaitTermination())


def source_transactions(spark, sf):
    """A1: the transaction topic (events published as JSON-lines records) read by a
    stream (available-now trigger) and parsed; the stream's sink is read back."""
    base = scratch_folder(spark, "source_transactions")
    SP.as_records(_ev(spark, sf), CANONICAL[1:]).write.json(f"{base}/topic")
    _drain(P.parse_transactions(SP.read_topic(spark, f"{base}/topic"), keep=["seq"]).select(*CANONICAL), f"{base}/parsed", f"{base}/ck")
    return spark.read.parquet(f"{base}/parsed")


def sink_scored_json(spark, sf):
    """A4: the scored records written to the scored topic by the streaming writer, keyed by user, and read back."""
    base = scratch_folder(spark, "sink_scored_json")
    SP.as_records(_ev(spark, sf), CANONICAL[1:]).write.json(f"{base}/txn")
    scored = SP.scored_records(SP.detector_stream(SP.read_topic(spark, f"{base}/txn", max_files_per_trigger=10_000)))
    SP.write_topic(scored, f"{base}/scored", f"{base}/ck").awaitTermination()
    return SP.parse_scored(spark.read.schema(SP.FILE_RECORD).json(f"{base}/scored")).drop("extras")


def source_scored(spark, sf):
    """A2: the scored topic read by a stream and parsed."""
    base = scratch_folder(spark, "source_scored")
    SP.scored_records(D.score_all(_ev(spark, sf))).write.json(f"{base}/topic")
    _drain(SP.parse_scored(SP.read_topic(spark, f"{base}/topic")), f"{base}/parsed", f"{base}/ck")
    return spark.read.parquet(f"{base}/parsed").drop("extras")


def source_final(spark, sf):
    """Final records as bytes, read by a stream, decoded and parsed to table columns."""
    base = scratch_folder(spark, "source_final")
    rows = R.total_score(D.score_all(_ev(spark, sf)))
    SP.as_records(rows, [*CANONICAL[1:], "fraud_score"]).select("seq", F.encode("value", "UTF-8").alias("value")).write.parquet(f"{base}/topic")
    raw = spark.readStream.schema("seq long, value binary").parquet(f"{base}/topic")
    _drain(SP.parse_final(raw.select("seq", P.decode_utf8("value").alias("value"))), f"{base}/parsed", f"{base}/ck")
    return P.final_projection(spark.read.parquet(f"{base}/parsed"))


def processing_windows(spark, sf):
    """Which one-second window of arrival a record falls in is not repeatable; the sum over a transaction's windows is."""
    base = scratch_folder(spark, "processing_windows")
    SP.scored_records(D.score_all(_ev(spark, sf))).write.json(f"{base}/topic")
    rolled = SP.rollup_stream(SP.parse_scored(SP.read_topic(spark, f"{base}/topic")), window="processing")
    (rolled.writeStream.outputMode("complete").foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(f"{base}/out"))
     .option("checkpointLocation", f"{base}/ck").trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(f"{base}/out").groupBy("transaction_id").agg(F.sum("fraud_score").alias("fraud_score"))


SCORED_FIELDS = [*CANONICAL[1:], "fraud_score", "detector"]


def _closing(long: DataFrame) -> DataFrame:
    """A record so late in event time that it closes all windows."""
    return long.limit(1).withColumn("transaction_id", F.lit("closing")).withColumn("txn_time", F.lit(4_000_000_000).cast("long"))


def _kept(df: DataFrame, path: str) -> DataFrame:
    """``df`` written under the shared folder and read again, for rows that are used more than once."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stream_rollup_orders(spark, sf):
    """Orders, half of which come out of time order, rolled up in one-second windows over several micro-batches.

    The watermark allows for the ten years that the orders span, so none is late.
    """
    base = scratch_folder(spark, "stream_rollup_orders")
    long = _kept(R.scored_long(D.score_all(_or(spark, sf))), f"{base}/scored")
    files = 4 * max(1, spark.sparkContext.defaultParallelism)
    SP.as_records(long, SCORED_FIELDS).repartitionByRange(files, "seq").write.json(f"{base}/topic")
    SP.as_records(_closing(long), SCORED_FIELDS).write.mode("append").json(f"{base}/topic")
    scored = SP.parse_scored(SP.read_topic(spark, f"{base}/topic", max_files_per_trigger=files // 2))
    rolled = SP.rollup_stream(scored, window="tumbling", watermark="3650 days")
    for _ in range(2):  # the second run closes what the last record's time allows
        _drain(rolled, f"{base}/out", f"{base}/ck")
    return spark.read.parquet(f"{base}/out").filter("transaction_id != 'closing'").drop("extras")


def stream_dedup(spark, sf):
    """Redeliveries, in other micro-batches than their first delivery, counted once."""
    base = scratch_folder(spark, "stream_dedup")
    long = _kept(R.scored_long(D.score_all(_ev(spark, sf))), f"{base}/scored")
    for drop in (long, long.filter("location = 'error'"), _closing(long)):
        SP.as_records(drop, SCORED_FIELDS).write.mode("append").json(f"{base}/topic")
        scored = SP.parse_scored(SP.read_topic(spark, f"{base}/topic", max_files_per_trigger=10_000))  # a drop is a micro-batch
        rolled = SP.rollup_stream(scored, window="tumbling", watermark="3650 days", dedup=True)
        _drain(rolled, f"{base}/out", f"{base}/ck")
    _drain(rolled, f"{base}/out", f"{base}/ck")  # closes what the last record's time allows
    return spark.read.parquet(f"{base}/out").filter("transaction_id != 'closing'").drop("extras", "window_start")


def stream_profiles(spark, sf):
    """Profiles of the orders kept by a stream in several micro-batches, compacted on the way."""
    base = scratch_folder(spark, "stream_profiles")
    SP.as_records(_or(spark, sf), CANONICAL[1:]).repartitionByRange(5, "seq").write.json(f"{base}/topic")
    parsed = P.parse_transactions(SP.read_topic(spark, f"{base}/topic", max_files_per_trigger=1), keep=["seq"])
    (parsed.writeStream.foreachBatch(SPR.profile_delta_writer(f"{base}/profiles", compact_every=2)).option("checkpointLocation", f"{base}/ck")
     .trigger(availableNow=True).start().awaitTermination())
    return SPR.read_profiles(spark, f"{base}/profiles")


def final_projection(spark, sf):
    """Rolled-up final records projected to the 7 table columns (the loader's rows)."""
    return P.final_projection(R.final_scores(R.scored_long(D.score_all(_ev(spark, sf)))))


QUERIES: dict[str, Query] = {
    f.__name__: f for f in [
        publish_transactions, parse_json, parse_coerce, to_json_roundtrip, filter_null, parse_rejects,
        flatten_transaction, quality_rules, sampled_offsets, final_count,
        round3, location_ci, seconds_of_day_gap, surrogate_id,
        detect_amount, detect_amount_orders, detect_velocity, detect_velocity_wide, detect_velocity_orders,
        detect_location, detect_location_prev, detect_amount_all, score_all, score_all_orders,
        scored_long, final_scores, final_scores_redelivered, final_scores_dedup, final_scores_tumbling,
        final_scores_session, end_to_end, end_to_end_orders,
        user_profile, profile_running, profile_upsert, user_count, profile_lookup, first_transactions,
        sample_users,
        inject_pick_rows, inject_pick_types, inject_high_amount,
        inject_location, inject_close_time, inject_all, inject_backtest,
        stream_end_to_end, source_transactions, sink_scored_json, final_projection, score_all_hot_user,
        score_all_burst_user, score_all_zero_start, final_rejects, unknown_fields, add_time, source_scored, source_final,
        processing_windows, stream_rollup_orders, stream_dedup, stream_profiles,
    ]
}


# ------------------------------------------------------------------ oracles

_EV, _OR = O.EVENTS_TXN, O.ORDERS_TXN
_JSON_OBJ = ("json_object('transaction_id', transaction_id, 'user_id', user_id, 'txn_time', txn_time, "
             "'amount', amount, 'location', location, 'transaction_type', transaction_type)::VARCHAR")


def _avg_sql(total: str, count: str) -> str:
    """Exact total/count rounded half up to 3 places (integer arithmetic on micro-units)."""
    micro = f"CAST(({total}) * 1000000 AS HUGEINT)"
    return (f"CAST(sign({micro}) * ((2 * abs({micro}) + ({count}) * 1000) // (2 * ({count}) * 1000)) AS DOUBLE)"
            " / 1000")


def _profile_sql(src: str) -> str:
    return f"""WITH t AS ({src})
SELECT user_id, count(*) AS txn_count, sum(CAST(amount AS DECIMAL(38,6))) AS total_amt,
       {_avg_sql("sum(CAST(amount AS DECIMAL(38,6)))", "count(amount)")} AS average_amt,
       arg_min(txn_time, seq) AS first_txn_time, arg_min(location, seq) AS main_location,
       arg_max(txn_time, seq) AS last_txn_time, arg_max(location, seq) AS last_location
  FROM t GROUP BY user_id"""


def _running_sql(src: str) -> str:
    return f"""WITH t AS ({src}),
a AS (
  SELECT seq, user_id, transaction_id, txn_time, amount, location, transaction_type,
         count(*) OVER u AS txn_count,
         CAST(coalesce(sum(CAST(amount AS DECIMAL(38,6))) OVER u, 0) AS DECIMAL(38,6)) AS total_amt,
         first_value(location) OVER u AS main_location,
         lag(txn_time) OVER (PARTITION BY user_id ORDER BY seq) AS last_txn_time_before,
         lag(location) OVER (PARTITION BY user_id ORDER BY seq) AS last_location_before,
         nullif(count(amount) OVER u, 0) AS n, nullif(count(amount) OVER b, 0) AS nb,
         CAST(coalesce(sum(CAST(amount AS DECIMAL(38,6))) OVER b, 0) AS DECIMAL(38,6)) AS tb
    FROM t
  WINDOW u AS (PARTITION BY user_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         b AS (PARTITION BY user_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
p AS (
  SELECT * EXCLUDE (n, nb, tb), {_avg_sql("total_amt", "n")} AS average_amt,
         CASE WHEN txn_count > 1 THEN txn_count - 1 END AS txn_count_before,
         CASE WHEN txn_count > 1 THEN tb END AS total_amt_before,
         CASE WHEN txn_count > 1 THEN {_avg_sql("tb", "nb")} END AS average_amt_before
    FROM a)
SELECT * FROM p"""


ORACLE: dict[str, str] = {
    "publish_transactions": f"WITH t AS ({_EV}) SELECT seq, user_id AS key, {_JSON_OBJ} AS value FROM t",
    "parse_json": f"{_EV}",
    "parse_coerce": f"{_EV}",
    "to_json_roundtrip": f"""WITH t AS ({_OR})
SELECT t.seq, t.transaction_id, t.user_id, t.txn_time, t.amount,
       CASE WHEN o.o_orderstatus <> 'P' THEN t.location END AS location, t.transaction_type
  FROM t JOIN orders o ON o.o_orderkey = t.seq""",
    "filter_null": f"WITH t AS ({_EV}) SELECT * FROM t WHERE location <> 'error'",
    "parse_rejects": f"""WITH t AS ({_EV})
SELECT seq, CASE seq % 7 WHEN 1 THEN 'text' WHEN 2 THEN 'amount' WHEN 3 THEN 'time' ELSE 'kept' END AS kind,
       CASE seq % 7 WHEN 2 THEN txn_time WHEN 4 THEN txn_time + 9007199254740992 END AS txn_time
  FROM t WHERE seq % 7 IN (1, 2, 3, 4)""",
    "final_rejects": f"WITH t AS ({_EV}) SELECT seq, amount + 1e7 AS amount FROM t WHERE seq % 5 = 0",
    "unknown_fields": "SELECT event_id AS seq, props FROM events",
    "add_time": f"WITH t AS ({_EV}) SELECT seq, txn_time * 1000 + 30000 AS plus_seconds, txn_time * 1000 + 1500 AS plus_millis FROM t",
    "flatten_transaction": f"WITH t AS ({_EV}) SELECT transaction_id, user_id, txn_time, amount, location, "
                           "'Normal' AS transaction_type FROM t",
    "quality_rules": f"""WITH t AS ({_EV} UNION ALL {_OR})
SELECT count(*) AS n_rows, count(*) FILTER (WHERE amount < 0) AS bad_amount,
       count(*) FILTER (WHERE coalesce(location, '') = '') AS empty_location,
       count(*) FILTER (WHERE NOT coalesce(transaction_type IN ('Normal', 'Fraud'), false)) AS bad_type
  FROM t""",
    "sampled_offsets": f"WITH t AS ({_EV}) SELECT seq, user_id AS key, {_JSON_OBJ} AS value FROM t WHERE seq % 10 = 0",
    "final_count": f"WITH t AS ({_EV}) SELECT count(*) AS n FROM t",
    "round3": f"WITH t AS ({_EV}) SELECT seq, CAST(format('{{:.3f}}', amount / 3) AS DOUBLE) AS amount_third FROM t",
    "location_ci": f"""WITH t AS ({_EV}),
p AS (SELECT user_id, arg_min(location, seq) AS main_location FROM t GROUP BY user_id)
SELECT t.seq, t.location, p.main_location,
       lower(t.location) = lower(upper(p.main_location)) AS same_ci,
       t.location IS DISTINCT FROM upper(p.main_location) AS differs_cs
  FROM t LEFT JOIN p ON p.user_id IS NOT DISTINCT FROM t.user_id""",
    "seconds_of_day_gap": f"""WITH t AS ({_OR}),
a AS (SELECT seq, txn_time - lag(txn_time) OVER (PARTITION BY user_id ORDER BY seq) AS d FROM t)
SELECT seq, CAST(((d % 86400) + 86400) % 86400 AS BIGINT) AS gap_seconds FROM a""",
    "surrogate_id": f"WITH t AS ({_EV}) SELECT seq, 'txn-' || CAST(seq AS VARCHAR) || "
                    "substr(md5(CAST(seq AS VARCHAR) || 'id'), 1, 8) AS surrogate_id FROM t",
    "detect_amount": O.detect_sql("amount"),
    "detect_amount_orders": O.detect_sql("amount", "orders"),
    "detect_velocity": O.detect_sql("velocity"),
    "detect_velocity_wide": O.detect_sql("velocity", max_gap=300),
    "detect_velocity_orders": O.detect_sql("velocity", "orders"),
    "detect_location": O.detect_sql("location"),
    "detect_location_prev": O.detect_location_prev_sql(),
    "detect_amount_all": O.detect_amount_all_sql(),
    "score_all": O.score_all_sql(),
    "score_all_orders": O.score_all_sql("orders"),
    "scored_long": O.scored_long_sql(),
    "final_scores": O.final_scores_sql(),
    "final_scores_redelivered": O.final_scores_redelivered_sql(dedup=False),
    "final_scores_dedup": O.final_scores_redelivered_sql(dedup=True),
    "final_scores_tumbling": O.final_scores_tumbling_sql(),
    "final_scores_session": O.final_scores_session_sql(3600),
    "end_to_end": O.end_to_end_sql(),
    "end_to_end_orders": O.end_to_end_sql("orders"),
    "stream_end_to_end": O.end_to_end_sql(),
    "source_transactions": f"{_EV}",
    "score_all_hot_user": O.score_all_sql(source=f"""SELECT seq, transaction_id,
       CASE WHEN seq % 3 = 0 THEN 'user-hot' ELSE user_id END AS user_id,
       txn_time, amount, location, transaction_type FROM ({_EV})"""),
    "score_all_burst_user": O.score_all_sql(source=f"""SELECT CASE WHEN seq < 3 THEN seq - 1000000000000 ELSE seq END AS seq, transaction_id,
       CASE seq % 3 WHEN 0 THEN 'user-hot' WHEN 1 THEN NULL ELSE user_id END AS user_id,
       txn_time, amount, location, transaction_type FROM ({_EV})"""),
    "score_all_zero_start": O.score_all_sql(source=f"""SELECT seq, transaction_id,
       CASE WHEN seq % 3 = 0 THEN 'user-hot' ELSE user_id END AS user_id, txn_time,
       CASE WHEN seq % 3 = 0 AND seq < 6 THEN 0 ELSE amount END AS amount, location, transaction_type FROM ({_EV})"""),
    "source_scored": O.scored_long_sql(),
    "source_final": O.end_to_end_sql(),
    "processing_windows": f"""WITH {O.scores_ctes()}
SELECT transaction_id, CAST(amount_score + velocity_score + location_score AS BIGINT) AS fraud_score FROM s""",
    "stream_rollup_orders": f"""WITH {O.scores_ctes('orders')}, l AS (
{O.scored_long_body()})
{O._rollup_select('(SELECT *, txn_time AS window_start FROM l)', keys='transaction_id, window_start')}""",
    "stream_dedup": O.final_scores_redelivered_sql(dedup=True),
    "stream_profiles": _profile_sql(_OR),
    "sink_scored_json": O.scored_long_sql(),
    "final_projection": f"""WITH {O.scores_ctes('events')}, l AS (
{O.scored_long_body()}),
f AS ({O._rollup_select('l')})
SELECT transaction_id, user_id, txn_time, CAST(amount AS DECIMAL(10,3)) AS amount, location, transaction_type,
       fraud_score FROM f""",
    "user_profile": _profile_sql(_EV),
    "profile_running": _running_sql(_EV),
    "profile_upsert": f"""WITH p AS ({_profile_sql(_OR)})
SELECT user_id, txn_count, total_amt, average_amt, main_location, last_txn_time, last_location FROM p""",
    "user_count": f"WITH t AS ({_OR}) SELECT count(DISTINCT user_id) AS user_count FROM t",
    "profile_lookup": f"""WITH p AS ({_profile_sql(_OR)})
SELECT c.user_id, p.txn_count, p.total_amt, p.average_amt, p.first_txn_time, p.main_location,
       p.last_txn_time, p.last_location
  FROM (SELECT 'user-' || CAST(c_custkey AS VARCHAR) AS user_id FROM customer) c LEFT JOIN p USING (user_id)""",
    "first_transactions": f"""WITH t AS ({_EV})
SELECT t.* FROM t JOIN (SELECT user_id, min(seq) AS s FROM t GROUP BY user_id) f
  ON f.user_id = t.user_id AND f.s = t.seq""",
    "sample_users": f"""WITH p AS ({_profile_sql(_EV)})
SELECT * EXCLUDE (h) FROM (SELECT *, md5(user_id || 'pick') AS h FROM p) ORDER BY h, user_id LIMIT 25""",
}


def _inject_oracles() -> dict[str, str]:
    ev = _EV
    backtest_src = "SELECT seq, transaction_id, user_id, txn_time, amount, location, transaction_type FROM inj"
    return {
        "inject_pick_rows": f"WITH t AS ({ev}),\n{OI.picked_sql()}\nSELECT seq, block, pos, n FROM picked",
        "inject_pick_types": f"WITH t AS ({ev}),\n{OI.picked_sql()},\n{OI.types_sql()}\nSELECT * FROM types",
        "inject_high_amount": OI.behaviour_sql(ev, I.HIGH_VALUE),
        "inject_location": OI.behaviour_sql(ev, I.PROXIMITY),
        "inject_close_time": OI.behaviour_sql(ev, I.TIME),
        "inject_all": f"WITH {OI.inject_all_ctes(ev)}\nSELECT * FROM inj",
        "inject_backtest": f"""WITH RECURSIVE {OI.inject_all_ctes(ev)},
{O.scores_ctes(source=backtest_src, p='x_').removeprefix('RECURSIVE ')}
SELECT coalesce(inj.fraud_types, 'none') AS fraud_types, count(*) AS n,
       count(*) FILTER (WHERE x_s.amount_score + x_s.velocity_score + x_s.location_score >= 2) AS n_detected,
       CAST(sum(x_s.amount_score + x_s.velocity_score + x_s.location_score) AS BIGINT) AS score_sum
  FROM x_s JOIN inj USING (seq)
 GROUP BY 1""",
    }


ORACLE.update(_inject_oracles())

from . import catalog_streams  # noqa: E402

QUERIES.update(catalog_streams.QUERIES)
ORACLE.update(catalog_streams.oracles(_running_sql, _profile_sql))
