"""Streaming stages: topics in and out, the detector query, the roll-up, the loader.

The reference runs three detector jobs, an aggregator and a loader connected
by topics. Here the detectors are one query (one keyed state), and the three
stages can run as one query (scores summed in the row) or as separate queries
connected by topics, as in the reference.

Topics are Kafka topics (``fmt="kafka"``) or, for tests and file drops,
folders of JSON-lines files whose records are ``{"seq": .., "value": ..}``
(the Kafka offset and value).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.parse import (LABEL_THRESHOLD, as_json, decode_utf8, filter_null, final_projection, final_rejects, label,
                               parse_transactions, unknown_fields)
from ..operators.rollup import scored_long, total_score
from ..schema import DETECTORS, PAYLOAD, SCORED
from ..sources import topic
from .processor import score_with_group_state, score_with_state

FILE_RECORD = T.StructType([T.StructField("seq", T.LongType()), T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])

# Scored record on the topic: the arrival offset plus the scored transaction.
SCORED_TEXT = T.StructType([T.StructField("seq", T.LongType())] + SCORED.fields)


#: Bounds of a micro-batch (and so of one user's rows that the stateful stage holds): Kafka records, topic files.
MAX_OFFSETS = 1_000_000
MAX_FILES = 64


def kafka_options(bootstrap: str, topic: str, starting: str = "earliest", max_offsets: int | None = MAX_OFFSETS,
                  fail_on_data_loss: bool = True) -> dict:
    """Connector options in one place.

    ``max_offsets`` bounds a micro-batch (the reference polls 100 records at a time,
    which is a client setting, not a batch size). Offsets that are gone from the
    topic stop the query unless ``fail_on_data_loss`` is turned off.
    """
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic, "startingOffsets": starting,
            "failOnDataLoss": str(bool(fail_on_data_loss)).lower()}
    if max_offsets:
        opts["maxOffsetsPerTrigger"] = str(max_offsets)
    return opts


def read_topic(spark: SparkSession, where: str, fmt: str = "files", max_files_per_trigger: int | None = MAX_FILES,
               **kafka) -> DataFrame:
    """A stream of (seq, value) records: a folder of JSON-lines files, a folder topic (``fmt="log"``) or a Kafka topic.

    Records of a log or of Kafka carry their partition too: offsets only order the records of one. Both
    take ``starting``: ``earliest`` or ``latest``, for a new query; a log takes its number of ``partitions``.
    """
    if fmt == "log":
        raw = (spark.readStream.format(topic.register(spark)).option("path", where).option("partitions", str(kafka.get("partitions", 1)))
               .option("startingOffsets", kafka.get("starting", "earliest")).load())
        return raw.select(F.col("offset").alias("seq"), "partition", "value")
    if fmt == "kafka":
        raw = spark.readStream.format("kafka").options(**kafka_options(kafka["bootstrap"], where, **{
            k: v for k, v in kafka.items() if k != "bootstrap"})).load()
        return raw.select(F.col("offset").alias("seq"), F.col("partition"), decode_utf8("value").alias("value"))
    reader = spark.readStream.schema(FILE_RECORD)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.json(where)


def write_topic(df: DataFrame, where: str, checkpoint: str, fmt: str = "files", trigger: dict | None = None,
                query_name: str | None = None, **kafka) -> StreamingQuery:
    """Write (seq, key, value) records to a folder of JSON files, a folder topic (``fmt="log"``) or a Kafka topic."""
    w = df.writeStream.option("checkpointLocation", checkpoint).outputMode("append")
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(**(trigger or {"availableNow": True}))
    if fmt == "kafka":
        return w.format("kafka").option("kafka.bootstrap.servers", kafka["bootstrap"]).option("topic", where).start()
    if fmt == "log":
        return (w.format(topic.register(df.sparkSession)).option("path", where).option("partitions", str(kafka.get("partitions", 1))).start())
    if fmt == "console":
        return w.format("console").option("truncate", "false").start()
    return w.format("json").option("path", where).start()


def as_records(df: DataFrame, columns: list[str], seq: str = "seq", key: str = "user_id") -> DataFrame:
    """Rows to (seq, key, value) topic records (B2); null fields are kept, unknown fields of an ``extras`` column go along.

    The key keeps a user's records in one Kafka partition, and so in order.
    """
    value = as_json(columns, "extras" if "extras" in df.columns else None)
    keyed = [F.col(key).cast("string").alias("key")] if key in df.columns else []
    return df.select(F.col(seq).alias("seq"), *keyed, value.alias("value"))


def _arrival(records: DataFrame) -> list[str]:
    return ["seq"] + [c for c in ["partition"] if c in records.columns]


def detector_stream(records: DataFrame, mode: str = "FAILFAST", api: str = "group_state", **params) -> DataFrame:
    """Stage 1: parse transactions, score them with keyed state (wide: three score columns).

    ``api="group_state"`` (default, ``applyInPandasWithState``: the state travels
    with the Arrow batches) or ``"transform"`` (``transformWithStateInPandas``,
    state through the state server; also runs on batch frames). With mode PERMISSIVE the
    rejects are left out here; ``parse_transactions`` and ``rejects`` give them.
    """
    parsed = parse_transactions(records, mode=mode, keep=_arrival(records), extras=True)
    if mode.upper() == "PERMISSIVE":
        parsed = filter_null(parsed).drop("_corrupt")
    if api == "transform":
        return score_with_state(parsed, **params)
    return score_with_group_state(parsed, **params)


def scored_records(wide: DataFrame) -> DataFrame:
    """Stage 1 output in the shared-topic form: one record per (transaction, detector)."""
    return as_records(scored_long(wide), PAYLOAD + ["fraud_score", "detector"])


def _parsed(records: DataFrame, fields: list[T.StructField]) -> DataFrame:
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in fields])
    known = [f.name for f in fields]
    p = records.select(*_arrival(records), F.from_json("value", text, {"mode": "FAILFAST"}).alias("r"), unknown_fields(F.col("value"), known).alias("extras"))
    return p.select(*_arrival(records), *[F.col(f"r.{f.name}").cast(f.dataType).alias(f.name) for f in fields], "extras")


def parse_scored(records: DataFrame) -> DataFrame:
    """Scored records to columns (a bad record stops the job), unknown fields in ``extras``."""
    return _parsed(records, [f for f in SCORED_TEXT.fields if f.name != "seq"])


def parse_final(records: DataFrame) -> DataFrame:
    """Final records to columns."""
    return _parsed(records, [f for f in SCORED.fields if f.name != "detector"])


def rollup_stream(scored: DataFrame, window: str = "processing", seconds: int = 1, gap_seconds: int = 1,
                  watermark: str | None = None, dedup: bool = False, threshold: int = LABEL_THRESHOLD) -> DataFrame:
    """Stage 2: per transaction and window, sum the scores and label.

    ``processing``: tumbling 1 s windows of arrival (processing) time, as the
    reference; ``tumbling``/``session``: windows of event time ``txn_time``, for which a
    ``watermark`` must say how far behind the latest time a record may come (times out of order are
    usual here). A window is emitted once the watermark passes its end; a record later than that is
    left out and counted by the query (``late_records``). ``dedup`` counts a
    (transaction, detector) once per window: the copies meet in the window's state, so a
    redelivery counts once however many micro-batches later it comes, until the window is emitted.
    """
    if window == "processing":
        ts, watermark = F.current_timestamp(), watermark or "0 seconds"
    elif watermark is None:
        raise ValueError("event-time windows need a watermark, e.g. '1 hour'")
    else:
        ts = F.timestamp_seconds("txn_time")
    s = scored.withColumn("_t", ts).withWatermark("_t", watermark)
    if window == "session":
        win = F.session_window("_t", f"{int(gap_seconds)} seconds")
    else:
        win = F.window("_t", f"{int(seconds)} seconds")
    payload = [c for c in [*PAYLOAD, "extras"] if c != "transaction_id" and c in scored.columns]
    if dedup:
        score = sum((F.coalesce(F.max(F.when(F.col("detector") == d, F.col("fraud_score"))), F.lit(0)) for d in DETECTORS), F.lit(0))
    else:
        score = F.sum("fraud_score")
    agg = s.groupBy(win.alias("_w"), "transaction_id").agg(
        score.cast("int").alias("fraud_score"), F.max_by(F.struct(*payload), F.col("seq")).alias("_base"))
    return agg.select(
        F.unix_seconds("_w.start").alias("window_start"), "transaction_id",
        *[F.col(f"_base.{c}").alias(c) for c in payload if c != "transaction_type"],
        label("fraud_score", F.col("_base.transaction_type"), threshold).alias("transaction_type"),
        "fraud_score", (F.col("fraud_score") >= threshold).alias("detected"))


def late_records(query: StreamingQuery) -> int:
    """Records that came after their window was emitted, over the micro-batches that the query still reports."""
    return sum(int(op.numRowsDroppedByWatermark) for p in query.recentProgress for op in p.stateOperators)


def final_stream(wide: DataFrame, threshold: int = LABEL_THRESHOLD, safe: bool = False) -> DataFrame:
    """Stages 1-2 in one query (E8): the three scores summed in the row, 7 table columns.

    An amount that the table can't hold stops the query, or with ``safe`` its row is left
    to ``final_rejects`` (see ``split_writer``).
    """
    return final_projection(total_score(wide, threshold), safe=safe)


def split_writer(write_rows, rejects_path: str):
    """``foreachBatch`` function over rows with a score: table rows to ``write_rows(batch, batch_id)``, oversize ones as JSON under ``rejects_path``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            final_rejects(batch).write.mode("overwrite").json(f"{rejects_path.rstrip('/')}/query={query_id(batch)}/batch={int(batch_id)}")
            write_rows(final_projection(batch, safe=True), batch_id)
        finally:
            batch.unpersist()
    return write


def query_id(batch: DataFrame) -> str:
    """Id of the streaming query that runs a ``foreachBatch`` function: the same after restarts from its checkpoint, another for any other."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def with_progress_count(df: DataFrame, name: str = "messages") -> DataFrame:
    """Running message count (A12): an observed metric, reported per micro-batch in
    ``query.lastProgress["observedMetrics"]`` (batch: ``Observation``); no extra job."""
    return df.observe(name, F.count(F.lit(1)).alias("n"))


def _children(spark: SparkSession, path: str) -> list[str]:
    """Names of the complete folders in a folder of any Hadoop file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p)]
