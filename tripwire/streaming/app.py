"""Run the streaming stages as services: ``python -m tripwire.streaming.app MODE ...``.

Modes (the reference's services, as Spark streaming queries):

* ``publish``: a folder of parquet transactions -> transaction topic, keyed by user;
* ``detect``: transaction topic -> scored topic (one record per transaction and
  detector; the three analyzers in one query);
* ``aggregate``: scored topic -> final topic (per transaction and window, summed
  and labelled; ``--window processing|tumbling|session``, ``--dedup``; event-time windows
  need ``--watermark``, how far behind the latest time a record may come);
* ``load``: final topic -> JDBC table (batches of 100, idempotent per micro-batch);
* ``all``: transaction topic -> final rows in one query (scores summed in
  the row) -> ``--sink files|jdbc|console``.

``--mode PERMISSIVE`` with ``--rejects FOLDER`` keeps records that can't be read and amounts that the
table can't hold apart instead of stopping.

Topics are folders of JSON-lines records (``--fmt files``), folder topics with partitions and offsets
(``--fmt log --partitions n``) or Kafka topics (``--fmt kafka --bootstrap host:port``); ``--sink`` takes the same
names. ``--starting earliest|latest`` is where a new query starts in the last two. Checkpoints go under ``--checkpoint``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.parse import final_projection, parse_transactions, rejects
from ..operators.rollup import total_score
from ..schema import FINAL_COLUMNS, PAYLOAD, TRANSACTION
from ..sources import jdbc
from . import stages as SP

PUBLISHED = T.StructType([T.StructField("seq", T.LongType())] + TRANSACTION.fields)


def _args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="tripwire.streaming.app")
    p.add_argument("mode", choices=["publish", "detect", "aggregate", "load", "all"])
    p.add_argument("--source", required=True, help="input topic (folder or Kafka topic)")
    p.add_argument("--target", default="", help="output topic / folder / JDBC table")
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--fmt", default="files", choices=["files", "log", "kafka"])
    p.add_argument("--partitions", type=int, default=1, help="partitions of a folder topic")
    p.add_argument("--bootstrap", default="")
    p.add_argument("--sink", default="files", choices=["files", "log", "kafka", "jdbc", "console"])
    p.add_argument("--jdbc-url", default="")
    p.add_argument("--jdbc-driver", default="")
    p.add_argument("--create-table", action="store_true",
                   help="create the JDBC table: anew with a new checkpoint, only if missing with one that has been used")
    p.add_argument("--window", default="processing", choices=["processing", "tumbling", "session"])
    p.add_argument("--watermark", default=None, help="for event-time windows, e.g. '1 hour'")
    p.add_argument("--seconds", type=int, default=1, help="length of a tumbling window, gap of a session")
    p.add_argument("--dedup", action="store_true")
    p.add_argument("--mode", dest="parse_mode", default="FAILFAST", choices=["FAILFAST", "PERMISSIVE"])
    p.add_argument("--rejects", default="", help="folder for rejected records (JSON)")
    p.add_argument("--starting", default="earliest", help="start offsets of a new query on a folder topic or Kafka")
    p.add_argument("--allow-data-loss", action="store_true", help="go on when Kafka offsets are gone")
    p.add_argument("--trigger", default="5 seconds", help="processing-time interval, or 'once' (available now)")
    p.add_argument("--max-files", type=int, default=SP.MAX_FILES, help="topic files in a micro-batch")
    p.add_argument("--max-offsets", type=int, default=SP.MAX_OFFSETS, help="Kafka records in a micro-batch")
    return p.parse_args(argv)


def _trigger(a) -> dict:
    return {"availableNow": True} if a.trigger == "once" else {"processingTime": a.trigger}


def _read(spark: SparkSession, a) -> DataFrame:
    kafka = {"bootstrap": a.bootstrap, "starting": a.starting, "max_offsets": a.max_offsets,
             "fail_on_data_loss": not a.allow_data_loss} if a.fmt == "kafka" else {}
    if a.fmt == "log":
        kafka = {"partitions": a.partitions, "starting": a.starting}
    return SP.read_topic(spark, a.source, fmt=a.fmt, max_files_per_trigger=a.max_files, **kafka)


def _sink_options(a) -> dict:
    return {"bootstrap": a.bootstrap} if a.sink == "kafka" else {"partitions": a.partitions} if a.sink == "log" else {}


def _jdbc_props(a) -> dict:
    return {"driver": a.jdbc_driver} if a.jdbc_driver else {}


def _final_records(df: DataFrame) -> DataFrame:
    """Final rows as topic records; seq is a hash of the row's key columns."""
    keys = [c for c in ("transaction_id", "window_start") if c in df.columns]
    return SP.as_records(df.withColumn("seq", F.xxhash64(*keys)), FINAL_COLUMNS)


def _new_checkpoint(spark: SparkSession, path: str) -> bool:
    return "offsets" not in SP._children(spark, path)


def _write_rows(df: DataFrame, a, spark: SparkSession) -> StreamingQuery:
    """Scored rows (with amount as double) to the chosen sink; oversize amounts to the rejects if a folder is given."""
    if a.sink == "jdbc":
        if a.create_table:  # the reference drops and re-creates the table at start (A8)
            jdbc.create_table(spark, a.jdbc_url, a.target, _jdbc_props(a), drop=_new_checkpoint(spark, a.checkpoint))
        writer = jdbc.jdbc_batch_writer(a.jdbc_url, a.target, _jdbc_props(a))
        if a.rejects:
            writer = SP.split_writer(writer, f"{a.rejects}/amounts")
        else:
            df = final_projection(df)
        return (df.writeStream.foreachBatch(writer).option("checkpointLocation", a.checkpoint)
                .trigger(**_trigger(a)).start())
    kafka = _sink_options(a)
    return SP.write_topic(_final_records(df), a.target, a.checkpoint, fmt=a.sink, trigger=_trigger(a), **kafka)


def _start_rejects(src: DataFrame, a) -> None:
    """A second query of the same topic that keeps the records a PERMISSIVE parse rejects."""
    parsed = parse_transactions(src, mode="PERMISSIVE", keep=["seq"])
    (rejects(parsed).select("seq", F.col("_corrupt").alias("value")).writeStream.format("json").option("path", f"{a.rejects}/records")
     .option("checkpointLocation", f"{a.checkpoint.rstrip('/')}-rejects").trigger(**_trigger(a)).start())


def run(spark: SparkSession, argv=None) -> StreamingQuery:
    a = _args(argv)
    kafka = _sink_options(a)
    if a.mode == "publish":
        rows = spark.readStream.schema(PUBLISHED).option("maxFilesPerTrigger", str(a.max_files)).parquet(a.source)
        return SP.write_topic(SP.as_records(rows, PAYLOAD), a.target, a.checkpoint, fmt=a.sink, trigger=_trigger(a), **kafka)
    src = _read(spark, a)
    if a.mode in ("detect", "all") and a.parse_mode == "PERMISSIVE" and a.rejects:
        _start_rejects(_read(spark, a), a)
    if a.mode == "detect":
        out = SP.scored_records(SP.detector_stream(src, mode=a.parse_mode))
        return SP.write_topic(out, a.target, a.checkpoint, fmt=a.sink, trigger=_trigger(a), **kafka)
    if a.mode == "aggregate":
        final = SP.rollup_stream(SP.parse_scored(src), window=a.window, seconds=a.seconds, gap_seconds=a.seconds, watermark=a.watermark, dedup=a.dedup)
        return _write_rows(final, a, spark)
    if a.mode == "load":
        return _write_rows(SP.parse_final(src), a, spark)
    return _write_rows(total_score(SP.detector_stream(src, mode=a.parse_mode)), a, spark)


def main(argv=None) -> None:
    spark = SparkSession.builder.appName("tripwire-stream").getOrCreate()
    q = run(spark, argv)
    q.awaitTermination()


if __name__ == "__main__":
    main()
