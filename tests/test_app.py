"""The service modes wired end to end: detect -> aggregate -> load, and all in one query."""

import uuid

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tripwire.operators.rollup import score_and_label
from tripwire.schema import PAYLOAD
from tripwire.sources import jdbc
from tripwire.sources.tables import transactions
from tripwire.streaming import app
from tripwire.streaming import stages as SP

DERBY_DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


def test_three_services(spark, scratch):
    tx = transactions(spark, SF_SMALL, "events")
    SP.as_records(tx, PAYLOAD).coalesce(1).write.json(f"{scratch}/transaction")
    # A closing record far in the future lets the event-time windows of the rest close.
    closing = tx.limit(1).withColumn("seq", F.lit(10**9)).withColumn("transaction_id", F.lit("closing")) \
        .withColumn("user_id", F.lit("closing")).withColumn("txn_time", F.lit(4_000_000_000))
    SP.as_records(closing, PAYLOAD).coalesce(1).write.mode("append").json(f"{scratch}/transaction")
    app.run(spark, ["detect", "--source", f"{scratch}/transaction", "--target", f"{scratch}/scored",
                    "--checkpoint", f"{scratch}/ck1", "--trigger", "once"]).awaitTermination()
    for _ in range(2):  # second run: the advanced watermark closes the windows
        app.run(spark, ["aggregate", "--source", f"{scratch}/scored", "--target", f"{scratch}/final",
                        "--checkpoint", f"{scratch}/ck2", "--window", "tumbling", "--watermark", "3650 days", "--trigger", "once"]).awaitTermination()
    url = f"jdbc:derby:memory:svc{uuid.uuid4().hex[:8]};create=true"
    app.run(spark, ["load", "--source", f"{scratch}/final", "--target", "fraud_events", "--checkpoint",
                    f"{scratch}/ck3", "--sink", "jdbc", "--jdbc-url", url, "--jdbc-driver", DERBY_DRIVER,
                    "--create-table", "--trigger", "once"]).awaitTermination()
    stored = jdbc.read_table(spark, url, "fraud_events", {"driver": DERBY_DRIVER})
    stored = stored.toDF(*[c.lower() for c in stored.columns])  # Derby upper-cases names
    got = sorted((r["transaction_id"], r["fraud_score"], r["transaction_type"]) for r in stored.collect())
    exp = sorted((r["transaction_id"], r["fraud_score"], r["transaction_type"]) for r in score_and_label(tx).collect())
    assert got == exp


def test_all_in_one_mode(spark, scratch):
    tx = transactions(spark, SF_SMALL, "orders")
    SP.as_records(tx, PAYLOAD).coalesce(1).write.json(f"{scratch}/transaction")
    app.run(spark, ["all", "--source", f"{scratch}/transaction", "--target", f"{scratch}/final",
                    "--checkpoint", f"{scratch}/ck", "--trigger", "once"]).awaitTermination()
    sch = "transaction_id string, user_id string, txn_time long, amount decimal(10,3), location string, " \
          "transaction_type string, fraud_score int"
    got = spark.read.schema(SP.FILE_RECORD).json(f"{scratch}/final").select(F.from_json("value", sch).alias("r"))
    a = sorted(tuple(r) for r in got.select("r.*").collect())
    b = sorted(tuple(r) for r in score_and_label(tx).collect())
    assert a == b


def test_services_on_folder_topics(spark, scratch):
    """publish -> detect -> aggregate over topics of three partitions; a second consumer that starts at the latest offset sees nothing old."""
    from tripwire.sources import topic
    tx = transactions(spark, SF_SMALL, "events").filter("seq < 200")
    tx.select("seq", *PAYLOAD).coalesce(1).write.parquet(f"{scratch}/table")
    log = ["--fmt", "log", "--partitions", "3", "--trigger", "once"]
    app.run(spark, ["publish", "--source", f"{scratch}/table", "--target", f"{scratch}/txn", "--sink", "log", "--checkpoint", f"{scratch}/ck1", *log]).awaitTermination()
    app.run(spark, ["detect", "--source", f"{scratch}/txn", "--target", f"{scratch}/scored", "--sink", "log", "--checkpoint", f"{scratch}/ck2", *log]).awaitTermination()
    app.run(spark, ["detect", "--source", f"{scratch}/txn", "--target", f"{scratch}/none", "--sink", "log", "--checkpoint", f"{scratch}/ck3",
                    "--starting", "latest", *log]).awaitTermination()
    topic.register(spark)
    scored = spark.read.format(topic.NAME).option("path", f"{scratch}/scored").option("partitions", "3").load()
    assert scored.count() == 3 * tx.count() and scored.select("partition").distinct().count() == 3
    none = spark.read.format(topic.NAME).option("path", f"{scratch}/none").option("partitions", "3").load()
    assert none.count() == 0
