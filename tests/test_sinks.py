"""JDBC sink against embedded Derby (in the Spark jars, no server), and the console sink."""

import uuid

from conftest import SF_SMALL
from tripwire.operators.rollup import score_and_label
from tripwire.schema import PAYLOAD
from tripwire.sources import jdbc
from tripwire.sources.tables import transactions
from tripwire.streaming import stages as SP

DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def test_jdbc_stream_sink_idempotent(spark, scratch):
    url = f"jdbc:derby:memory:fraud{uuid.uuid4().hex[:8]};create=true"
    jdbc.create_table(spark, url, "fraud_events", DERBY)
    topic = f"{scratch}/topic"
    tx = transactions(spark, SF_SMALL, "events")
    SP.as_records(tx, PAYLOAD).coalesce(1).write.json(topic)
    final = SP.final_stream(SP.detector_stream(SP.read_topic(spark, topic)))
    writer = jdbc.jdbc_batch_writer(url, "fraud_events", DERBY)
    q = (final.writeStream.foreachBatch(writer).option("checkpointLocation", f"{scratch}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    stored = jdbc.read_table(spark, url, "fraud_events", DERBY)
    assert stored.count() == tx.count()
    a = sorted(tuple(r)[1:8] for r in stored.orderBy("transaction_id").collect())
    # Another run with a new checkpoint keeps the first one's rows; writing its micro-batch again does not duplicate its own.
    writer(score_and_label(tx), 0)
    writer(score_and_label(tx), 0)
    assert jdbc.final_count(spark, url, "fraud_events", DERBY).first()["n"] == 2 * tx.count()
    jdbc.create_table(spark, url, "fraud_events", DERBY, drop=False)
    assert jdbc.final_count(spark, url, "fraud_events", DERBY).first()["n"] == 2 * tx.count()
    b = sorted(tuple(r) for r in score_and_label(tx).collect())
    assert a == b


def test_console_sink_runs(spark, scratch):
    topic = f"{scratch}/topic"
    tx = transactions(spark, SF_SMALL, "events").limit(5)
    SP.as_records(tx, PAYLOAD).coalesce(1).write.json(topic)
    q = SP.write_topic(SP.read_topic(spark, topic), "", f"{scratch}/ck", fmt="console")
    q.awaitTermination()
    assert q.lastProgress["numInputRows"] == 5


def test_failure_between_the_steps_leaves_the_old_rows(spark, monkeypatch):
    """The stage is filled, then the swap breaks at each of its steps: the final table is as before, and a replay gives each row once."""
    url = f"jdbc:derby:memory:fraud{uuid.uuid4().hex[:8]};create=true"
    jdbc.create_table(spark, url, "fraud_events", DERBY)
    tx = score_and_label(transactions(spark, SF_SMALL, "events")).limit(20).cache()
    writer = jdbc.jdbc_batch_writer(url, "fraud_events", DERBY)
    writer(tx, 0)

    def rows():
        return sorted(tuple(r)[1:10] for r in jdbc.read_table(spark, url, "fraud_events", DERBY).collect())
    before, whole = rows(), jdbc.swap_statements
    assert len(before) == 20
    for step in range(3):
        monkeypatch.setattr(jdbc, "swap_statements", lambda *a, step=step: [*whole(*a)[:step], "DELETE FROM no_such_table"])
        for batch_id in (0, 1):  # a replayed micro-batch and a new one
            try:
                writer(tx, batch_id)
                raise AssertionError("the swap did not fail")
            except Exception as e:  # noqa: BLE001
                assert "no_such_table" in str(e).lower()
            assert rows() == before
    monkeypatch.setattr(jdbc, "swap_statements", whole)
    writer(tx, 0)
    writer(tx, 1)
    assert len(rows()) == 40 and jdbc.read_table(spark, url, "fraud_events_stage", DERBY).count() == 0
    tx.unpersist()
