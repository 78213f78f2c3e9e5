"""A topic as a folder: partitions, offsets, commits, starts, replays."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tripwire.sources import topic


@pytest.fixture()
def place(spark, scratch):
    topic.register(spark)
    return f"{scratch}/topic"


def _publish(spark, scratch, place, rows, n=3, ck="ck"):
    schema = "key string, value string"
    spark.createDataFrame(rows, schema).repartition(2).write.mode("append").parquet(f"{scratch}/rows")
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(f"{scratch}/rows")
    (src.writeStream.format(topic.NAME).option("path", place).option("partitions", str(n)).option("checkpointLocation", f"{scratch}/{ck}")
     .trigger(availableNow=True).start().awaitTermination())


def _consume(spark, scratch, place, n=3, starting="earliest"):
    src = spark.readStream.format(topic.NAME).option("path", place).option("partitions", str(n)).option("startingOffsets", starting).load()
    (src.writeStream.format("parquet").option("path", f"{scratch}/{starting}/out").option("checkpointLocation", f"{scratch}/{starting}/ck")
     .trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema(src.schema).parquet(f"{scratch}/{starting}/out")


def test_offsets_partitions_and_starts(spark, scratch, place):
    rows = [(f"k{i % 7}" if i % 10 else None, f"v{i} é\"\n{i}") for i in range(200)]
    _publish(spark, scratch, place, rows[:120])
    assert _consume(spark, scratch, place, starting="latest").count() == 0  # all of it came before this reader
    first = _consume(spark, scratch, place)
    assert first.count() == 120
    _publish(spark, scratch, place, rows[120:])
    got = _consume(spark, scratch, place)  # goes on from its checkpoint
    assert sorted((r.key or "", r.value) for r in got.collect()) == sorted((k or "", v) for k, v in rows)
    for r in got.groupBy("partition").agg(F.min("offset").alias("a"), F.max("offset").alias("b"), F.countDistinct("offset").alias("n"), F.count("*").alias("m")).collect():
        assert (r.a, r.b + 1) == (0, r.n) and r.n == r.m
    assert {(r.key, r.partition) for r in got.select("key", "partition").distinct().collect()} == {(k, topic.partition_of(k, 3)) for k, _ in rows}
    late = _consume(spark, scratch, place, starting="latest")
    assert sorted(r.value for r in late.collect()) == sorted(v for _, v in rows[120:])
    batch = spark.read.format(topic.NAME).option("path", place).option("partitions", "3").load()
    assert batch.count() == 200


def test_killed_writer_leaves_no_half_batch(spark, scratch, place):
    _publish(spark, scratch, place, [("a", "1"), ("b", "2")])
    writer = topic._StreamWriter(spark.createDataFrame([], "key string, value string").schema, {"path": place, "partitions": "3", "writer": "default"})
    before = len(topic.commits(place))
    written = writer.write(iter([("a", "3"), ("b", "4")]))  # tasks wrote, the driver died before the commit
    assert len(topic.commits(place)) == before
    assert spark.read.format(topic.NAME).option("path", place).option("partitions", "3").load().count() == 2
    writer.commit([written, None], 50)
    replay = writer.write(iter([("a", "3"), ("b", "4")]))
    writer.commit([replay], 50)  # the restarted query writes the batch again: it is there
    got = spark.read.format(topic.NAME).option("path", place).option("partitions", "3").load()
    assert sorted(r.value for r in got.collect()) == ["1", "2", "3", "4"]
    assert not [f for f in replay.files if os.path.exists(f"{place}/{f['path']}")]
    failed = writer.write(iter([("a", "5")]))
    writer.abort([failed, None], 51)
    assert not [f for f in failed.files if os.path.exists(f"{place}/{f['path']}")]


def test_log_is_plain(spark, scratch, place):
    _publish(spark, scratch, place, [("a", "1")], n=1)
    entry = next(e for e in topic.commits(place) if e["files"])
    assert {f["partition"] for f in entry["files"]} == {0} and entry["files"][0]["first"] == 0
    line = open(f"{place}/{entry['files'][0]['path']}").read()
    assert json.loads(line)[1:] == ["a", "1"]
    with pytest.raises(ValueError):
        topic._StreamReader({"path": place, "startingOffsets": "yesterday"})
