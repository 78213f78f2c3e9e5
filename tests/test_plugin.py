"""Detectors as plug-ins: tables, blocks, streams, a start from history, a state table."""

import json
import sys

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle
from pyspark.sql import functions as F

from brute import brute_scores
from conftest import SF_SMALL
from tripwire.operators import detectors as D
from tripwire.operators import plugin as PL
from tripwire.plans.catalog_streams import _in_drops
from tripwire.schema import PAYLOAD
from tripwire.sources.tables import transactions
from tripwire.sources.versioned import VersionedTable
from tripwire.streaming import detect as DT
from tripwire.streaming import stages as SP
from util import scores, txns

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the detector below reaches the workers without being installed there

ODD = [None, float("nan"), 0.0, 1.0, 2.0, 7.5, 1e18, 1e33, 1e40, 10000000000000.1, 9.3e12, 3e40]


class RepeatDetector(PL.Detector):
    """A fourth detector: 1 from the third transaction in a row at one location on."""

    name = "repeat"

    def inputs(self):
        return {"location": F.col("location")}

    def init(self):
        return [None, 0]

    def step(self, state, rows):
        out, (loc, n) = [], state
        for x in rows["location"]:
            n = n + 1 if x == loc and n else 1
            loc = x
            out.append(int(n >= 3))
        return out, [loc, n]


def repeat_brute(rows):
    out, seen = {}, {}
    for r in sorted(rows):
        seen.setdefault(r[1], []).append(r[4])
        out[r[0]] = int(len(seen[r[1]]) >= 3 and len(set(seen[r[1]][-3:])) == 1)
    return out


def brute(rows):
    """As brute_scores, with rows without an amount: they score 0 and leave the state."""
    have = {r[0]: r[3] is not None and r[3] == r[3] for r in rows}
    base = brute_scores([dict(seq=r[0], user_id=r[1], txn_time=r[2], amount=0.0, location=r[4]) for r in rows])
    amount = brute_scores([dict(seq=r[0], user_id=r[1], txn_time=r[2], amount=r[3], location=r[4]) for r in rows if have[r[0]]])
    return {s: ((amount[s][0] if have[s] else 0), *v[1:]) for s, v in base.items()}


row = st.tuples(st.sampled_from(["a", "a", "b", None]), st.integers(0, 200), st.sampled_from(ODD), st.sampled_from(["VN", "US", None]))


@settings(max_examples=8, deadline=None, phases=[Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(row, min_size=1, max_size=40), rpb=st.sampled_from([1, 3, 5, 1000]))
def test_any_history_any_amounts(spark, rows, rpb):
    data = [(i, *r) for i, r in enumerate(rows)]
    want = brute(data)
    assert scores(D.score_all(txns(spark, data), rows_per_block=rpb)) == want
    got = PL.score_with(txns(spark, data), [*PL.standard(), RepeatDetector()], rows_per_block=rpb)
    assert scores(got) == want
    assert scores(got, ["repeat_score"]) == {s: (v,) for s, v in repeat_brute(data).items()}


BIG = [(i, "u", 100 * i, a, "VN") for i, a in enumerate([1.0] * 9 + [1e40] + [2.0] * 10 + [None, 1e18, float("nan"), 1e33, 10000000000000.1, 2.0])]


def test_amounts_of_any_size_on_every_path(spark, scratch):
    """Whole, in blocks of 5, by plug-ins, in two micro-batches of both stream forms, and all amounts in the average."""
    want = brute(BIG)
    df = txns(spark, BIG)
    assert scores(D.score_all(df)) == scores(D.score_all(df, rows_per_block=5)) == want
    whole = scores(D.detect_amount_all(df), ["fraud_score"])
    assert scores(D.detect_amount_all(df, rows_per_block=5), ["fraud_score"]) == whole
    assert whole[9] == (1,) and whole[10] == (0,)
    for kind in ("group_state", "transform", "plugin", "table"):
        topic, out = f"{scratch}/{kind}/topic", f"{scratch}/{kind}/out"
        for lo in (0, 10):
            df.filter((F.col("seq") >= lo) & (F.col("seq") < lo + 10 + lo)).coalesce(1).write.mode("append").parquet(topic)
            source = spark.readStream.schema(df.schema).parquet(topic)
            if kind == "table":
                scorer = DT.TableScorer(spark, out, PL.standard(), rows_per_block=5)
                q = source.writeStream.foreachBatch(scorer)
            else:
                scored = (DT.score_stream(source, PL.standard()) if kind == "plugin" else
                          SP.score_with_group_state(source) if kind == "group_state" else SP.score_with_state(source))
                q = scored.writeStream.format("parquet").option("path", out)
            q.option("checkpointLocation", f"{scratch}/{kind}/ck").trigger(availableNow=True).start().awaitTermination()
        got = scorer.scored() if kind == "table" else spark.read.parquet(out)
        assert scores(got) == want, kind


def test_start_from_history(spark, scratch):
    """Batch over the first half, stream over the second: the same scores as batch over all."""
    tx = transactions(spark, SF_SMALL, "events")
    detectors = [*PL.standard(), RepeatDetector()]
    cols = [f"{d.name}_score" for d in detectors]
    first, rest = tx.filter("seq < 500"), tx.filter("seq >= 500")
    states = PL.end_states(first, detectors, rows_per_block=100)
    want = {s: v for s, v in scores(PL.score_with(tx, detectors), cols).items() if s >= 500}
    states.write.parquet(f"{scratch}/states")
    initial = spark.read.parquet(f"{scratch}/states")
    _in_drops(rest, f"{scratch}/topic", 3)
    source = spark.readStream.schema(tx.schema).option("maxFilesPerTrigger", "1").parquet(f"{scratch}/topic")
    q = (DT.score_stream(source, detectors, initial=initial).writeStream.format("parquet").option("path", f"{scratch}/out")
         .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    assert scores(spark.read.parquet(f"{scratch}/out"), cols) == want
    # a table goes on from states too
    assert scores(PL.score_with(rest, detectors, initial=initial, rows_per_block=100), cols) == want
    scorer = DT.TableScorer(spark, f"{scratch}/table", detectors, rows_per_block=50)
    scorer.start_from(initial)
    scorer(rest, 0)
    assert scores(scorer.scored(), cols) == want


@pytest.fixture()
def numbers(spark, scratch):
    def merge(rows):
        return rows.groupBy("k").agg(F.sum("n").alias("n"))
    return lambda **o: VersionedTable(spark, f"{scratch}/table", merge, **o)


def test_versions_are_atomic_and_bounded(spark, numbers):
    table = numbers(compact_every=4, keep=2)
    assert table.read() is None and table.manifest() is None
    for v in range(30):
        assert table.commit(v, spark.createDataFrame([(v % 3, 1)], "k long, n long"), {"at": v})
        assert not table.commit(v, spark.createDataFrame([(0, 100)], "k long, n long"))  # a replay changes nothing
        if v == 20:
            held = table.read()  # a reader that opened its version before later commits
            assert {r.k: r.n for r in held.collect()} == {0: 7, 1: 7, 2: 7}
        if v == 21:
            assert {r.k: r.n for r in held.collect()} == {0: 7, 1: 7, 2: 7}
        assert len(table.versions()) <= 2 and len(table.folder.names("data")) <= 7
    assert {r.k: r.n for r in table.read().collect()} == {0: 10, 1: 10, 2: 10}
    assert table.manifest()["info"] == {"at": 29}
    assert not [n for n in table.folder.names("manifests") if n.endswith(".tmp")]


def test_broken_commit_leaves_the_version(spark, numbers, monkeypatch):
    table = numbers()
    table.commit(0, spark.createDataFrame([(1, 1)], "k long, n long"))
    monkeypatch.setattr(table.folder, "write_once", lambda *a: (_ for _ in ()).throw(OSError("driver killed")))
    with pytest.raises(OSError):
        table.commit(1, spark.createDataFrame([(1, 5)], "k long, n long"))
    monkeypatch.undo()
    assert table.read().first().n == 1 and len(table.folder.names("data")) == 2
    again = numbers()
    again.commit(1, spark.createDataFrame([(1, 5)], "k long, n long"))
    assert again.read().first().n == 6 and len(again.folder.names("data")) == 2  # what the broken commit left is gone


def test_hot_user_of_a_stream_is_spread(spark, scratch):
    """One user with a third of the rows: several micro-batches, a killed one, a restart; no task folds more than its block."""
    tx = transactions(spark, SF_SMALL, "events")
    hot = tx.withColumn("user_id", F.when(F.col("seq") % 3 == 0, "hot").when(F.col("seq") % 3 == 1, F.lit(None)).otherwise(F.col("user_id")))
    want = scores(D.score_all(hot))
    _in_drops(hot, f"{scratch}/topic", 3)

    def run(scorer):
        source = spark.readStream.schema(hot.schema).option("maxFilesPerTrigger", "1").parquet(f"{scratch}/topic")
        q = (source.writeStream.foreachBatch(scorer).option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start())
        q.awaitTermination()

    def broken(batch, batch_id):
        scorer = DT.TableScorer(spark, f"{scratch}/out", PL.standard(), rows_per_block=20, compact_every=2)
        if batch_id == 1:  # killed after the rows are written, before the commit
            scorer.table.commit = lambda *a: (_ for _ in ()).throw(RuntimeError("killed"))
        scorer(batch, batch_id)

    with pytest.raises(Exception, match="killed"):
        run(broken)
    scorer = DT.TableScorer(spark, f"{scratch}/out", PL.standard(), rows_per_block=20, compact_every=2)
    assert scorer.table.manifest()["version"] == 1
    run(scorer)
    assert scores(scorer.scored()) == want and scorer.table.manifest()["version"] == 3
    blocks = spark.read.parquet(f"{scratch}/out/scored").groupBy("batch", "user_id", "blk").count()
    assert blocks.agg(F.max("count")).first()[0] <= 40
    assert blocks.filter("user_id = 'hot'").count() > 3
    state = {r.user_id: json.loads(r.state) for r in scorer.states().collect()}
    assert len(state) == hot.select("user_id").distinct().count()
