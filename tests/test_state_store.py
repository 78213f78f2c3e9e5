"""Stateful queries on a session with Spark's own default state store."""

import pytest

from conftest import SF_SMALL
from tripwire.operators import profile as PR
from tripwire.plans import catalog
from tripwire.schema import DETECTORS
from tripwire.session import ROCKSDB, STATE_STORE_CONF, rocksdb_state
from tripwire.sources.tables import transactions


@pytest.fixture()
def default_store(spark):
    spark.conf.set(STATE_STORE_CONF, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    yield
    spark.conf.set(STATE_STORE_CONF, ROCKSDB)


def test_streams_bring_their_state_store(spark, default_store):
    before = spark.conf.get(STATE_STORE_CONF)
    scored = catalog.QUERIES["score_all"](spark, SF_SMALL)
    for name in ("stream_from_history", "stream_in_order"):
        got = catalog.QUERIES[name](spark, SF_SMALL)
        want, rows = {tuple(r) for r in scored.select(got.columns).collect()}, got.collect()
        assert len(rows) == len(want) and {tuple(r) for r in rows} == want, name
    kinds = {r.kind: r["count"] for r in catalog.QUERIES["stream_late_windows"](spark, SF_SMALL).groupBy("kind").count().collect()}
    errors = transactions(spark, SF_SMALL, "events").filter("location = 'error'").count()
    assert kinds == {"window": len(want), "late": len(DETECTORS) * errors}
    profiles = catalog.QUERIES["stream_running_profile"](spark, SF_SMALL)
    right = PR.profile_running(transactions(spark, SF_SMALL, "orders")).select(profiles.columns)
    rows = profiles.collect()
    assert {tuple(r) for r in rows} == {tuple(r) for r in right.collect()} and len(rows) == right.count()
    assert spark.conf.get(STATE_STORE_CONF) == before


def test_session_setting_is_put_back(spark, default_store):
    before = spark.conf.get(STATE_STORE_CONF)
    with pytest.raises(ValueError), rocksdb_state(spark):
        assert spark.conf.get(STATE_STORE_CONF) == ROCKSDB
        raise ValueError
    assert spark.conf.get(STATE_STORE_CONF) == before
