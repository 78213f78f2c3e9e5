"""Profiles on streams (F1-F4): a compacted log of profiles, the running profile as keyed state, lookups of a stream in it, distinct users."""

from __future__ import annotations

import json
from collections.abc import Iterator
from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.profile import _avg, TOTAL_TYPE, merge_deltas, merge_profiles, profile_deltas, profile_lookup
from ..schema import columns
from ..sources.versioned import VersionedTable
from .stages import _children, query_id

COMPACT_EVERY = 20


def _log(spark: SparkSession, path: str, query: str, key: str, compact_every: int = COMPACT_EVERY) -> VersionedTable:
    return VersionedTable(spark, f"{path.rstrip('/')}/query={query}", lambda rows: merge_deltas(rows, key), compact_every)


def profile_delta_writer(path: str, key: str = "user_id", compact_every: int = COMPACT_EVERY):
    """``foreachBatch`` function: keeps the profile of every user under ``path`` (F1, F3 on streams).

    Each query has a versioned table of its own there: a micro-batch commits its per-user
    delta under its batch id, a replayed one changes nothing, and every ``compact_every`` micro-batches the
    deltas are merged into one snapshot, so readers merge few files and merged ones are deleted.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        _log(batch.sparkSession, path, query_id(batch), key, compact_every).commit(int(batch_id), profile_deltas(batch, key))
    return write


def read_profiles(spark: SparkSession, path: str, key: str = "user_id") -> DataFrame | None:
    """Current profile of every user from what ``profile_delta_writer`` keeps, over all queries that wrote there; None if none did."""
    parts = [t for q in _children(spark, path) if q.startswith("query=") if (t := _log(spark, path, q.removeprefix("query="), key).read()) is not None]
    out = None
    for rows in parts:
        out = rows if out is None else out.unionByName(rows)
    return None if out is None else merge_profiles(out, key)


def profile_version(spark: SparkSession, path: str, key: str = "user_id") -> dict[str, int]:
    """Newest committed micro-batch of each writing query."""
    out = {}
    for q in _children(spark, path):
        if q.startswith("query=") and (live := _log(spark, path, q.removeprefix("query="), key).manifest()):
            out[q.removeprefix("query=")] = live["version"]
    return out


def lookup_writer(profiles: str, write, key: str = "user_id"):
    """``foreachBatch`` function: each micro-batch joined with the profiles as they are then (F4 on streams), given to ``write(rows, batch_id)``.

    The profiles of a micro-batch are one version of the log, named in ``profile_version`` (JSON by query); ids
    without a profile have nulls. Only ids of the micro-batch are kept of the profiles before the join.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        version = profile_version(spark, profiles, key)
        known = read_profiles(spark, profiles, key)
        if known is None:
            known = merge_profiles(profile_deltas(spark.createDataFrame([], T.StructType([
                batch.schema[key], *columns("seq long, txn_time long, amount double, location string").fields])), key), key)
        write(profile_lookup(batch, known, key).withColumn("profile_version", F.lit(json.dumps(version, sort_keys=True))), batch_id)
    return run


# --------------------------------------------------------------------- running profile

RUNNING = columns("users string")
RUNNING_OUT = ("txn_count long, total string, amounts long, main_location string, last_txn_time_before long, last_location_before string, "
               "txn_count_before long, total_before string, amounts_before long")
#: Groups of users whose states are kept together.
RUNNING_BUCKETS = 512


def _run_on(stored: str | None, chunks: Iterator[pd.DataFrame], kept: list[str], order: list[str]) -> tuple[pd.DataFrame, str]:
    """The profile after, and just before, each transaction of a bucket's users in a micro-batch; and their states after it, as JSON."""
    pdf = pd.concat(list(chunks)).sort_values(order, kind="stable")
    states = {user: state for user, *state in json.loads(stored or "[]")}
    out = []
    for user, units, t, place in zip(pdf["key_text"], pdf["amt_text"], pdf["time_text"], pdf["loc_text"]):
        count, total, amounts, main, time, loc = states.get(user) or (0, "0", 0, None, None, None)
        before = (time, loc, count or None, total if count else None, amounts if count else None)
        main = place if not count else main
        count += 1
        if units is not None:
            total, amounts = str(Decimal(total) + Decimal(units)), amounts + 1
        time, loc = None if t is None else int(t), place
        out.append((count, total, amounts, main, *before))
        states[user] = (count, total, amounts, main, time, loc)
    names = [f.name for f in columns(RUNNING_OUT).fields]
    new = pd.DataFrame(out, columns=[f"_{n}" for n in names], dtype=object, index=pdf.index)
    for n in ("txn_count", "amounts", "last_txn_time_before", "txn_count_before", "amounts_before"):
        new[f"_{n}"] = new[f"_{n}"].astype("Int64")
    return pd.concat([pdf[kept], new], axis=1), json.dumps([[user, *state] for user, state in states.items()])


class RunningProfile(StatefulProcessor):
    """Running profiles of a table: one value state per bucket of users."""

    def __init__(self, kept: list[str], order: list[str]):
        self.kept, self.order = kept, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("profile", RUNNING)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        stored = self.state.get()
        out, state = _run_on(stored[0] if stored else None, rows, self.kept, self.order)
        self.state.update((state,))
        yield out

    def close(self) -> None:
        pass


def running_profile_stream(txns: DataFrame, key: str = "user_id", order: tuple[str, ...] = ("seq",), buckets: int = RUNNING_BUCKETS) -> DataFrame:
    """F2 on a stream: one row out per transaction, the columns of ``operators.profile.profile_running``.

    A user's state is its count, total, number of amounts, first and last location and last time. Totals are
    decimals carried as text, so they are the exact sums of the batch operator, in any split into micro-batches.
    Users are many and have few rows in a micro-batch, so their states are kept by ``buckets`` of users: a call for each
    bucket, not each user. A bucket's states, and its rows of a micro-batch, are one task's; ``buckets`` stays the same over restarts.
    """
    kept = [c for c in ("seq", key, "transaction_id", "txn_time", "amount", "location", "transaction_type") if c in txns.columns]
    src = txns.select(*kept, *(c for c in order if c not in kept), F.col(key).cast("string").alias("key_text"),
                      F.pmod(F.xxhash64(key), F.lit(buckets)).alias("bucket"), F.col("amount").try_cast(TOTAL_TYPE).cast("string").alias("amt_text"),
                      F.col("txn_time").cast("string").alias("time_text"), F.col("location").alias("loc_text"))
    schema = T.StructType([txns.schema[c] for c in kept] + [T.StructField(f"_{f.name}", f.dataType) for f in columns(RUNNING_OUT).fields])

    def fold(_, chunks, state):
        out, after = _run_on(state.get[0] if state.exists else None, chunks, kept, list(order))
        state.update((after,))
        yield out

    if src.isStreaming:
        out = src.groupBy("bucket").applyInPandasWithState(fold, schema, RUNNING, "append", "NoTimeout")
    else:
        _ = src.sparkSession.streams.active
        out = src.groupBy("bucket").transformWithStateInPandas(
            statefulProcessor=RunningProfile(kept, list(order)), outputStructType=schema, outputMode="Append", timeMode="None")
    total, before = (F.col(c).try_cast(TOTAL_TYPE) for c in ("_total", "_total_before"))
    return out.select(
        *kept, F.col("_txn_count").alias("txn_count"), total.alias("total_amt"), F.col("_main_location").alias("main_location"),
        F.col("_last_txn_time_before").alias("last_txn_time_before"), F.col("_last_location_before").alias("last_location_before"),
        _avg(total, F.col("_amounts")).alias("average_amt"), F.col("_txn_count_before").alias("txn_count_before"),
        before.alias("total_amt_before"), _avg(before, F.col("_amounts_before")).alias("average_amt_before"))


# --------------------------------------------------------------------- distinct users

SKETCH_BITS = 14  # 2^14 registers: a standard error of 1.04 / 2^7, under one percent


def user_sketch(txns: DataFrame, key: str = "user_id") -> DataFrame:
    """HyperLogLog registers (bucket, rank) of the distinct keys of some rows; registers of any split merge by their maximum.

    The first 14 bits of a key's md5 name the bucket, the place of the first one bit among the next 32 is its rank.
    """
    h = F.md5(F.col(key).cast("string"))
    bits = F.conv(F.substring(h, 5, 8), 16, 10).cast("bigint")
    rank = F.when(bits == 0, 33).otherwise(32 - F.floor(F.log2(bits.cast("double")))).cast("int")
    bucket = F.floor(F.conv(F.substring(h, 1, 4), 16, 10).cast("bigint") / 4).cast("int")
    return txns.where(F.col(key).isNotNull()).groupBy(bucket.alias("bucket")).agg(F.max(rank).alias("rank"))


def merge_sketches(parts: DataFrame) -> DataFrame:
    return parts.groupBy("bucket").agg(F.max("rank").alias("rank"))


def sketch_estimate(sketch: DataFrame) -> DataFrame:
    """(user_count): the estimate of merged registers; linear counting while few are filled. Standard error 0.8 percent."""
    m = 1 << SKETCH_BITS
    alpha = 0.7213 / (1 + 1.079 / m)
    agg = sketch.agg(F.count(F.lit(1)).alias("_filled"), F.coalesce(F.sum(F.pow(F.lit(2.0), -F.col("rank"))), F.lit(0.0)).alias("_sum"))
    empty = F.lit(m) - F.col("_filled")
    raw = F.lit(alpha * m * m) / (F.col("_sum") + empty)
    few = (raw <= 2.5 * m) & (empty > 0)
    return agg.select(F.round(F.when(few, F.lit(float(m)) * F.ln(F.lit(float(m)) / F.greatest(empty, F.lit(1)))).otherwise(raw)).cast("long").alias("user_count"))


def user_sketch_writer(path: str, key: str = "user_id", compact_every: int = COMPACT_EVERY):
    """``foreachBatch`` function: the number of distinct users of a stream as mergeable registers in a versioned table."""
    def write(batch: DataFrame, batch_id: int) -> None:
        VersionedTable(batch.sparkSession, f"{path.rstrip('/')}/query={query_id(batch)}", merge_sketches, compact_every).commit(int(batch_id), user_sketch(batch, key))
    return write


def read_user_sketch(spark: SparkSession, path: str) -> DataFrame | None:
    """Merged registers over all queries that wrote there."""
    out = None
    for q in _children(spark, path):
        if q.startswith("query="):
            rows = VersionedTable(spark, f"{path.rstrip('/')}/{q}", merge_sketches).read()
            out = rows if out is None or rows is None else out.unionByName(rows)
    return None if out is None else merge_sketches(out)
