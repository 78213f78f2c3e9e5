"""The three detectors as one keyed stateful processor (streams, and batch too).

One value state per user holds everything the three detectors carry between
micro-batches: the amount fold (total, count of unflagged amounts), the last
transaction time and the first location. Rows of a user within a micro-batch
are taken in ``seq`` order (within the source partition, for Kafka); across
micro-batches the source order is the arrival order. The chunks of one user in one micro-batch are
held, not copied, until their order is known, so the micro-batch size
(``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger``, both set by default) bounds that memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.amount import exact_units, fold, micro_units, ratio
from ..operators.detectors import AMOUNT_FACTOR, VELOCITY_MAX_GAP
from ..schema import CANONICAL

STATE_SCHEMA = T.StructType([
    T.StructField("total", T.StringType()),  # micro-units: a whole number of any size
    T.StructField("cnt", T.LongType()),
    T.StructField("last_time", T.LongType()),
    T.StructField("first_loc", T.StringType()),
])

INPUT_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("transaction_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("txn_time", T.LongType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("location", T.StringType()),
    T.StructField("transaction_type", T.StringType()),
    T.StructField("extras", T.StringType()),  # unknown fields of the record
])

#: Arrival order: a Kafka record's partition comes before its offset.
ORDER_COLUMNS = ["partition", "seq"]

_INPUT_NAMES = [f.name for f in INPUT_SCHEMA.fields]

WIDE_SCHEMA = T.StructType(INPUT_SCHEMA.fields + [
    T.StructField("amount_score", T.IntegerType()),
    T.StructField("velocity_score", T.IntegerType()),
    T.StructField("location_score", T.IntegerType()),
])


def _list(column: pd.Series) -> list:
    return [None if v is None or v != v else v for v in column.tolist()]


def fold_user(chunks: list[pd.DataFrame], stored, factor: float, max_gap: int):
    """Score one user's chunks of a micro-batch from the stored state; yields the scored chunks, returns the new state.

    The order is found over the chunks' order columns alone; payload columns stay where they are.
    """
    order = [c for c in ORDER_COLUMNS if c in chunks[0].columns]
    sizes = [len(c) for c in chunks]
    keys = [np.concatenate([c[o].to_numpy() for c in chunks]) for o in order]
    at = np.lexsort(keys[::-1])
    amounts, times, locs = ([x for c in chunks for x in _list(c[name])] for name in ("amount", "txn_time", "location"))
    texts = [x for c in chunks for x in (_list(c["units_text"]) if "units_text" in c else [None] * len(c))]
    units = [exact_units(None if u is None else int(u), a) for u, a in zip(texts, amounts)]
    total, cnt, last_time, first_loc = stored if stored is not None else ("0", 0, None, None)
    started = stored is not None
    scores, total, cnt = fold([units[i] for i in at], int(total), int(cnt), ratio(factor))
    n = len(at)
    sa, sv, sl = (np.zeros(n, np.int32) for _ in range(3))
    sa[at] = scores
    for i in at:
        t, loc = times[i], locs[i]
        if started:
            if t is not None and last_time is not None and t - last_time <= max_gap:
                sv[i] = 1
            if loc != first_loc:
                sl[i] = 1
        else:
            started, first_loc = True, loc
        last_time = t
    out, start = [], 0
    for chunk, size in zip(chunks, sizes):
        part = slice(start, start + size)
        out.append(chunk[_INPUT_NAMES].assign(amount_score=sa[part], velocity_score=sv[part], location_score=sl[part]))
        start += size
    return out, (str(total), int(cnt), None if last_time is None else int(last_time), first_loc)


class DetectorProcessor(StatefulProcessor):
    """Amount, velocity and location scores per user, state kept across batches."""

    def __init__(self, factor: float = AMOUNT_FACTOR, max_gap: int = VELOCITY_MAX_GAP,
                 ttl_ms: int | None = None):
        self.factor = float(factor)
        self.max_gap = int(max_gap)
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("detectors", STATE_SCHEMA, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        out, new_state = fold_user(list(rows), self.state.get(), self.factor, self.max_gap)
        self.state.update(new_state)
        yield from out

    def close(self) -> None:
        pass


def _source(txns: DataFrame) -> DataFrame:
    extras = F.col("extras") if "extras" in txns.columns else F.lit(None).cast("string").alias("extras")
    # Units as text: a long column with nulls would reach pandas as doubles.
    return txns.select(*CANONICAL, extras, *(["partition"] if "partition" in txns.columns else []), micro_units("amount").cast("string").alias("units_text"))


def score_with_state(txns: DataFrame, factor: float = AMOUNT_FACTOR, max_gap: int = VELOCITY_MAX_GAP,
                     ttl_ms: int | None = None) -> DataFrame:
    """Score a (streaming or batch) frame of canonical transactions with keyed state."""
    src = _source(txns)
    if not src.isStreaming:
        # The state store coordinator is started with the streaming query manager.
        _ = src.sparkSession.streams.active
    return src.groupBy("user_id").transformWithStateInPandas(
        statefulProcessor=DetectorProcessor(factor, max_gap, ttl_ms),
        outputStructType=WIDE_SCHEMA, outputMode="Append", timeMode="None")


def score_with_group_state(txns: DataFrame, factor: float = AMOUNT_FACTOR,
                           max_gap: int = VELOCITY_MAX_GAP, ttl_ms: int | None = None) -> DataFrame:
    """The same detectors on the older ``applyInPandasWithState`` API (streams only).

    The group state travels with the Arrow batches instead of through the state
    server, which is cheaper per user. With ``ttl_ms`` a user's state is dropped
    after that much processing time without transactions (its next one starts
    fresh), which bounds the state of users who stop transacting. Timeouts fire
    in micro-batches without data, so use TTL with a processing-time trigger
    (an available-now run keeps running them and does not finish).
    """
    def fn(key, pdfs, state):
        if state.hasTimedOut:
            state.remove()
            return
        stored = state.get if state.exists else None
        out, new_state = fold_user(list(pdfs), stored, factor, max_gap)
        state.update(new_state)
        if ttl_ms:
            state.setTimeoutDuration(int(ttl_ms))
        yield from out

    timeout = "ProcessingTimeTimeout" if ttl_ms else "NoTimeout"
    return _source(txns).groupBy("user_id").applyInPandasWithState(
        fn, WIDE_SCHEMA, STATE_SCHEMA, "append", timeout)
