"""Plug-in detectors on streams: keyed state, a start from history, and a state table that spreads a hot user over tasks.

* :func:`score_stream`: any detectors as one keyed stateful operator (``transformWithStateInPandas``). A user's rows of
  a micro-batch are one task's. It can go on from the end states of a batch run.
* :class:`TableScorer`: for users with so many rows that one task is too few. The states are a versioned table, and each
  micro-batch is scored like a table, hot users in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.plugin import Detector, dump, input_columns, input_names, last_states, score_with, start
from ..sources.versioned import VersionedTable

STATE = T.StructType([T.StructField("states", T.StringType())])


def _plain(column: pd.Series) -> list:
    return [None if v is None or v != v else v for v in column.tolist()]


class PluginProcessor(StatefulProcessor):
    """Scores a user's rows by all detectors; their states are one JSON text per user."""

    def __init__(self, detectors: list[Detector], kept: list[str], order: list[str]):
        self.detectors, self.kept, self.order = detectors, kept, order
        self.names, self.longs = input_names(detectors), set()

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("plugins", STATE)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.state.update((initialState["state"].iloc[0],))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        chunks = list(rows)  # held until their order is known
        at = np.lexsort([np.concatenate([c[o].to_numpy() for c in chunks]) for o in reversed(self.order)])
        stored = self.state.get()
        states = start(self.detectors, stored[0] if stored else None)
        scores = []
        for k, d in enumerate(self.detectors):
            columns = {n: [v for c in chunks for v in _plain(c[col])] for n, col in self.names[d.name]}
            columns = {n: [int(x) if x is not None and f"{d.name}/{n}" in self.longs else x for x in v] for n, v in columns.items()}
            part, states[k] = d.step(states[k], {n: [v[i] for i in at] for n, v in columns.items()})
            out = np.zeros(len(at), np.int32)
            out[at] = part
            scores.append(out)
        self.state.update((dump(states),))
        begin = 0
        for c in chunks:
            yield c[self.kept].assign(**{f"{d.name}_score": s[begin:begin + len(c)] for d, s in zip(self.detectors, scores)})
            begin += len(c)

    def close(self) -> None:
        pass


def score_stream(txns: DataFrame, detectors: list[Detector], key: str = "user_id", order: tuple[str, ...] = ("seq",),
                 initial: DataFrame | None = None) -> DataFrame:
    """``txns`` (a stream, or a table) plus a score column for each detector, states kept between micro-batches.

    ``initial`` (key, state), as ``operators.plugin.end_states`` gives it, is where a new query starts: history is scored
    as a table and the stream goes on from there. Whole-number inputs travel as text, so that nulls beside them cost no digits.
    """
    kept = [f for f in txns.schema.fields]
    inputs = txns.withColumns(input_columns(detectors))
    processor = PluginProcessor(detectors, [f.name for f in kept], list(order))
    for d in detectors:
        for n, c in processor.names[d.name]:
            if isinstance(inputs.schema[c].dataType, (T.LongType, T.IntegerType)):
                processor.longs.add(f"{d.name}/{n}")
                inputs = inputs.withColumn(c, F.col(c).cast("string"))
    if not txns.isStreaming:
        _ = txns.sparkSession.streams.active  # starts the state store coordinator
    schema = T.StructType(kept + [T.StructField(f"{d.name}_score", T.IntegerType()) for d in detectors])
    more = {} if initial is None else {"initialState": initial.select(key, "state").groupBy(key)}
    return inputs.groupBy(key).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode="None", **more)


def _newest(key: str):
    def merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy(key).agg(F.max_by("state", "version").alias("state"), F.max("version").alias("version"))
    return merge


class TableScorer:
    """``foreachBatch`` function: scores micro-batches by detectors whose states are a versioned table under ``path``.

    A micro-batch is scored by ``score_with``: a user with more than ``rows_per_block`` of its rows is cut into
    blocks over many tasks, carried from its stored state. Scored rows go to ``path/scored``, a folder per micro-batch, and the new
    states of its users are a delta of the table; the manifest of the commit names both, so a reader
    sees all of a micro-batch or nothing, and a replayed micro-batch that was committed changes nothing. Only the
    states of the micro-batch's users are read into the join; every ``compact_every`` micro-batches the deltas are merged.
    """

    def __init__(self, spark, path: str, detectors: list[Detector], key: str = "user_id", order: str = "seq",
                 rows_per_block: int | None = None, compact_every: int = 20):
        self.spark, self.path, self.detectors = spark, path.rstrip("/"), detectors
        self.key, self.order, self.rows_per_block = key, order, rows_per_block
        self.table = VersionedTable(spark, f"{self.path}/states", _newest(key), compact_every)

    def start_from(self, states: DataFrame) -> None:
        """States (key, state) to begin with, such as the end of a batch run over the history; before the first micro-batch."""
        self.table.commit(0, states.select(self.key, "state", F.lit(0).cast("long").alias("version")), {"scored": []})

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        version = int(batch_id) + 1
        live = self.table.manifest()
        if live and live["version"] >= version:
            return
        users = batch.select(F.col(self.key).alias("_u")).distinct()
        states = self.table.read()
        if states is not None:
            states = states.join(users, F.col(self.key).eqNullSafe(F.col("_u")), "left_semi").select(self.key, "state")
        name = f"batch={int(batch_id)}"
        scored = score_with(batch, self.detectors, self.key, self.order, self.rows_per_block, states, keep_state=True)
        scored.write.mode("overwrite").parquet(f"{self.path}/scored/{name}")
        done = self.spark.read.schema(scored.schema).parquet(f"{self.path}/scored/{name}")
        delta = last_states(done, self.key).withColumn("version", F.lit(version).cast("long"))
        # Names of batches from 0 on would make the manifest grow: the first and last id say the same.
        self.table.commit(version, delta, {"last_batch": int(batch_id)})

    def scored(self) -> DataFrame | None:
        """Rows of all committed micro-batches."""
        live = self.table.manifest()
        if not live or "last_batch" not in live["info"]:
            return None
        rows = self.spark.read.option("basePath", f"{self.path}/scored").parquet(f"{self.path}/scored")
        return rows.filter(F.col("batch") <= live["info"]["last_batch"]).drop("batch", "_state", "blk")

    def states(self) -> DataFrame | None:
        """(key, state) of every user."""
        rows = self.table.read()
        return None if rows is None else rows.select(self.key, "state")
