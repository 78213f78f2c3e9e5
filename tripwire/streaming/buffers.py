"""Keyed buffers with event-time timers: windows that keep late rows, and a fold over records that arrive out of order.

Both hold a key's rows in list state until the watermark says that no earlier row is due. Rows that come even later
are an output of their own instead of being dropped, so that every input row is in one of the two outputs.
Rows travel as JSON text; results are typed again outside the operator, by built-in functions.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.plugin import Detector, dump, start

ROW = T.StructType([T.StructField("at", T.LongType()), T.StructField("body", T.StringType())])
_NUMBERS = {"NaN": float("nan"), "Infinity": float("inf"), "-Infinity": float("-inf")}


def _body(columns: dict[str, Column]) -> Column:
    return F.to_json(F.struct(*(c.alias(n) for n, c in columns.items())), {"ignoreNullFields": "false"})


def _typed(text: Column, schema: T.StructType) -> Column:
    return F.from_json(text, schema, {"mode": "FAILFAST"})


def _timed(df: DataFrame, time: Column, watermark: str) -> DataFrame:
    """``df`` with ``event_ms``, its event time in milliseconds, and a watermark.

    The operators take the watermark from the query, but their rows carry the plain number: Spark itself
    then drops no late row before they see it.
    """
    return df.withColumn("_t", time).withWatermark("_t", watermark).withColumn("event_ms", F.unix_millis("_t")).drop("_t")


# --------------------------------------------------------------------- windows

class WindowProcessor(StatefulProcessor):
    """Tumbling event-time windows: the rows until their window ends, then ``fn(key, start, rows)`` once for each key.

    One timer, at the next end that is due, serves all windows of a state key.
    """

    def __init__(self, size_ms: int, keys: list[str], fn: Callable[[tuple, int, list[dict]], list[dict]]):
        self.size, self.keys, self.fn = size_ms, keys, fn

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.rows = handle, handle.getListState("rows", ROW)

    def _end(self, at: int) -> int:
        return at // self.size * self.size + self.size

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now, late, held = timerValues.getCurrentWatermarkInMs(), [], []
        for chunk in rows:
            for at, body in zip(chunk["event_ms"].tolist(), chunk["body_json"].tolist()):
                if self._end(at) <= now:
                    late.append(body)
                else:
                    held.append((at, body))
        if held:
            self.rows.appendList(held)
            self.handle.registerTimer(min(self._end(at) for at, _ in held))
        yield self._out(late=late)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, due, rest = timerValues.getCurrentWatermarkInMs(), {}, []
        for at, body in self.rows.get():
            if self._end(at) <= now:
                row = json.loads(body)
                due.setdefault((self._end(at) - self.size, tuple(row[k] for k in self.keys)), []).append(row)
            else:
                rest.append((at, body))
        if not due:  # an earlier timer of this micro-batch took them
            return
        if rest:
            self.rows.put(rest)
            self.handle.registerTimer(min(self._end(at) for at, _ in rest))
        else:
            self.rows.clear()
        yield self._out(result=[json.dumps(r) for (begin, of), found in due.items() for r in self.fn(of, begin // 1000, found)])

    @staticmethod
    def _out(result: list[str] = (), late: list[str] = ()) -> pd.DataFrame:
        return pd.DataFrame({"result": [*result] + [None] * len(late), "late": [None] * len(result) + [*late]}, dtype=object)

    def close(self) -> None:
        pass


def window_stream(df: DataFrame, keys: list[str], time: Column, seconds: int, watermark: str,
                  fn: Callable[[tuple, int, list[dict]], list[dict]], schema: T.StructType, buckets: int | None = None) -> DataFrame:
    """Each tumbling window of each key through a function of the user's, and the rows that come after their window.

    ``fn(key, window start in epoch seconds, rows)`` gets a window's rows as dicts (all columns of ``df``, in no set order) once the
    watermark passes its end, and gives dicts of ``schema``. The result has two columns: ``result`` (a struct of
    ``schema``) and ``late`` (a struct of the columns of ``df``), of which one is null. ``fn`` sees a window whole, so
    a key's rows of one window must fit a task, as in any whole-window function. State is kept by key, or, for very many keys
    of a few rows each, as transactions are, by ``buckets`` of keys: far fewer calls to the state store, but a bucket's open rows
    are read whole whenever one of its windows ends.
    """
    body = _body({c: F.col(c) for c in df.columns}).alias("body_json")
    timed = _timed(df, time, watermark)
    if buckets:
        rows, by = timed.select(F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("bucket"), "event_ms", body), ["bucket"]
    else:
        rows, by = timed.select(*keys, "event_ms", body), keys
    out = rows.groupBy(*by).transformWithStateInPandas(
        statefulProcessor=WindowProcessor(seconds * 1000, keys, fn), outputStructType="result string, late string", outputMode="Append", timeMode="EventTime")
    return out.select(_typed(F.col("result"), schema).alias("result"), _typed(F.col("late"), df.schema).alias("late"))


def sum_scores(threshold: int):
    """Whole-window function of the reference's aggregator: scores summed, the payload of the last row, the label by threshold."""
    def fn(key, begin: int, rows: list[dict]) -> list[dict]:
        base = max(rows, key=lambda r: r["seq"])
        total = sum(r["fraud_score"] or 0 for r in rows)
        return [{**base, "window_start": begin, "fraud_score": total, "detected": total >= threshold,
                 "transaction_type": "Fraud" if total >= threshold else base["transaction_type"]}]
    return fn


def two_outputs(write_results: Callable[[DataFrame, int], None], write_late: Callable[[DataFrame, int], None]):
    """``foreachBatch`` function for rows of ``window_stream`` or ``in_order``: results to one writer, late rows to another."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            write_results(batch.filter(F.col("result").isNotNull()).select("result.*"), batch_id)
            write_late(batch.filter(F.col("late").isNotNull()).select("late.*"), batch_id)
        finally:
            batch.unpersist()
    return write


# --------------------------------------------------------------------- order

class OrderedProcessor(StatefulProcessor):
    """Holds rows until the watermark passes their time, then folds each key's by the detectors, in order of time.

    A state key is a key, or a bucket of keys: its open rows and its keys' folded states are read and written together.
    """

    def __init__(self, detectors: list[Detector]):
        self.detectors = detectors

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", ROW)
        self.folded = handle.getListState("folded", T.StructType([T.StructField(c, T.StringType()) for c in ("key", "states", "last")]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last = {of: json.loads(order) for of, _, order in self.folded.get()}
        late, held = [], []
        for chunk in rows:
            for at, body in zip(chunk["event_ms"].tolist(), chunk["body_json"].tolist()):
                row = json.loads(body) if last else None
                (late if last and (until := last.get(row["key"].get("k"))) is not None and row["order"] <= until else held).append((at, body))
        if held:
            self.rows.appendList(held)
            self.handle.registerTimer(min(at for at, _ in held) + 1)  # a row goes when the watermark is past its time
        yield self._out([json.loads(b)["row"]["r"] for _, b in late], [[None] * len(late) for _ in self.detectors], True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, due, rest = timerValues.getCurrentWatermarkInMs(), {}, []
        for at, body in self.rows.get():
            if at < now:
                row = json.loads(body)
                due.setdefault(row["key"].get("k"), []).append(row)
            else:
                rest.append((at, body))
        if not due:  # an earlier timer of this micro-batch took them
            return
        if rest:
            self.rows.put(rest)
            self.handle.registerTimer(min(at for at, _ in rest) + 1)
        else:
            self.rows.clear()
        folded = {of: (states, order) for of, states, order in self.folded.get()}
        rows, scores = [], [[] for _ in self.detectors]
        for of, bodies in due.items():
            bodies.sort(key=lambda b: b["order"])
            states = start(self.detectors, folded[of][0] if of in folded else None)
            for k, d in enumerate(self.detectors):
                columns = {n: [_NUMBERS.get(v, v) if isinstance(v, str) and number else v for v in (b["in"][k][n] for b in bodies)]
                           for n, number in self.numbers[k].items()}
                part, states[k] = d.step(states[k], columns)
                scores[k] += part
            folded[of] = (dump(states), json.dumps(bodies[-1]["order"]))
            rows += [b["row"]["r"] for b in bodies]
        self.folded.put([(of, *x) for of, x in folded.items()])
        yield self._out(rows, scores, False)

    def _out(self, rows: list, scores: list[list], late: bool) -> pd.DataFrame:
        out = {"row": pd.Series(rows, dtype=object), "is_late": pd.Series([late] * len(rows), dtype=bool)}
        return pd.DataFrame(out | {f"{d.name}_score": pd.array(s, "Int32") for d, s in zip(self.detectors, scores)})

    def close(self) -> None:
        pass


def in_order(df: DataFrame, detectors: list[Detector], time: Column, order: list[str], watermark: str, key: str = "user_id",
             buckets: int | None = None) -> DataFrame:
    """Detector scores of a stream whose rows of one key come through several partitions, in any interleaving.

    A row is held until the watermark passes its ``time``; then a key's rows are folded in order of (time, ``order``).
    ``order`` are whole-number columns that tell rows of one time apart. So however its partitions are
    interleaved within the watermark's delay, a key's scores are those of its rows in order. The result has
    ``result`` (columns of ``df`` and the scores) and ``late`` (columns of ``df``; rows that came after a later row was
    folded), of which one is null. State is kept by key, or, for many keys, by ``buckets`` of keys: far fewer calls to the
    state store, but a bucket's open rows are read whole whenever one is due.
    """
    names = {c: F.col(c) for c in df.columns}
    parts = [F.to_json(F.struct(*(c.alias(n) for n, c in d.inputs().items())), {"ignoreNullFields": "false"}) for d in detectors]
    timed = _timed(df, time, watermark)
    body = F.concat(F.lit('{"key":'), F.to_json(F.struct(F.col(key).cast("string").alias("k"))), F.lit(',"order":['), F.concat_ws(",", F.col("event_ms").cast("string"), *(F.coalesce(F.col(c).cast("long"), F.lit(0)).cast("string") for c in order)),
                    F.lit('],"in":['), F.concat_ws(",", *parts), F.lit('],"row":'), F.to_json(F.struct(F.to_json(F.struct(*(c.alias(n) for n, c in names.items())),
                                                                                                   {"ignoreNullFields": "false"}).alias("r"))), F.lit("}"))
    processor = OrderedProcessor(detectors)
    types = df.select(*(c.alias(f"{k}/{n}") for k, d in enumerate(detectors) for n, c in d.inputs().items())).schema
    processor.numbers = [{n: isinstance(types[f"{k}/{n}"].dataType, (T.DoubleType, T.FloatType)) for n in d.inputs()} for k, d in enumerate(detectors)]
    by = F.pmod(F.xxhash64(key), F.lit(buckets)).alias("bucket") if buckets else F.col(key)
    out = timed.select(by, "event_ms", body.alias("body_json")).groupBy("bucket" if buckets else key).transformWithStateInPandas(
        statefulProcessor=processor, outputMode="Append", timeMode="EventTime",
        outputStructType="row string, is_late boolean, " + ", ".join(f"{d.name}_score int" for d in detectors))
    row = _typed(F.col("row"), df.schema)
    result = T.StructType(df.schema.fields)
    scored = F.struct(*(row.getField(f.name).alias(f.name) for f in result.fields), *(F.col(f"{d.name}_score") for d in detectors))
    return out.select(F.when(~F.col("is_late"), scored).alias("result"), F.when(F.col("is_late"), row).alias("late"))
