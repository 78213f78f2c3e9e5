"""Detectors as plug-ins: given once, run on tables (hot users in blocks) and on streams.

A detector reads some columns of a user's transactions in arrival order and scores each from a state
that it carries along. :func:`score_with` compiles detectors to one shuffle, one sort and one Arrow fold;
``streaming.detect`` compiles the same objects to stream state. To add one, subclass :class:`Detector`.
"""

from __future__ import annotations

import json
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .amount import Margin, exact_units, fold, fold_all, micro_units, ratio
from .sequence import BLK, cut_blocks, on_block

#: Rounds in which the entry states of a hot user's blocks must settle (each settles one block at least).
MAX_ROUNDS = 1_000_000


class Detector:
    """One detector. States and carries are JSON values (lists, texts, whole numbers of any size, None).

    ``inputs`` and ``step`` make a detector; a hot user's blocks are then folded one after another. With ``carry`` and
    ``merge`` they are folded side by side: ``carry`` says what a block does, folded from some entry, and
    ``merge`` gives ``(state,)``, the state after the block from another entry, or None if the block must be folded again from that.
    """

    name: str  #: the score column is called <name>_score

    def inputs(self) -> dict[str, Column]:
        """Columns that the fold needs, by name, as expressions over a transaction."""
        raise NotImplementedError

    def init(self) -> Any:
        """State before a user's first row."""
        return None

    def step(self, state: Any, rows: dict[str, list]) -> tuple[list[int], Any]:
        """Scores of a stretch of a user's rows (a list per input, in arrival order), and the state after it."""
        raise NotImplementedError

    def carry(self, state: Any, rows: dict[str, list]) -> Any:
        return [state, self.step(state, rows)[1]]

    def merge(self, state: Any, carry: Any) -> tuple | None:
        return (carry[1],) if carry[0] == state else None

    def guess(self, state: Any, carry: Any) -> Any:
        """State that probably follows a block whose carry does not hold; it only saves rounds."""
        return carry[1]


class AmountDetector(Detector):
    """1 if the amount is ``factor`` times the average of the user's earlier unflagged amounts, or more."""

    name = "amount"

    def __init__(self, factor: float = 3.0):
        self.factor = ratio(factor)

    def inputs(self):
        return {"units": micro_units("amount"), "amount": F.col("amount")}

    def init(self):
        return [0, 0]

    def _units(self, rows):
        return [exact_units(u, a) for u, a in zip(rows["units"], rows["amount"])]

    def step(self, state, rows):
        scores, total, count = fold(self._units(rows), *state, self.factor)
        return scores, [total, count]

    def carry(self, state, rows):
        units = self._units(rows)
        scores, total, count = fold(units, *state, self.factor)
        margin = Margin()
        margin.add(units, scores, *state, self.factor)
        return [state, [total - state[0], count - state[1]], margin.flagged, margin.kept]

    def merge(self, state, carry):
        entry, delta, flagged, kept = carry
        if (state[1] > 0) != (entry[1] > 0):
            return None
        if state != entry and not Margin(flagged, kept).holds(state[0] - entry[0], state[1] - entry[1], self.factor):
            return None
        return (self.guess(state, carry),)

    def guess(self, state, carry):
        return [state[0] + carry[1][0], state[1] + carry[1][1]]


class AverageOfAllDetector(AmountDetector):
    """Documented variant: the average of *all* earlier amounts, flagged ones too."""

    name = "amount_all"

    def step(self, state, rows):
        scores, total, count = fold_all(self._units(rows), *state, self.factor)
        return scores, [total, count]

    def carry(self, state, rows):
        units = [u for u in self._units(rows) if u is not None]
        return [sum(units), len(units)]

    def merge(self, state, carry):
        return ([state[0] + carry[0], state[1] + carry[1]],)


class VelocityDetector(Detector):
    """1 if a transaction comes ``max_gap`` seconds or less after the one before (earlier times too)."""

    name = "velocity"

    def __init__(self, max_gap: int = 20):
        self.max_gap = max_gap

    def inputs(self):
        return {"time": F.col("txn_time")}

    def step(self, state, rows):
        scores, last = [], state
        for t in rows["time"]:
            scores.append(int(last is not None and t is not None and last[0] is not None and t - last[0] <= self.max_gap))
            last = [t]
        return scores, last

    def carry(self, state, rows):
        return [rows["time"][-1]] if rows["time"] else None

    def merge(self, state, carry):
        return (carry or state,)


class LocationDetector(Detector):
    """1 if the location differs from the user's first."""

    name = "location"

    def inputs(self):
        return {"location": F.col("location")}

    def step(self, state, rows):
        scores = []
        for loc in rows["location"]:
            scores.append(int(state is not None and loc != state[0]))
            state = state or [loc]
        return scores, state

    def carry(self, state, rows):
        return rows["location"][:1] or None

    def merge(self, state, carry):
        return (state or carry,)


def standard(factor: float = 3.0, max_gap: int = 20) -> list[Detector]:
    """The reference's three detectors."""
    return [AmountDetector(factor), VelocityDetector(max_gap), LocationDetector()]


# ------------------------------------------------------------------ compilation

def input_columns(detectors: list[Detector]) -> dict[str, Column]:
    """All inputs, as columns ``input_<detector>_<input>` (stream state takes no names that begin with an underscore)`."""
    return {f"input_{d.name}_{n}": c for d in detectors for n, c in d.inputs().items()}


def input_names(detectors: list[Detector]) -> dict[str, list[tuple[str, str]]]:
    """Per detector its (input, column) names, for the Python side."""
    return {d.name: [(n, f"input_{d.name}_{n}") for n in d.inputs()] for d in detectors}


def dump(states: list) -> str:
    return json.dumps(states, separators=(",", ":"))


def start(detectors: list[Detector], text: str | None) -> list:
    """States from their text; a user's first ones for None."""
    return json.loads(text or dump([d.init() for d in detectors]))


def _stretches(batch: pa.RecordBatch, key: str):
    """(start, end) of the stretches of equal (key, blk)."""
    keys, blks = batch.column(key).to_pylist(), batch.column(BLK).to_pylist()
    begin = 0
    for i in range(1, len(keys) + 1):
        if i == len(keys) or keys[i] != keys[begin] or blks[i] != blks[begin]:
            yield (keys[begin], blks[begin]), begin, i
            begin = i


def _scored(detectors: list[Detector], names: dict, key: str, drop: list[str], keep_state: bool):
    """mapInArrow function over rows sorted by (key, blk, order): adds the scores, and the states at each block's last row."""
    def run(batches):
        cur, states = None, []
        for batch in batches:
            entry = batch.column("_entry")
            ends = batch.column("_last") if keep_state else None
            columns = {c: batch.column(c).to_pylist() for pairs in names.values() for _, c in pairs}
            scores: list[list[int]] = [[] for _ in detectors]
            after: list[str | None] = []
            for block, a, b in _stretches(batch, key):
                if block != cur:
                    cur, states = block, start(detectors, entry[a].as_py())
                for k, d in enumerate(detectors):
                    part, states[k] = d.step(states[k], {n: columns[c][a:b] for n, c in names[d.name]})
                    scores[k] += part
                after += [None] * (b - a - 1) + [dump(states) if keep_state and ends[b - 1].as_py() else None]
            kept = [n for n in batch.schema.names if n not in drop]
            out = [batch.column(n) for n in kept] + [pa.array(s, pa.int32()) for s in scores]
            yield pa.RecordBatch.from_arrays(out + ([pa.array(after, pa.string())] if keep_state else []),
                                             kept + [f"{d.name}_score" for d in detectors] + (["_state"] if keep_state else []))
    return run


def _carries(detectors: list[Detector], names: dict, key: str, schema: T.StructType):
    """mapInArrow function: one row a block, what it does when folded from its entry. A block's rows are gathered (they are bounded)."""
    arrow = to_arrow_schema(schema)

    def run(batches):
        cur, first, held, done = None, None, {}, []

        def close():
            states = start(detectors, first)
            return [*cur, dump([d.carry(s, {n: held[c] for n, c in names[d.name]}) for d, s in zip(detectors, states)])]

        for batch in batches:
            columns = {c: batch.column(c).to_pylist() for pairs in names.values() for _, c in pairs}
            for block, a, b in _stretches(batch, key):
                if block != cur:
                    if cur is not None:
                        done.append(close())
                    cur, first, held = block, batch.column("_entry")[a].as_py(), {c: [] for c in columns}
                for c, v in columns.items():
                    held[c] += v[a:b]
        if cur is not None:
            done.append(close())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), arrow)], schema=arrow)
    return run


def _walk(detectors: list[Detector], key: str):
    """applyInPandas function over one user's block table: the entry of each block as far as known, and which to fold (again)."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(BLK)
        first = pdf["_first"].iloc[0]
        states, rows = start(detectors, first if isinstance(first, str) else None), []
        for blk, text in zip(pdf[BLK], pdf["_carry"]):
            carries = json.loads(text) if isinstance(text, str) else None
            entry, again = dump(states), carries is None
            for k, d in enumerate(detectors):
                if carries:
                    after = d.merge(states[k], carries[k])
                    again = again or after is None
                    states[k] = d.guess(states[k], carries[k]) if after is None else after[0]
            rows.append((blk, entry, again))
        return pd.DataFrame({key: pdf[key].tolist(), BLK: [r[0] for r in rows], "_entry": [r[1] for r in rows], "_again": [r[2] for r in rows]})
    return run


def block_states(rows: DataFrame, detectors: list[Detector], key: str, order: str, initial: DataFrame | None) -> DataFrame:
    """(key, blk, _entry): entry states of the hot users' blocks. ``rows`` are theirs: key, blk, order and the inputs.

    All blocks are folded side by side from guessed entries; a walk over each user's block table (one row a
    block) merges what they do; blocks whose carry doesn't hold for their entry are folded again, all at once.
    The first of them has its true entry, so each round settles one block at least.
    """
    names = input_names(detectors)
    rows = rows.repartition(key, BLK).sortWithinPartitions(key, BLK, order).checkpoint()
    table = rows.select(key, BLK).distinct()
    if initial is not None:
        i = initial.select(F.col(key).alias("_ik"), F.col("_entry").alias("_first"))
        table = table.join(i, F.col(key).eqNullSafe(F.col("_ik")), "left").drop("_ik")
    else:
        table = table.withColumn("_first", F.lit(None).cast("string"))
    table = table.withColumn("_carry", F.lit(None).cast("string")).checkpoint()
    field = table.schema[key]
    plan_schema = T.StructType([field, T.StructField(BLK, T.LongType()), T.StructField("_entry", T.StringType()), T.StructField("_again", T.BooleanType())])
    new_schema = T.StructType([field, T.StructField(BLK, T.LongType()), T.StructField("_carry", T.StringType())])
    for _ in range(MAX_ROUNDS):
        plan = table.groupBy(key).applyInPandas(_walk(detectors, key), plan_schema).checkpoint()
        todo = plan.filter("_again")
        if todo.isEmpty():
            return plan.drop("_again")
        src = (rows.alias("_r").join(todo.alias("_e"), on_block("_r", "_e", key)).select("_r.*", "_e._entry")
               .repartition(key, BLK).sortWithinPartitions(key, BLK, order))
        new = src.mapInArrow(_carries(detectors, names, key, new_schema), new_schema).alias("_n")
        table = (table.alias("_t").join(new, on_block("_t", "_n", key), "left")
                 .select(f"_t.{key}", f"_t.{BLK}", "_t._first", F.coalesce("_n._carry", "_t._carry").alias("_carry")).checkpoint())
    raise RuntimeError("block states did not settle")


def score_with(df: DataFrame, detectors: list[Detector], key: str = "user_id", order: str = "seq",
               rows_per_block: int | None = None, initial: DataFrame | None = None, keep_state: bool = False) -> DataFrame:
    """``df`` plus one ``<name>_score`` column (int) for each detector, in one pass over rows partitioned by user.

    ``initial`` (key, state) are the states to go on from, as ``end_states`` gives them. ``keep_state`` adds
    ``_state``, the states after each block, at its last row (null elsewhere), and ``blk``.
    """
    names = input_names(detectors)
    blocks = cut_blocks(df.withColumns(input_columns(detectors)), key, order, rows_per_block)
    rows = blocks.df
    entry = F.lit(None).cast("string")
    if initial is not None:
        initial = initial.select(F.col(key), F.col("state").alias("_entry"))
        i = initial.select(F.col(key).alias("_ik"), F.col("_entry").alias("_first"))
        rows = rows.join(i, F.col(key).eqNullSafe(F.col("_ik")), "left").drop("_ik")
        entry = F.col("_first")
    if blocks.hot:
        inputs = [c for pairs in names.values() for _, c in pairs]
        known = block_states(blocks.df.filter(F.col(BLK) > 0).select(key, BLK, order, *inputs), detectors, key, order, initial)
        rows = rows.alias("_r").join(known.alias("_e"), on_block("_r", "_e", key), "left").select("_r.*", F.col("_e._entry").alias("_known"))
        entry = F.coalesce("_known", entry)
    rows = rows.withColumn("_entry", entry).drop("_first", "_known").repartition(key, BLK)
    if keep_state:
        rows = rows.withColumn("_last", F.lead(F.lit(1)).over(blocks.window()).isNull())
    drop = ["_entry", "_last", *(c for pairs in names.values() for _, c in pairs)]
    schema = T.StructType([f for f in rows.schema.fields if f.name not in drop] + [T.StructField(f"{d.name}_score", T.IntegerType()) for d in detectors]
                          + ([T.StructField("_state", T.StringType())] if keep_state else []))
    out = rows.sortWithinPartitions(key, BLK, order).mapInArrow(_scored(detectors, names, key, drop, keep_state), schema)
    return out if keep_state else out.drop(BLK)


def last_states(scored: DataFrame, key: str = "user_id") -> DataFrame:
    """(key, state) from rows that ``score_with`` made with ``keep_state``."""
    return scored.filter(F.col("_state").isNotNull()).groupBy(key).agg(F.max_by("_state", BLK).alias("state"))


def end_states(df: DataFrame, detectors: list[Detector], key: str = "user_id", order: str = "seq", **options) -> DataFrame:
    """(key, state) of every user after all rows of ``df``: what a stream or a later batch goes on from."""
    return last_states(score_with(df, detectors, key, order, keep_state=True, **options), key)
