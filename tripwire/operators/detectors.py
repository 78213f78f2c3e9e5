"""The three per-user detectors (amount, velocity, location) and their variants.

Input: canonical transactions (``seq`` = arrival order). Every detector keys by
``user_id`` and walks a user's rows in ``seq`` order, through
:mod:`.sequence` blocks so a hot user is spread over many tasks.

* velocity and location are windows (JVM, whole-stage codegen);
* amount has feedback (a flagged amount is left out of the average the next
  rows are judged by), so it is a sorted left fold in Arrow batches
  (:mod:`.amount`) that never holds a user whole and hands all columns but its own
  through untouched; the entry states of a hot user's blocks are found first, see
  :func:`block_entries`.
"""

from __future__ import annotations

import logging

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.scalar import location_differs
from .amount import Margin, exact_units, fold, micro_units, ratio
from .sequence import BLK, Blocks, HotKeys, by_blocks, cut_blocks, on_block, with_carry

# The reference thresholds (parameters everywhere below).
AMOUNT_FACTOR = 3.0
VELOCITY_MAX_GAP = 20

log = logging.getLogger(__name__)

SCORE_COLUMNS = {"amount": "amount_score", "velocity": "velocity_score", "location": "location_score"}
_CARRY_FIELDS = ["txn_time", "location"]
_HELPER_COLS = ["has_prev", "prev_last", "first_row", "pre_sum", "pre_cnt", "pre_amounts", "_rn"]


# --------------------------------------------------------------------- windows

def _windowed(blocks: Blocks) -> DataFrame:
    """Rows with carries and the in-block row number (one exchange on key, blk)."""
    df = with_carry(blocks, _CARRY_FIELDS)
    return df.withColumn("_rn", F.row_number().over(blocks.window()))


def _is_user_first(_: Blocks) -> Column:
    return (F.col("_rn") == 1) & ~F.col("has_prev")


def velocity_score(blocks: Blocks, max_gap: int = VELOCITY_MAX_GAP) -> Column:
    """1 if ``txn_time - previous txn_time <= max_gap`` (negative gaps too); first row 0."""
    prev = F.when(F.col("_rn") == 1, F.col("prev_last.txn_time")).otherwise(
        F.lag("txn_time").over(blocks.window()))
    hit = (F.col("txn_time") - prev) <= F.lit(max_gap)
    return F.when(_is_user_first(blocks), 0).otherwise(F.coalesce(hit.cast("int"), F.lit(0)))


def location_score(blocks: Blocks) -> Column:
    """1 if the location differs from the user's first location (case-sensitive, null-safe)."""
    first_in_block = F.first("location").over(
        blocks.window().rowsBetween(Window.unboundedPreceding, Window.currentRow))
    first_loc = F.when(F.col("has_prev"), F.col("first_row.location")).otherwise(first_in_block)
    return F.when(_is_user_first(blocks), 0).otherwise(location_differs("location", first_loc).cast("int"))


def location_prev_score(blocks: Blocks) -> Column:
    """Documented variant: 1 if the location differs from the previous row's."""
    prev = F.when(F.col("_rn") == 1, F.col("prev_last.location")).otherwise(
        F.lag("location").over(blocks.window()))
    return F.when(_is_user_first(blocks), 0).otherwise(location_differs("location", prev).cast("int"))


def _drop_helpers(df: DataFrame) -> DataFrame:
    return df.drop(*_HELPER_COLS)


# ---------------------------------------------------------------- amount fold

def _runs(keys: list, blks: list):
    """(start, end) of the stretches of equal (key, blk)."""
    start = 0
    for i in range(1, len(keys) + 1):
        if i == len(keys) or keys[i] != keys[start] or blks[i] != blks[start]:
            yield start, i
            start = i


def _columns(batch: pa.RecordBatch, key: str, order: str):
    units = [exact_units(u, a) for u, a in zip(batch.column("_u").to_pylist(), batch.column("amount").to_pylist())]
    return batch.column(key).to_pylist(), batch.column(BLK).to_pylist(), batch.column(order).to_pylist(), units


def _scores(factor: float, key: str, order: str, entries: bool):
    """mapInArrow function: adds amount_score to rows sorted by (key, blk, order); blocks start from ``_e_total, _e_count`` if given."""
    num_den = ratio(factor)

    def run(batches):
        cur, total, count, last = None, 0, 0, None
        for batch in batches:
            keys, blks, seqs, units = _columns(batch, key, order)
            scores: list[int] = []
            for a, b in _runs(keys, blks):
                if (keys[a], blks[a]) != cur:
                    cur, last, total, count = (keys[a], blks[a]), None, 0, 0
                    if entries and (n := batch.column("_e_count")[a].as_py()):
                        total, count = int(batch.column("_e_total")[a].as_py()), n
                if any(x > y for x, y in zip(seqs[a:b], seqs[a + 1:b])) or last is not None and last > seqs[a]:
                    raise ValueError(f"rows of {cur} are not in {order} order")
                last = seqs[b - 1]
                part, total, count = fold(units[a:b], total, count, num_den)
                scores += part
            kept = [n for n in batch.schema.names if n not in ("_u", "_e_total", "_e_count")]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in kept] + [pa.array(scores, pa.int32())], kept + ["amount_score"])
    return run


#: Totals and margins are whole numbers of any size, hence texts.
_SUMMARY = "f_total string, f_count long, d_total string, d_count long, " + ", ".join(
    f"{side}_{what} string" for side in ("fl", "kp") for what in ("slack", "lo", "hi"))


def _summaries(factor: float, key: str, order: str, schema: T.StructType):
    """mapInArrow function: one row per block, folded from its entry: the entry, what the block adds, and its margins."""
    num_den = ratio(factor)
    arrow = to_arrow_schema(schema)

    def run(batches):
        cur = entry = state = margin = None
        done: list[list] = []

        def close():
            text = lambda t: [None if x is None else str(x) for x in (t or (None,) * 3)]
            done.append([*cur, str(entry[0]), entry[1], str(state[0] - entry[0]), state[1] - entry[1], *text(margin.flagged), *text(margin.kept)])

        for batch in batches:
            keys, blks, _, units = _columns(batch, key, order)
            for a, b in _runs(keys, blks):
                if (keys[a], blks[a]) != cur:
                    if cur is not None:
                        close()
                    cur, margin = (keys[a], blks[a]), Margin()
                    entry = (int(batch.column("_e_total")[a].as_py()), batch.column("_e_count")[a].as_py())
                    state = entry
                part, total, count = fold(units[a:b], *state, num_den)
                margin.add(units[a:b], part, *state, num_den)
                state = (total, count)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), arrow)], schema=arrow)
                done = []
        if cur is not None:
            close()
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), arrow)], schema=arrow)
    return run


def _scan(factor: float, key: str):
    """applyInPandas function over one user's block table: the blocks' entry states as far as known, and which to fold (again)."""
    num, den = ratio(factor)

    def whole(x):
        return None if x is None or x != x else int(x)  # texts, decimals and floats of missing longs

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(BLK)
        total = count = 0
        out = []
        for r in pdf.to_dict("records"):
            n, s, lo, hi = (whole(r[c]) for c in ("n", "s", "lo", "hi"))
            out.append((total, count))
            refold = False
            if not n:
                d = (0, 0)
            else:
                d, folded = None, whole(r["f_count"]) is not None
                if folded:
                    d_total, d_count = total - whole(r["f_total"]), count - whole(r["f_count"])
                    side = lambda p: tuple(whole(r[f"{p}_{c}"]) for c in ("slack", "lo", "hi")) if whole(r[f"{p}_slack"]) is not None else None
                    started = (count > 0) == (whole(r["f_count"]) > 0)
                    if started and (count == 0 or Margin(side("fl"), side("kp")).holds(d_total, d_count, (num, den))):
                        d = (whole(r["d_total"]), whole(r["d_count"]))
                if d is None and count and lo is not None and den * lo * count >= num * total:
                    d = (0, 0)  # all flagged
                if d is None and count and lo is not None and den * hi * count < num * total and den * hi < num * lo:
                    d = (s, n)  # all kept: the average stays above the smaller of its start and lo
                if d is None:
                    refold = True
                    d = (whole(r["d_total"]), whole(r["d_count"])) if folded else (s, n)
            out[-1] += (refold,)
            total, count = total + d[0], count + d[1]
        return pd.DataFrame({key: pdf[key].tolist(), BLK: pdf[BLK].tolist(), "_e_total": [str(x[0]) for x in out],
                             "_e_count": [x[1] for x in out], "_refold": [x[2] for x in out]})
    return run


def block_entries(rows: DataFrame, key: str, order: str, factor: float) -> tuple[DataFrame, int]:
    """Entry state (key, blk, _e_total, _e_count) of every block of the hot users, and the rounds it took.

    ``rows`` are the hot users' (key, blk, order, _u, amount). A table holds for each block the
    count, sum, least and largest of its amounts, and the last fold of it. A scan over a user's
    blocks (one row a block) takes a block's effect from its fold if the fold's margins hold for
    the entry state, or if all its amounts must be flagged or kept; the others are folded again,
    all at once, from the entry states as they are then thought to be. The first of them has its true
    entry, so each round settles one block at least; blocks that settle by their margins or bounds,
    nearly all, need no further round.
    """
    rows = rows.repartition(key, BLK).sortWithinPartitions(key, BLK, order).checkpoint()
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(_SUMMARY).fields]
    table = rows.groupBy(key, BLK).agg(
        F.count("_u").alias("n"), F.sum(F.col("_u").cast("decimal(20,0)")).cast("decimal(38,0)").alias("s"),
        F.min("_u").alias("lo"), F.max("_u").alias("hi"), F.max(F.col("_u").isNull() & F.col("amount").isNotNull()).alias("odd"))
    # Amounts beyond a long are known to the fold only: such a block has no bounds that decide it.
    table = table.select(key, BLK, F.when(F.col("odd"), F.greatest("n", F.lit(1).cast("long"))).otherwise(F.col("n")).alias("n"),
                         F.coalesce("s", F.lit(0)).cast("decimal(38,0)").alias("s"),
                         *[F.when(~F.col("odd"), F.col(c).cast("string")).alias(c) for c in ("lo", "hi")], *none).checkpoint()
    key_field = table.schema[key]
    plan_schema = T.StructType([key_field, T.StructField(BLK, T.LongType()), T.StructField("_e_total", T.StringType()),
                                T.StructField("_e_count", T.LongType()), T.StructField("_refold", T.BooleanType())])
    sum_schema = T.StructType([key_field, T.StructField(BLK, T.LongType())] + T.StructType.fromDDL(_SUMMARY).fields)
    rounds = 0
    while True:
        plan = table.groupBy(key).applyInPandas(_scan(factor, key), plan_schema).checkpoint()
        todo = plan.filter("_refold")
        if todo.isEmpty():
            log.info("amount fold of hot users: settled after %d round(s)", rounds)
            return plan.drop("_refold"), rounds
        rounds += 1
        src = (rows.alias("_r").join(by_blocks(todo).alias("_e"), on_block("_r", "_e", key)).select("_r.*", "_e._e_total", "_e._e_count")
               .repartition(key, BLK).sortWithinPartitions(key, BLK, order))
        new = src.mapInArrow(_summaries(factor, key, order, sum_schema), sum_schema)
        new = by_blocks(new).alias("_n")
        cols = [f.name for f in T.StructType.fromDDL(_SUMMARY).fields]
        table = (table.alias("_t").join(new, on_block("_t", "_n", key), "left")
                 .select(f"_t.{key}", f"_t.{BLK}", "_t.n", "_t.s", "_t.lo", "_t.hi",
                         *[F.when(F.col("_n.f_count").isNotNull(), F.col(f"_n.{c}")).otherwise(F.col(f"_t.{c}")).alias(c) for c in cols])
                 .checkpoint())


def _with_amount(df: DataFrame, blocks: Blocks, factor: float) -> DataFrame:
    """amount_score added to rows of the blocks (in one pass; hot blocks join their entry states first)."""
    key, order = blocks.key, blocks.order
    df = df.withColumn("_u", micro_units("amount"))
    if blocks.hot:
        narrow = blocks.df.filter(F.col(BLK) > 0).select(key, BLK, order, micro_units("amount").alias("_u"), "amount")
        entries, _ = block_entries(narrow, key, order, factor)
        df = (df.alias("_r").join(by_blocks(entries).alias("_e"), on_block("_r", "_e", key), "left").select("_r.*", "_e._e_total", "_e._e_count")
              .repartition(key, BLK))
    schema = T.StructType([f for f in df.schema.fields if f.name not in ("_u", "_e_total", "_e_count")] + [T.StructField("amount_score", T.IntegerType())])
    return df.sortWithinPartitions(key, BLK, order).mapInArrow(_scores(factor, key, order, blocks.hot), schema)


# ------------------------------------------------------------------ public API

def score_all(df: DataFrame, factor: float = AMOUNT_FACTOR, max_gap: int = VELOCITY_MAX_GAP,
              key: str = "user_id", order: str = "seq", rows_per_block: int | None = None, hot: HotKeys | None = None) -> DataFrame:
    """All three detectors in one pass over rows partitioned by user.

    Adds ``amount_score``, ``velocity_score``, ``location_score`` (int 0/1). ``hot`` are
    the hot keys if they are known (``sequence.hot_keys``).
    """
    blocks = cut_blocks(df, key, order, rows_per_block, hot)
    w = _windowed(blocks).select(
        "*", velocity_score(blocks, max_gap).alias("velocity_score"), location_score(blocks).alias("location_score"))
    return _with_amount(_drop_helpers(w), blocks, factor).drop(BLK)


def detect_amount(df: DataFrame, factor: float = AMOUNT_FACTOR, key: str = "user_id", order: str = "seq",
                  rows_per_block: int | None = None) -> DataFrame:
    """Amount detector alone: adds ``fraud_score``."""
    blocks = cut_blocks(df, key, order, rows_per_block)
    out = _with_amount(blocks.df.repartition(key, BLK), blocks, factor)
    return out.drop(BLK).withColumnRenamed("amount_score", "fraud_score")


def _one(df: DataFrame, blocks: Blocks, score: Column) -> DataFrame:
    return _drop_helpers(df.select("*", score.alias("fraud_score"))).drop(BLK)


def detect_velocity(df: DataFrame, max_gap: int = VELOCITY_MAX_GAP, key: str = "user_id", order: str = "seq",
                    rows_per_block: int | None = None) -> DataFrame:
    blocks = cut_blocks(df, key, order, rows_per_block)
    return _one(_windowed(blocks), blocks, velocity_score(blocks, max_gap))


def detect_location(df: DataFrame, key: str = "user_id", order: str = "seq",
                    rows_per_block: int | None = None) -> DataFrame:
    blocks = cut_blocks(df, key, order, rows_per_block)
    return _one(_windowed(blocks), blocks, location_score(blocks))


def detect_location_prev(df: DataFrame, key: str = "user_id", order: str = "seq",
                         rows_per_block: int | None = None) -> DataFrame:
    blocks = cut_blocks(df, key, order, rows_per_block)
    return _one(_windowed(blocks), blocks, location_prev_score(blocks))


def detect_amount_all(df: DataFrame, factor: float = AMOUNT_FACTOR, key: str = "user_id", order: str = "seq",
                      rows_per_block: int | None = None) -> DataFrame:
    """Documented variant: against the average of all earlier amounts, exact whatever their size."""
    from .plugin import AverageOfAllDetector, score_with
    return score_with(df, [AverageOfAllDetector(factor)], key, order, rows_per_block).withColumnRenamed("amount_all_score", "fraud_score")
