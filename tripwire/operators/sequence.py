"""Per-key sequences cut into blocks, so that no key is processed whole in one task.

Everything "per user, in arrival order" (previous row, first row, running sums,
the amount fold) is computed per ``(key, blk)``. A key with at most
``rows_per_block`` rows is one block (``blk = 0``) and is processed exactly as
a plain ``Window.partitionBy(key)`` would. A *hot* key (more rows than that; a
single one, the null key too, may hold a third of the table) is cut, by counts
of its rows, into blocks of ``rows_per_block`` to twice as many (``blk >= 1``),
and a small table of per-block summaries carries what a block needs from the
blocks before it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import rows_per_block as _conf_rows_per_block

BLK = "blk"
#: Hot keys are broadcast up to this many (a key and four numbers each), and joined plainly beyond.
BROADCAST_KEYS = 10_000
#: Cells a hot key's range is counted in, for each block it needs.
CELLS_PER_BLOCK = 64


@dataclass
class HotKeys:
    """Keys with more than ``limit`` rows: ``_hot_key, _n, _lo, _hi``; no table if there is none."""

    table: DataFrame | None
    n: int
    limit: int


@dataclass
class Blocks:
    df: DataFrame  # input rows plus the `blk` column
    key: str
    order: str
    hot: bool  # at least one key was cut into several blocks

    def window(self) -> Window:
        """Rows of one block in arrival order."""
        return Window.partitionBy(self.key, BLK).orderBy(self.order)


def hot_keys(df: DataFrame, key: str = "user_id", order: str = "seq", rows_per_block: int | None = None) -> HotKeys:
    """Find the hot keys: one action over (key, order), whose counts combine map-side.

    Operators that keep the keys of their rows can share the result down a chain.
    """
    limit = _conf_rows_per_block(df.sparkSession, rows_per_block)
    hot = (df.groupBy(F.col(key).alias("_hot_key"))
           .agg(F.count(F.lit(1)).alias("_n"), F.min(order).alias("_lo"), F.max(order).alias("_hi"))
           .filter(F.col("_n") > limit))
    n = hot.count()
    return HotKeys(hot.checkpoint() if n else None, n, limit)


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_KEYS else by_blocks(df)


def by_blocks(df: DataFrame) -> DataFrame:
    """A table with a row for each block or cell, whose joins do not bring it to the driver: it grows with the input, and its broadcasts stay with each plan."""
    return df.hint("merge")


def _in_cells(rows: DataFrame, order: str, limit: int, finer: list[tuple[DataFrame, int]]) -> DataFrame:
    """Rows (joined with the hot keys) with the start ``_c`` and width ``_w`` of their cell; null where the key is not hot.

    A key's order range is cut evenly, then the cells of each table of ``finer`` are cut again.
    """
    width = F.greatest(F.lit(1).cast("long"), F.ceil(
        (F.col("_hi") - F.col("_lo") + 1) * F.lit(float(limit)) / (F.col("_n") * F.lit(float(CELLS_PER_BLOCK)))).cast("long"))
    rows = rows.withColumn("_w", width).withColumn("_c", F.expr(f"_lo + (({order} - _lo) div _w) * _w"))
    for table, n in finer:
        rows = (rows.join(_small(table, n), F.col("_hot_key").eqNullSafe(F.col("_k2")) & (F.col("_c") == F.col("_c2")), "left")
                .withColumn("_c", F.when(F.col("_w2").isNull(), F.col("_c")).otherwise(F.expr(f"_c + (({order} - _c) div _w2) * _w2")))
                .withColumn("_w", F.coalesce("_w2", "_w")).drop("_k2", "_c2", "_w2"))
    return rows


def cut_blocks(df: DataFrame, key: str = "user_id", order: str = "seq", rows_per_block: int | None = None,
               hot: HotKeys | None = None) -> Blocks:
    """Add `blk`: 0 for keys held whole, 1.. for consecutive stretches of `order` of a hot key.

    A hot key's rows are counted in cells of its order range (map-side), cells that
    hold too many rows, as bursts do, are cut finer until none does, and consecutive cells are
    gathered into blocks by the number of rows before them. So blocks hold about
    `rows_per_block` rows however the rows are spread, and never over twice as many
    unless one order value does. Rows with the same order value share a block. The null
    key is cut like any other.
    """
    hot = hot or hot_keys(df, key, order, rows_per_block)
    if hot.table is None:
        return Blocks(df.withColumn(BLK, F.lit(0).cast("long")), key, order, False)
    listed, finer = _small(hot.table, hot.n), []
    rows = df.select(F.col(key).alias("_key"), order).join(listed, F.col("_key").eqNullSafe(F.col("_hot_key")))
    while True:
        cells = (_in_cells(rows, order, hot.limit, finer).groupBy("_hot_key", "_c", "_w").agg(F.count(F.lit(1)).alias("_m")).checkpoint())
        heavy = cells.filter((F.col("_m") > hot.limit) & (F.col("_w") > 1))
        n = heavy.count()
        if not n:
            break
        # Even within the cell; by half at least, for rows that lie close together.
        even = F.ceil(F.col("_w") * F.lit(float(hot.limit)) / (F.col("_m") * F.lit(float(CELLS_PER_BLOCK)))).cast("long")
        width = F.greatest(F.lit(1).cast("long"), F.least(even, F.expr("_w div 2")))
        finer.append((heavy.select(F.col("_hot_key").alias("_k2"), F.col("_c").alias("_c2"), width.alias("_w2")).checkpoint(), n))
    before = Window.partitionBy("_hot_key").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    placed = cells.select(
        F.col("_hot_key").alias("_bk"), F.col("_c").alias("_bc"),
        (F.floor(F.coalesce(F.sum("_m").over(before), F.lit(0)) / F.lit(hot.limit)) + 1).cast("long").alias(BLK)).checkpoint()
    all_rows = _in_cells(df.join(listed, F.col(key).eqNullSafe(F.col("_hot_key")), "left"), order, hot.limit, finer)
    out = (all_rows.join(_small(placed, placed.count()), F.col(key).eqNullSafe(F.col("_bk")) & (F.col("_c") == F.col("_bc")), "left")
           .select(*df.columns, F.coalesce(BLK, F.lit(0).cast("long")).alias(BLK)).checkpoint())  # read for carries, folds and scores
    return Blocks(out, key, order, True)


def on_block(left: str, right: str, key: str) -> Column:
    """Join condition of two aliased frames on (key, blk); a null key meets a null key."""
    return (F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}")) & (F.col(f"{left}.{BLK}") == F.col(f"{right}.{BLK}")))


def carry_table(blocks: Blocks, fields: list[str], amount: str | None = None) -> DataFrame:
    """For each hot block: what it needs from the blocks of the same key before it.

    Columns: key, blk, ``has_prev`` (an earlier block exists), ``prev_last``
    (struct of `fields` of the last row of the previous block), ``first_row``
    (struct of `fields` of the key's first row), ``pre_sum`` / ``pre_cnt`` /
    ``pre_amounts`` (sum of `amount`, rows and amounts of earlier blocks).
    """
    k, o = blocks.key, blocks.order
    hot_rows = blocks.df.filter(F.col(BLK) > 0)
    row = F.struct(*[F.col(f) for f in fields])
    summed = F.col(amount) if amount else F.lit(None).cast("decimal(38,6)")
    per_block = hot_rows.groupBy(k, BLK).agg(
        F.min_by(row, F.col(o)).alias("_first"),
        F.max_by(row, F.col(o)).alias("_last"),
        F.try_sum(summed).alias("_sum"), F.count(summed).alias("_amounts"), F.count(F.lit(1)).alias("_cnt"),
    )
    w = Window.partitionBy(k).orderBy(BLK)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    return per_block.select(
        k, BLK,
        (F.row_number().over(w) > 1).alias("has_prev"),
        F.lag("_last").over(w).alias("prev_last"),
        F.first("_first").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("first_row"),
        # null if the sum of a block, or of them all, outgrew its type
        F.when(F.coalesce(F.bool_or(F.col("_sum").isNull() & (F.col("_amounts") > 0)).over(before), F.lit(False)), None)
        .when(F.coalesce(F.sum("_amounts").over(before), F.lit(0)) == 0, 0).otherwise(F.try_sum("_sum").over(before)).alias("pre_sum"),
        F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("pre_cnt"),
        F.coalesce(F.sum("_amounts").over(before), F.lit(0)).alias("pre_amounts"),
    )


def with_carry(blocks: Blocks, fields: list[str], amount: str | None = None) -> DataFrame:
    """Rows with the carry columns attached (null / false / 0 for keys held whole)."""
    df = blocks.df
    zero = F.lit(0).cast("long")
    if not blocks.hot:
        none_row = F.when(F.lit(False), F.struct(*[F.col(f) for f in fields]))
        return df.select(
            "*", F.lit(False).alias("has_prev"), none_row.alias("prev_last"), none_row.alias("first_row"),
            F.lit(0).alias("pre_sum"), zero.alias("pre_cnt"), zero.alias("pre_amounts"))
    c = by_blocks(carry_table(blocks, fields, amount)).alias("_c")
    j = df.alias("_r").join(c, on_block("_r", "_c", blocks.key), "left")
    return j.select(
        "_r.*",
        F.coalesce(F.col("_c.has_prev"), F.lit(False)).alias("has_prev"),
        F.col("_c.prev_last").alias("prev_last"),
        F.col("_c.first_row").alias("first_row"),
        F.when(F.col("_c.has_prev").isNull(), 0).otherwise(F.col("_c.pre_sum")).alias("pre_sum"),
        F.coalesce(F.col("_c.pre_cnt"), zero).alias("pre_cnt"),
        F.coalesce(F.col("_c.pre_amounts"), zero).alias("pre_amounts"),
    )
