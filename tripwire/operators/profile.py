"""Per-user spending profiles over the transaction history.

Totals are exact ``DECIMAL(38,6)`` sums (the amount rounded to 6 places), so
they do not depend on the order Spark adds them in; the average is the exact
quotient by the number of amounts, rounded half up to 3 decimals. (The producer rounds a double quotient;
engines disagree on such ties, an exact quotient does not.) A row without an amount (null, NaN, infinite) counts
as a transaction, and an amount that the type can't hold (10^32 and more) counts as none: ``amount_rejects`` names
both. A total that outgrows the type is null; nothing stops the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sequence import BLK, HotKeys, cut_blocks, with_carry

TOTAL_TYPE = "decimal(38,6)"


def _amt() -> Column:
    return F.col("amount").try_cast(TOTAL_TYPE)


def amount_rejects(txns: DataFrame) -> DataFrame:
    """Rows whose amount no profile holds."""
    return txns.filter(_amt().isNull())


def _avg(total: Column, count: Column) -> Column:
    """Quotient rounded half up to 3 places, as a double; null without amounts.

    Exact up to totals of 10^24; beyond, where a double has no third decimal, the quotient of doubles.
    """
    n = F.nullif(count, F.lit(0).cast("long"))
    return F.coalesce(F.round(total.try_cast("decimal(30,6)") / n, 3).cast("double"), total.cast("double") / n)


def user_profile(txns: DataFrame, key: str = "user_id", order: str = "seq") -> DataFrame:
    """One row per user (F1): count, total, average, main (first) and last location/time.

    All aggregates combine map-side, so a hot user is pre-aggregated before the
    shuffle.
    """
    agg = txns.groupBy(key).agg(
        F.count(F.lit(1)).alias("txn_count"),
        F.try_sum(_amt()).alias("total_amt"),
        F.count(_amt()).alias("amounts"),
        F.min_by("txn_time", F.col(order)).alias("first_txn_time"),
        F.min_by("location", F.col(order)).alias("main_location"),
        F.max_by("txn_time", F.col(order)).alias("last_txn_time"),
        F.max_by("location", F.col(order)).alias("last_location"),
    )
    return agg.select(
        key, "txn_count", "total_amt", _avg(F.col("total_amt"), F.col("amounts")).alias("average_amt"),
        "first_txn_time", "main_location", "last_txn_time", "last_location")


def profile_running(txns: DataFrame, key: str = "user_id", order: str = "seq",
                    rows_per_block: int | None = None, hot: HotKeys | None = None) -> DataFrame:
    """The profile as it stood after each transaction, and just before it (F2).

    ``*_before`` columns are the profile the row was generated from (null for
    the user's first row).
    """
    base = txns.withColumn("_amt", _amt())
    blocks = cut_blocks(base, key, order, rows_per_block, hot)
    df = with_carry(blocks, ["txn_time", "location"], amount="_amt")
    w = blocks.window()
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    rn = F.row_number().over(w)
    count = F.col("pre_cnt") + F.count(F.lit(1)).over(upto)

    def total(frame):
        return F.try_add(F.col("pre_sum").cast(TOTAL_TYPE), F.when(F.count("_amt").over(frame) > 0, F.try_sum("_amt").over(frame)).otherwise(0))

    def amounts(frame):
        return F.col("pre_amounts") + F.count("_amt").over(frame)
    first_in_block = F.first("location").over(upto)
    main = F.when(F.col("has_prev"), F.col("first_row.location")).otherwise(first_in_block)
    prev_time = F.when(rn == 1, F.col("prev_last.txn_time")).otherwise(F.lag("txn_time").over(w))
    prev_loc = F.when(rn == 1, F.col("prev_last.location")).otherwise(F.lag("location").over(w))
    out = df.select(
        order, key, "transaction_id", "txn_time", "amount", "location", "transaction_type",
        count.alias("txn_count"), total(upto).try_cast(TOTAL_TYPE).alias("total_amt"), main.alias("main_location"),
        prev_time.alias("last_txn_time_before"), prev_loc.alias("last_location_before"), amounts(upto).alias("_amounts"),
        total(before).try_cast(TOTAL_TYPE).alias("_total_before"), amounts(before).alias("_amounts_before"),
    )
    before_cnt = F.col("txn_count") - 1
    return out.select(
        "*",
        _avg(F.col("total_amt"), F.col("_amounts")).alias("average_amt"),
        F.when(before_cnt > 0, before_cnt).alias("txn_count_before"),
        F.when(before_cnt > 0, F.col("_total_before")).alias("total_amt_before"),
        F.when(before_cnt > 0, _avg(F.col("_total_before"), F.col("_amounts_before"))).alias("average_amt_before"),
    ).drop(BLK, "_amounts", "_total_before", "_amounts_before")


def profile_upsert(versions: DataFrame, key: str = "user_id", order: str = "seq") -> DataFrame:
    """Last write wins per key (F3), as a combinable max_by (no per-key sort)."""
    cols = [c for c in versions.columns if c not in (key,)]
    agg = versions.groupBy(key).agg(F.max_by(F.struct(*cols), F.col(order)).alias("_v"))
    return agg.select(key, *[F.col(f"_v.{c}").alias(c) for c in cols if c != order])


def user_count(txns: DataFrame, key: str = "user_id") -> DataFrame:
    """Number of distinct users."""
    return txns.agg(F.countDistinct(key).alias("user_count"))


def profile_lookup(ids: DataFrame, profiles: DataFrame, key: str = "user_id") -> DataFrame:
    """Profile of each id, nulls for an unknown id.

    A plain left join: AQE broadcasts the profile side when its measured size is
    small and otherwise splits skewed id partitions.
    """
    return ids.join(profiles, on=key, how="left")


def first_transactions(txns: DataFrame, key: str = "user_id", order: str = "seq") -> DataFrame:
    """Each user's first transaction (F5): one scan and one aggregate that combines map-side."""
    rest = [c for c in txns.columns if c != key]
    first = txns.groupBy(key).agg(F.min_by(F.struct(*rest), F.col(order)).alias("_f"))
    return first.select(key, *[F.col(f"_f.{c}").alias(c) for c in rest]).select(*txns.columns)


def sample_users(profiles: DataFrame, n: int, key: str = "user_id", salt: str = "pick") -> DataFrame:
    """A repeatable uniform pick of n users (F6): the n smallest md5 values (top-k)."""
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(salt)))
    return profiles.select("*", h.alias("_h")).orderBy("_h", key).limit(int(n)).drop("_h")


def profile_deltas(txns: DataFrame, key: str = "user_id", order: str = "seq") -> DataFrame:
    """Per-user partial profile of some rows (one micro-batch, one file drop).

    Every field merges associatively (sums, first/last by `order`), so profiles
    built from any split of the rows merge to the same result (F1 on streams).
    """
    first = F.struct(F.col(order).alias("seq"), "txn_time", "location")
    return txns.groupBy(key).agg(
        F.count(F.lit(1)).alias("txn_count"), F.try_sum(_amt()).alias("total_amt"), F.count(_amt()).alias("amounts"),
        F.min_by(first, F.col(order)).alias("first"), F.max_by(first, F.col(order)).alias("last"))


def merge_profiles(deltas: DataFrame, key: str = "user_id") -> DataFrame:
    """Merge partial profiles into one row per user (same columns as ``user_profile``; F3 upsert)."""
    return merge_deltas(deltas, key).select(
        key, "txn_count", "total_amt", _avg(F.col("total_amt"), F.col("amounts")).alias("average_amt"),
        F.col("first.txn_time").alias("first_txn_time"), F.col("first.location").alias("main_location"),
        F.col("last.txn_time").alias("last_txn_time"), F.col("last.location").alias("last_location"))


def merge_deltas(deltas: DataFrame, key: str = "user_id") -> DataFrame:
    """Partial profiles merged to one per user, still partial: a compacted form of ``deltas``."""
    return deltas.groupBy(key).agg(
        F.sum("txn_count").alias("txn_count"),
        # a part that outgrew the type has amounts but no total
        F.when(~F.bool_or(F.col("total_amt").isNull() & (F.col("amounts") > 0)), F.try_sum("total_amt")).try_cast(TOTAL_TYPE).alias("total_amt"),
        F.sum("amounts").alias("amounts"),
        F.min_by("first", F.col("first.seq")).alias("first"), F.max_by("last", F.col("last.seq")).alias("last"))
