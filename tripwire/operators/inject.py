"""Labelled anomaly injection into existing transactions, for back-testing.

The producer's fraud behaviours, applied to real rows instead of generated
ones: each row is altered against the user's profile as it stood just before
it (``profile_running``), chosen rows get 1-3 fraud behaviours in a random
order and are labelled ``Fraud``. Every random draw is ``frac(key, salt)``
(md5 of the row key), so a run repeats exactly and SQL can state the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import frac, seconds_of_day_gap, uniform, uniform_int
from ..schema import CANONICAL, FRAUD, FRAUD_TYPES
from .profile import profile_running
from .sequence import HotKeys

# The producer's ranges and picking constants.
AMOUNT_FACTOR_RANGE = (0.8, 1.2)  # normal amount, x average
FRAUD_FACTOR_RANGE = (3.0, 10.0)  # high amount, x average
LOCATION_TIME_WINDOW = (1, 600)  # seconds after the last transaction
CLOSE_TIME_WINDOW = (1, 20000)  # milliseconds after the last transaction
NORMAL_TXN_MIN_GAP = 30  # seconds; closer normal transactions are moved
NORMAL_TXN_MOVE = (30, 1000)  # seconds after the last transaction
FRAUD_INTERVAL = 1000  # rows per picking block
FRAUD_COUNT_RANGE = (0, 20)  # frauds per block
HIGH_VALUE, PROXIMITY, TIME = FRAUD_TYPES
FRAUD_TYPE_ORDER = FRAUD_TYPES


def _key() -> Column:
    return F.col("seq").cast("string")


def with_history(txns: DataFrame, rows_per_block: int | None = None, hot: HotKeys | None = None) -> DataFrame:
    """Rows plus the profile just before each (null averages on a user's first row)."""
    run = profile_running(txns, rows_per_block=rows_per_block, hot=hot)
    return run.select(
        "seq", "transaction_id", "user_id", "txn_time", "amount", "location", "transaction_type",
        F.col("average_amt_before").alias("avg_before"), F.col("last_txn_time_before").alias("last_time"),
        "main_location", (F.col("txn_count") == 1).alias("is_first"))


def _last_ms() -> Column:
    return F.col("last_time") * F.lit(1000)


# Each behaviour: columns -> {column: new value}; time values are epoch milliseconds.
def normal_amount(_: DataFrame | None = None) -> dict[str, Column]:
    lo, hi = AMOUNT_FACTOR_RANGE
    return {"amount": F.col("avg_before") * uniform(lo, hi, _key(), "normal")}


def normal_spacing(_: DataFrame | None = None) -> dict[str, Column]:
    lo, hi = NORMAL_TXN_MOVE
    gap = seconds_of_day_gap(F.timestamp_seconds("txn_time"), F.timestamp_seconds("last_time"))
    moved = _last_ms() + uniform_int(lo, hi, _key(), "spacing") * F.lit(1000)
    return {"ts_ms": F.when(gap <= F.lit(NORMAL_TXN_MIN_GAP), moved)}


def high_amount(_: DataFrame | None = None) -> dict[str, Column]:
    lo, hi = FRAUD_FACTOR_RANGE
    return {"amount": F.col("avg_before") * uniform(lo, hi, _key(), "high")}


def other_location(_: DataFrame | None = None) -> dict[str, Column]:
    lo, hi = LOCATION_TIME_WINDOW
    return {"location": F.col("_other_location"),
            "ts_ms": _last_ms() + uniform_int(lo, hi, _key(), "loc_time") * F.lit(1000)}


def close_time(_: DataFrame | None = None) -> dict[str, Column]:
    lo, hi = CLOSE_TIME_WINDOW
    return {"ts_ms": _last_ms() + uniform_int(lo, hi, _key(), "close")}


BEHAVIOURS: dict[str, Callable[..., dict[str, Column]]] = {
    HIGH_VALUE: high_amount, PROXIMITY: other_location, TIME: close_time,
}


#: Lists of locations up to this length are broadcast.
BROADCAST_LOCATIONS = 10_000


def numbered_locations(locations: DataFrame) -> DataFrame:
    """lk, loc, idx, m: the distinct locations (case-insensitive) numbered from 0 in order of md5, and how many there are.

    Counted and numbered by the first two hex digits of the md5, so no task sees them all;
    only the 256 counts are added up in one.
    """
    distinct = (locations.filter(F.col("location").isNotNull()).groupBy(F.lower("location").alias("lk")).agg(F.min("location").alias("loc"))
                .withColumn("h", F.md5("lk")).withColumn("part", F.substring("h", 1, 2)))
    counts = distinct.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.orderBy("part")
    offsets = counts.select("part", (F.sum("n").over(upto.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"),
                            F.sum("n").over(upto.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("m"))
    inside = Window.partitionBy("part").orderBy("h", "lk")
    return (distinct.join(offsets, "part")
            .select("lk", "loc", (F.col("before") + F.row_number().over(inside) - 1).alias("idx"), "m"))


def with_other_location(df: DataFrame, locations: DataFrame) -> DataFrame:
    """`_other_location`: another location than the user's main one (case-insensitive).

    The distinct locations are numbered in a repeatable order; the row takes the
    entry 1..m-1 places after its main location, which never equals it. A list of up to
    BROADCAST_LOCATIONS is broadcast, so rows are not shuffled onto a few locations; a longer
    one is joined plainly. No main location, or a single location: null (no move).
    """
    numbered = numbered_locations(locations).checkpoint()
    small = F.broadcast if numbered.count() <= BROADCAST_LOCATIONS else (lambda x: x)
    main = small(numbered.select(F.col("lk").alias("_mlk"), F.col("idx").alias("_midx"), F.col("m").alias("_m")))
    out = df.join(main, F.lower(F.col("main_location")) == F.col("_mlk"), "left")
    shift = F.lit(1) + F.floor(frac(_key(), "loc_pick") * (F.col("_m") - 1))
    out = out.withColumn("_oidx", F.when(F.col("_m") >= 2, F.pmod(F.col("_midx") + shift, F.col("_m"))))
    other = small(numbered.select(F.col("idx").alias("_oidx2"), F.col("loc").alias("_other_location")))
    out = out.join(other, out["_oidx"] == other["_oidx2"], "left")
    return out.drop("_mlk", "_midx", "_m", "_oidx", "_oidx2")


def _prime_from(n: int) -> int:
    """Smallest prime of n or more."""
    while n < 2 or any(n % d == 0 for d in range(2, int(n ** 0.5) + 1)):
        n += 1
    return n


def _pick_coefficients(block: Column, p: int) -> tuple[Column, Column]:
    return (F.lit(1) + F.floor(frac(block, "perm_a") * F.lit(p - 1))).cast("long"), \
        F.floor(frac(block, "perm_b") * F.lit(p)).cast("long")


def pick_position(a: Column, b: Column, pos: Column, interval: int = FRAUD_INTERVAL) -> Column:
    """Rank of `pos` in a repeatable random order of the positions 0..interval of a block.

    x -> (a*x + b) mod p is a bijection of 0..p-1 (p the first prime above the interval, a != 0);
    walking the cycle until the value falls in 0..interval (at most p - interval - 1
    more steps) makes it a bijection of 0..interval. A row expression: no join,
    window or shuffle.
    """
    p = _prime_from(interval + 1)

    def f(x: Column) -> Column:
        return F.pmod(a * x + b, F.lit(p))

    if p == interval + 1:
        return f(pos)
    walk = F.sequence(F.lit(1), F.lit(p - interval - 1))
    return F.aggregate(walk, f(pos), lambda acc, _: F.when(acc <= F.lit(interval), acc).otherwise(f(acc)))


def pick_flags(txns: DataFrame, interval: int = FRAUD_INTERVAL) -> DataFrame:
    """Rows plus block, pos, n (frauds drawn for the block) and `picked`.

    Per block of `interval` offsets, n in 0..20 distinct positions out of
    0..interval are chosen (the last position never exists, as in the producer).
    """
    lo, hi = FRAUD_COUNT_RANGE
    block = F.expr(f"seq div {int(interval)}")
    pos = F.pmod(F.col("seq"), F.lit(int(interval)))
    out = txns.select("*", block.alias("block"), pos.alias("pos"))
    pa, pb = _pick_coefficients(F.col("block"), _prime_from(interval + 1))
    out = out.select("*", uniform_int(lo, hi, F.col("block"), "count").alias("n"), pa.alias("_pa"), pb.alias("_pb"))
    rank = pick_position(F.col("_pa"), F.col("_pb"), F.col("pos"), interval)
    return out.select("*", (rank < F.col("n")).alias("picked")).drop("_pa", "_pb")


def pick_rows(txns: DataFrame, interval: int = FRAUD_INTERVAL) -> DataFrame:
    """The chosen rows: seq, block, pos, n."""
    return pick_flags(txns.select("seq"), interval).filter("picked").select("seq", "block", "pos", "n")


def fraud_types_col() -> Column:
    """1 to 3 distinct fraud types in a random order, comma-separated."""
    k = uniform_int(1, 3, _key(), "k")
    ranked = F.array_sort(F.array(*[
        F.struct(F.md5(F.concat(_key(), F.lit(t))).alias("h"), F.lit(t).alias("t")) for t in FRAUD_TYPE_ORDER]))
    chosen = F.slice(F.transform(ranked, lambda s: s["t"]), F.lit(1), k.cast("int"))
    return F.array_join(chosen, ",")


def pick_types(keys: DataFrame) -> DataFrame:
    """seq, fraud_types for the given rows."""
    return keys.select("seq", fraud_types_col().alias("fraud_types"))


def _apply(df: DataFrame, changes: dict[str, Column], when: Column) -> DataFrame:
    for c, v in changes.items():
        base = F.col(c) if c in df.columns else F.lit(None).cast("long")
        df = df.withColumn(c, F.when(when & v.isNotNull(), v).otherwise(base))
    return df


def _finish(df: DataFrame) -> DataFrame:
    t = F.when(F.col("ts_ms").isNotNull(), F.expr("ts_ms div 1000")).otherwise(F.col("txn_time"))
    return df.withColumn("txn_time", t.cast("long")).drop("ts_ms")


def apply_behaviour(txns: DataFrame, name: str, rows_per_block: int | None = None) -> DataFrame:
    """One behaviour applied to every non-first row (G1-G5): seq, amount, txn_time, location."""
    h = with_history(txns, rows_per_block)
    if name == PROXIMITY:
        h = with_other_location(h, txns.select("location"))
    fn = {"normal": normal_amount, "spacing": normal_spacing, **BEHAVIOURS}[name]
    out = _finish(_apply(h.withColumn("ts_ms", F.lit(None).cast("long")), fn(), ~F.col("is_first")))
    return out.select("seq", "amount", "txn_time", "location")


def inject_all(txns: DataFrame, rows_per_block: int | None = None, hot: HotKeys | None = None) -> DataFrame:
    """Chosen rows get normal behaviour, then their fraud behaviours in order; labelled Fraud.

    A user's first row is never altered. The last time-setting behaviour in the
    drawn order sets the time (else the normal spacing move). Output: canonical
    columns plus ``fraud_types`` (comma-separated, in order; null when untouched).
    """
    h = with_history(txns, rows_per_block, hot)
    h = with_other_location(h, txns.select("location"))
    h = pick_flags(h)
    h = h.select("*", F.when(F.col("picked") & ~F.col("is_first"), fraud_types_col()).alias("fraud_types"))
    types = F.split(F.col("fraud_types"), ",")
    alter = F.col("fraud_types").isNotNull()
    time_of = {t: fn()["ts_ms"] for t, fn in BEHAVIOURS.items() if "ts_ms" in fn()}

    def ts_at(i: int) -> Column:
        t = F.try_element_at(types, F.lit(i))
        out = F.lit(None).cast("long")
        for name, v in time_of.items():
            out = F.when(t == F.lit(name), v).otherwise(out)
        return out

    ts_ms = F.when(alter, F.coalesce(ts_at(3), ts_at(2), ts_at(1), normal_spacing()["ts_ms"]))
    amount = F.when(~alter, F.col("amount")).when(
        F.array_contains(types, HIGH_VALUE), high_amount()["amount"]).otherwise(normal_amount()["amount"])
    location = F.when(alter & F.array_contains(types, PROXIMITY) & F.col("_other_location").isNotNull(),
                      F.col("_other_location")).otherwise(F.col("location"))
    out = h.select(
        "seq", "transaction_id", "user_id",
        F.when(ts_ms.isNotNull(), F.floor(ts_ms / F.lit(1000))).otherwise(F.col("txn_time")).cast("long")
        .alias("txn_time"),
        amount.alias("amount"), location.alias("location"),
        F.when(alter, F.lit(FRAUD)).otherwise(F.col("transaction_type")).alias("transaction_type"),
        "fraud_types")
    return out.select(*CANONICAL, "fraud_types")


__all__ = ["with_history", "pick_flags", "pick_rows", "pick_types", "apply_behaviour", "inject_all", "BEHAVIOURS"]
