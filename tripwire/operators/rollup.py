"""Fan-in of detector scores and the per-transaction roll-up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.parse import LABEL_THRESHOLD, final_projection, label
from ..schema import DETECTORS, PAYLOAD
from .detectors import AMOUNT_FACTOR, SCORE_COLUMNS, VELOCITY_MAX_GAP, score_all


def scored_long(wide: DataFrame) -> DataFrame:
    """Wide scores to one row per (transaction, detector) (E1: the shared topic).

    ``stack`` is a generator in the same stage: no shuffle.
    """
    args = ", ".join(f"'{d}', {SCORE_COLUMNS[d]}" for d in DETECTORS)
    keep = [c for c in wide.columns if c not in SCORE_COLUMNS.values()]
    return wide.select(*keep, F.expr(f"stack({len(DETECTORS)}, {args}) AS (detector, fraud_score)"))


def _payload(df: DataFrame, keys: list[str]) -> list[str]:
    return [c for c in [*PAYLOAD, "extras"] if c not in keys and c in df.columns]


def _labelled(agg: DataFrame, keys: list[str], payload: list[str], threshold: int) -> DataFrame:
    return agg.select(
        *keys,
        *[F.col(f"_base.{c}").alias(c) for c in payload if c != "transaction_type"],
        label("fraud_score", F.col("_base.transaction_type"), threshold).alias("transaction_type"),
        "fraud_score",
        (F.col("fraud_score") >= threshold).alias("detected"),
    )


def _rollup(scored: DataFrame, keys: list[str], order: str = "seq", threshold: int = LABEL_THRESHOLD, dedup: bool = False) -> DataFrame:
    payload = _payload(scored, keys)
    if dedup:  # copies of a (transaction, detector) count once: the largest score of each detector
        score = sum((F.coalesce(F.max(F.when(F.col("detector") == d, F.col("fraud_score"))), F.lit(0)) for d in DETECTORS), F.lit(0))
    else:
        score = F.sum("fraud_score")
    agg = scored.groupBy(*keys).agg(score.cast("int").alias("fraud_score"),
                                    F.max_by(F.struct(*payload), F.col(order)).alias("_base"))
    return _labelled(agg, keys, payload, threshold)


def final_scores(scored: DataFrame, dedup: bool = False, threshold: int = LABEL_THRESHOLD) -> DataFrame:
    """Per transaction: summed score, payload of the last delivery, label.

    One aggregate that combines map-side, so a transaction delivered very often is
    pre-aggregated before the only shuffle. ``dedup`` counts redeliveries of the same
    (transaction, detector) once.
    """
    return _rollup(scored, ["transaction_id"], threshold=threshold, dedup=dedup)


def final_scores_tumbling(scored: DataFrame, seconds: int = 1, dedup: bool = False,
                          threshold: int = LABEL_THRESHOLD) -> DataFrame:
    """Tumbling event-time window on ``txn_time`` per transaction."""
    ts = F.timestamp_seconds("txn_time")
    win = F.window(ts, f"{int(seconds)} seconds")
    out = _rollup(scored.withColumn("_w", win), ["transaction_id", "_w"], threshold=threshold, dedup=dedup)
    return out.select(F.unix_seconds("_w.start").alias("window_start"), *[c for c in out.columns if c != "_w"])


def final_scores_session(scored: DataFrame, gap_seconds: int = 1, key: str = "transaction_id",
                         threshold: int = LABEL_THRESHOLD) -> DataFrame:
    """Session window on ``txn_time`` per key (E6); a gap equal to `gap_seconds` joins.

    Rows with the same key and time fall in the same session, so they are first
    combined by a plain (map-side combinable) aggregate: sum of scores and the
    payload of the latest delivery. A key delivered very often is thus reduced
    before the session merge, which sorts each key's rows in one task.
    """
    payload = _payload(scored, [key, "txn_time"])
    pre = scored.groupBy(key, "txn_time").agg(
        F.sum("fraud_score").alias("fraud_score"),
        F.max_by(F.struct(*payload, F.col("seq")), F.col("seq")).alias("_p"))
    pre = pre.select(key, "txn_time", "fraud_score", *[F.col(f"_p.{c}").alias(c) for c in payload + ["seq"]])
    ts = F.timestamp_seconds("txn_time")
    win = F.session_window(ts, f"{int(gap_seconds)} seconds")
    out = _rollup(pre.withColumn("_s", win), [key, "_s"], threshold=threshold)
    return out.select(
        F.unix_seconds("_s.start").alias("session_start"), F.unix_seconds("_s.end").alias("session_end"),
        *[c for c in out.columns if c != "_s"])


def total_score(wide: DataFrame, threshold: int = LABEL_THRESHOLD) -> DataFrame:
    """Sum the three scores in the row itself (E8: no fan-in shuffle, no window)."""
    s = sum((F.col(c) for c in SCORE_COLUMNS.values()), F.lit(0)).cast("int")
    keep = [c for c in wide.columns if c not in SCORE_COLUMNS.values() and c != "transaction_type"]
    return wide.select(
        *keep, label(s, "transaction_type", threshold).alias("transaction_type"), s.alias("fraud_score"),
        (s >= threshold).alias("detected"))


def score_and_label(txns: DataFrame, factor: float = AMOUNT_FACTOR, max_gap: int = VELOCITY_MAX_GAP,
                   threshold: int = LABEL_THRESHOLD, rows_per_block: int | None = None, safe: bool = False) -> DataFrame:
    """End to end (E8): detectors, summed score, label, the 7 table columns."""
    wide = score_all(txns, factor=factor, max_gap=max_gap, rows_per_block=rows_per_block)
    return final_projection(total_score(wide, threshold), safe=safe)
