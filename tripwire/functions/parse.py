"""Parsing, serialising, projections and predicates on transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import FINAL_AMOUNT_TYPE, FINAL_COLUMNS, FRAUD, TRANSACTION_TEXT, TRANSACTION_TYPES
from .scalar import epoch_seconds

LABEL_THRESHOLD = 2  # fixed value: a summed score at or above it labels the row Fraud


def _typed(text: Column, kind: str) -> Column:
    """Number text as bigint or double, null if it is none; a bigint is taken exactly, and only whole numbers are."""
    if kind == "double":
        return text.try_cast("double")
    exact = text.try_cast("decimal(38,6)")
    return F.when(exact == F.floor(exact), F.floor(exact)).try_cast("bigint")


def unknown_fields(text: Column, known: list[str]) -> Column:
    """JSON object of the fields that are not ``known``, values as they came; null without any."""
    fields = F.try_parse_json(text).try_cast("map<string,variant>")
    rest = F.map_filter(fields, lambda k, v: ~k.isin(*known))
    return F.when(F.size(rest) > 0, F.to_json(rest, {"ignoreNullFields": "false"}))


def parse_transactions(raw: DataFrame, value: str = "value", mode: str = "FAILFAST",
                       keep: list[str] | None = None, extras: bool = False) -> DataFrame:
    """JSON text to the transaction columns.

    Numbers are parsed as text and then cast, so quoted and bare numbers both work and
    whole numbers keep all their digits. FAILFAST (the reference's behaviour: a bad record
    stops the job) or PERMISSIVE, where a record that can't be read, has no id, or has a
    number that is none yields ``_corrupt`` = its text. ``extras`` adds a column with the JSON
    object of unknown fields; ``as_json`` puts them back.
    """
    text = F.col(value).cast("string")
    cols = [F.col(c) for c in (keep or [])]
    out = raw.select(*cols, F.from_json(text, TRANSACTION_TEXT, {"mode": mode}).alias("_t"), text.alias("_raw"))
    time, amount = _typed(F.col("_t.txn_time"), "bigint"), _typed(F.col("_t.amount"), "double")
    bad_number = ((F.col("_t.txn_time").isNotNull() & time.isNull()) | (F.col("_t.amount").isNotNull() & amount.isNull()))
    permissive = mode.upper() == "PERMISSIVE"
    if not permissive:
        refuse = F.raise_error(F.concat(F.lit("not a number in "), F.col("_raw")))
        time, amount = (F.when(bad_number, refuse.cast(kind)).otherwise(c) for c, kind in ((time, "bigint"), (amount, "double")))
    typed = [F.col("_t.transaction_id").alias("transaction_id"), F.col("_t.user_id").alias("user_id"), time.alias("txn_time"),
             amount.alias("amount"), F.col("_t.location").alias("location"), F.col("_t.transaction_type").alias("transaction_type")]
    if extras:
        typed.append(unknown_fields(F.col("_raw"), TRANSACTION_TEXT.names).alias("extras"))
    if permissive:
        bad = F.col("_t").isNull() | F.col("_t.transaction_id").isNull() | F.coalesce(bad_number, F.lit(False))
        typed.append(F.when(bad, F.coalesce("_raw", F.lit(""))).alias("_corrupt"))
    return out.select(*cols, *typed)


def rejects(parsed: DataFrame) -> DataFrame:
    """Rows a PERMISSIVE parse could not read (the reject stream)."""
    return parsed.filter(F.col("_corrupt").isNotNull())


def filter_null(parsed: DataFrame) -> DataFrame:
    """Drop empty records, and those that a PERMISSIVE parse rejects."""
    kept = parsed.filter(F.col("transaction_id").isNotNull())
    return kept.filter(F.col("_corrupt").isNull()) if "_corrupt" in parsed.columns else kept


def as_json(columns: list[str], extras: str | None = None) -> Column:
    """Record to JSON text (B2): null fields are kept, unknown fields of the ``extras`` column follow the known ones."""
    known = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    if extras is None:
        return known
    return F.when(F.col(extras).isNull(), known).otherwise(
        F.concat(F.substring(known, F.lit(1), F.length(known) - 1), F.lit(","), F.substring(F.col(extras), F.lit(2), F.length(extras))))


def decode_utf8(col: str = "value") -> Column:
    """Bytes to UTF-8 text."""
    return F.decode(F.col(col), "UTF-8")


def flatten_transaction(nested: DataFrame) -> DataFrame:
    """Nested transaction (timestamp, location struct) to the wire form."""
    return nested.select(
        "transaction_id", "user_id",
        epoch_seconds("timestamp", ntz=False).alias("txn_time"),
        F.col("amount").cast("double").alias("amount"),
        F.col("location.country").alias("location"),
        "transaction_type",
    )


def label(score: Column | str = "fraud_score", incoming: Column | str = "transaction_type",
          threshold: int = LABEL_THRESHOLD) -> Column:
    """Fraud when the summed score reaches the threshold, else the incoming label."""
    s = F.col(score) if isinstance(score, str) else score
    t = F.col(incoming) if isinstance(incoming, str) else incoming
    return F.when(s >= F.lit(threshold), F.lit(FRAUD)).otherwise(t)


def final_projection(df: DataFrame, safe: bool = False) -> DataFrame:
    """The 7 table columns in table order, amount as DECIMAL(10,3).

    The cast rounds half up. An amount of 10,000,000 or more fails the job, or with ``safe``
    its row is left to ``final_rejects``.
    """
    if safe:
        df = df.filter(~_oversize())
    return df.select(
        "transaction_id", "user_id", "txn_time", F.col("amount").cast(FINAL_AMOUNT_TYPE).alias("amount"), "location", "transaction_type",
        F.col("fraud_score").cast("int").alias("fraud_score"),
    ).select(*FINAL_COLUMNS)


def _oversize() -> Column:
    return F.col("amount").isNotNull() & F.col("amount").try_cast(FINAL_AMOUNT_TYPE).isNull()


def final_rejects(df: DataFrame) -> DataFrame:
    """Rows whose amount the final table can't hold (the other part of ``final_projection(safe=True)``)."""
    return df.filter(_oversize())


def quality_flags(df: DataFrame) -> DataFrame:
    """One boolean column per domain rule."""
    return df.select(
        "*",
        (F.col("amount") < 0).alias("bad_amount"),
        (F.coalesce(F.col("location"), F.lit("")) == "").alias("empty_location"),
        (~F.coalesce(F.col("transaction_type").isin(*TRANSACTION_TYPES), F.lit(False))).alias("bad_type"),
    )


def quality_counts(df: DataFrame) -> DataFrame:
    """Count of violations per rule, in one pass."""
    q = quality_flags(df)
    return q.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(F.col("bad_amount"), 1)).alias("bad_amount"),
        F.count(F.when(F.col("empty_location"), 1)).alias("empty_location"),
        F.count(F.when(F.col("bad_type"), 1)).alias("bad_type"),
    )
