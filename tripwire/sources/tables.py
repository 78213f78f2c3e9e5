"""Table sources: parquet tables read as canonical transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import epoch_seconds
from ..schema import FRAUD, NORMAL

# Fixed value: an event counts as a labelled fraud when props.k reaches it.
EVENT_FRAUD_K = 95


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_as_transactions(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """`events` as transactions, arrival order = event_id (plus `extra` source columns)."""
    ev = read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").try_cast("int")
    return ev.select(
        F.col("event_id").alias("seq"),
        F.concat(F.lit("txn-"), F.col("event_id").cast("string")).alias("transaction_id"),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("user_id"),
        epoch_seconds("ts").alias("txn_time"),
        F.col("value").cast("double").alias("amount"),
        F.col("event_type").alias("location"),
        F.when(k >= EVENT_FRAUD_K, F.lit(FRAUD)).otherwise(F.lit(NORMAL)).alias("transaction_type"),
        *extra,
    )


def orders_as_transactions(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """`orders` as transactions, arrival order = o_orderkey (times out of order; plus `extra` columns)."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("seq"),
        F.concat(F.lit("txn-"), F.col("o_orderkey").cast("string")).alias("transaction_id"),
        F.concat(F.lit("user-"), F.col("o_custkey").cast("string")).alias("user_id"),
        epoch_seconds("o_orderdate").alias("txn_time"),
        F.col("o_totalprice").cast("double").alias("amount"),
        F.col("o_orderpriority").alias("location"),
        F.lit(NORMAL).alias("transaction_type"),
        *extra,
    )


TRANSACTION_TABLES = {
    "events": events_as_transactions,
    "orders": orders_as_transactions,
}


def transactions(spark: SparkSession, sf_dir: str, table: str = "events") -> DataFrame:
    return TRANSACTION_TABLES[table](spark, sf_dir)
