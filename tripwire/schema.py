"""Record shapes: the wire transaction, scored and final records, the table."""

from __future__ import annotations

from pyspark.sql import types as T

# Transaction on the wire (one JSON object per message).
TRANSACTION = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("txn_time", T.LongType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("location", T.StringType()),
    T.StructField("transaction_type", T.StringType()),
])

# Parse schema: numbers are read as text and cast afterwards, so that quoted
# and bare numbers are both accepted (a DOUBLE field turns "1.5" into null).
TRANSACTION_TEXT = T.StructType([T.StructField(f.name, T.StringType()) for f in TRANSACTION.fields])

# Canonical columns every operator takes and returns; `seq` is the arrival order
# (Kafka partition/offset, file order or a table key).
CANONICAL = ["seq", "transaction_id", "user_id", "txn_time", "amount", "location", "transaction_type"]
PAYLOAD = CANONICAL[1:]

# Scored record: the transaction plus one detector's 0/1 score.
SCORED = T.StructType(TRANSACTION.fields + [
    T.StructField("fraud_score", T.IntegerType()),
    T.StructField("detector", T.StringType()),
])

# Columns of the final table, in table order (the row id is left to the database).
FINAL_COLUMNS = ["transaction_id", "user_id", "txn_time", "amount", "location", "transaction_type", "fraud_score"]
FINAL_AMOUNT_TYPE = T.DecimalType(10, 3)

# Labels and fraud behaviours, as named by the producer.
NORMAL = "Normal"
FRAUD = "Fraud"
TRANSACTION_TYPES = [NORMAL, FRAUD]
FRAUD_TYPES = ["High Value Fraud", "Proximity Fraud", "Time Fraud"]
DETECTORS = ["amount", "velocity", "location"]

# In-memory (nested) transaction and the user profile.
LOCATION = T.StructType([T.StructField("country", T.StringType())])
NESTED_TRANSACTION = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("location", LOCATION),
    T.StructField("transaction_type", T.StringType()),
])


_TYPES = {"long": T.LongType, "int": T.IntegerType, "string": T.StringType, "double": T.DoubleType, "boolean": T.BooleanType}


def columns(text: str) -> T.StructType:
    """A struct type from ``name type, name type``, also where no session runs yet."""
    return T.StructType([T.StructField(name, _TYPES[kind]()) for name, kind in (c.split() for c in text.split(","))])
