from pyspark.sql import types as T

CANON_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()), T.StructField("transaction_id", T.StringType()),
    T.StructField("user_id", T.StringType()), T.StructField("txn_time", T.LongType()),
    T.StructField("amount", T.DoubleType()), T.StructField("location", T.StringType()),
    T.StructField("transaction_type", T.StringType()),
])


def txns(spark, rows):
    """rows: (seq, user, time, amount, location[, type])."""
    full = [(s, f"txn-{s}", u, t, None if a is None else float(a), loc, (rest[0] if rest else "Normal"))
            for (s, u, t, a, loc, *rest) in rows]
    return spark.createDataFrame(full, CANON_SCHEMA)


def scores(df, cols=("amount_score", "velocity_score", "location_score")):
    return {r["seq"]: tuple(r[c] for c in cols) for r in df.collect()}
