"""Rounding to 3 decimals by the exact binary value, as formatting does."""

import math
import random
import struct

from pyspark.sql import functions as F

from tripwire.functions.scalar import round3

TIES = [2.0025, 2.6755, 0.0005, 0.0625, 0.1875, 1.0005, 2.5, 1234567.0625, 0.3125, 4.4375]


def test_equals_formatting(spark):
    rng = random.Random(1)
    values = [rng.uniform(-10 ** rng.randrange(-4, 16), 10 ** rng.randrange(-4, 16)) for _ in range(600_000)]
    values += [round(rng.uniform(0, 5000), rng.randrange(3, 6)) for _ in range(200_000)]
    values += [rng.randrange(1 << 50) / 2 ** rng.randrange(0, 64) for _ in range(150_000)]  # many exact ties
    values += [struct.unpack("d", rng.randbytes(8))[0] for _ in range(50_000)]
    values += [s * v for v in TIES for s in (1, -1)] + [2.0 ** k for k in range(-1074, 1024, 3)] + [math.nextafter(2.0 ** k, 0) for k in range(-20, 60)]
    values = [v for v in values if math.isfinite(v)]
    assert len(values) >= 990_000
    df = spark.createDataFrame([(v, float(f"{v:.3f}")) for v in values], "v double, want double").withColumn("got", round3("v"))
    wrong = df.filter(F.col("got") != F.col("want"))
    assert wrong.count() == 0, wrong.take(5)


def test_odd_values(spark):
    rows = spark.createDataFrame([(None,), (float("nan"),), (float("inf"),), (-0.0,), (0.0,), (-0.0001,)], "v double").select(round3("v").alias("r")).collect()
    got = [r.r for r in rows]
    assert got[0] is None and math.isnan(got[1]) and got[2] == math.inf and got[3:] == [0, 0, 0]
