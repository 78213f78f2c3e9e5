"""Helpers of this subpackage: tables kept in the shared folder, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwire.session import scratch_folder

#: What separates words: space and the five ASCII control spaces.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stash(df: DataFrame) -> DataFrame:
    """``df`` written to a fresh folder under ``spark.checkpoint.dir`` and read again.

    It cuts the lineage as checkpoint() does, survives lost executors, and keeps
    columns apart, so a reader of two columns reads just those. The folder is deleted when the
    driver ends.
    """
    spark = df.sparkSession
    path = f"{scratch_folder(spark, 'llm')}/rows"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def connected(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root) of the undirected edges (a, b) of longs: root is the smallest node that can be reached.

    Alternates large-star and small-star steps until the edges no longer change.
    Minima combine before the shuffle; the joins that bring them back are plain
    equality joins of kept tables, so adaptive execution splits the edges of a node that has many.
    Each round's edges and minima are kept in the shared folder. Nodes without an edge do not
    appear; null ends and loops are left out.
    """
    e = stash(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
              .where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("u") != F.col("v"))).distinct())
    mark = None
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stash(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        e = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .where("u != v").distinct())
        e = stash(e)
        low = stash(e.groupBy("u").agg(F.min("v").alias("m")))
        e = e.join(low, "u")
        e = stash(e.select("u", F.col("m").alias("v"))
                  .union(e.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct())
        now = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    roots = e.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
