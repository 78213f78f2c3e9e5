"""Benchmark decontamination by spaced-seed hashing; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwire.llm.shared import read

#: Fixed masks over token positions: 0 ignores a token. Together they hit every alignment of
#: 6 or more tokens with at most a fifth of them substituted (tests/llm checks this).
MASKS = ("1111", "11011")
TOKEN_PATTERN = r"[\p{L}\p{N}]+"
#: Seeds broadcast at a time (a hash, an item number and two positions each, some 100 MB).
SEEDS_AT_ONCE = 2_000_000


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits of a whole text; none for null."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN_PATTERN), F.lit(0))


def _seeds(words: Column, at: Column, masks: tuple[str, ...]) -> Column:
    """Hashes of the masks laid on ``words`` at 0-based position ``at``; null where a mask does not fit."""
    return F.array(*(
        F.when(at + len(m) <= F.size(words),
               F.xxhash64(F.lit(k), *(F.get(words, at + i) for i, bit in enumerate(m) if bit == "1")))
        for k, m in enumerate(masks)))


def _passages(benchmark: DataFrame, longest: int) -> DataFrame:
    """Items cut into passages of ``longest`` tokens at half steps (item_id, part, passage)."""
    step = max(1, longest // 2)
    n = F.size("words")
    parts = F.when(n <= longest, F.lit(0)).otherwise(F.ceil((n - longest) / step).cast("int"))
    return (benchmark.select("item_id", tokens(F.col("text")).alias("words"))
            .where(F.size("words") >= 4)
            .select("item_id", "words", F.explode(F.sequence(F.lit(0), parts)).alias("part"))
            .select("item_id", "part", F.slice("words", F.least(F.col("part") * step, F.greatest(n - longest, F.lit(0))) + 1,
                                               longest).alias("passage"))
            .distinct().withColumn("number", F.xxhash64("passage")))


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", min_similarity: float = 0.8,
          masks: tuple[str, ...] = MASKS, longest: int = 64, at_once: int = SEEDS_AT_ONCE) -> DataFrame:
    """Benchmark items that documents hold: key, item_id, start, n_tokens, matched, similarity.

    Spaced seeds (hashes of the tokens that a mask keeps) of every document position
    meet those of the benchmark; around each hit the whole passage is laid on the
    document at the hit's offset and counts if ``min_similarity`` of its tokens are the
    same at the same place, so substituted tokens are tolerated. Items over ``longest`` tokens
    are searched as overlapping passages of that length. One row per key and item, the
    best place (the first of equals); start is a token number from 0 (negative if
    the passage begins before the text).

    Benchmark seeds are broadcast at most ``at_once`` at a time, for each such block the
    documents are read once. Null and empty texts hold nothing; items with fewer than
    4 tokens or null text take no part; repeated rows of a key give one row; empty tables give none.
    """
    passages = _passages(benchmark.select("item_id", "text"), longest)
    n_tokens = passages.agg(F.coalesce(F.sum(F.size("passage")), F.lit(0)).alias("n")).first().n
    blocks = max(1, -(-n_tokens * len(masks) // at_once))
    by_number = passages.select("number", "passage").distinct()
    seeds = (by_number.select("number", "passage", F.explode(F.sequence(F.lit(0), F.size("passage") - 1)).alias("at"))
             .select("number", F.size("passage").alias("n"), "at", F.explode(_seeds(F.col("passage"), F.col("at"), masks)).alias("seed"))
             .where("seed is not null"))
    spots = (docs.select(F.col(key).alias("key"), tokens(F.col("text")).alias("words"))
             .select("key", "words", F.explode(F.sequence(F.lit(0), F.size("words") - 1)).alias("place"))
             .where(F.size("words") > 0)
             .select("key", "words", "place", F.explode(_seeds(F.col("words"), F.col("place"), masks)).alias("seed")))
    found = None
    for b in range(blocks):
        part = seeds if blocks == 1 else seeds.where(F.pmod("seed", F.lit(blocks)) == b)
        hits = (spots.join(F.broadcast(part), "seed")
                .select("key", "number", (F.col("place") - F.col("at")).alias("start"), F.col("n"),
                        F.slice("words", F.greatest(F.col("place") - F.col("at"), F.lit(0)) + 1,
                                F.col("n") + F.least(F.col("place") - F.col("at"), F.lit(0))).alias("piece")))
        found = hits if found is None else found.union(hits)
    lost = F.greatest(-F.col("start"), F.lit(0))
    same = F.aggregate(F.zip_with("piece", F.slice("passage", lost + 1, F.size("passage")),
                                  lambda x, y: F.coalesce(x == y, F.lit(False)).cast("int")), F.lit(0), lambda s, x: s + x)
    held = (found.dropDuplicates(["key", "number", "start"]).join(by_number, "number")
            .select("key", "number", "start", "n", same.alias("matched"))
            .where(F.col("matched") >= min_similarity * F.col("n")))
    best = F.max(F.struct((F.col("matched") / F.col("n")).alias("similarity"), (-F.col("start")).alias("before"), "n", "matched"))
    return (held.join(passages.select("number", "item_id").distinct(), "number").groupBy("key", "item_id").agg(best.alias("b"))
            .select(F.col("key").alias(key), "item_id", (-F.col("b.before")).alias("start"), F.col("b.n").alias("n_tokens"),
                    F.col("b.matched").alias("matched"), F.col("b.similarity").alias("similarity")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark passage (see ``leaks``).

    The text decides alone, so rows with a null doc_id and repeated rows are judged
    like any other; a null text stays. Further columns are carried along.
    """
    keyed = docs.select(F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("text_key"), "text")
    dirty = leaks(keyed, benchmark, "text_key", **options).select("text_key").distinct()
    return docs.join(dirty, F.md5(F.coalesce(docs["text"], F.lit(""))) == dirty["text_key"], "left_anti")


def query(spark, sf_dir: str) -> DataFrame:
    """op2: benchmark items held by documents."""
    return leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


#: Every alignment of every item, counted by equal tokens on a diagonal.
ORACLE = r"""
WITH b AS (
  SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark),
bt AS (SELECT item_id, len(w) AS n, unnest(w) AS tok, unnest(range(len(w))) AS j FROM b WHERE len(w) >= 4),
d AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents),
dt AS (SELECT doc_id, unnest(w) AS tok, unnest(range(len(w))) AS i FROM d WHERE len(w) > 0),
m AS (
  SELECT doc_id, item_id, n, i - j AS start, count(*) AS matched
  FROM dt JOIN bt USING (tok) GROUP BY ALL HAVING count(*) >= 0.8 * n),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY matched DESC, start) AS k FROM m)
SELECT doc_id, item_id, CAST(start AS INTEGER) AS start, CAST(n AS INTEGER) AS n_tokens, CAST(matched AS INTEGER) AS matched,
       CAST(matched AS DOUBLE) / n AS similarity
FROM r WHERE k = 1
"""
