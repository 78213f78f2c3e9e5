"""Mixing sources to target weights: a van der Corput schedule of equal-token blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripwire.llm.shared import read, stash, word_count

WEIGHTS = (5.0, 2.0, 1.0)
MOST_REPEATS = 3
BLOCK_TOKENS = 512
#: Slots ranked together; a source's slots are counted by chunk first.
SLOT_CHUNK = 1 << 16


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most_repeats: int = MOST_REPEATS) -> DataFrame:
    """source_no, source, source_size, target of (source, source_size), one row a source.

    Sources by code point, null last, are numbered from 1 and take the weights in turn.
    The targets share the sum of all sizes by weight; a target stops at ``most_repeats``
    times its source's size, and the excess goes to the others by weight until none is
    above. The ordered windows here hold one row a source, no documents.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # Sources whose cap is reached first come first; from the first one that stays under its cap on, none is full.
    by_cap = Window.orderBy("reach", "source_no")
    earlier = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    w = F.array(*(F.lit(float(x)) for x in weights))
    df = (sizes.withColumn("source_no", F.row_number().over(by_name).cast("long"))
          .withColumn("weight", F.get(w, ((F.col("source_no") - 1) % len(weights)).cast("int")))
          .withColumn("cap", F.col("source_size").cast("double") * most_repeats)
          .withColumn("reach", F.col("cap") / F.col("weight"))
          .withColumn("level", (F.sum(F.col("source_size").cast("double")).over(everything) - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0)))
                      / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))))
          .withColumn("open", F.col("level") * F.col("weight") < F.col("cap"))
          .withColumn("rest", F.min(F.when(F.col("open"), F.struct("reach", "source_no", "level"))).over(everything)))
    target = F.when(F.col("rest").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("rest.level") * F.col("weight")))
    return df.select("source_no", "source", "source_size", target.alias("target"))


def _reversed(x: Column, bits: int) -> Column:
    """The lowest ``bits`` bits of a long in reverse order."""
    for step, mask in ((1, 0x5555555555555555), (2, 0x3333333333333333), (4, 0x0F0F0F0F0F0F0F0F),
                       (8, 0x00FF00FF00FF00FF), (16, 0x0000FFFF0000FFFF), (32, 0x00000000FFFFFFFF)):
        x = F.shiftrightunsigned(x, step).bitwiseAND(F.lit(mask)).bitwiseOR(F.shiftleft(x.bitwiseAND(F.lit(mask)), step))
    return F.shiftrightunsigned(x, 64 - bits) if bits else F.lit(0).cast("long")


def _grid(per_source: DataFrame, block_tokens: int) -> tuple[DataFrame, int]:
    """source_no, first, last (grid points of each source with a target of a word or more) and m, for 2^m points."""
    live = per_source.where("target >= 1").select("source_no", "target")
    total = live.agg(F.coalesce(F.sum("target"), F.lit(0.0)).alias("t")).first().t
    m = max(0, int(-(-total // block_tokens)) - 1).bit_length()
    upto = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    top = F.sum("target").over(upto)
    edge = lambda x: F.least(F.ceil(x / F.lit(total or 1.0) * float(1 << m)), F.lit(1 << m)).cast("long")
    grid = (live.withColumn("first", F.least(edge(top - F.col("target")), F.lit((1 << m) - 1)))
            .withColumn("last", F.greatest(edge(top) - 1, F.col("first"))))
    return grid.select("source_no", "first", "last"), m


def schedule(per_source: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Slots of the mix: source_no, slot, rank, slots (of the source), from (source_no, target).

    Slot k of the 2^m slots belongs to the source whose stretch of cumulative target
    weight holds the van der Corput point of k (its bits reversed, over 2^m); any run of
    slots so holds the sources nearly in proportion. Turned round, a source's grid
    points give its slots by bit reversal, without a search. rank counts a source's slots from
    0. There are total target / ``block_tokens`` slots or up to twice as many; a
    source whose stretch is too short to hold a point shares the next one's slot, so
    every source with a target of a word or more has a slot.
    """
    grid, m = _grid(per_source, block_tokens)
    spread = (grid.select("source_no", "last", (F.col("last") - F.col("first") + 1).alias("slots"),
                          F.explode(F.sequence("first", "last", F.lit(SLOT_CHUNK))).alias("from_point"))
              .repartition("source_no", "from_point"))
    points = spread.select("source_no", "slots", F.explode(F.sequence(
        "from_point", F.least(F.col("from_point") + SLOT_CHUNK - 1, F.col("last")))).alias("point"))
    slots = (points.withColumn("slot", _reversed(F.col("point"), m))
             .withColumn("chunk", F.floor(F.col("slot") / SLOT_CHUNK)))
    per_chunk = slots.groupBy("source_no", "chunk").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("source_no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    per_chunk = per_chunk.select("source_no", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("passed"))
    inside = Window.partitionBy("source_no", "chunk").orderBy("slot")
    # Slots come out of a few ranges, so their number is not seen in the plan: no broadcast of them.
    return (slots.hint("merge").join(per_chunk, ["source_no", "chunk"])
            .select("source_no", "slot", (F.col("passed") + F.row_number().over(inside) - 1).alias("rank"), "slots"))


def streams(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most_repeats: int = MOST_REPEATS) -> tuple[DataFrame, DataFrame]:
    """Documents laid end to end in each source, shuffled, and the table of sources.

    The shuffle is by md5 of doc_id (then doc_id, null first, and size), so reruns agree. A
    place in the source's stream is the sum of its earlier decks (the first hex digits of
    the md5) and of the deck's earlier documents; no task holds a whole source.
    """
    rows = stash(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                             F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("h")))
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    digits = 2
    while 16 ** digits * 20_000 < (sums.agg(F.sum("n").alias("n")).first().n or 0):
        digits += 1
    per_source = stash(targets(sums.select("source", "source_size"), weights, most_repeats))
    rows = (rows.join(per_source.select("source_no", F.col("source").alias("_s")), F.col("source").eqNullSafe(F.col("_s")))
            .drop("_s").withColumn("deck", F.substring("h", 1, digits)))
    decks = rows.groupBy("source_no", "deck").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("source_no").orderBy("deck").rowsBetween(Window.unboundedPreceding, -1)
    decks = decks.select("source_no", "deck", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("passed"))
    inside = (Window.partitionBy("source_no", "deck").orderBy("h", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = (rows.join(decks, ["source_no", "deck"])
              .select("doc_id", "source_no", "source", "size",
                      (F.col("passed") + F.coalesce(F.sum("size").over(inside), F.lit(0))).alias("start")))
    return stash(placed), per_source


def mix(placed: DataFrame, per_source: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The mix in spans: slot, source_no, start (of the document in its stream), doc_id, first, words.

    A source's target, whole words, is cut into as many equal blocks (to a word) as it has
    slots; its stream is repeated until the target is full. The block whose number is a
    slot's rank fills the slot: ``words`` words of each document in it, from word ``first`` on.
    """
    slots = schedule(per_source, block_tokens)
    counts = _grid(per_source, block_tokens)[0].select("source_no", (F.col("last") - F.col("first") + 1).alias("slots"))
    sources = (per_source.join(counts, "source_no")
               .select("source_no", "source_size", F.floor("target").alias("goal"), "slots")
               .withColumn("base", F.floor(F.col("goal") / F.col("slots")))
               .withColumn("longer", F.col("goal") - F.col("base") * F.col("slots")))
    begin = lambda r: r * F.col("base") + F.least(r, F.col("longer"))
    bent = F.col("longer") * (F.col("base") + 1)
    block = lambda x: F.when(x < bent, F.floor(x / (F.col("base") + 1))).otherwise(
        F.col("longer") + F.floor((x - bent) / F.greatest(F.col("base"), F.lit(1)))).cast("long")
    laps = (placed.where("size > 0").join(sources, "source_no").where("start < goal")
            .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("goal") - 1 - F.col("start")) / F.col("source_size")))).alias("lap"))
            .withColumn("a", F.col("lap") * F.col("source_size") + F.col("start"))
            .withColumn("b", F.least(F.col("a") + F.col("size"), F.col("goal"))))
    pieces = (laps.select("*", F.explode(F.sequence(block(F.col("a")), block(F.col("b") - 1))).alias("rank"))
              .withColumn("lo", F.greatest("a", begin(F.col("rank"))))
              .withColumn("hi", F.least("b", begin(F.col("rank") + 1)))
              .select("source_no", "rank", "start", "doc_id", (F.col("lo") - F.col("a")).alias("first"), (F.col("hi") - F.col("lo")).alias("words")))
    return (pieces.join(slots.select("source_no", "rank", "slot").hint("merge"), ["source_no", "rank"])
            .select("slot", "source_no", "start", "doc_id", "first", "words"))


def mixture(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most_repeats: int = MOST_REPEATS,
            block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """doc_id, source, size, source_size, target, taken: what the mix takes of each row of ``docs``.

    size is the number of words; a null text or one without words has size 0 and nothing
    is taken. Every row is returned, repeated rows and null ids as well; an empty table
    gives an empty result. Reads doc_id, text and source only.
    """
    placed, per_source = streams(docs, weights, most_repeats)
    taken = mix(placed, per_source, block_tokens).groupBy("source_no", "start").agg(F.sum("words").alias("words"))
    return (placed.join(taken, ["source_no", "start"], "left")
            .join(per_source.select("source_no", "source_size", "target"), "source_no")
            .select("doc_id", "source", "size", "source_size", "target",
                    F.when(F.col("size") > 0, F.coalesce("words", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("taken")))


def query(spark, sf_dir: str) -> DataFrame:
    """op5: words the mix takes of every document."""
    return mixture(read(spark, sf_dir, "documents")).drop("source")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source IS NULL, source) AS source_no
  FROM d GROUP BY source),
w AS (
  SELECT *, CASE (source_no - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
         source_size::DOUBLE * 3 AS cap
  FROM s),
l AS (
  SELECT *, (sum(source_size::DOUBLE) OVER () - coalesce(sum(cap) OVER e, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER e, 0)) AS level
  FROM w
  WINDOW e AS (ORDER BY cap / weight, source_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
r AS (
  SELECT level FROM l WHERE level * weight < cap ORDER BY cap / weight, source_no LIMIT 1),
t AS (
  SELECT source, source_size, source_no,
         CASE WHEN (SELECT count(*) FROM r) = 0 THEN cap ELSE least(cap, (SELECT level FROM r) * weight) END AS target
  FROM l),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target)::BIGINT AS goal,
         coalesce(sum(d.size) OVER (PARTITION BY t.source_no ORDER BY d.h, d.doc_id NULLS FIRST, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(start + size, goal) - least(start, goal))
        + greatest(0, least(source_size + start + size, goal) - least(source_size + start, goal))
        + greatest(0, least(2 * source_size + start + size, goal) - least(2 * source_size + start, goal)))::BIGINT AS taken
FROM p
"""
