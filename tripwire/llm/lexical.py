"""Ranked lexical search: dense blocks of item vocabularies times blocks of document impacts, exact in float64."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwire.llm.shared import read, stash

TOP = 10
#: Text of the items of one block (bytes, about), whose vocabulary is broadcast; items, documents and terms of a tile.
BLOCK_BYTES, ITEM_TILE, DOC_TILE, TERM_TILE = 4_000_000, 512, 512, 4096
#: A partial sum of a tile stays under this, so that float64 adds whole numbers exactly.
EXACT = 1 << 53

# What is no part of a term becomes a space, A-Z become a-z; every byte of other characters stays.
_TERM = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """Terms of a whole text: runs of ASCII letters and digits and of all characters beyond ASCII, only A-Z lower-cased."""
    return text.translate(_TERM).split() if text else []


class ItemTile:
    """Some items of a block: their own compact vocabulary, cut into tiles, and their weighted counts (sparse until used)."""

    def __init__(self, counts: list[Counter], weight: np.ndarray, most: int):
        """``weight``: of the block's terms; ``most``: the highest impact of a term before its weight."""
        self.n = len(counts)
        self.vocabulary = np.array(sorted({t for c in counts for t in c}), np.int64)
        term = np.fromiter((t for c in counts for t in c), np.int64, sum(map(len, counts)))
        self.item = np.repeat(np.arange(self.n), [*map(len, counts)])
        self.place = np.searchsorted(self.vocabulary, term)
        self.value = np.fromiter((k for c in counts for k in c.values()), np.float64, len(term)) * weight[term]
        # In no tile can an item's sum reach EXACT: the largest part of each term over all items bounds every item's.
        load = np.zeros(len(self.vocabulary))
        np.maximum.at(load, self.place, self.value * most)
        if len(load) and load.max() >= EXACT:
            raise ValueError("a term stands too often in one item for exact sums")
        self.cuts, begin, total = [0], 0, 0.0
        for t, x in enumerate(load.tolist()):
            if t - begin >= TERM_TILE or total + x >= EXACT:
                self.cuts.append(t)
                begin, total = t, 0.0
            total += x
        self.cuts.append(len(load))

    def scores(self, row: np.ndarray, term: np.ndarray, value: np.ndarray, n_docs: int) -> np.ndarray:
        """Scores (document, item) of documents with impact ``value`` of ``term`` in ``row``: a dense product for each tile of terms."""
        place = np.searchsorted(self.vocabulary, term)
        here = place < len(self.vocabulary)
        here[here] = self.vocabulary[place[here]] == term[here]
        row, place, value = row[here], place[here], value[here]
        out = np.zeros((n_docs, self.n), np.int64)
        for a, b in zip(self.cuts, self.cuts[1:], strict=False):
            weights, mine = np.zeros((b - a, self.n)), (self.place >= a) & (self.place < b)
            weights[self.place[mine] - a, self.item[mine]] = self.value[mine]
            inside = (place >= a) & (place < b)
            at, col, v = row[inside], place[inside] - a, value[inside]
            for first in range(0, n_docs, DOC_TILE):
                tile = np.zeros((min(DOC_TILE, n_docs - first), b - a))
                of = slice(*np.searchsorted(at, (first, first + DOC_TILE)))
                tile[at[of] - first, col[of]] = v[of]
                out[first:first + DOC_TILE] += (tile @ weights).astype(np.int64)
        return out


def impacts(tf: np.ndarray, n: np.ndarray, total_docs: int, total_terms: int) -> np.ndarray:
    """(10^9 tf) div (1000 tf + 8 m) with m = 100 - 75 + ((75 n N) div L), in 64-bit integers."""
    m = 25 + (75 * n * total_docs) // max(1, total_terms)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def best_of_tile(scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """(item, document) places of the ``top`` scores above 0 of every item (column), ties to smaller ids, nulls last.

    All documents that tie with the last place are compared before the cut.
    """
    if len(scores) > top:
        least = np.partition(scores, len(scores) - top, axis=0)[len(scores) - top]
    else:
        least = np.zeros(scores.shape[1], scores.dtype)
    doc, item = np.nonzero((scores >= np.maximum(least, 1)))
    order = np.lexsort((ids[doc], nulls[doc], -scores[doc, item], item))
    doc, item = doc[order], item[order]
    place = np.arange(len(item)) - np.searchsorted(item, item)
    return item[place < top], doc[place < top]


def _counted(docs: DataFrame, vocabulary, text_col: str, id_col: str) -> DataFrame:
    """(_id, n, term, tf): number of terms of each document, and its terms of the vocabulary with their occurrences."""
    schema = T.StructType([T.StructField("_id", T.LongType()), *T.StructType.fromDDL("n long, term array<int>, tf array<int>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = vocabulary.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                n, sizes, term, tf = [], [], [], []
                for text in part.column("_raw").to_pylist():
                    words = terms(text)
                    t, k = np.unique(np.array([i for i in map(index.get, words) if i is not None], np.int32), return_counts=True)
                    n.append(len(words))
                    sizes.append(len(t))
                    term.append(t)
                    tf.append(k.astype(np.int32))
                ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), pa.array(n, pa.int64()),
                     *(pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x))) for x in (term, tf))], names=schema.names)

    return docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("binary").alias("_raw")).mapInArrow(run, schema)


def _scored(found: DataFrame, shared, total_docs: int, total_terms: int, top: int) -> DataFrame:
    """(item, _id, score): the best documents of each item in each task's rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = shared.value
        kept = [[np.zeros(0, np.int64) for _ in range(3)] + [np.zeros(0, bool)] for _ in tiles]
        for batch in batches:
            for at in range(0, batch.num_rows, 4 * DOC_TILE):
                part = batch.slice(at, 4 * DOC_TILE)
                ids, lists = part.column("_id"), part.column("term")
                nulls = ids.is_null().to_numpy(zero_copy_only=False)
                ids = ids.fill_null(0).to_numpy()
                size = lists.value_lengths().to_numpy()
                row = np.repeat(np.arange(len(size)), size)
                term, tf = lists.flatten().to_numpy(), part.column("tf").flatten().to_numpy().astype(np.int64)
                value = impacts(tf, part.column("n").to_numpy()[row], total_docs, total_terms).astype(np.float64)
                for k, tile in enumerate(tiles):
                    score = tile.scores(row, term, value, len(size))
                    item, doc = best_of_tile(score, ids, nulls, top)
                    merged = [np.concatenate([old, new]) for old, new in zip(kept[k], (item, score[doc, item], ids[doc], nulls[doc]), strict=True)]
                    order = np.lexsort((merged[2], merged[3], -merged[1], merged[0]))
                    items = merged[0][order]
                    order = order[np.arange(len(items)) - np.searchsorted(items, items) < top]
                    kept[k] = [x[order] for x in merged]
        for k, (item, score, ids, nulls) in enumerate(kept):
            if len(item):
                yield pa.RecordBatch.from_arrays([pa.array((item + k * ITEM_TILE).astype(np.int64)), pa.array(ids, pa.int64(), mask=nulls), pa.array(score)],
                                                 names=["item", "_id", "score"])

    return found.select("_id", "n", "term", "tf").mapInArrow(run, "item long, _id long, score long")


def _blocks(items: DataFrame, text_col: str, block_bytes: int) -> int:
    size = items.agg(F.sum(F.octet_length(text_col) + 64)).first()[0] or 0
    return max(1, -(-size // block_bytes))


def search(docs: DataFrame, items: DataFrame, top: int = TOP, text_col: str = "text", doc_id: str = "doc_id",
           item_id: str = "item_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of each item, as the module's formula scores them.

    With N documents that hold a term, L terms in all, n in a document: a term in df documents weighs
    w = floor(1000 ln((2N + 2) / (2 df + 1))), a document's m is 25 + ((75 n N) div L), and the score adds w * ((10^9 tf)
    div (1000 tf + 8 m)) over the item's terms, repeats included. Only scores above 0 are ranked, ties to
    the smaller doc_id (null ids last). Items are taken in blocks of a bounded amount of text (their vocabulary is
    broadcast), each against all documents: tiles of the block's compact vocabulary are multiplied with tiles of document impacts,
    cut so that no sum can reach 2^53. Null and empty texts have no terms; every row of ``items`` is an item of its own,
    a repeated one too; repeated documents are ranked each; other columns don't matter; an empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    items = items.select(F.col(item_id).alias("_item"), F.col(text_col).cast("binary").alias("_text"))
    n_blocks = _blocks(items, "_text", block_bytes)
    if n_blocks > 1:
        items = stash(items.withColumn("_block", F.pmod(F.xxhash64("_text", "_item", F.monotonically_increasing_id()), F.lit(n_blocks))))
    out = None
    for k in range(n_blocks):
        block = (items.where(F.col("_block") == k) if n_blocks > 1 else items).select("_item", "_text").collect()
        found = _search_block(spark, docs, [terms(r["_text"]) for r in block], top)
        if found is None:
            continue
        names = spark.createDataFrame([(i, r["_item"]) for i, r in enumerate(block)],
                                      T.StructType([T.StructField("item", T.LongType()), T.StructField(item_id, items.schema["_item"].dataType)]))
        found = found.join(F.broadcast(names), "item").select(item_id, "rank", F.col("_id").alias(doc_id), "score")
        out = found if n_blocks == 1 else stash(found) if out is None else out.union(stash(found))
    if out is None:
        return spark.createDataFrame([], T.StructType([T.StructField(item_id, items.schema["_item"].dataType), *T.StructType.fromDDL(
            f"rank int, {doc_id} long, score long").fields]))
    return out


def _search_block(spark: SparkSession, docs: DataFrame, items: list[list[bytes]], top: int) -> DataFrame | None:
    """(item, rank, _id, score) of one block of items; None if they have no term."""
    index = {w: i for i, w in enumerate(dict.fromkeys(w for item in items for w in item))}
    if not index:
        return None
    counts = [Counter(index[w] for w in item) for item in items]
    found = stash(_counted(docs, spark.sparkContext.broadcast(index), "_text", "_id"))
    total = found.where("n > 0").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    if not total.docs:
        return None
    df = {r.t: r.n for r in found.select(F.explode("term").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n")).collect()}
    weight = np.array([np.floor(1000 * np.log((2 * total.docs + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(index))])
    tiles = [ItemTile(counts[k:k + ITEM_TILE], weight, 1_000_000) for k in range(0, len(items), ITEM_TILE)]
    shared = spark.sparkContext.broadcast(tiles)
    best = _scored(found.where(F.size("term") > 0), shared, total.docs, total.terms, top)
    best = best.withColumn("_part", F.spark_partition_id() % 64)
    order = [F.desc("score"), F.asc_nulls_last("_id")]
    best = (best.withColumn("_k", F.row_number().over(Window.partitionBy("item", "_part").orderBy(*order))).where(F.col("_k") <= top)
            .withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top))
    return best.select("item", "rank", "_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    """op12: the ten best documents of every benchmark item."""
    return search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


ORACLE = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
i AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
q AS (SELECT item_id, term, count(*) AS k FROM i GROUP BY ALL),
s AS (SELECT count(*) AS n, CAST(sum(len(terms)) AS BIGINT) AS l FROM d WHERE len(terms) > 0),
m AS (SELECT doc_id, terms, 25 + ((75 * len(terms) * s.n) // s.l) AS m FROM d, s WHERE len(terms) > 0),
t AS (SELECT doc_id, m, unnest(terms) AS term FROM m),
tf AS (SELECT doc_id, m, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * s.n + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, s GROUP BY term, s.n),
sc AS (
  SELECT item_id, doc_id, CAST(sum(k * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN tf USING (term) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
FROM sc WHERE score > 0 QUALIFY rank <= {TOP}
"""
