"""Approximate nearest neighbours over shifted Hilbert curves."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripwire.llm.shared import read, stash

CURVES = 16
PROJECTED = 8
BITS = 6
#: Rows of a key block: BLOCK_SHARE times the 3/4th power of the number of vectors, BLOCK_LEAST at least.
BLOCK_SHARE, BLOCK_LEAST = 0.32, 64
SAMPLE_ROWS = 20_000
#: Low bits of a key: one for each axis and, below, a hash of the id.
FINE_BITS = 15
#: Sampled rows from which a cell is split at its own mean.
FULL_CELL = 8


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of grid cells (n x dims, under 2^bits), by Skilling's transform."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        q, low = 1 << level, (1 << level) - 1
        for i in range(dims):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flips = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flips ^= np.where(x[-1] & (1 << level), (1 << level) - 1, 0)
    x ^= flips
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | (x[i] >> level & 1)
    return key


@dataclass
class Curves:
    """Projections, shifts and scales of the curves, and the means of full cells; fitted on a bounded sample."""

    mean: np.ndarray
    axes: list[np.ndarray]
    offset: list[np.ndarray]
    bits: int
    full: list[tuple[np.ndarray, np.ndarray]]

    def places(self, vectors: np.ndarray, c: int) -> tuple[np.ndarray, np.ndarray]:
        """Place on the grid of curve ``c`` (n x axes), and Hilbert place of the cell."""
        side = 1 << self.bits
        at = np.clip((((vectors - self.mean) @ self.axes[c] + self.offset[c]) / 6 + 0.5) * side, 0, side * (1 - 1e-12))
        return at, hilbert_keys(at.astype(np.int64), self.bits)

    def keys(self, vectors: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """n x curves keys: the cell's Hilbert place, a place within the cell, and a hash of the id, another on each curve.

        A cell is halved along each axis, a full one at the mean of its own rows: near copies, which all lie in one corner of a
        cell, are parted by where they lie among each other.
        """
        out = []
        for c in range(len(self.axes)):
            at, key = self.places(vectors, c)
            cells, means = self.full[c]
            split = np.floor(at) + 0.5
            if len(cells):
                i = np.minimum(np.searchsorted(cells, key), len(cells) - 1)
                split = np.where((cells[i] == key)[:, None], means[i], split)
            fine = hilbert_keys((at >= split).astype(np.int64), 1)
            rest = FINE_BITS - at.shape[1]
            salted = (ids.astype(np.uint64) + np.uint64(c + 1)) * np.uint64(0x9E3779B97F4A7C15)
            salted = (salted ^ salted >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
            out.append((key << at.shape[1] | fine) << rest | (salted >> np.uint64(64 - rest)).astype(np.int64))
        return np.stack(out, axis=1)


def fit_curves(sample: np.ndarray, curves: int = CURVES, projected: int = PROJECTED, bits: int = BITS, seed: int = 11) -> Curves:
    """Curves from a sample (rows x dims): random orthonormal axes, scaled to unit spread, each curve with a random shift; means of the cells with ``FULL_CELL`` or more of its rows."""
    rng, dims = np.random.default_rng(seed), sample.shape[1]
    p = min(projected, dims)
    bits = max(1, min(bits, 48 // p))
    mean, axes, turn = sample.mean(axis=0), [], np.empty((dims, 0))
    for _ in range(curves):
        if turn.shape[1] < p:
            turn = np.linalg.qr(rng.standard_normal((dims, dims)))[0]
        a, turn = turn[:, :p], turn[:, p:]
        spread = ((sample - mean) @ a).std(axis=0)
        axes.append(a / np.where(spread > 0, spread, 1.0))
    shape = Curves(mean, axes, [rng.uniform(-0.5, 0.5, p) for _ in axes], bits, [])
    for c in range(curves):
        at, key = shape.places(sample, c)
        cells, where, n = np.unique(key, return_inverse=True, return_counts=True)
        means = np.stack([np.bincount(where, at[:, i], len(cells)) for i in range(p)], axis=1) / n[:, None]
        shape.full.append((cells[n >= FULL_CELL], means[n >= FULL_CELL]))
    return shape


def _matrix(column, dims: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def _valid(v: str) -> Column:
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return F.col(v).isNotNull() & finite & F.exists(v, lambda x: x != 0)


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, curves: int = CURVES, projected: int = PROJECTED,
            bits: int = BITS, block_rows: int | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The ``k`` nearest found of each query row: query_id, rank, vec_id, score.

    ``vectors`` has vec_id and embedding (an array of numbers); ``is_query`` picks the rows
    to search for. Nearest is the smallest Euclidean distance in double precision, ties to the
    smaller vec_id; a query's own id is no candidate; fewer than ``k`` candidates are all
    returned.

    Vectors are projected onto ``projected`` random axes for each of ``curves`` shifted
    Hilbert curves (means and scales from ``sample_rows`` rows at most; every row is indexed).
    On each curve Spark deals the rows into key ranges of about ``block_rows`` rows; a
    query is compared with its own and both neighbouring ranges by exact distance, and the
    curves' lists are merged. Cells that hold a larger share of the rows are split at the mean of
    their sampled rows (see ``Curves.keys``). Identical vectors are searched once, with their k + 1 smallest
    ids, so a vector that fills a third of the table is no hot group.

    Null ids and vectors that are null, zero, or hold null or non-finite numbers take no part, nor
    do vectors of another length than the commonest (of equals the shortest). Of rows with the
    same id the smallest vector counts. Empty tables give an empty result.
    """
    spark = vectors.sparkSession
    rows = (vectors.where("vec_id is not null").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"),
                                                       F.coalesce(is_query, F.lit(False)).alias("is_query"))
            .where(_valid("embedding")))
    common = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if common is None:
        return empty
    dims = common.d
    rows = (rows.where(F.size("embedding") == dims).groupBy("vec_id")
            .agg(F.min(F.struct("embedding", "is_query")).alias("r")).select("vec_id", "r.embedding", "r.is_query"))
    same = Window.partitionBy("embedding").orderBy("vec_id")
    queries = rows.where("is_query").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("wanted"))
    copies = (rows.select("vec_id", "embedding").withColumn("n", F.row_number().over(same)).where(F.col("n") <= k + 1)
              .withColumn("rep", F.first("vec_id").over(same)))
    copies = stash(copies.select("rep", "vec_id", F.when(F.col("n") == 1, F.col("embedding")).alias("embedding")))
    heads = copies.where("embedding is not null").select("rep", "embedding")
    asked = stash(queries.join(heads, F.col("wanted") == F.col("embedding")).select("query_id", "rep"))
    sample = heads.orderBy(F.xxhash64("rep"), "rep").limit(sample_rows).select("embedding").toArrow()
    shape = fit_curves(_matrix(sample["embedding"], dims), curves, projected, bits)

    def with_keys(batches):
        for batch in batches:
            v = _matrix(batch.column("embedding"), dims)
            ids = batch.column("rep").to_numpy()
            keys = shape.keys(v, ids)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("embedding"), batch.column("asked"),
                 pa.ListArray.from_arrays(np.arange(len(ids) + 1, dtype=np.int32) * curves, pa.array(keys.ravel()))],
                ["rep", "embedding", "asked", "keys"])

    marked = heads.join(asked.select("rep").distinct().withColumn("asked", F.lit(True)), "rep", "left")
    keyed = stash(marked.mapInArrow(with_keys, "rep long, embedding array<double>, asked boolean, keys array<long>"))
    n = keyed.count()
    per_block = block_rows or max(BLOCK_LEAST, int(BLOCK_SHARE * n ** 0.75))
    blocks = max(1, round(n / per_block))
    cuts = [[]] * curves
    if blocks > 1:
        shares = [i / blocks for i in range(1, blocks)]
        cuts = list(keyed.agg(*(F.percentile_approx(F.get("keys", F.lit(c)), shares, max(10_000, 20 * blocks)) for c in range(curves))).first())

    def dealt(batches):
        for batch in batches:
            keys = batch.column("keys").flatten().to_numpy().reshape(-1, curves)
            asks = batch.column("asked").fill_null(False).to_numpy(zero_copy_only=False)
            place = np.stack([np.searchsorted(np.asarray(c, np.int64), keys[:, i], "right") for i, c in enumerate(cuts)], axis=1)
            for c in range(curves):
                members = np.arange(len(keys))
                seekers = np.flatnonzero(asks)
                parts = [(members, place[:, c], False)] + [(seekers, place[seekers, c] + s, True) for s in (-1, 0, 1)]
                for at, block, seeks in parts:
                    ok = (block >= 0) & (block < blocks)
                    at, block = at[ok], block[ok]
                    if len(at):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(block.astype(np.int64) * curves + c), pa.array(np.full(len(at), seeks)),
                             batch.column("rep").take(pa.array(at)), batch.column("embedding").take(pa.array(at))],
                            ["block", "seeks", "rep", "embedding"])

    def search(table: pa.Table) -> pa.Table:
        seeks = table["seeks"].to_numpy()
        ids, v = table["rep"].to_numpy(), _matrix(table["embedding"], dims)
        there, have = ids[~seeks], v[~seeks]
        out = []
        for q, w in zip(ids[seeks], v[seeks]):
            d = np.sqrt(((have - w) ** 2).sum(axis=1))
            if len(d) > k + 1:
                near = np.flatnonzero(d <= np.partition(d, k)[k])
            else:
                near = np.arange(len(d))
            near = near[np.lexsort((there[near], d[near]))][: k + 1]
            out.append((np.full(len(near), q), there[near], d[near]))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
        return pa.table({"asked": pa.array(cols[0], pa.int64()), "rep": pa.array(cols[1], pa.int64()), "score": pa.array(cols[2], pa.float64())})

    found = (keyed.mapInArrow(dealt, "block long, seeks boolean, rep long, embedding array<double>")
             .groupBy("block").applyInArrow(search, "asked long, rep long, score double").distinct())
    by_head = Window.partitionBy("asked").orderBy("score", "rep")
    found = found.withColumn("n", F.row_number().over(by_head)).where(F.col("n") <= k + 1).drop("n")
    by_id = Window.partitionBy("asked").orderBy("score", "vec_id")
    found = (found.join(copies.select("rep", "vec_id"), "rep").withColumn("n", F.row_number().over(by_id))
             .where(F.col("n") <= k + 1).select("asked", "vec_id", "score"))
    by_query = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (asked.join(found, asked.rep == found.asked).where("query_id != vec_id")
            .withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def query(spark, sf_dir: str) -> DataFrame:
    """op1: 10 nearest of every vector whose id is divisible by 100."""
    return nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
