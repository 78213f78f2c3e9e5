"""SimHash near-duplicates: fingerprints linked through vantage-point trees."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwire.llm.shared import connected, stash

HALF = 32


def _fingerprint(text: bytes | None, words: int) -> int:
    """Signed 64-bit SimHash of the word shingles of one text (ASCII lower-cased)."""
    w = text.lower().split() if text else []
    if not w:
        return 0
    shingles = iter([b" ".join(w)]) if len(w) < words else map(b" ".join, zip(*(w[i:] for i in range(words))))
    n, counts = 0, np.zeros(64, np.int64)
    while len(h := np.fromiter((xxhash.xxh64_intdigest(x, 42) for x in itertools.islice(shingles, 65536)), np.uint64)):
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(h)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.int64)[0])


def fingerprint(text: Column, words: int = 3) -> Column:
    """64-bit SimHash of a text as a long; 0 for a null text or one without words.

    A-Z are lower-cased, words are what ASCII white space separates, shingles of
    ``words`` words count as often as they occur (a shorter text is one shingle), and
    a bit is set if it is set in over half of the shingles' XXH64 (seed 42).
    Works on the UTF-8 bytes, one whole text at a time.
    """
    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array((_fingerprint(t.as_py(), words) for t in texts), pa.int64())

    return of(text.cast("binary"))


def _levels(vantage: list[int], half: int, bits: int) -> list[tuple[int, int]]:
    """(vantage point, mask) of each level of one half's tree."""
    first = half * HALF
    return [(vantage[(half * HALF // bits + i) % len(vantage)], ((1 << bits) - 1) << (first + i * bits))
            for i in range(HALF // bits)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _distance(fp: str, vantage: int, mask: int) -> Column:
    return F.bit_count(F.col(fp).bitwiseXOR(F.lit(_signed(vantage & (1 << 64) - 1))).bitwiseAND(F.lit(_signed(mask)))).cast("long")


def _visits(fp: str, levels: list[tuple[int, int]], bits: int, budget: int, both_ways: bool) -> Column:
    """Leaf numbers a fingerprint belongs to (first) and must be compared in (the others).

    A leaf is the list of distances to the levels' vantage points. Two fingerprints
    within ``budget`` bits have lists that differ by ``budget`` in sum at most (the
    triangle bound of each level, on disjoint bits), so only those leaves are visited;
    of two leaves only the one with the larger first differing distance, unless
    ``both_ways``. Visits outside the possible distances are null.
    """
    d = [_distance(fp, v, m) for v, m in levels]
    base = bits + 1
    home = sum((x * base ** i for i, x in enumerate(d)), F.lit(0).cast("long"))
    visits = [home]
    for size in range(1, budget + 1):
        for at in itertools.combinations(range(len(d)), size):
            for steps in itertools.product([s for s in range(-budget, budget + 1) if s], repeat=size):
                if sum(map(abs, steps)) > budget or not both_ways and steps[0] < 0:
                    continue
                ok = F.lit(True)
                for i, s in zip(at, steps):
                    ok = ok & (d[i] + s).between(0, bits)
                visits.append(F.when(ok, home + sum(s * base ** i for i, s in zip(at, steps))))
    return F.array(*visits)


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of values as stars: each value with the smallest of its component."""
    nodes, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inv[: len(a)], inv[len(a):]
    low = np.arange(len(nodes))
    while True:
        m = np.minimum(low[x], low[y])
        new = low.copy()
        np.minimum.at(new, x, m)
        np.minimum.at(new, y, m)
        new = new[new]
        if (new == low).all():
            break
        low = new
    keep = low != np.arange(len(nodes))
    return nodes[keep], nodes[low[keep]]


def _links(leaf: np.ndarray, fp: np.ndarray, probe: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Stars of the fingerprints within ``max_bits`` in each leaf; rows sorted by leaf, members before probes."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    held, at, step = 0, np.flatnonzero(~probe), 1
    while True:
        at = at[at + step < len(leaf)]
        at = at[leaf[at] == leaf[at + step]]
        if not len(at):
            break
        x, y = fp[at], fp[at + step]
        hit = (np.bitwise_count((x ^ y).view(np.uint64)) <= max_bits) & (x != y)
        if hit.any():
            found.append((x[hit], y[hit]))
            held += int(hit.sum())
            if held > 1_000_000:
                found = [_forest(np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))]
                held = len(found[0][0])
        step += 1
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return _forest(np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))


def _search(visits: DataFrame, max_bits: int) -> DataFrame:
    """Star edges (a, b) of visits (leaf, fp, probe), leaf by leaf."""
    def each(batches):
        rest = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
                rows = [np.concatenate(p) for p in zip(rest, new)] if rest is not None else new
                cut = int(np.searchsorted(rows[0], rows[0][-1])) if len(rows[0]) else 0
                rest, rows = [r[cut:] for r in rows], [r[:cut] for r in rows]
            elif rest is None:
                return
            else:
                rows = rest
            if len(rows[0]):
                a, b = _links(*rows, max_bits)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return (visits.repartition("leaf").sortWithinPartitions("leaf", "probe")
            .mapInArrow(each, "a long, b long"))


def link_fingerprints(fps: DataFrame, max_bits: int = 3, bits_per_level: int | None = None,
                      hot_leaf: int = 50_000) -> DataFrame:
    """Star edges (a, b) that join all distinct fingerprints ``fp`` (long) within ``max_bits`` bits; exact.

    Of two fingerprints within ``max_bits``, one half of the bits differs by half of
    that at most. Each half has a vantage-point tree: a level's vantage point is a
    fingerprint of the data, its branches are the Hamming distances to it over the
    level's bits. Leaves are shards that Spark deals out; a fingerprint also visits the
    neighbouring leaves that the triangle bounds don't exclude. A leaf visited by more
    than ``hot_leaf`` rows is split by the trees of the other half's quarters, by the
    same bounds. Levels get finer (2 bits each instead of 4) for many fingerprints;
    this changes the work, not the result. In a leaf only stars are returned, not pairs.
    """
    if not 0 <= max_bits < 16:
        raise ValueError("max_bits must be 0 to 15")
    fps = stash(fps.select("fp").where("fp is not null").distinct())
    n = fps.count()
    vantage = [r.fp for r in fps.orderBy(F.xxhash64("fp"), "fp").limit(HALF).collect()] or [0]
    bits = bits_per_level or (4 if n <= 1 << 21 else 2)
    budget = max_bits // 2

    def exploded(df: DataFrame, visits: Column, number: Column, *more) -> DataFrame:
        return (df.select("fp", *more, F.posexplode(visits).alias("at", "code")).where("code is not null")
                .withColumn("leaf", number))

    out = None
    trees = [exploded(fps, _visits("fp", _levels(vantage, h, bits), bits, budget, False), F.col("code") * 2 + h)
             .select("leaf", "fp", (F.col("at") > 0).alias("probe"), F.lit(h).alias("half")) for h in (0, 1)]
    visits = trees[0].union(trees[1])
    bucket = F.pmod(F.xxhash64("leaf"), F.lit(65536))
    full = [r.bucket for r in visits.groupBy(bucket.alias("bucket")).count().where(F.col("count") > hot_leaf).collect()]
    if full:
        hot = stash(visits.where(bucket.isin(full)).groupBy("leaf").count().where(F.col("count") > hot_leaf).select("leaf"))
        marked = stash(visits.join(hot.withColumn("hot", F.lit(True)), "leaf", "left"))
        visits = marked.where("hot is null")
        for half, quarter in itertools.product((0, 1), (0, 1)):
            first = (1 - half) * HALF + quarter * 16
            levels = [(vantage[(i + quarter) % len(vantage)], 3 << (first + 2 * i)) for i in range(8)]
            part = marked.where(f"hot and half = {half}")
            number = F.xxhash64("leaf", "code", F.lit(quarter))
            members = exploded(part.where("not probe"), _visits("fp", levels, 2, budget, False), number, "leaf")
            guests = exploded(part.where("probe"), _visits("fp", levels, 2, budget, True), number, "leaf")
            deep = (members.select("leaf", "fp", (F.col("at") > 0).alias("probe"))
                    .union(guests.select("leaf", "fp", F.lit(True).alias("probe"))))
            found = _search(deep, max_bits)
            out = found if out is None else out.union(found)
    found = _search(visits.select("leaf", "fp", "probe"), max_bits)
    return found if out is None else out.union(found)


def simhash_components(docs: DataFrame, max_bits: int = 3, words: int = 3, bits_per_level: int | None = None,
                       hot_leaf: int = 50_000) -> DataFrame:
    """Near-duplicate groups of documents by SimHash: doc_id, fp (long), component_id.

    Fingerprints within ``max_bits`` bits are linked; component_id is the smallest
    doc_id that can be reached over links. Reads the columns doc_id and text only. Null
    and empty texts have fingerprint 0 and are linked like any other. A row with a null
    doc_id gets its group's component_id (null if the whole group has no id); repeated
    rows give repeated results; an empty table gives an empty result.
    """
    marked = stash(docs.select("doc_id", fingerprint(F.col("text"), words).alias("fp")))
    per_fp = marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = connected(link_fingerprints(per_fp, max_bits, bits_per_level, hot_leaf))
    per_fp = per_fp.join(roots, per_fp.fp == roots.node, "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    ids = per_fp.groupBy("root").agg(F.min("first_id").alias("component_id"))
    per_fp = per_fp.join(ids, "root").select("fp", "component_id")
    return marked.join(per_fp, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, max_bits: int = 3, words: int = 3) -> DataFrame:
    """``docs`` with one document of each SimHash group: the one with the smallest doc_id.

    Of repeated rows of that id one stays. Rows with a null doc_id can't be named
    and all stay. Further columns are carried along.
    """
    groups = simhash_components(docs.select("doc_id", "text"), max_bits, words)
    keep = groups.where("doc_id = component_id").select("doc_id").distinct()
    named = docs.where("doc_id is not null").join(keep, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.select(docs.columns).union(docs.where("doc_id is null"))


def query(spark, sf_dir: str) -> DataFrame:
    """op3: SimHash groups of all documents (3-word shingles, 3 bits)."""
    from tripwire.llm.shared import read
    found = simhash_components(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
