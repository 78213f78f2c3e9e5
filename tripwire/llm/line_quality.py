"""Quality rules: counts within a text, and lines that too many documents of a host share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwire.llm.shared import read, stash

# White space, symbols, and the base rules.
SPACES, SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"
MIN_WORDS, REPEATED_PERCENT = 50, 50
#: A line goes if it stands in more than MAX_DOCS different texts of its host and in more than MAX_SHARE of them;
#: a document goes if less than LEFT_SHARE of its words is left.
MAX_DOCS, MAX_SHARE, LEFT_SHARE = 10, 0.05, 1 / 3
BROADCAST_LINES = 1_000_000
#: A-Z to a-z, digits to 0.
NORMAL = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", b"abcdefghijklmnopqrstuvwxyz000000000")

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
VERDICT = ("base_failed", "n_common_lines", "n_common_words", "kept")


def repeated_words(words: list[bytes]) -> int:
    """Words in 3-word windows that stand twice or more in ``words``, first ones included."""
    if len(words) < 4:
        return 0
    index = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
    pair = ids[:-1] * len(index) + ids[1:]
    if len(index) >= 1 << 20:  # else three ids fit into 63 bits
        pair = np.unique(pair, return_inverse=True)[1]
    _, back, n = np.unique(pair[:-1] * len(index) + ids[2:], return_inverse=True, return_counts=True)
    twice = n[back] > 1
    hit = np.zeros(len(words), bool)
    for k in range(3):
        hit[k:len(twice) + k] |= twice
    return int(hit.sum())


def measure(text: bytes) -> tuple[tuple[int, ...], list[int], list[int]]:
    """COUNTS of a whole text; hash (0 without a word) and number of words of each line."""
    words = text.split()  # bytes split at the six ASCII spaces alone
    lines = text.split(b"\n")
    parts = [line.translate(NORMAL).split() for line in lines]
    full = [line for line, p in zip(lines, parts, strict=True) if p]
    chars = len(text) - sum(map(text.count, [bytes([c]) for c in SPACES]))
    if not text.isascii():
        raw = np.frombuffer(text, np.uint8)
        chars -= int(((raw & 0xC0) == 0x80).sum())
    counts = (len(words), chars, sum(map(text.count, [bytes([c]) for c in SYMBOLS])), len(full) - len(set(full)), repeated_words(words))
    return counts, [xxhash.xxh64_intdigest(b" ".join(p)) if p else 0 for p in parts], [*map(len, parts)]


def measured(docs: DataFrame, text_col: str = "text", host_col: str = "source", keep_text: bool = True) -> DataFrame:
    """``docs`` (without the text, if not kept) plus COUNTS, _host, _text (a 128-bit hash) and _lines (line, words)."""
    kept = [f for f in docs.schema.fields if f.name not in (*COUNTS, *VERDICT) and (keep_text or f.name != text_col)]
    schema = T.StructType([*kept, *T.StructType.fromDDL(
        ", ".join(f"{c} long" for c in COUNTS) + ", _host long, _text binary, _lines array<struct<line: long, words: int>>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [t or b"" for t in part.column("_raw").to_pylist()]
                found = [measure(t) for t in texts]
                ends = np.concatenate([[0], np.cumsum([len(x) for _, x, _ in found])]).astype(np.int32)
                line = np.array([h for _, x, _ in found for h in x], np.uint64).view(np.int64)
                n = np.array([k for *_, x in found for k in x], np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(f.name) for f in kept), *(pa.array(c, pa.int64()) for c in zip(*(x for x, *_ in found), strict=True)),
                     part.column("_host"), pa.array([xxhash.xxh128_digest(t) for t in texts], pa.binary()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(line), pa.array(n)], ["line", "words"]))],
                    names=schema.names)

    return docs.select(*(F.col(f.name) for f in kept), F.xxhash64(F.col(host_col)).alias("_host"),
                       F.col(text_col).cast("binary").alias("_raw")).mapInArrow(run, schema)


def common_lines(found: DataFrame, max_docs: int = MAX_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """(_host, line) of the lines above the limits, from the rows of ``measured``.

    Equal texts of a host count once: copies are for the near-duplicate operators, and would otherwise condemn
    each other's every line.
    """
    texts = found.where(F.exists("_lines", lambda x: x["words"] > 0)).select("_host", "_text", "_lines").dropDuplicates(["_host", "_text"])
    hosts = found.select("_host", "_text").distinct().groupBy("_host").agg(F.count(F.lit(1)).alias("_docs"))
    each = F.array_distinct(F.transform(F.filter("_lines", lambda x: x["words"] > 0), lambda x: x["line"]))
    n = (texts.select("_host", F.explode(each).alias("line")).groupBy("_host", "line").agg(F.count(F.lit(1)).alias("_n"))
         .where(F.col("_n") > max_docs))
    return n.join(hosts, "_host").where(F.col("_n") > max_share * F.col("_docs")).select("_host", "line")


def _judged(docs: DataFrame, text_col: str, host_col: str, keep_text: bool, max_docs: int, max_share: float,
            left_share: float) -> DataFrame:
    """Rows of ``measured`` plus VERDICT and _cut, the numbers of the common lines of each."""
    found = stash(measured(docs.withColumn("_row", F.monotonically_increasing_id()), text_col, host_col, keep_text))
    common = stash(common_lines(found, max_docs, max_share))
    few = common.count() <= BROADCAST_LINES  # else a plain join, whose hot lines adaptive execution splits
    hits = (found.select("_row", "_host", F.posexplode("_lines").alias("_at", "_l")).where("_l.words > 0")
            .select("_row", "_host", "_at", "_l.line", "_l.words").join(F.broadcast(common) if few else common, ["_host", "line"])
            .groupBy("_row").agg(F.count(F.lit(1)).alias("n_common_lines"), F.sum("words").alias("n_common_words"),
                                 F.collect_list("_at").alias("_cut")))
    n = found.drop("_lines", "_host", "_text").join(hits, "_row", "left").drop("_row")
    n = n.withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in VERDICT[1:3]})
    n = n.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words")))
    return n.withColumn("kept", ~F.col("base_failed") & (F.col("n_words") - F.col("n_common_words") >= left_share * F.col("n_words")))


def judge(docs: DataFrame, text_col: str = "text", host_col: str = "source", max_docs: int = MAX_DOCS,
          max_share: float = MAX_SHARE, left_share: float = LEFT_SHARE) -> DataFrame:
    """``docs`` without the text, plus COUNTS and VERDICT of each row.

    Words are runs of other characters than the six ASCII spaces, lines end at line feeds. A line without
    a word is none. Lines are compared with A-Z lower-cased, digits as 0 and spaces joined, by a 64-bit
    hash. A line in more than ``max_docs`` different texts of its host and more than ``max_share`` of them is common.
    kept: neither are there under 50 words or more than half of them in repeated 3-word windows (base_failed),
    nor is less than ``left_share`` of the words left without the common lines. Null texts have no words; null
    hosts are one host; texts of any length are taken whole; repeated rows stay and are judged alike; columns
    of ``docs`` with the new names are replaced; empty in, empty out.
    """
    found = _judged(docs, text_col, host_col, False, max_docs, max_share, left_share)
    return found.select(*(c for c in found.columns if c not in (*COUNTS, *VERDICT, "_cut")), *COUNTS, *VERDICT)


def clean(docs: DataFrame, text_col: str = "text", host_col: str = "source", max_docs: int = MAX_DOCS,
          max_share: float = MAX_SHARE, left_share: float = LEFT_SHARE) -> DataFrame:
    """The kept rows of ``docs``, their common lines taken out of the text (rules: see ``judge``)."""
    @F.arrow_udf("string")
    def without(texts: pa.Array, cuts: pa.Array) -> pa.Array:
        out = []
        for text, cut in zip(texts.to_pylist(), cuts.to_pylist(), strict=True):
            gone = set(cut or ())
            out.append("\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone) if gone else text)
        return pa.array(out, pa.string())

    found = _judged(docs.drop(*COUNTS, *VERDICT), text_col, host_col, True, max_docs, max_share, left_share).where("kept")
    found = found.withColumn(text_col, without(F.col(text_col), F.col("_cut"))).drop(*COUNTS, *VERDICT, "_cut")
    return found.select(*(c for c in docs.columns if c in found.columns))


def query(spark, sf_dir: str) -> DataFrame:
    """op11: counts and verdict of every document, its source as host."""
    return judge(read(spark, sf_dir, "documents").select("doc_id", "source", "text")).drop("source")


ORACLE = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, row_number() OVER () AS r,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
w AS (SELECT r, unnest(words) AS w, unnest(range(len(words))) AS i FROM d),
tri AS (
  SELECT r, i, w || ' ' || lead(w) OVER o || ' ' || lead(w, 2) OVER o AS g FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
twice AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM tri WHERE g IS NOT NULL),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest(range(3)) AS k) WHERE n > 1 GROUP BY r),
raw AS (SELECT r, source, t, unnest(string_split(t, chr(10))) AS line FROM d),
l AS (
  SELECT r, source, t, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
         trim(regexp_replace(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[0-9]', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS norm
  FROM raw WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM l GROUP BY r),
hosts AS (SELECT source, count(DISTINCT t) AS docs FROM d GROUP BY source),
common AS (
  SELECT l.source, norm FROM l JOIN hosts ON l.source IS NOT DISTINCT FROM hosts.source
  GROUP BY l.source, norm, docs HAVING count(DISTINCT t) > {MAX_DOCS} AND count(DISTINCT t) > {MAX_SHARE}::DOUBLE * docs),
cut AS (
  SELECT r, count(*) AS lines, sum(words) AS words FROM l JOIN common c ON c.norm = l.norm AND c.source IS NOT DISTINCT FROM l.source
  GROUP BY r),
x AS (
  SELECT doc_id, len(d.words) AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(dup.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
         coalesce(cut.lines, 0) AS n_common_lines, CAST(coalesce(cut.words, 0) AS BIGINT) AS n_common_words
  FROM d LEFT JOIN rep USING (r) LEFT JOIN dup USING (r) LEFT JOIN cut USING (r))
SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEATED_PERCENT} * n_words AS base_failed,
       n_words >= {MIN_WORDS} AND 100 * n_repeat_words <= {REPEATED_PERCENT} * n_words
         AND n_words - n_common_words >= {LEFT_SHARE}::DOUBLE * n_words AS kept
FROM x
"""
