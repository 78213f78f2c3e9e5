"""Secret scans: fixed patterns and sliding-window entropy; DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwire.llm.shared import read

# The base patterns (kind, pattern after any gap, cheap test, least length of the last group).
ASSIGN = r"""(?:(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""
ACCESS = r"(?:AKIA[A-Z0-9]{14,})"
HEX = r"(?:[0-9a-f]{16,})"
ASSIGN_VALUE = 12

#: Candidate strings of the entropy scan: runs of letters and digits, and longer ones joined by the other characters of
#: base64 and its url-safe form. An equals sign ends a candidate, so a key is never judged together with its value.
RUN, JOINED = r"(?:[A-Za-z0-9]{20,})", r"(?:[A-Za-z0-9+/_-]{20,})"
WINDOW = 20
#: Classes of a candidate, the first that fits: kind, pattern of the whole, and the bits that a window must reach. Random
#: strings of 16, 32, 36 and 62 symbols have about 3.4, 3.8, 3.85 and 4.05 bits in 20 characters; all but hex need a digit,
#: the last also both cases, which words and paths seldom have.
CLASSES = (("entropy_hex", r"^(?:[0-9a-f]+|[0-9A-F]+)$", 3.0), ("entropy_base32", r"^(?=.*[0-9])[A-Z2-7]+$", 3.5),
           ("entropy_alnum", r"^(?=.*[0-9])(?:[0-9a-z]+|[0-9A-Z]+)$", 3.55), ("entropy_mixed", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z]).+$", 3.9))
#: Candidates that hold one of these are no secrets: placeholders, plain words and numbers with what joins them.
ALLOW = (r"(?i)example|sample|placeholder|dummy|changeme", r"^[A-Za-z/_+-]+$", r"^[0-9/_+-]+$")
KINDS = ("assign", "access", "hex", *(c for c, _, _ in CLASSES))
#: A candidate is scanned in pieces of so many characters, each with the last WINDOW - 1 of the one before.
PIECE = 256
MARK = "[SECRET]"


def _matches(text: Column, pattern: str, kind: int, value: bool = False, keep=None) -> Column:
    """Spans (start, end, kind, body) of the leftmost non-overlapping matches, in code points.

    Every match is taken with the gap before it (the anchor makes it begin where the last
    one ended), so the running sum of lengths gives its place.
    """
    whole = F.lit(rf"\G((?s:.*?))({pattern})")
    parts = F.arrays_zip(
        F.transform(F.regexp_extract_all(text, whole, F.lit(1)), F.length).alias("gap"),
        F.regexp_extract_all(text, whole, F.lit(2)).alias("body"),
        (F.transform(F.regexp_extract_all(text, whole, F.lit(3)), F.length) if value
         else F.array().cast("array<int>")).alias("value"))
    none = F.array().cast("array<struct<start:int,end:int,kind:int,body:string,value:int>>")

    def step(acc, m):
        start = acc["at"] + m["gap"]
        end = start + F.length(m["body"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(
            start.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), m["body"].alias("body"),
            m["value"].alias("value")))).alias("out"))

    spans = F.aggregate(parts, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda acc: acc["out"])
    found = F.when(F.regexp_like(text, F.lit(pattern)), spans).otherwise(none)
    return F.filter(found, keep) if keep else found


def _weight(n: int) -> float:
    """How much the sum of c log2 c grows when a count becomes ``n``."""
    return n * math.log2(n) - ((n - 1) * math.log2(n - 1) if n > 1 else 0.0) if n else 0.0


def _hot_part(body: Column, limit: Column, window: int) -> Column:
    """struct(first, last): ends of the first and last window of a piece whose sum of c log2 c is ``limit`` or less; 0 without one.

    One character enters and one leaves the window at each step; only their counts change
    the sum. The changes are found first, each on its own, and then added up along the piece.
    """
    weight = F.array(*(F.lit(_weight(n)) for n in range(window + 1)))

    def count(where: Column, what: Column) -> Column:
        return F.length(where) - F.length(F.replace(where, what))

    def change(i):
        now = F.substring(body, F.greatest(i - window + 1, F.lit(1)), F.least(i, F.lit(window)))
        entering = F.get(weight, count(now, F.substring(body, i, F.lit(1))))
        before = F.substring(body, i - window, F.lit(window))
        return entering - F.when(i > window, F.get(weight, count(before, F.substring(body, i - window, F.lit(1))))).otherwise(F.lit(0.0))

    def step(acc, d):
        at = acc["at"] + 1
        high = (at >= window) & (acc["sum"] + d <= limit)
        return F.struct((acc["sum"] + d).alias("sum"), at.alias("at"), F.when(high & (acc["first"] == 0), at).otherwise(acc["first"]).alias("first"),
                        F.when(high, at).otherwise(acc["last"]).alias("last"))

    zero = F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("at"), F.lit(0).alias("first"), F.lit(0).alias("last"))
    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(body)), change), zero, step)


def _hot_whole(body: Column, limit: Column, window: int) -> Column:
    """struct(first, last) as of ``_hot_part``, null without one, for a candidate of any length.

    Its pieces overlap by a window less one, so each window is in one of them. Pieces are scanned from the start until
    one has such a window, then from the end.
    """
    step = PIECE - window + 1
    found = F.regexp_extract_all(body, F.lit(f"(?=(.{{1,{PIECE}}})).{{1,{step}}}"), F.lit(1))
    pieces = F.transform(found, lambda p, k: F.struct(p.alias("p"), (k * step).alias("at")))

    def nearest(order: Column, which: str) -> Column:
        return F.aggregate(order, F.lit(None).cast("int"),
                           lambda acc, x: F.coalesce(acc, F.nullif(_hot_part(x["p"], limit, window)[which], F.lit(0)) + x["at"]))

    both = F.transform(F.array(nearest(pieces, "first")), lambda first: F.struct(
        first.alias("first"), F.when(first.isNotNull(), nearest(F.reverse(pieces), "last")).alias("last")))
    return F.get(both, F.lit(0))


def _entropy_spans(candidates: Column, window: int, classes: tuple, allow: tuple[str, ...]) -> Column:
    ok = F.filter(candidates, lambda s: ~F.regexp_like(s["body"], F.lit("|".join(f"(?:{p})" for p in allow))) if allow
                  else F.lit(True))

    def classed(s):
        kind = F.lit(None).cast("int")
        for k in reversed(range(len(classes))):
            kind = F.when(F.regexp_like(s["body"], F.lit(classes[k][1])), F.lit(3 + k)).otherwise(kind)
        return F.struct(s["start"].alias("start"), s["body"].alias("body"), kind.alias("kind"))

    def scored(s):
        # entropy = log2(window) - sum / window
        limit = F.get(F.array(*(F.lit((math.log2(window) - b + 1e-9) * window) for _, _, b in classes)), s["kind"] - 3)
        return F.struct(s["start"].alias("start"), _hot_whole(s["body"], limit, window).alias("part"), s["kind"].alias("kind"))

    known = F.filter(F.transform(ok, classed), lambda s: s["kind"].isNotNull())
    hot = F.filter(F.transform(known, scored), lambda s: s["part"]["last"].isNotNull())
    return F.transform(hot, lambda s: F.struct((s["start"] + s["part"]["first"] - window).alias("start"),
                                               (s["start"] + s["part"]["last"]).alias("end"), s["kind"].alias("kind")))


def _plain(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))


def _uncovered(spans: Column) -> Column:
    """Spans by start, then kind, without those added ones that lie in another (of equal ones the first kind stays).

    Taken by start, the longest first, a span lies in an earlier one if it ends no later than any did.
    """
    longest_first = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], (-s["end"]).alias("back"), s["kind"])))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")

    def step(acc, s):
        end = -s["back"]
        here = F.array(F.struct(s["start"].alias("start"), s["kind"].alias("kind"), end.alias("end")))
        return F.struct(F.greatest(acc["end"], end).alias("end"),
                        F.when((s["kind"] < 3) | (end > acc["end"]), F.concat(acc["out"], here)).otherwise(acc["out"]).alias("out"))

    return F.array_sort(F.aggregate(longest_first, F.struct(F.lit(-1).alias("end"), none.alias("out")), step, lambda acc: acc["out"]))


def scan(docs: DataFrame, text_col: str = "text", window: int = WINDOW, classes: tuple = CLASSES,
         allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """``docs`` with base_spans and all_spans, arrays of (start, kind, end) by start, then kind.

    kind counts KINDS from 0; start and end (exclusive) are code points of the whole text.
    Base spans: keyword assignments with a value of 12 or more characters, access keys of 18
    or more, runs of 16 or more lower-case hex digits. The entropy scan adds the parts of
    candidate strings (20 or more characters) whose windows of ``window`` characters
    reach the bits of the candidate's class, unless the candidate is on the allow-list or the part
    lies in a base span or in another part. Null and empty texts have no spans; texts and candidates of any length take
    time by their length; repeated rows stay; columns of ``docs`` with the two names are replaced.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    joined = _matches(text, JOINED, 4, keep=lambda s: F.regexp_like(s["body"], F.lit("[+/_-]")))
    df = (docs.drop("base_spans", "all_spans")
          .withColumn("_assign", _matches(text, ASSIGN, 0, True, lambda s: s["value"] >= ASSIGN_VALUE))
          .withColumn("_access", _matches(text, ACCESS, 1))
          .withColumn("_hex", _matches(text, HEX, 2))
          .withColumn("_entropy", _entropy_spans(F.concat(_matches(text, RUN, 3), joined), window, classes, allow)))
    df = df.withColumn("base_spans", F.array_sort(F.concat(*(_plain(F.col(c)) for c in ("_assign", "_access", "_hex")))))
    df = df.withColumn("all_spans", _uncovered(F.concat("base_spans", _plain(F.col("_entropy")))))
    return df.drop("_assign", "_access", "_hex", "_entropy")


def digest(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def redact(docs: DataFrame, mark: str = MARK, **options) -> DataFrame:
    """``docs`` with every secret in text replaced by ``mark`` (overlapping spans by one) and n_chars set anew if it is there."""
    found = scan(docs, **options)

    def step(acc, s):
        new = s["start"] >= acc["at"]
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(new, F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark)))
                        .otherwise(acc["out"]).alias("out"))

    clean = F.aggregate("all_spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                        lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    found = found.withColumn("text", F.when(F.size("all_spans") > 0, clean).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.when(F.size("all_spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return found.select(docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    """op7: secrets of every document."""
    found = scan(read(spark, sf_dir, "documents").select("doc_id", "text"))
    n = lambda k: F.size(F.filter("base_spans", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
                        F.sha2(digest("base_spans"), 256).alias("base_sha256"), digest("all_spans").alias("spans"))


def _found_sql(name: str, pattern: str, groups: int = 2) -> str:
    """CTEs: every match of a pattern with the gap before it, then its place from the lengths."""
    lists = ", ".join(f"regexp_extract_all(t, '(?s:(.*?))({pattern})', {g}) AS g{g}" for g in range(1, groups + 1))
    parts = ", ".join(f"unnest(g{g}) AS v{g}" for g in range(1, groups + 1))
    return f"""{name}0 AS (SELECT doc_id, {lists} FROM d),
{name}1 AS (SELECT doc_id, unnest(range(len(g1))) AS i, {parts} FROM {name}0),
{name} AS (SELECT *, sum(length(v1) + length(v2)) OVER (PARTITION BY doc_id ORDER BY i) AS e FROM {name}1)"""


def _oracle() -> str:
    assign = ASSIGN.replace("'", "''")
    allow = " AND ".join(f"NOT regexp_matches(v2, '{p}')" for p in ALLOW)
    # RE2 has no lookahead: a class is its characters and what it must hold
    kind = """CASE WHEN regexp_full_match(v2, '[0-9a-f]+|[0-9A-F]+') THEN 3
              WHEN regexp_full_match(v2, '[A-Z2-7]+') AND regexp_matches(v2, '[0-9]') THEN 4
              WHEN regexp_full_match(v2, '[0-9a-z]+|[0-9A-Z]+') AND regexp_matches(v2, '[0-9]') THEN 5
              WHEN regexp_matches(v2, '[0-9]') AND regexp_matches(v2, '[a-z]') AND regexp_matches(v2, '[A-Z]') THEN 6 END"""
    bits = "CASE kind " + " ".join(f"WHEN {3 + k} THEN {b}" for k, (_, _, b) in enumerate(CLASSES)) + " END"
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
{_found_sql("a", assign, 3)},
{_found_sql("k", ACCESS)},
{_found_sql("h", HEX)},
{_found_sql("r", RUN)},
{_found_sql("j", JOINED)},
c AS (SELECT doc_id, v2, e FROM r UNION ALL SELECT doc_id, v2, e FROM j WHERE regexp_matches(v2, '[+/_-]')),
base AS (
  SELECT doc_id, e - length(v2) AS s, e, 0 AS kind FROM a WHERE length(v3) >= {ASSIGN_VALUE}
  UNION ALL SELECT doc_id, e - length(v2), e, 1 FROM k
  UNION ALL SELECT doc_id, e - length(v2), e, 2 FROM h),
w AS (
  SELECT doc_id, e - length(v2) AS s, v2, unnest(range({WINDOW}, length(v2) + 1)) AS x, {kind} AS kind
  FROM c WHERE {allow}),
ch AS (SELECT doc_id, s, x, kind, unnest(string_split(substr(v2, CAST(x - {WINDOW} + 1 AS BIGINT), {WINDOW}), '')) AS ch FROM w WHERE kind IS NOT NULL),
n AS (SELECT doc_id, s, x, kind, ch, count(*) AS n FROM ch GROUP BY ALL),
en AS (
  SELECT doc_id, s, x, kind FROM n GROUP BY ALL
  HAVING -sum(n / {WINDOW}.0 * log2(n / {WINDOW}.0)) >= {bits} - 1e-9),
hot AS (SELECT doc_id, s + min(x) - {WINDOW} AS s, s + max(x) AS e, kind FROM en GROUP BY doc_id, en.s, kind),
spans AS (
  SELECT * FROM base
  UNION ALL
  SELECT * FROM hot WHERE NOT EXISTS (
    SELECT 1 FROM base WHERE base.doc_id = hot.doc_id AND base.s <= hot.s AND base.e >= hot.e)
  AND NOT EXISTS (
    SELECT 1 FROM hot o WHERE o.doc_id = hot.doc_id AND o.s <= hot.s AND o.e >= hot.e AND (o.s <> hot.s OR o.e <> hot.e OR o.kind < hot.kind))),
g AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n0, count(*) FILTER (kind = 1) AS n1, count(*) FILTER (kind = 2) AS n2,
         string_agg(name, ',' ORDER BY s, kind, e) FILTER (kind < 3) AS b, string_agg(name, ',' ORDER BY s, kind, e) AS spans
  FROM (SELECT *, list_extract({list(KINDS)}, kind + 1) || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT) AS name FROM spans)
  GROUP BY doc_id)
SELECT d.doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex,
       sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)
"""


ORACLE = _oracle()
