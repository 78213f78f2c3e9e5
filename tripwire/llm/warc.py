"""Not-modified revisits of web archives resolved to the full responses they stand for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripwire.llm.shared import read, stash

#: Headers that a 304 answer may renew in the stored response.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")


def canonical_url(url: Column) -> Column:
    """Host (lower case, no www., no default port), path without a closing slash, query sorted without utm_ keys; no scheme, no fragment.

    Null for null.
    """
    bare = F.regexp_replace(F.regexp_replace(url, r"(?s)#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(bare, r"^[^/?]*", 0)), r"^www\.", ""), r":(?:80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    keys = F.array_sort(F.filter(F.split(F.regexp_extract(bare, r"(?s)\?(.*)$", 1), "&"), lambda q: (q != "") & ~q.startswith("utm_")))
    return F.concat(host, path, F.when(F.size(keys) > 0, F.concat(F.lit("?"), F.array_join(keys, "&"))).otherwise(""))


def lower_headers(headers: Column) -> Column:
    """Header map with lower-case names; values of names that fall together are joined by a comma in order of their spelling, nulls go. Empty for null."""
    entries = F.array_sort(F.filter(F.coalesce(F.map_entries(headers), F.array().cast("array<struct<key:string,value:string>>")),
                                    lambda e: e["value"].isNotNull()))
    low = F.transform(entries, lambda e: F.struct(F.lower(F.trim(e["key"])).alias("key"), e["value"].alias("value")))
    names = F.array_distinct(F.transform(low, lambda e: e["key"]))
    return F.map_from_arrays(names, F.transform(names, lambda n: F.array_join(
        F.transform(F.filter(low, lambda e: e["key"] == n), lambda e: e["value"]), ", ")))


def resolve(records: DataFrame, permitted: tuple[str, ...] = PERMITTED) -> DataFrame:
    """record_id, url, canonical, ts, base_id, outcome, headers of every revisit in ``records``.

    ``records`` has record_id, url, ts (a number or a time), kind (response or revisit), status and
    headers (a map). A revisit's base is the latest response with status 200 of the same
    canonical url before it, by ts, then record_id. outcome is ``resolved`` if the ETags (weak
    marks apart) agree, or without two ETags the Last-Modified values; ``mismatch`` if they
    differ; ``unverified`` if there is nothing to compare; ``orphan`` without a base (base_id and
    headers null), which holds for a null url or ts as well. A resolved or
    unverified revisit's headers are the base's, renewed by the revisit's permitted ones; a
    mismatch has null headers.

    Rows are dealt out in order of url and time, so a url with any share of the records is spread over
    tasks; each part hands on its last full response, one row a part. Payloads are not
    read: base_id names them. Repeated rows stay, other columns go.
    """
    rows = records.select("record_id", "url", canonical_url(F.col("url")).alias("canonical"), "ts",
                          F.coalesce((F.col("kind") == "response") & (F.col("status") == 200), F.lit(False)).alias("full"),
                          F.coalesce(F.col("kind") == "revisit", F.lit(False)).alias("revisit"), lower_headers(F.col("headers")).alias("headers"))
    rows = rows.where("full or revisit")
    dealt = stash(rows.where("canonical is not null and ts is not null")
                  .repartitionByRange("canonical", "ts", "record_id").withColumn("part", F.spark_partition_id()))
    base = F.struct(F.col("record_id").alias("id"), F.col("headers").alias("headers"))
    before = Window.partitionBy("part", "canonical").orderBy("ts", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    here = dealt.withColumn("base", F.last(F.when(F.col("full"), base), ignorenulls=True).over(before)).where("revisit")
    # Only a part's first and last url can go on in another part.
    ends = dealt.groupBy("part").agg(F.min("canonical").alias("a"), F.max("canonical").alias("b"))
    shared = (ends.select("part", F.explode(F.array("a", "b")).alias("canonical")).distinct()
              .groupBy("canonical").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("canonical"))
    last = (dealt.join(shared, "canonical").groupBy("part", "canonical")
            .agg(F.max_by(F.when(F.col("full"), base), F.when(F.col("full"), F.struct("ts", "record_id"))).alias("last")))
    handed = last.select("part", "canonical", F.last("last", ignorenulls=True).over(
        Window.partitionBy("canonical").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("handed"))
    found = here.join(handed, ["part", "canonical"], "left").withColumn("base", F.coalesce("base", "handed"))
    lost = (rows.where("revisit and (canonical is null or ts is null)")
            .withColumn("base", F.lit(None).cast(found.schema["base"].dataType)))
    cols = ["record_id", "url", "canonical", "ts", "headers", "base"]
    found = found.select(cols).unionByName(lost.select(cols))

    def header(where: str, name: str) -> Column:
        return F.try_element_at(F.col(where), F.lit(name))

    tag = lambda where: F.regexp_replace(F.trim(header(where, "etag")), "^W/", "")
    same = F.coalesce(tag("headers") == tag("base.headers"), F.trim(header("headers", "last-modified")) == F.trim(header("base.headers", "last-modified")))
    outcome = (F.when(F.col("base").isNull(), "orphan").when(same.isNull(), "unverified").when(same, "resolved").otherwise("mismatch"))
    renew = F.map_filter("headers", lambda k, v: k.isin(*permitted))
    merged = F.map_concat(F.map_filter("base.headers", lambda k, v: ~F.map_contains_key(renew, k)), renew)
    return (found.withColumn("outcome", outcome)
            .select("record_id", "url", "canonical", "ts", F.col("base.id").alias("base_id"), "outcome",
                    F.when(F.col("outcome").isin("resolved", "unverified"), merged).alias("headers")))


def captures(pages: DataFrame) -> DataFrame:
    """Archive records of ``pages``: a full response of each page and two later not-modified revisits.

    Page p is fetched at minute p, its ETag is the md5 of the html (none where p mod 7 is
    3). An hour later a revisit, of the url in another spelling, repeats the ETag, or Last-Modified
    where there is none; two hours later another has a changed ETag where p mod 3 is 0, and no
    validator else.
    """
    p, minute = F.col("page_id"), F.lit(60)
    etag = F.concat(F.lit('"'), F.md5(F.coalesce(F.col("html"), F.lit(""))), F.lit('"'))
    plain = p % 7 == 3
    modified = F.concat(F.lit("day "), (p % 1000).cast("string"))
    text = lambda *kv: F.create_map(*(F.lit(x) if isinstance(x, str) else x for x in kv))
    none = F.lit(None).cast("string")
    df = pages.select("page_id", "url", "html")
    every = F.array(
        F.struct((p * 3).alias("record_id"), F.col("url").alias("url"), (p * minute).alias("ts"), F.lit("response").alias("kind"),
                 F.lit(200).alias("status"),
                 text("ETag", F.when(~plain, etag), "Last-Modified", modified, "Content-Type", "text/html", "Date", (p * minute).cast("string"),
                      "Content-Length", F.length("html").cast("string")).alias("headers")),
        F.struct((p * 3 + 1).alias("record_id"), F.concat("url", F.lit("#again")).alias("url"), (p * minute + 3600).alias("ts"), F.lit("revisit").alias("kind"),
                 F.lit(304).alias("status"),
                 text("etag", F.when(~plain, F.concat(F.lit("W/"), etag)), "last-modified", modified, "date", (p * minute + 3600).cast("string"),
                      "content-length", "0").alias("headers")),
        F.struct((p * 3 + 2).alias("record_id"), F.col("url").alias("url"), (p * minute + 7200).alias("ts"), F.lit("revisit").alias("kind"),
                 F.lit(304).alias("status"),
                 text("ETag", F.when(p % 3 == 0, F.lit('"changed"')), "Cache-Control", F.when(p % 2 == 0, F.lit("max-age=60")).otherwise(none),
                      "Date", (p * minute + 7200).cast("string")).alias("headers")))
    return df.select(F.explode(every).alias("r")).select("r.*")


def query(spark, sf_dir: str) -> DataFrame:
    """op8: all revisits in the capture log of pages, with their base and merged headers (sorted lines)."""
    found = resolve(captures(read(spark, sf_dir, "pages")))
    lines = F.array_join(F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat_ws(": ", e["key"], e["value"])), "\n")
    return found.select("record_id", "canonical", "ts", "base_id", "outcome", lines.alias("headers"))


ORACLE = r"""
WITH p AS (
  SELECT page_id AS p, url, html, '"' || md5(coalesce(html, '')) || '"' AS tag, 'day ' || (page_id % 1000) AS modified FROM pages),
r AS (
  SELECT p * 3 AS record_id, url, p * 60 AS ts, true AS is_full, CASE WHEN p % 7 <> 3 THEN tag END AS etag, modified,
         CAST(p * 60 AS VARCHAR) AS date, CAST(NULL AS VARCHAR) AS cache, CAST(length(html) AS VARCHAR) AS len FROM p
  UNION ALL
  SELECT p * 3 + 1, url || '#again', p * 60 + 3600, false, CASE WHEN p % 7 <> 3 THEN 'W/' || tag END, modified, CAST(p * 60 + 3600 AS VARCHAR), NULL, '0' FROM p
  UNION ALL
  SELECT p * 3 + 2, url, p * 60 + 7200, false, CASE WHEN p % 3 = 0 THEN '"changed"' END, NULL, CAST(p * 60 + 7200 AS VARCHAR),
         CASE WHEN p % 2 = 0 THEN 'max-age=60' END, NULL FROM p),
b AS (
  SELECT *, regexp_replace(regexp_replace(url, '(?s)#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM r),
q AS (
  SELECT *, list_sort([x FOR x IN string_split(regexp_extract(bare, '(?s)\?(.*)$', 1), '&') IF x <> '' AND NOT starts_with(x, 'utm_')]) AS keys FROM b),
c AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(bare, '^[^/?]*')), '^www\.', ''), ':(?:80|443)$', '')
         || regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '')
         || CASE WHEN len(keys) > 0 THEN '?' || array_to_string(keys, '&') ELSE '' END AS canonical
  FROM q),
w AS (
  SELECT *, max(CASE WHEN is_full THEN struct_pack(t := ts, i := record_id) END) OVER (
           PARTITION BY canonical ORDER BY ts, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS base
  FROM c),
j AS (
  SELECT w.record_id, w.canonical, w.ts, f.record_id AS base_id, w.etag, w.modified, w.date, w.cache,
         f.etag AS b_etag, f.modified AS b_modified, f.len AS b_len,
         coalesce(regexp_replace(w.etag, '^W/', '') = regexp_replace(f.etag, '^W/', ''), w.modified = f.modified) AS same
  FROM w LEFT JOIN r f ON f.record_id = w.base.i WHERE NOT w.is_full),
o AS (
  SELECT *, CASE WHEN base_id IS NULL THEN 'orphan' WHEN same IS NULL THEN 'unverified' WHEN same THEN 'resolved' ELSE 'mismatch' END AS outcome FROM j)
SELECT record_id, canonical, ts, base_id, outcome,
       CASE WHEN outcome IN ('resolved', 'unverified') THEN
         coalesce('cache-control: ' || cache || chr(10), '')
         || coalesce('content-length: ' || b_len || chr(10), '')
         || 'content-type: text/html' || chr(10) || 'date: ' || date
         || coalesce(chr(10) || 'etag: ' || coalesce(etag, b_etag), '')
         || coalesce(chr(10) || 'last-modified: ' || coalesce(modified, b_modified), '') END AS headers
FROM o
"""
