"""URL filter: fixed host and path rules first, then association rules mined by FP-growth."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwire.llm.shared import read, stash

# Fixed values: (verdict, host, path). A rule fits its host and all subdomains if the path starts with its own.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
BLOCKED = "label=block"


def host(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty without ://."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 1), UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host up to ? # or the end; empty without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2)


def fixed_rule(host_col: Column, path_col: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, null if none does; ``rules`` is a short list given in code."""
    found = None
    for verdict, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host_col == h) | host_col.endswith("." + h)) & path_col.startswith(p)
        what = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, what) if found is None else found.when(fits, what)
    return found if found is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def tokens(url: Column) -> Column:
    """Distinct tokens of a url: scheme, host suffixes, path segments (numbers as #), file ending, query keys, fragment."""
    h, p = host(url), path(url)
    labels = F.filter(F.split(h, r"\."), lambda x: x != "")
    suffixes = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels), F.lit(1))),
                           lambda n: F.concat(F.lit("host="), F.array_join(F.slice(labels, -F.least(n, F.size(labels)), n), ".")))
    segments = F.transform(F.filter(F.split(p, "/"), lambda x: x != ""),
                           lambda x: F.concat(F.lit("path="), F.regexp_replace(x, "[0-9]+", "#")))
    keys = F.transform(F.regexp_extract_all(url, F.lit(r"[?&]([^=&#?]+)"), F.lit(1)), lambda x: F.concat(F.lit("query="), x))
    parts = F.concat(
        F.array(F.concat(F.lit("scheme="), F.regexp_extract(url, r"(?s)^(.*?)://", 1))),
        F.when(F.size(labels) > 0, suffixes).otherwise(F.array().cast("array<string>")), segments, keys,
        F.when(F.contains(url, F.lit("#")), F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>")))
    return F.when(F.contains(url, F.lit("://")), F.array_distinct(parts)).otherwise(F.array().cast("array<string>"))


def token_classes(rows: DataFrame) -> DataFrame:
    """(token, cls) of tokens that stand in just the same rows of ``rows`` (t): cls is the least of them.

    Tokens that always come together would multiply the frequent sets by two each; as one item they don't.
    Equal rows are told by a 128-bit signature of where a token stands.
    """
    where = rows.groupBy("t").agg(F.count(F.lit(1)).alias("n")).withColumns({"a": F.xxhash64("t"), "b": F.xxhash64(F.lit(1), "t")})
    signed = where.select(F.explode("t").alias("token"), "n", "a", "b").groupBy("token").agg(
        F.sum("n").alias("n"), F.bit_xor("a").alias("a"), F.sum(F.col("b").cast("decimal(38,0)")).alias("b"))
    least = signed.groupBy("n", "a", "b").agg(F.min("token").alias("cls"))
    return signed.join(least, ["n", "a", "b"]).select("token", "cls")


def _classed(rows: DataFrame, key: str, listed: str, classes: DataFrame) -> DataFrame:
    """(key, items): the distinct classes of the tokens of each row; a token that was not seen is its own."""
    each = rows.select(key, F.explode(listed).alias("token")).join(classes, "token", "left")
    return each.groupBy(key).agg(F.collect_set(F.coalesce("cls", "token")).alias("items"))


def mine(labelled: DataFrame, min_support: float = 0.002, min_confidence: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Rules for blocking (tokens, n, blocked, confidence, key) from rows (url, blocked), and the classes (token, cls) of their tokens.

    Spark's FP-growth finds the token sets, of any size, that occur in ``min_support`` of the rows together
    with the label; those blocked in ``min_confidence`` of their rows are rules. A rule is pruned if a part of its tokens
    is a rule already. Tokens that always come together are one item, named by its least; a url that has any of them has
    the item. key is the rule's rarest item. Null urls and labels and urls without tokens say nothing.
    """
    spark = labelled.sparkSession
    rows = stash(labelled.where("url is not null and blocked is not null").select(tokens(F.col("url")).alias("t"), "blocked").where(F.size("t") > 0)
                 .withColumn("row", F.monotonically_increasing_id()))
    classes = stash(token_classes(rows))
    items = _classed(rows, "row", "t", classes).join(rows.select("row", "blocked"), "row")
    items = items.select(F.when(F.col("blocked"), F.array_append("items", F.lit(BLOCKED))).otherwise(F.col("items")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence,
                     numPartitions=int(spark.conf.get("spark.sql.shuffle.partitions"))).fit(items)
    sets = stash(model.freqItemsets.select(F.array_sort("items").alias("items"), "freq"))
    joint = (sets.where(F.array_contains("items", BLOCKED) & (F.size("items") > 1))
             .select(F.array_remove("items", BLOCKED).alias("tokens"), F.col("freq").alias("blocked")))
    rated = stash(joint.join(sets.select(F.col("items").alias("tokens"), F.col("freq").alias("n")), "tokens")
                  .select("tokens", "n", "blocked", (F.col("blocked") / F.col("n")).alias("confidence"), F.size("tokens").alias("size")))
    # By size: a set is wider than a rule if a set with one token less is a rule or wider than one. Those sets are all here,
    # since a part of a frequent set is frequent.
    rules, over = None, None
    for size in range(1, (rated.agg(F.max("size")).first()[0] or 0) + 1):
        level = rated.where(F.col("size") == size)
        if over is None:
            level = level.withColumn("wider", F.lit(False))
        else:
            less = (level.select("tokens", F.explode("tokens").alias("x")).select("tokens", F.array_remove("tokens", F.col("x")).alias("part"))
                    .join(over.select(F.col("tokens").alias("part")), "part").select("tokens").distinct().withColumn("wider", F.lit(True)))
            level = level.join(less, "tokens", "left").withColumn("wider", F.coalesce("wider", F.lit(False)))
        level = stash(level.withColumn("rule", ~F.col("wider") & (F.col("confidence") >= min_confidence)))
        over = level.where("rule or wider")
        rules = level.where("rule") if rules is None else rules.union(level.where("rule"))
    if rules is None:
        rules = rated.withColumn("wider", F.lit(False)).withColumn("rule", F.lit(False))
    singles = sets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), F.col("freq").alias("seen"))
    key = (rules.select("tokens", F.explode("tokens").alias("token")).join(singles, "token")
           .groupBy("tokens").agg(F.min(F.struct("seen", "token")).alias("k")).select("tokens", F.col("k.token").alias("key")))
    return rules.join(key, "tokens").select("tokens", "n", "blocked", "confidence", "key"), classes


def matched(urls: DataFrame, rules: DataFrame, classes: DataFrame) -> DataFrame:
    """url, confidence of the distinct urls that fit a mined rule (the surest one's), by an inverted index on the rules' rarest items."""
    listed = urls.select("url").where("url is not null").distinct().select("url", tokens(F.col("url")).alias("t"))
    listed = _classed(listed, "url", "t", classes).withColumnRenamed("items", "has")
    hits = (listed.select("url", "has", F.explode("has").alias("key")).join(rules, "key")
            .where(F.size(F.array_except("tokens", "has")) == 0))
    return hits.groupBy("url").agg(F.max("confidence").alias("confidence"))


def judge(pages: DataFrame, labelled: DataFrame, rules=RULES, **mining) -> DataFrame:
    """page_id, host, path, rule, verdict, confidence of every row of ``pages`` (page_id, url).

    verdict is the longest fitting fixed rule's (rule is its host and path), else block if
    a mined rule fits (confidence is the surest one's), else allow. Rows with a null url
    or one without :// have empty host and path, no rule, and are allowed; repeated rows
    stay; other columns go. Without labelled rows nothing is mined.
    """
    df = pages.select("page_id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    df = df.withColumn("fixed", fixed_rule(F.col("host"), F.col("path"), rules))
    learnt = labelled.where("url is not null and blocked is not null")
    if learnt.isEmpty():
        sure = df.select("url").limit(0).withColumn("confidence", F.lit(0.0))
    else:
        sure = matched(df.where("fixed is null"), *mine(learnt, **mining))
    return (df.join(sure, "url", "left")
            .select("page_id", "host", "path", F.col("fixed.rule").alias("rule"),
                    F.coalesce(F.col("fixed.verdict"), F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")).alias("verdict"),
                    F.when(F.col("fixed").isNull(), F.col("confidence")).alias("confidence")))


def labelled_pages(pages: DataFrame, labels: DataFrame, rules=RULES) -> DataFrame:
    """url, blocked: the fixed rule's verdict, else the label of the row with the page's id (quality 0 or toxic 1 is to be blocked)."""
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("bad"))
    df = pages.select("page_id", "url").join(marks, F.col("page_id") == F.col("doc_id"), "left")
    fixed = fixed_rule(host(F.col("url")), path(F.col("url")), rules)
    return df.select("url", F.coalesce(fixed["verdict"] == "block", F.col("bad") == 1).alias("blocked")).where("blocked is not null")


def query(spark, sf_dir: str) -> DataFrame:
    """op10: verdict of every page's url."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, labelled_pages(pages, read(spark, sf_dir, "labels")))
