"""URL filters: fixed rules first, else association rules mined from labels.

Fixed rules name a host and a path prefix; a rule fits its host and all
subdomains of it where the URL's path starts with the rule's path, and the
longest rule that fits wins.  They are a short parameter list, evaluated as
column expressions.

Other URLs are judged by mined rules.  A URL is a set of tokens: the first host
label, host suffixes, path words, extension, query parameters and fragment,
numbers as ``#``.  Spark's FP-growth finds token combinations that are frequent among the
labelled URLs together with the label ``bad``; rules tokens -> bad are kept from
a least number of bad URLs on, the same however many URLs are labelled (and a share of
them, if one is given), and at the given confidence, unless a rule with fewer of the same tokens
is as confident.  Tokens that the same labelled URLs hold are one class, so a
long path that many URLs share is one item to FP-growth (see :func:`mined`).  A rule is filed in an inverted index under its least frequent
token; the distinct token sets of all URLs look their tokens up there, and a
rule matches if the set holds a token of each of its classes.

Only distinct token sets are mined, matched and joined back, each with its count
of URLs in the statistics, so a host with a third of all rows is no hot group.

Defined cases: a null URL, or one without ``://``, has an empty host and path
and no tokens, fits no rule and is allowed; rules of equal length go by their
text; repeated rows are repeated; without labels nothing is mined.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillbook.llm.common import stored

#: (verdict, host, path)
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
MIN_SUPPORT, MIN_ROWS, MIN_CONFIDENCE = 0.0, 30, 0.6

BAD = "label=bad"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), "^([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: Column) -> Column:
    """The sorted distinct tokens of a URL; empty where it has no host."""
    host, path, rest = host_of(url), path_of(url), _rest(url)
    labels = F.split(host, r"\.")
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), n), lambda k: F.concat(
        F.lit("host="), F.array_join(F.slice(labels, k, n), ".")))
    words = F.transform(F.filter(F.split(path, "[^\\p{L}\\p{N}]+"), lambda w: w.rlike("\\p{L}")),
                        lambda w: F.concat(F.lit("path="), F.regexp_replace(F.lower(w), "\\p{N}+", "#")))
    end = F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1)
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    params = F.transform(F.filter(F.split(query, "&"), lambda w: w != ""),
                         lambda w: F.concat(F.lit("query="), F.regexp_replace(w, "\\p{N}+", "#")))
    mark = F.regexp_extract(rest, "#(.*)$", 1)
    single = F.filter(F.array(
        F.when(end != "", F.concat(F.lit("ext="), F.lower(end))),
        F.when(mark != "", F.concat(F.lit("mark="), F.regexp_replace(mark, "\\p{N}+", "#")))),
        lambda w: w.isNotNull())
    every = F.array_sort(F.array_distinct(F.concat(
        F.transform(F.slice(labels, 1, F.when(n > 2, 1).otherwise(0)), lambda w: F.concat(F.lit("first="), w)),
        suffixes, words, params, single)))
    return F.when(host != "", every).otherwise(F.array().cast("array<string>"))


def fixed_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null."""
    fits = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
                   F.struct(F.lit(len(h + p)).alias("n"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
            for v, h, p in rules]
    if not fits:
        return F.lit(None).cast("struct<n:int,rule:string,verdict:string>")
    return F.array_max(F.array(*fits))


def mined(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_rows: int = MIN_ROWS,
          min_confidence: float = MIN_CONFIDENCE) -> tuple[DataFrame, DataFrame]:
    """Rules (tokens, key, confidence) from (tokens, bad boolean) rows, and the classes (t, rep, n)
    that their tokens stand for.

    Three cuts leave every rule in place and keep FP-growth from listing sets that would fall:
    tokens with too few bad URLs are in no rule; tokens of exactly the same labelled URLs are
    one class, which stands by its least token (two of them in one set count as one); a class
    all of whose URLs are bad is a rule by itself, and sets with more than it fall by it.
    What is left can still be many sets, if many classes overlap in all ways.
    """
    seen = labelled.filter(F.col("bad").isNotNull() & (F.size("tokens") > 0)).select(
        F.array_distinct("tokens").alias("tokens"), "bad")
    sets = stored(seen.groupBy("tokens").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("bad")).alias("n_bad")), "labelled-sets")
    rows = sets.agg(F.sum("n")).first()[0] or 0
    least = max(1, math.ceil(max(min_support * rows, min_rows)))
    each = sets.select(F.explode("tokens").alias("t"), "n", "n_bad", *[
        F.xxhash64(F.lit(i), "tokens").alias(f"h{i}") for i in (1, 2)])
    same = ["h1", "h2", "n", "n_bad"]                     # which URLs hold the token
    classes = stored(each.groupBy("t").agg(
        F.sum("n").alias("n"), F.sum("n_bad").alias("n_bad"), F.bit_xor("h1").alias("h1"),
        F.bit_xor("h2").alias("h2")).filter(F.col("n_bad") >= least).withColumn(
        "rep", F.min("t").over(Window.partitionBy(*same))), "token-classes")
    rules = classes.filter("n = n_bad AND t = rep").select(
        F.array("rep").alias("tokens"), F.col("rep").alias("key"), F.lit(1.0).alias("confidence"))
    classes, open_ = classes.select("t", "rep", "n"), classes.filter("n > n_bad").select("t", "rep")
    items = stored(sets.select("tokens", "n", F.explode("tokens").alias("t")).join(open_, "t").groupBy(
        "tokens", "n").agg(F.collect_set("rep").alias("items")), "labelled-items")
    kept = items.agg(F.sum("n")).first()[0] or 0
    if kept:
        held = seen.join(items.select("tokens", "items"), "tokens").select(F.when(
            F.col("bad"), F.concat("items", F.array(F.lit(BAD)))).otherwise(F.col("items")).alias("items"))
        rules = rules.unionByName(_combined(held, classes, least, kept, min_confidence))
    return stored(rules, "rules"), classes


def _combined(held: DataFrame, classes: DataFrame, least: int, rows: int, min_confidence: float) -> DataFrame:
    """Rules (tokens, key, confidence) that FP-growth finds in ``rows`` item sets."""
    # FP-growth rounds support * rows up, so half a row less keeps ``least`` whatever the division rounds to
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / rows, minConfidence=min_confidence).fit(held)
    # a longer host suffix implies the shorter ones: a set of two of them counts the same URLs
    # as without the shorter, and falls by that; sets of any other tokens are rules of any length
    sets = model.freqItemsets.filter(F.size(F.filter("items", lambda t: t.startswith("host="))) <= 1)
    labelled_so = F.array_contains("items", BAD)
    rules = stored(sets.groupBy(F.array_sort(F.array_remove("items", BAD)).alias("tokens")).agg(
        F.max(F.when(~labelled_so, F.col("freq"))).alias("n"), F.max(F.when(labelled_so, F.col("freq"))).alias("n_bad"))
        .withColumn("confidence", F.col("n_bad") / F.col("n"))
        .filter((F.size("tokens") > 0) & (F.col("confidence") >= min_confidence)), "frequent-rules")
    # a rule falls if dropping one token leaves a rule that is as confident
    parts = rules.select("tokens", "confidence", F.explode("tokens").alias("t")).withColumn(
        "part", F.array_remove(F.col("tokens"), F.col("t")))
    lesser = rules.select(F.col("tokens").alias("part"), F.col("confidence").alias("part_confidence"))
    falls = parts.join(lesser, "part").filter("part_confidence >= confidence").select("tokens")
    rules = rules.join(falls, "tokens", "left_anti")
    key = rules.select("tokens", "confidence", F.explode("tokens").alias("t")).join(classes, "t").groupBy(
        "tokens").agg(F.min(F.struct("n", "t")).alias("k"), F.max("confidence").alias("confidence"))
    return key.select("tokens", F.col("k.t").alias("key"), "confidence")


def mine(labelled: DataFrame, *limits) -> DataFrame:
    """(tokens, confidence): the rules of :func:`mined` with each token of a class in its turn.

    For reading: tokens of the same URLs give one rule each, so there can be many more rows
    than rules; :func:`judged` matches classes and never writes them out.
    """
    rules, classes = mined(labelled, *limits)
    members = classes.groupBy("rep").agg(F.collect_list("t").alias("members"))
    number = rules.withColumn("rule", F.array_join("tokens", "\0"))
    parts = number.select("rule", "confidence", F.explode("tokens").alias("rep")).join(members, "rep").groupBy(
        "rule").agg(F.max("confidence").alias("confidence"), F.collect_list("members").alias("parts"))
    each = F.aggregate("parts", F.array(F.array().cast("array<string>")), lambda all_, ms: F.flatten(
        F.transform(all_, lambda a: F.transform(ms, lambda m: F.array_append(a, m)))))
    return parts.select(F.explode(each).alias("tokens"), "confidence").select(
        F.array_sort("tokens").alias("tokens"), "confidence")


def matched(sets: DataFrame, rules: DataFrame, classes: DataFrame) -> DataFrame:
    """The token sets that hold a token of each class of some rule, with the best confidence."""
    held = stored(sets.select("tokens", F.explode("tokens").alias("t")).join(classes, "t").groupBy("tokens").agg(
        F.array_sort(F.collect_set("rep")).alias("reps")), "held-classes")
    r = rules.select(F.col("tokens").alias("needed"), "key", "confidence")
    best = stored(held.select("reps").distinct().select("reps", F.explode("reps").alias("key")).join(r, "key").filter(
        F.size(F.array_except("needed", "reps")) == 0).groupBy("reps").agg(
        F.max("confidence").alias("confidence")), "matched-classes")
    return held.join(best, "reps").select("tokens", "confidence")


def judged(pages: DataFrame, labelled: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES,
           url: str = "url", page_id: str = "page_id", **options) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    ``labelled`` has (url, bad boolean) rows to mine from.
    """
    seen = labelled.select(tokens_of(F.col("url")).alias("tokens"), "bad")
    rules_found, classes = mined(seen, **options)
    own = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("__url")).withColumns({
        "host": host_of(F.col("__url")), "path": path_of(F.col("__url")), "tokens": tokens_of(F.col("__url"))})
    own = own.withColumn("fit", fixed_rule(F.col("host"), F.col("path"), rules))
    blocked = stored(matched(own.filter(F.col("fit").isNull()).select("tokens").distinct(), rules_found,
                             classes), "blocked-tokens")
    return own.join(blocked, "tokens", "left").select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce(F.col("fit.verdict"), F.when(F.col("confidence").isNotNull(), "block").otherwise("allow"))
        .alias("verdict"), F.when(F.col("fit").isNull(), F.col("confidence")).alias("confidence"))


def labelled_pages(pages: DataFrame, labels: DataFrame, url: str = "url") -> DataFrame:
    """(url, bad) of pages whose path ends in the id of a labelled document: bad if any
    label of it says low quality or toxic."""
    known = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False)))
        .alias("bad"))
    path = path_of(F.col(url))
    number = F.regexp_extract(path, r"/(\d{1,18})(?:\.[A-Za-z]+)?/?$", 1)
    return pages.select(F.col(url).alias("url"), F.when(number != "", number).cast("long").alias("doc_id")).join(
        known, "doc_id").select("url", "bad")
