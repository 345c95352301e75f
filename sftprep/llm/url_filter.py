"""Operator 4: URL filter by stated rules and by mined association rules.

Stated rules (host and path prefix) decide first; the longest that fits wins.
Their verdicts label the urls they reach, and Spark's FP-growth mines the token
combinations of the labelled urls.  Rules pruned by support and confidence
then judge the urls that no stated rule reaches, matched by an inverted index:
a mined rule is filed under its rarest token, so a url is only compared with the
rules of its own tokens.

Sizes: every mined antecedent is a frequent itemset, so with support s and at
most T frequent tokens in a url there are at most 2**T / s of them, whatever the
number of urls.  Verdicts are computed once per distinct url.

Defined results: a null url, or one without ``://``, has an empty host and path,
no rule, and the method's verdict, which is ``default`` where no mined rule
matches; repeated rows each give a row; an empty table gives no rows; without
labelled urls nothing is mined.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sftprep.llm.common import ascii_lower, stored, table

RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.9
LABELS = {"label=block": "block", "label=allow": "allow"}
PATTERN = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, PATTERN, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PATTERN, 2), F.lit(""))


def stated(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """struct<rule, verdict> of the longest stated rule that fits, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: len(r[0])):  # the last that fits is the longest
        at, prefix = rule[: rule.index("/")], rule[rule.index("/") :]
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(prefix)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a url: host labels by place, path parts, query keys, scheme, fragment."""
    labels = F.reverse(F.filter(F.split(host, r"\."), lambda x: x != ""))
    # by place from the right, so that no token implies another and itemsets stay few
    hosts = F.transform(labels, lambda x, i: F.concat(F.lit("host"), (i + 1).cast("string"), F.lit("="), x))
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    # numbers and long digit runs are one token, else every page would have its own
    named = F.transform(parts, lambda p: F.concat(F.lit("path="), F.regexp_replace(p, r"[0-9]+", "0")))
    query = F.filter(F.split(F.regexp_extract(url, r"(?s)\?([^#]*)", 1), "&"), lambda x: x != "")
    keys = F.transform(query, lambda q: F.concat(F.lit("query="), F.split(q, "=")[0]))
    scheme = F.array(F.concat(F.lit("scheme="), F.regexp_extract(url, r"(?s)^(.*?)://", 1)))
    fragment = F.when(url.contains("#"), F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>"))
    words = F.transform(labels, lambda x: F.concat(F.lit("label-of-host="), x))
    return F.array_distinct(F.concat(hosts, named, keys, scheme, fragment))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Pruned rules (antecedent, verdict, confidence, support) from rows (tokens, verdict).

    A rule goes if a more general one with the same verdict is at least as
    confident: it can change no decision.
    """
    spark = labelled.sparkSession
    shape = "antecedent array<string>, verdict string, confidence double, support double"
    baskets = labelled.select(F.concat("tokens", F.array(F.concat(F.lit("label="), "verdict"))).alias("items"))
    if baskets.isEmpty():
        return spark.createDataFrame([], shape)
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    found = model.associationRules.filter(F.element_at("consequent", 1).isin(list(LABELS)))
    rules = found.select("antecedent", F.element_at("consequent", 1).substr(7, 100).alias("verdict"), "confidence", "support")
    rules = stored(rules, "url-rules")
    general = rules.select(F.col("antecedent").alias("a"), F.col("verdict").alias("v"), F.col("confidence").alias("c"), F.explode("antecedent").alias("t"))
    # a more general rule shares a token, so candidates meet by token and not by a cross join
    own = rules.select("*", F.explode("antecedent").alias("t"))
    worse = own.join(general, "t").filter(
        (F.col("v") == F.col("verdict")) & (F.size("a") < F.size("antecedent")) & (F.col("c") >= F.col("confidence")) & (F.size(F.array_except("a", "antecedent")) == 0)
    )
    return rules.join(worse.select("antecedent", "verdict").distinct(), ["antecedent", "verdict"], "left_anti")


def match(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """(url, verdict) for the distinct urls of (url, tokens) that a mined rule fits.

    The most confident rule wins, then the better supported, then the longer.
    """
    often = urls.select(F.explode("tokens").alias("token")).groupBy("token").count()
    filed = rules.select("*", F.explode("antecedent").alias("token")).join(often, "token")
    anchor = filed.groupBy("antecedent", "verdict", "confidence", "support").agg(F.min(F.struct("count", "token"))["token"].alias("token"))
    hits = urls.select(url, "tokens", F.explode("tokens").alias("token")).join(anchor, "token")
    fits = hits.filter(F.size(F.array_except("antecedent", "tokens")) == 0)
    best = F.max(F.struct("confidence", "support", F.size("antecedent").alias("n"), "verdict"))
    return fits.groupBy(url).agg(best["verdict"].alias("mined"))


def judge(pages: DataFrame, key: str = "page_id", url: str = "url", rules: list[tuple[str, str]] = RULES, default: str = "allow", **limits) -> DataFrame:
    """(key, host, path, rule, verdict) for every row."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = pages.select(F.col(key).alias("k"), F.col(url).alias("url")).withColumns({"host": host, "path": path})
    rows = rows.withColumn("s", stated(F.col("host"), F.col("path"), rules))
    told = rows.withColumn("tokens", tokens(F.col("url"), F.col("host"), F.col("path")))
    mined = mine(told.filter("s is not null").select("tokens", F.col("s.verdict").alias("verdict")), **limits)
    open_urls = told.filter("s is null and url is not null and host <> ''").select("url", "tokens").distinct()
    verdicts = match(open_urls, mined)
    return rows.join(verdicts, "url", "left").select(
        F.col("k").alias(key), "host", "path", F.col("s.rule").alias("rule"), F.coalesce("s.verdict", "mined", F.lit(default)).alias("verdict")
    )


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every url of ``pages``."""
    return judge(table(spark, sf_dir, "pages"))
