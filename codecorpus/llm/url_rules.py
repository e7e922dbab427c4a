"""URL filter: written rules first, mined rules for what they leave open.

Written rules name a host (with its subdomains) and the start of a path; the longest
that fits decides. For the other URLs, FP-growth mines combinations of URL tokens from
labelled URLs. A combination with enough support and confidence for ``block`` becomes
a rule; combinations that contain another rule are redundant and go. An inverted index
from tokens to rules finds the rules whose tokens a URL has: the URL's tokens are
looked up, and a rule fits if it is met as often as it has tokens.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codecorpus.llm.common import Staging, ascii_lower, broadcast_below

#: The written rules (verdict, host, path).
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.9
#: Tokens of a mined rule, at most.
MAX_TOKENS = 3
BLOCKED = "=block"
BROADCAST_BYTES = 8 << 20


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def written_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest written rule that fits, as text, and its verdict; both null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, at, start in sorted(rules, key=lambda r: len(r[1] + r[2])):  # a longer one later goes over it
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(start)
        name, verdict = F.when(fits, at + start).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """Labels of the host, parts of the path (digits as ``#``) and keys of the query, each once."""
    parts = lambda text, sep: F.filter(F.split(text, sep), lambda x: x != "")
    query = F.coalesce(F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1), F.lit(""))
    return F.array_distinct(F.concat(
        F.transform(parts(host, r"\."), lambda x: F.concat(F.lit("h:"), x)),
        F.transform(parts(path, "/"), lambda x: F.concat(F.lit("p:"), F.regexp_replace(ascii_lower(x), "[0-9]+", "#"))),
        F.transform(parts(query, "&"), lambda x: F.concat(F.lit("q:"), F.regexp_extract(x, "^([^=]*)", 1)))))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """``labelled``: ``tokens`` and ``blocked``. Rows ``rule, tokens, confidence, support`` of the rules for ``block``.

    Support is the share of all labelled rows that have the tokens and are blocked.
    """
    items = F.when(F.col("blocked"), F.array_append("tokens", F.lit(BLOCKED))).otherwise(F.col("tokens"))
    baskets = labelled.select(items.alias("items")).filter(F.size("items") > 0)
    staging = Staging(labelled.sparkSession)
    baskets = staging.put(baskets, "baskets")
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    rules = model.associationRules.filter((F.col("consequent") == F.array(F.lit(BLOCKED))) & (F.size("antecedent") <= max_tokens))
    rules = staging.put(rules.select(F.array_sort("antecedent").alias("tokens"), "confidence", "support"), "rules")
    # a rule is redundant if dropping some of its tokens leaves a rule; subsets are looked up, not compared pairwise
    fewer = F.expr("filter(transform(sequence(1, (1 << size(tokens)) - 2), m -> filter(tokens, (t, i) -> (m & (1 << i)) > 0)), s -> size(s) > 0)")
    subsets = rules.filter("size(tokens) > 1").select("tokens", F.explode(fewer).alias("subset"))
    redundant = subsets.join(rules.select(F.col("tokens").alias("subset")), "subset", "left_semi").select("tokens").distinct()
    kept = rules.join(redundant, "tokens", "left_anti")
    return kept.select(F.array_join("tokens", " ").alias("rule"), "tokens", "confidence", "support")


def matching(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls``: distinct ``url`` with ``tokens``. Rows ``url, rule`` for each rule all of whose tokens the URL has."""
    index = rules.select("rule", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
    index = broadcast_below(Staging(urls.sparkSession).put(index, "index"), BROADCAST_BYTES)
    met = urls.select("url", F.explode("tokens").alias("token")).join(index, "token")
    return met.groupBy("url", "rule", "n").agg(F.count("*").alias("met")).filter("met = n").select("url", "rule")


def verdicts(pages: DataFrame) -> DataFrame:
    """One row for each row of ``pages``: ``page_id, host, path, rule, verdict, mined_rule``.

    The labels to mine from are the verdicts of the written rules. A URL that no rule fits is allowed, as are
    null URLs and those without ``://`` (host and path empty). ``mined_rule``: the first by name that fits.
    """
    parts = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = written_rule(F.col("host"), F.col("path"))
    rows = parts.select("*", rule.alias("rule"), verdict.alias("written"))
    tokens = tokens_of(F.col("url"), F.col("host"), F.col("path")).alias("tokens")
    rules = mine(rows.filter("written is not null").select(tokens, (F.col("written") == "block").alias("blocked")))
    open_urls = rows.filter("written is null and url is not null and host != ''").select("url", tokens).dropDuplicates(["url"])
    found = matching(open_urls, rules).groupBy("url").agg(F.min("rule").alias("mined_rule"))
    return rows.join(found, "url", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("written", F.when(F.col("mined_rule").isNotNull(), "block").otherwise("allow")).alias("verdict"), "mined_rule")
