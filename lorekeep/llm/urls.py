"""URL filtering with fixed rules and with association rules mined from labels.

FP-growth mines combinations of URL tokens that go with a label.  Rules are pruned by
support, by confidence, and where a rule with fewer tokens is as confident.  They are
matched by an inverted index: a rule is filed under its rarest token, so a URL meets
the rules filed under its own tokens only, and those are then held against all of them.

Fixed rules come first: a rule fits its host and all subdomains if the path
starts with the rule's; the longest rule wins.  URLs without one get the mined verdict.

Defined results: a null URL or one without "://" has empty host and path, fits no rule and
gets the default verdict; repeated rows keep their number; without labels nothing is
mined and the default holds; other columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorekeep.llm.common import drop_written, materialize

#: (verdict, host, path)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
MIN_SUPPORT = 0.002
MIN_CONFIDENCE = 0.6
#: A rule rests on so many labelled pages at least, however few there are in all.
MIN_PAGES = 10
DEFAULT = "allow"
#: Label items; no token of a URL holds a space.
GOOD, BAD = "label good", "label bad"
#: Rules in the broadcast index at most; more are joined by shuffle.
BROADCAST_RULES = 200_000


def parsed(urls: DataFrame, url: str = "url") -> DataFrame:
    """Add host and path."""
    u = F.col(url).cast("string")
    at = F.locate("://", u)
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, locate('://', `{url}`) + 3)")).otherwise("")
    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), upper, lower)
    return urls.withColumn("host", F.coalesce(host, F.lit(""))).withColumn("path", F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit("")))


def fixed_rule(rules=RULES):
    """A struct (rule, verdict) of the longest fitting rule, or null; needs host and path."""
    found = None
    for verdict, host, path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))) & F.startswith(F.col("path"), F.lit(path))
        one = F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, one) if found is None else found.when(fits, one)
    return found if found is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def tokens(url: str = "url"):
    """Distinct tokens of a URL: host suffixes, path words, query keys.  Numbers, which name single pages, are left out."""
    names = F.filter(F.split("host", r"\."), lambda x: x != "")
    count = F.size(names)
    suffixes = F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda i: F.concat(F.lit("host "), F.array_join(F.slice(names, i, count), ".")))
    first = F.transform(F.slice(names, 1, 1), lambda x: F.concat(F.lit("name "), x))
    words = F.transform(F.filter(F.split("path", r"[^\p{L}\p{N}]+"), lambda x: (x != "") & ~x.rlike(r"^\d+$")), lambda x: F.concat(F.lit("path "), F.lower(x)))
    after = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"\?([^#]*)", 1)
    keys = F.transform(F.filter(F.split(after, "&"), lambda x: x != ""), lambda x: F.concat(F.lit("query "), F.substring_index(x, "=", 1)))
    fragment = F.when(F.contains(F.coalesce(F.col(url), F.lit("")), F.lit("#")), F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(suffixes, first, words, keys, fragment))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """From (tokens, bad): rules (tokens, verdict, confidence, support, key), key being the rarest token."""
    baskets = labelled.select(F.array_append("tokens", F.when(F.col("bad"), BAD).otherwise(GOOD)).alias("items")).where("items is not null")
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    rules = model.associationRules.where(F.element_at("consequent", 1).isin(GOOD, BAD))
    rules = rules.where(~F.arrays_overlap("antecedent", F.array(F.lit(GOOD), F.lit(BAD))))
    rules = rules.select(F.array_sort("antecedent").alias("tokens"), F.when(F.element_at("consequent", 1) == BAD, "block").otherwise("allow").alias("verdict"), "confidence", "support")
    single = model.freqItemsets.where(F.size("items") == 1).select(F.element_at("items", 1).alias("_k"), "freq")
    rarest = rules.select("tokens", "verdict", F.explode("tokens").alias("_k")).join(single, "_k").groupBy("tokens", "verdict").agg(F.min(F.struct("freq", "_k")).alias("_m"))
    rules = rules.join(rarest, ["tokens", "verdict"]).select("tokens", "verdict", "confidence", "support", F.col("_m._k").alias("key"))
    # A rule adds nothing if a rule with a part of its tokens says the same as confidently.  That rule's rarest token is
    # one of its own tokens, so the index that URLs are matched by finds it.
    less = rules.select(F.col("tokens").alias("_t"), F.col("verdict").alias("_v"), F.col("confidence").alias("_c"), F.col("key").alias("_k"))
    more = rules.select("*", F.explode("tokens").alias("_k"))
    covered = more.join(less, "_k").where((F.size("_t") < F.size("tokens")) & (F.col("_v") == F.col("verdict")) & (F.col("_c") >= F.col("confidence")) & (F.size(F.array_except("_t", "tokens")) == 0))
    return rules.join(covered.select("tokens", "verdict").distinct(), ["tokens", "verdict"], "left_anti")


def match(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, mined): the verdict of the most confident mined rule for each distinct URL that meets one."""
    if rules.count() <= BROADCAST_RULES:
        rules = F.broadcast(rules)
    r = rules.select(F.col("key"), F.col("tokens").alias("_rule"), "verdict", "confidence", "support")
    met = urls.select("url", "tokens", F.explode("tokens").alias("key")).join(r, "key").where(F.size(F.array_except("_rule", "tokens")) == 0)
    best = F.max(F.struct("confidence", F.size("_rule").alias("n"), "support", "verdict"))
    return met.groupBy("url").agg(best.alias("_b")).select(F.col("url").alias("_url"), F.col("_b.verdict").alias("mined"))


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, bad) of the pages whose number, the last in the path, is a labelled document.

    A document is bad if it is of low quality or toxic.  Pages of one address count once.
    """
    p = parsed(pages.select("url").where("url is not null").distinct())
    p = p.withColumn("_doc", F.expr("try_cast(regexp_extract(path, '(\\\\d+)[^\\\\d]*$', 1) as bigint)"))
    bad = (F.coalesce(F.col("quality"), F.lit(1)) == 0) | (F.coalesce(F.col("toxic"), F.lit(0)) == 1)
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("_doc")).agg(F.max(bad).alias("bad"))
    return p.join(known, "_doc").withColumn("tokens", tokens()).select("url", "tokens", "bad")


def verdicts(pages: DataFrame, labels: DataFrame, rules=RULES, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    seen = materialize(labelled_urls(pages, labels), "labelled")
    n = seen.count()
    mined = materialize(mine(seen, min(1.0, max(min_support, MIN_PAGES / n)), min_confidence), "rules") if n else None
    drop_written(pages.sparkSession, seen)
    d = parsed(pages.select("page_id", F.col("url").cast("string").alias("url"))).withColumn("_fixed", fixed_rule(rules))
    if mined is None:
        return d.select("page_id", "host", "path", F.col("_fixed.rule").alias("rule"), F.coalesce(F.col("_fixed.verdict"), F.lit(DEFAULT)).alias("verdict"))
    open_urls = d.where("_fixed is null and contains(url, '://')").select("url", "host", "path").distinct().withColumn("tokens", tokens())
    m = match(open_urls, mined)
    d = d.join(m, d["url"] == m["_url"], "left")
    return d.select("page_id", "host", "path", F.col("_fixed.rule").alias("rule"), F.coalesce(F.col("_fixed.verdict"), F.col("mined"), F.lit(DEFAULT)).alias("verdict"))
