"""URL filters: fixed host and path rules first, then association rules that FP-growth mined from labels.

A url is a set of tokens (parts of its host, host suffixes, path words, kinds of numbers, query keys). Spark's FP-growth
over the urls labelled `block` finds the token combinations that enough of them share; how many other labelled urls have
each is counted by a join on its two rarest tokens. Combinations of enough confidence that no part of them with at least
the same confidence implies are the rules, of any length and without a limit on their number. A rule fits a url that has
all its tokens. Matching goes by an inverted index: each rule is filed under its rarest token alone, so a url looks only
at rules filed under its tokens.

Tokens that occur in exactly the same labelled urls are one token, named by the first of them, and tokens of all urls are
none: no rule with them could be kept, and each would double the combinations. With u tokens in a url there are at most
2^u over the support of combinations for each blocked url.

Fixed rules name a host and a path: such a rule fits that host and all its subdomains where the path starts with the
rule's; of several the longest (host and path together) wins, and it overrules what was mined.

Mining looks at labelled urls, at most `most` (200,000) of the smallest hashes; judging covers every row.

Defined cases: a null url or one without :// has an empty host and path, no tokens, and is allowed; nothing mined (no
labels, or no rule good enough) allows all that no fixed rule blocks; repeated urls are judged alike; an empty table
gives an empty result; input columns named like an output are replaced.
"""

from __future__ import annotations

import math
from collections import Counter

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tractloom.llm.common import bounded_sample, settle

MIN_SUPPORT, MIN_CONFIDENCE = 0.001, 0.6
MIN_URLS = 3  # a combination in fewer urls is no rule, however small the table
MOST_LABELLED = 200_000


def after_scheme(url: Column) -> Column:
    """What follows the first ://, empty without one."""
    at = F.locate("://", F.coalesce(url, F.lit("")))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(after_scheme(url), "^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def tokens_of(url: Column) -> Column:
    """The distinct tokens of a url. Numbers count by kind, as each is seen but once."""
    host, path = host_of(url), ascii_lower(path_of(url))
    query = F.regexp_extract(after_scheme(url), "\\?([^#]*)", 1)
    labels = F.split(host, "\\.")
    suffixes = F.transform(labels, lambda x, i: F.concat(F.lit("site="), F.array_join(F.slice(labels, i + 1, F.size(labels)), ".")))
    parts = F.transform(F.regexp_extract_all(host, F.lit("([^.\\-]+)"), 1), lambda x: F.concat(F.lit("host="), x))
    words = F.transform(F.regexp_extract_all(path, F.lit("([^/\\-_.]+)"), 1), lambda x: F.concat(F.lit("path="), F.regexp_replace(x, "[0-9]+", "0")))
    keys = F.transform(F.regexp_extract_all(query, F.lit("([^&=]+)(=[^&]*)?"), 1), lambda x: F.concat(F.lit("query="), x))
    scheme = F.array(F.concat(F.lit("scheme="), F.regexp_extract(F.coalesce(url, F.lit("")), "^([A-Za-z]+)://", 1)))
    end = F.array(F.when(path.endswith("/"), F.lit("end=/")).otherwise(F.concat(F.lit("end="), F.regexp_extract(path, "\\.([a-z0-9]{1,5})$", 1))))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(suffixes, parts, words, keys, scheme, end)))


def two_first(items: Column) -> Column:
    """The two smallest numbers of a sorted array, or the only one twice."""
    return F.struct(items[0].alias("a"), F.coalesce(F.get(items, F.lit(1)), items[0]).alias("b"))


def pairs_of(items: Column) -> Column:
    """Every two numbers of a sorted array, and every one twice, as `two_first` writes them."""
    return F.flatten(F.transform(items, lambda x, i: F.transform(F.slice(items, i + 1, F.size(items)), lambda y: F.struct(x.alias("a"), y.alias("b")))))


def within(sets: DataFrame, wholes: DataFrame) -> DataFrame:
    """Rows of sets (column items) with each row of wholes (column whole) that has all of it; both hold sorted numbers."""
    keyed = wholes.withColumn("key", F.explode(pairs_of(F.col("whole"))))
    return sets.withColumn("key", two_first(F.col("items"))).join(keyed, "key").where(F.size(F.array_except("items", "whole")) == 0).drop("key")


def mine_rules(
    labelled: DataFrame, *, url: str = "url", block: str = "block", min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, most: int = MOST_LABELLED,
) -> list[dict]:
    """All rules (tokens, confidence, support) from rows (url, block boolean) that no shorter rule at least as good implies."""
    known = labelled.where(F.col(block).isNotNull() & F.col(url).isNotNull()).select(F.col(url).alias("url"), F.col(block).cast("long").alias("block"))
    sample = bounded_sample(known, "url", most).select(F.array_sort(tokens_of(F.col("url"))).alias("tokens"), "block").where(F.size("tokens") > 0)
    baskets = settle(sample.groupBy("tokens").agg(F.count("*").alias("n"), F.sum("block").alias("n_block")))
    total = baskets.agg(F.sum("n").alias("n"), F.sum("n_block").alias("n_block")).first()
    if not total.n or not total.n_block:
        return []
    least = max(MIN_URLS, math.ceil(min_support * total.n))
    each = baskets.withColumn("token", F.explode("tokens"))
    same = F.sum(F.xxhash64("tokens").cast("decimal(20,0)") * F.col("n")).alias("same")  # equal for tokens of the same urls
    counted = each.groupBy("token").agg(F.sum("n").alias("n"), F.sum("n_block").alias("n_block"), same)
    # At most the tokens of a url over the support: some 10,000.
    tokens = counted.where((F.col("n_block") >= least) & (F.col("n") < total.n)).groupBy("n", "n_block", "same").agg(F.min("token").alias("token")).collect()
    names = [r.token for r in sorted(tokens, key=lambda r: (r.n - r.n_block, r.token))]  # the rarest among other urls first
    if not names:
        return []
    spark = labelled.sparkSession
    numbers = spark.createDataFrame(list(enumerate(names)), "item int, token string")
    whole = F.array_sort(F.collect_list("item")).alias("whole")
    rows = each.join(F.broadcast(numbers), "token").groupBy("tokens", "n", "n_block").agg(whole).groupBy("whole").agg(F.sum("n").alias("n"), F.sum("n_block").alias("n_block"))
    rows = settle(rows)
    blocked = rows.where("n_block > 0").select(F.explode(F.array_repeat("whole", F.col("n_block").cast("int"))).alias("items"))
    found = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / total.n_block).fit(blocked).freqItemsets
    sets = settle(found.select(F.array_sort("items").alias("items"), F.col("freq").alias("n_block")))
    others = rows.where("n > n_block").select("whole", (F.col("n") - F.col("n_block")).alias("n_other"))
    beside = within(sets, others).groupBy("items").agg(F.sum("n_other").alias("n_other"))
    n = F.col("n_block") + F.coalesce("n_other", F.lit(0))
    scored = sets.join(beside, "items", "left").select("items", (F.col("n_block") / n).alias("confidence"), (F.col("n_block") / F.lit(total.n)).alias("support"))
    rules = settle(scored.where(F.col("confidence") >= min_confidence))
    longer = rules.select(F.col("items").alias("whole"), F.col("confidence").alias("of_whole"))
    implied = within(rules, longer).where((F.size("items") < F.size("whole")) & (F.col("confidence") >= F.col("of_whole"))).select(F.col("whole").alias("items"))
    kept = rules.join(implied, "items", "left_anti").collect()
    made = [{"tokens": sorted(names[i] for i in r["items"]), "confidence": r.confidence, "support": r.support} for r in kept]
    return sorted(made, key=lambda r: (len(r["tokens"]), -r["confidence"], r["tokens"]))


def judge_mined(urls: DataFrame, rules: list[dict], *, url: str = "url", out: str = "mined") -> DataFrame:
    """urls with `out`: the best fitting mined rule as struct (tokens, confidence), or null."""
    if not rules:
        return urls.withColumn(out, F.lit(None).cast("struct<tokens:array<string>,confidence:double>"))
    held = urls.sparkSession.sparkContext.broadcast(inverted(rules))

    @F.arrow_udf("struct<tokens:array<string>,confidence:double>")
    def best(tokens: pa.Array) -> pa.Array:
        out = []
        for own in tokens.to_pylist():
            have = set(own or ())
            fits = [r for t in have for r in held.value.get(t, ()) if r["all"] <= have]
            top = max(fits, key=lambda r: (r["confidence"], r["tokens"]), default=None)
            out.append(top and {"tokens": top["tokens"], "confidence": top["confidence"]})
        return pa.array(out, type=pa.struct([("tokens", pa.list_(pa.string())), ("confidence", pa.float64())]))

    return urls.withColumn(out, best(tokens_of(F.col(url))))


def inverted(rules: list[dict]) -> dict[str, list[dict]]:
    """The rules by that token of each which the fewest rules have; bounded by the number of rules."""
    often = Counter(t for r in rules for t in r["tokens"])
    index: dict[str, list[dict]] = {}
    for r in rules:
        index.setdefault(min(r["tokens"], key=lambda t: (often[t], t)), []).append(r | {"all": frozenset(r["tokens"])})
    return index


def judge_fixed(urls: DataFrame, rules: list[tuple[str, str, str]], *, url: str = "url") -> DataFrame:
    """urls with host, path, rule and rule_verdict, for rules (verdict, host, path); null where none fits."""
    judged = urls.withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
    fitting = None
    for verdict, host, path in sorted(rules, key=lambda r: (-len(r[1]) - len(r[2]), r)):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        value = F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))
        fitting = F.when(fits, value) if fitting is None else fitting.when(fits, value)
    if fitting is None:
        fitting = F.lit(None).cast("struct<rule:string,verdict:string>")
    return judged.withColumn("__r", fitting).withColumn("rule", F.col("__r.rule")).withColumn("rule_verdict", F.col("__r.verdict")).drop("__r")


def judge(urls: DataFrame, fixed: list[tuple[str, str, str]], mined: list[dict], *, url: str = "url") -> DataFrame:
    """urls with host, path, rule (the fixed one that decided, else null), mined, and verdict."""
    both = judge_mined(judge_fixed(urls, fixed, url=url), mined, url=url)
    return both.withColumn("verdict", F.coalesce("rule_verdict", F.when(F.col("mined").isNotNull(), "block").otherwise("allow"))).drop("rule_verdict")
