"""URL filter by mined association rules.

Tokens of a URL: scheme, the host's suffixes of two and more labels, every
host label, the words of the host labels, path segments, file ending, query
names.  Numbers become ``0``.  Labelled URLs are transactions: their tokens
plus ``=bad`` when the page is labelled low quality or toxic.  Spark's
FP-growth mines the combinations frequent among bad URLs, and all URLs are
counted for them; rules ``tokens -> =bad`` with enough
support and confidence stay, unless a subset of the tokens is as confident.
Pages meet the rules through an inverted index: a rule is filed under its
rarest token, and a page that has this token must have all others.

Fixed rules (host and path prefix, longest first) come before mined ones.

The mining sees all tokens of a URL.  Tokens of exactly the same URLs are mined
as one and written out again in the rules; what a subset beats for certain is
not combined.  The rules are those of mining every frequent token.  URLs and
classes of tokens are told apart by 64-bit hashes.  Defined cases: a null url, or one without ``://``, has an empty host and path and is allowed;
URLs of any length are taken whole; of mined rules that fit equally well the one with
the highest id is named; empty tables give no rules and no verdicts;
labels that are null or have no page are ignored, of several labels for a page
any bad one counts; repeated pages are mined once and each judged; without labels no rule is
mined; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import lower_ascii, materialize

#: (host, path prefix, verdict)
FIXED = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


@dataclass(frozen=True)
class Mining:
    min_rows: int = 20            # bad URLs that a rule needs, however many are labelled
    min_support: float = 0.0      # and this share of the labelled URLs, if any
    min_confidence: float = 0.6   # of a rule, with min_lift
    min_lift: float = 1.5


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def tokens_of(url: Column) -> Column:
    """Distinct tokens; the first letter names the part of the URL."""
    url = F.coalesce(url, F.lit(""))
    labels = F.array_remove(F.split(host_of(url), r"\."), "")
    n = F.size(labels)
    suffixes = F.when(n >= 2, F.transform(F.sequence(F.lit(2), F.greatest(n, F.lit(2))), lambda k: F.concat(
        F.lit("h:"), F.array_join(F.slice(labels, n - k + 1, k), ".")))).otherwise(F.array())
    parts = F.array_remove(F.split(F.lower(F.regexp_replace(path_of(url), r"[0-9]+", "0")), "/"), "")
    query = F.array_remove(F.split(F.regexp_extract(url, r"\?([^#]*)", 1), "&"), "")
    def tag(letter: str, items: Column) -> Column:
        return F.transform(items, lambda x: F.concat(F.lit(letter + ":"), x))

    return F.array_distinct(F.concat(
        suffixes, tag("l", labels), tag("w", F.array_remove(F.split(host_of(url), r"[.\-]"), "")), tag("p", parts),
        tag("e", F.filter(F.transform(parts, lambda x: F.regexp_extract(x, r"\.([a-z]+)$", 1)), lambda x: x != "")),
        tag("q", F.transform(query, lambda x: F.regexp_extract(x, r"^([^=]*)", 1))),
        tag("s", F.array(F.regexp_extract(url, r"(?s)^(.*?)://", 1)))))


def fixed_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = FIXED) -> Column:
    """(rule, verdict) of the longest rule that fits, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def mine(pages: DataFrame, labels: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """Rules (rule_id, tokens, confidence, support), written once."""
    bad = (labels.where("doc_id is not null").groupBy("doc_id")
           .agg(F.max(((F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)).cast("int")).alias("bad")))
    seen = materialize(
        pages.where("url is not null").join(bad, F.col("page_id") == F.col("doc_id"))
        .select("page_id", "url", "bad").distinct()
        .select(F.xxhash64("page_id", "url").alias("u"), tokens_of(F.col("url")).alias("tokens"), "bad"))
    n, n_bad = seen.agg(F.count("*"), F.sum("bad")).first()
    least = math.ceil(max(mining.min_support * n, mining.min_rows))
    if not n_bad or n_bad < least:
        return seen.sparkSession.createDataFrame([], "rule_id bigint, tokens array<string>, confidence double, support double")
    # tokens of exactly the same URLs are one class; a token of all URLs adds nothing to any rule
    each = seen.select("u", "bad", F.explode("tokens").alias("t"))
    classes = materialize(
        each.groupBy("t").agg(F.count("*").alias("rows"), F.sum("bad").alias("bad"),
                              F.bit_xor("u").alias("h"), F.bit_xor(F.xxhash64("u")).alias("g"))
        .where((F.col("bad") >= least) & (F.col("rows") < n))
        .groupBy("rows", "bad", "h", "g").agg(F.sort_array(F.collect_list("t")).alias("members"))
        .select(F.xxhash64(F.get("members", F.lit(0))).alias("id"), F.get("members", F.lit(0)).alias("first"),
                "members", "rows", "bad"))
    found = (classes.select(F.array("id").alias("ids"), "rows", "bad")
             .unionByName(_combinations(each, classes, least))
             .withColumn("confidence", F.col("bad") / F.col("rows"))
             .where((F.col("confidence") >= mining.min_confidence)
                    & (F.col("confidence") * n >= mining.min_lift * n_bad)))
    found = materialize(found.select("ids", "confidence", (F.col("bad") / n).alias("support")))
    # a rule whose subset is as confident says nothing more: meet subsets under one of their classes
    narrow = found.select(F.get("ids", F.lit(0)).alias("id"), F.col("ids").alias("sub"), F.col("confidence").alias("c"))
    wider = found.select("ids", "confidence", F.explode("ids").alias("id"))
    dull = (wider.join(narrow, "id")
            .where((F.size("sub") < F.size("ids")) & (F.col("c") >= F.col("confidence"))
                   & (F.size(F.array_except("sub", "ids")) == 0))
            .select("ids").distinct())
    # back to tokens: a rule for every choice of one member a class
    named = (found.join(dull, "ids", "left_anti").select("ids", "confidence", "support", F.explode("ids").alias("id"))
             .join(classes.select("id", "members"), "id").groupBy("ids", "confidence", "support")
             .agg(F.collect_list("members").alias("groups")))
    choices = F.aggregate("groups", F.array(F.array().cast("array<string>")), lambda done, members: F.flatten(
        F.transform(done, lambda d: F.transform(members, lambda t: F.concat(d, F.array(t))))))
    rules = named.select(F.explode(choices).alias("tokens"), "confidence", "support").withColumn("tokens", F.sort_array("tokens"))
    return materialize(rules.select(F.xxhash64("tokens").alias("rule_id"), "tokens", "confidence", "support"))


def _combinations(each: DataFrame, classes: DataFrame, least: int) -> DataFrame:
    """(ids, rows, bad) of the combinations of classes with ``least`` bad URLs.

    Left out are only those that a subset beats for certain: with a class whose
    URLs are all bad, or with one that the combination's rarest implies.
    FP-growth runs over the bad URLs, a basket for each class of a URL with the
    more frequent ones beside it; all URLs are counted again afterwards.
    """
    some = classes.where(F.col("bad") < F.col("rows"))
    baskets = materialize(
        each.join(some.select(F.col("first").alias("t"), "id", "rows"), "t").groupBy("u", "bad")
        .agg(F.sort_array(F.collect_list(F.struct("rows", "id"))).alias("items"))
        .select("bad", F.transform("items", lambda x: x["id"]).alias("items")).where(F.size("items") > 1))
    first = baskets.select("bad", "items", F.posexplode("items").alias("i", "id"))
    first = first.select("bad", "items", "id", F.expr("slice(items, i + 2, size(items))").alias("after"))
    pairs = (first.select("bad", "id", F.explode("after").alias("other")).groupBy("id", "other")
             .agg(F.count("*").alias("both"), F.sum("bad").alias("bad")).where(F.col("bad") >= least)
             .join(some.select("id", "rows"), "id").where(F.col("both") < F.col("rows")))
    beside = materialize(pairs.groupBy("id").agg(F.collect_list("other").alias("others")))
    dealt = materialize(
        first.where("bad = 1").join(beside, "id").select("id", F.array_intersect("after", "others").alias("y")).where(F.size("y") > 0)
        .select(F.transform("y", lambda y: F.concat_ws(" ", "id", y)).alias("items")))
    n = dealt.count()
    if not n:
        return classes.select(F.array("id").alias("ids"), "rows", "bad").limit(0)
    sets = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n).fit(dealt).freqItemsets
    rarest = F.substring_index(F.get("items", F.lit(0)), " ", 1).cast("long")
    sets = materialize(sets.select(rarest.alias("id"), F.sort_array(F.concat(F.array(rarest), F.transform(
        "items", lambda x: F.substring_index(x, " ", -1).cast("long")))).alias("ids")))
    return (first.join(sets, "id").where(F.size(F.array_except("ids", "items")) == 0)
            .groupBy("ids").agg(F.count("*").alias("rows"), F.sum("bad").alias("bad")))


def inverted_index(rules: DataFrame) -> DataFrame:
    """(token, rule_id, tokens, confidence): every rule under the token that
    fewest rules hold."""
    each = rules.select("rule_id", "tokens", "confidence", F.explode("tokens").alias("token"))
    often = each.groupBy("token").agg(F.count("*").alias("n"))
    return (each.join(often, "token").groupBy("rule_id")
            .agg(F.min_by("token", F.struct("n", "token")).alias("token"), F.first("tokens").alias("tokens"),
                 F.first("confidence").alias("confidence")))


def judge(pages: DataFrame, rules: DataFrame, fixed: Sequence[tuple[str, str, str]] = FIXED) -> DataFrame:
    """page_id, host, path, rule, verdict and the best mined rule that fits."""
    index = materialize(inverted_index(rules)).select("token", "rule_id", F.col("tokens").alias("need"), "confidence")
    urls = pages.select(F.col("url").alias("link")).distinct()
    asked = urls.select("link", tokens_of(F.col("link")).alias("have"))
    hit = (asked.select("link", "have", F.explode("have").alias("token")).join(index, "token")
           .where(F.size(F.array_except("need", "have")) == 0)
           .groupBy("link").agg(F.max(F.struct("confidence", "rule_id")).alias("mined")))
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"), fixed_rule(host, path, fixed).alias("fixed"))
    verdict = F.coalesce(F.col("fixed.verdict"), F.when(F.col("mined").isNotNull(), "block").otherwise("allow"))
    return (rows.join(hit, F.col("url") == F.col("link"), "left")
            .select("page_id", "host", "path", F.col("fixed.rule").alias("rule"), verdict.alias("verdict"),
                    F.col("mined.confidence").alias("mined_confidence"), F.col("mined.rule_id").alias("mined_rule")))
