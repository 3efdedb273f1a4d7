"""Verdicts on urls: given rules first, then rules mined from labelled urls.

Mining: Spark's FP-growth finds token sets that are frequent among labelled urls; a set is a
rule if urls that hold it are bad with high confidence, and if no part of it is a rule at
least as sure. Tokens that are in exactly the same labelled urls stand for each other, so they
are mined as one: a long url that is repeated often does not make all sets of its tokens rules.
Matching: an inverted index maps the tokens of each rule's rarest need to the rule. A url meets
only the rules indexed under its own tokens, and one fits if it has a token of every need.

Defined results: a null url, or one without ``://``, has an empty host and path, no tokens
and no rule, and is allowed; repeated rows are judged each for itself; without labels no
rules are mined; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgertalk.sources.scratch import stored

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BAD = "label:bad"
MIN_SUPPORT = 0.002
# A rule stands for at least so many labelled urls, however few there are in all.
LEAST_URLS = 5
MIN_CONFIDENCE = 0.8


@dataclass(frozen=True)
class GivenRule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The contract's rules.
GIVEN = (
    GivenRule("allow", "com", "/"),
    GivenRule("block", "example.com", "/en/"),
    GivenRule("allow", "www.example.com", "/en/"),
    GivenRule("block", "net", "/es/"),
    GivenRule("block", "net", "/fr/"),
)


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), URL, 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), URL, 2)


def fits(rule: GivenRule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def longest_fit(rules: Sequence[GivenRule], host: Column, path: Column) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, both null if none does."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        hit = fits(rule, host, path)
        name = F.when(hit, F.lit(rule.text)).otherwise(name)
        verdict = F.when(hit, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def tokens(url: Column) -> Column:
    """Distinct tokens: scheme, host labels with their place from the right, path parts,
    query names and the fragment; digits read as 0, so that numbers are one token."""
    text = F.coalesce(url, F.lit(""))
    labels = F.reverse(F.split(host_of(url), r"\."))
    in_host = F.transform(labels, lambda x, i: F.concat(F.lit("h"), i.cast("string"), F.lit(":"), x))
    parts = F.split(F.regexp_replace(path_of(url), r"[0-9]+", "0"), r"[/._-]+")
    in_path = F.transform(parts, lambda x: F.concat(F.lit("p:"), x))
    query = F.regexp_extract(text, r"(?s)\?([^#]*)", 1)
    names = F.transform(
        F.split(query, "&"), lambda x: F.concat(F.lit("q:"), F.regexp_extract(x, "^([^=]*)", 1))
    )
    rest = F.array(
        F.concat(F.lit("s:"), F.regexp_extract(text, r"(?s)^([A-Za-z]*)://", 1)),
        F.concat(F.lit("f:"), F.regexp_extract(text, r"(?s)#(.*)$", 1)),
    )
    found = F.array_distinct(F.concat(in_host, in_path, names, rest))
    return F.when(
        host_of(url) == "", F.array().cast("array<string>")
    ).otherwise(F.filter(found, lambda x: ~x.endswith(":")))


def token_classes(item_sets: DataFrame) -> DataFrame:
    """``need, members``: tokens that are in exactly the same of these sets, under the smallest of
    them. All members are in one set, so a class is no longer than a url has tokens."""
    in_sets = item_sets.select("set_id", F.explode("items").alias("token")).distinct()
    same = ["sets", "x1", "x2"]
    signs = in_sets.filter(F.col("token") != BAD).groupBy("token").agg(
        F.count("*").alias("sets"),
        F.bit_xor(F.xxhash64("set_id.x1")).alias("x1"),
        F.bit_xor(F.xxhash64("set_id.x2")).alias("x2"),
    )
    members = signs.groupBy(*same).agg(F.array_sort(F.collect_list("token")).alias("members"))
    return members.select(F.get("members", F.lit(0)).alias("need"), "members")


def mined_rules(
    labelled: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """``rule_id, needs, members, confidence`` from rows ``url, bad``; every labelled row counts.
    Each need stands for its class of tokens, ``members`` in the same order."""
    items = F.concat(
        tokens(F.col("url")),
        F.when(F.col("bad"), F.array(F.lit(BAD))).otherwise(F.array().cast("array<string>")),
    )
    item_sets = labelled.filter(F.col("bad").isNotNull()).select(items.alias("items"))
    set_id = F.struct(
        F.xxhash64("items").alias("x1"), F.xxhash64(F.lit(1), F.col("items")).alias("x2")
    )
    item_sets = stored(item_sets.select("items", set_id.alias("set_id")), "item_sets")
    distinct_sets = item_sets.groupBy("set_id").agg(F.first("items").alias("items"))
    distinct_sets = stored(distinct_sets, "distinct_item_sets")
    classes = stored(token_classes(distinct_sets), "token_classes")
    need_of = classes.select("need", F.explode("members").alias("token"))
    needed = (
        distinct_sets.select("set_id", F.explode("items").alias("token"))
        .join(need_of, "token", "left")
        .groupBy("set_id")
        .agg(F.collect_set(F.coalesce("need", "token")).alias("items"))
    )
    needed = stored(needed, "needed_item_sets")
    mined = stored(item_sets.select("set_id").join(needed, "set_id").select("items"), "mined_sets")
    # Without a least number, every token of few labelled urls would be frequent, and with it
    # all sets of one long url's tokens.
    support = min(1.0, max(min_support, LEAST_URLS / max(item_sets.count(), 1)))
    model = FPGrowth(
        itemsCol="items", minSupport=support, minConfidence=min_confidence
    ).fit(mined)
    rules = model.associationRules.filter(F.col("consequent") == F.array(F.lit(BAD))).select(
        F.array_sort("antecedent").alias("needs"), "confidence"
    )
    rules = stored(rules.withColumn("rule_id", F.xxhash64(F.array_join("needs", "\x00"))), "rules")
    # Cut a rule that holds a shorter rule at least as sure: they meet on the short one's needs.
    longer = rules.select(
        F.col("rule_id").alias("long_id"),
        F.col("needs").alias("long_needs"),
        F.col("confidence").alias("long_confidence"),
        F.explode("needs").alias("first"),
    )
    shorter = rules.select("needs", "confidence", F.get("needs", F.lit(0)).alias("first"))
    spare = (
        longer.join(shorter, "first")
        .filter(F.size("needs") < F.size("long_needs"))
        .filter(F.size(F.array_except("needs", "long_needs")) == 0)
        .filter(F.col("confidence") >= F.col("long_confidence"))
        .select(F.col("long_id").alias("rule_id"))
    )
    kept = rules.join(spare, "rule_id", "left_anti")
    return (
        kept.select("rule_id", "confidence", F.explode("needs").alias("need"))
        .join(classes, "need")
        .groupBy("rule_id", "confidence")
        .agg(F.array_sort(F.collect_list(F.struct("need", "members"))).alias("found"))
        .select(
            "rule_id",
            F.col("found.need").alias("needs"),
            F.col("found.members").alias("members"),
            "confidence",
        )
    )


def matched(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct urls that some mined rule fits."""
    rules = stored(rules.select("rule_id", "needs", "members"), "kept_rules")
    use = rules.select("rule_id", F.explode(F.arrays_zip("needs", "members")).alias("use"))
    use = use.select("rule_id", "use.needs", "use.members")
    rarity = use.groupBy("needs").agg(F.count("*").alias("uses"))
    rarest = F.min_by("members", F.struct("uses", "needs"))
    index = (
        use.join(rarity, "needs")
        .groupBy("rule_id")
        .agg(rarest.alias("tokens"))
        .select("rule_id", F.explode("tokens").alias("token"))
        .join(rules, "rule_id")
        .select("token", F.col("members").alias("any_of"))
    )
    # Small when rules are few; as a stored table its size is known when the join is planned.
    index = stored(index, "rule_index")
    of_url = pages.select("url").distinct().select("url", tokens(F.col("url")).alias("has"))
    return (
        of_url.select("url", "has", F.explode("has").alias("token"))
        .join(index, "token")
        .filter(F.forall("any_of", lambda need: F.arrays_overlap(need, F.col("has"))))
        .select("url")
        .distinct()
    )


def judged(
    pages: DataFrame, labelled: DataFrame, given: Sequence[GivenRule] = GIVEN
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every page."""
    pages = pages.select("page_id", "url")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    name, verdict = longest_fit(given, F.col("host"), F.col("path"))
    open_pages = pages.withColumn("host", host).withColumn("path", path).select(
        "page_id", "url", "host", "path", name.alias("rule"), verdict.alias("given")
    )
    bad = matched(
        open_pages.filter(F.col("given").isNull()), mined_rules(labelled)
    ).withColumn("mined", F.lit("block"))
    # Stored, so that both sides come straight from a shuffle and a hot url can be split.
    bad = stored(bad, "bad_urls")
    return open_pages.join(bad, "url", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("given", "mined", F.lit("allow")).alias("verdict"),
    )


def labelled_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``url, bad``: a page's url names its document by number; bad is poor or toxic text."""
    number = F.regexp_extract(path_of(F.col("url")), r"/([0-9]{1,18})(?:\.[a-z]+)?/?$", 1)
    numbered = pages.select("url", number.try_cast("long").alias("doc_id"))
    marks = labels.groupBy("doc_id").agg(
        F.max((F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)).alias(
            "bad"
        )
    )
    return numbered.join(marks, "doc_id").select("url", "bad")
