"""URL filter: host and path rules, and association rules mined from labelled pages.

Spark's FP-growth mines combinations of URL tokens (labels of the host, path segments without numbers,
names of query arguments) that occur with a bad label. A mined rule says: a URL with all these tokens is
bad. Rules are pruned by support and confidence, and a rule is dropped if without one of its
tokens it is a rule as well.

Before that, tokens that too few bad pages hold are left out, as no rule can have them, and tokens that always
occur together are mined as one: mining takes time by the number of combinations, and a dozen arguments that
trackers always add would make thousands. Of such tokens each stands in a rule of its own afterwards.

Rules are matched by an inverted index: each rule is filed under its rarest token, a URL looks up its
own tokens, and only the rules found there are compared. All of it is DataFrame work.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefeed.llm.sharing import checked, stored
from tidefeed.storage import materialize

BAD = "=bad"


class Rule(NamedTuple):
    """A host and a path prefix; the host's subdomains are meant too."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def url_host(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, in lower case; '' if there is none."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), _UPPER, _UPPER.lower())


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; '' without ``://``."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, NULL if none does. Of equal length the first counts.

    The rules are a list in the program, so they are an expression of the plan.
    """
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r.text)):  # the last one set is tested first
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def url_tokens(url: Column) -> Column:
    """Distinct tokens: ``h:`` host suffixes and labels, ``p:`` path segments, ``q:`` argument names.

    Segments that hold a digit are left out, as numbers name single pages.
    """
    rest = _after_scheme(url)
    labels = F.split(url_host(url), r"\.")
    segments = F.filter(F.split(url_path(url), "/"), lambda x: (x != "") & ~x.rlike("[0-9]"))
    arguments = F.filter(F.split(F.regexp_extract(rest, r"\?([^#]*)", 1), "&"), lambda x: x != "")
    return F.array_distinct(
        F.concat(
            F.transform(F.filter(labels, lambda x: x != ""), lambda x: F.concat(F.lit("h:"), x)),
            F.transform(segments, lambda x: F.concat(F.lit("p:"), F.lower(x))),
            F.transform(arguments, lambda x: F.concat(F.lit("q:"), F.lower(F.split(x, "=")[0]))),
        )
    )


def mine(
    labelled: DataFrame,
    url: str = "url",
    bad: str = "bad",
    min_support: float = 0.002,
    min_confidence: float = 0.5,
) -> DataFrame:
    """Rules ``rule`` (sorted tokens, ``rarest`` the one that fewest pages have), ``confidence``, ``support`` that imply a bad page.

    ``labelled`` has a URL and a boolean; rows with NULL in either are left out. Every row counts.
    A rule whose tokens but one form a rule is dropped, as the shorter one matches wherever it does.
    """
    baskets = (
        labelled.where(F.col(url).isNotNull() & F.col(bad).isNotNull())
        .select(F.monotonically_increasing_id().alias("page"), url_tokens(F.col(url)).alias("items"), F.col(bad).alias("is_bad"))
        .where((F.size("items") > 0) | F.col("is_bad"))
    )
    baskets, seen = materialize(baskets, "baskets")
    least = math.ceil(min_support * seen["rows"])
    tokens = checked(_tokens(baskets, least), "tokens", F.octet_length("token") + F.octet_length("stands") + 24)
    bad_item = F.when(F.col("is_bad"), F.array(F.lit(BAD))).otherwise(F.array().cast("array<string>"))
    held = baskets.select("page", F.explode("items").alias("token")).join(tokens, "token")
    held = held.groupBy("page").agg(F.collect_set("stands").alias("held"))
    items = baskets.join(held, "page", "left").select(F.concat(F.coalesce("held", F.array().cast("array<string>")), bad_item).alias("items"))
    items = stored(items, "items")
    found = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    rules = stored(
        found.associationRules.where(F.col("consequent")[0] == BAD)
        .select(F.array_sort("antecedent").alias("rule"), "confidence", "support"),
        "rules",
    )
    part = F.explode(F.filter(_parts(F.col("rule")), lambda x: F.size(x) > 0)).alias("part")
    shorter = rules.select(F.col("rule").alias("part"))
    covered = rules.select("rule", part).join(shorter, "part").select("rule").distinct()
    return _each_token(rules.join(covered, "rule", "left_anti"), tokens)


def _tokens(baskets: DataFrame, least: int) -> DataFrame:
    """``token``, ``stands``, ``n``: the tokens of ``least`` bad pages or more, how many pages have each, and the first of those
    that the very same pages have. Which pages, is told by their number and two sums of hashes."""
    pages = baskets.select("page", "is_bad", F.explode("items").alias("token"))
    sums = [F.sum(F.xxhash64(F.lit(i), "page").cast("decimal(20,0)")).alias(f"pages{i}") for i in (1, 2)]
    counted = pages.groupBy("token").agg(F.count("*").alias("n"), F.count_if("is_bad").alias("n_bad"), *sums)
    counted = counted.where(F.col("n_bad") >= least)
    same = ["n", "pages1", "pages2"]
    return counted.join(counted.groupBy(*same).agg(F.min("token").alias("stands")), same).select("token", "stands", "n")


def _each_token(rules: DataFrame, tokens: DataFrame) -> DataFrame:
    """The rules with each choice of tokens for those that stand for several, and the rarest token of each."""
    alike = tokens.groupBy("stands").agg(F.collect_list("token").alias("tokens"), F.max("n").alias("n"))
    places = rules.select("rule", "confidence", "support", F.explode("rule").alias("stands")).join(alike, "stands")
    choice = F.struct("n", "tokens")
    whole = places.groupBy("rule", "confidence", "support").agg(F.array_sort(F.collect_list(choice)).alias("places"))
    none = F.array(F.array().cast("array<string>"))

    def longer(made: Column, place: Column) -> Column:
        return F.flatten(F.transform(made, lambda r: F.transform(place["tokens"], lambda t: F.array_append(r, t))))

    each = whole.select(F.explode(F.aggregate("places", none, longer)).alias("chosen"), "confidence", "support")
    return each.select(F.array_sort("chosen").alias("rule"), "confidence", "support", F.col("chosen")[0].alias("rarest"))


def _parts(rule: Column) -> Column:
    """The rule without one of its tokens, for each of them."""
    return F.transform(rule, lambda x: F.array_except(rule, F.array(x)))


def matches(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """Distinct URLs that a rule matches, with the best ``confidence``; through an index by token."""
    index = checked(
        rules.select(F.col("rarest").alias("token"), "rule", "confidence"),
        "rule-index",
        F.lit(64) + F.octet_length(F.to_json("rule")),
    )
    tokens = urls.select(url).where(F.col(url).isNotNull()).distinct().withColumn("tokens", url_tokens(F.col(url)))
    return (
        tokens.withColumn("token", F.explode("tokens"))
        .join(index, "token")
        .where(F.size(F.array_except("rule", "tokens")) == 0)
        .groupBy(url)
        .agg(F.max("confidence").alias("confidence"))
    )


def judge(pages: DataFrame, labelled: DataFrame, rules: Sequence[Rule], **mining) -> DataFrame:
    """``host``, ``path``, ``rule``, ``verdict``, ``confidence`` beside the columns ``page_id``, ``url``.

    The verdict is that of the longest fitting rule of ``rules``; without one it is ``block`` where a
    mined rule matches, else ``allow``. One row for each row of ``pages``, repeated ones included. A NULL
    URL or one without ``://`` has an empty host and path, fits no rule, and is allowed. With no labelled
    rows nothing is mined. Other columns of ``pages`` are not read.
    """
    mined = mine(labelled, **mining)
    hit = checked(matches(pages, mined), "hits", F.octet_length("url") + 32)
    hit = hit.select(F.col("url").alias("hit_url"), "confidence")
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    text, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    return (
        pages.select("page_id", "url")
        .withColumns({"host": F.coalesce(host, F.lit("")), "path": F.coalesce(path, F.lit(""))})
        .join(hit, F.col("url") == F.col("hit_url"), "left")
        .withColumn("rule", text)
        .withColumn(
            "verdict",
            F.coalesce(verdict, F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")),
        )
        .drop("hit_url")
    )


#: Fixed values of the task.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def labelled_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Pages whose document has a label; a page's URL ends in the number of its document."""
    number = F.regexp_extract(url_path(F.col("url")), r"/([0-9]{1,18})(?:\.html)?/?$", 1)
    pages = pages.select("url", number.try_cast("bigint").alias("doc_id"))
    known = labels.groupBy("doc_id").agg((F.max("quality") == 0).alias("bad"))
    return pages.join(known, "doc_id").select("url", "bad")
