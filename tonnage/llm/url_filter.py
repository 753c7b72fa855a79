"""URL rules indexed by their rarest literal token, in DataFrame operations only.

A rule is a regular expression over a page's address (host and path) and the tokens that
every address it fits must contain. How often each of these tokens occurs in the addresses
is counted, and the rule is filed under its rarest one. The tokens of an address fetch the
rules filed under them, and only those run.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """What an address that fits a pattern gets.

    tokens are runs of a-z and 0-9 that a fitting address, lower-cased A-Z, must contain
    between other characters or its ends; with none the rule is tried on every address.
    A site rule decides before any other rule; of two site rules the longer name decides.
    """

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...] = field(default=())
    is_site: bool = False


def _tokens(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def site_rule(verdict: str, site: str) -> Rule:
    """A rule for a host, its subdomains, and the paths that start as given: 'example.org/en/1'."""
    host, slash, path = site.partition("/")
    host = host.lower()
    # The last token of a path may go on in the address, so it cannot be looked up.
    whole = re.sub("[A-Za-z0-9]+$", "", slash + path)
    pattern = r"^(?:[^/]*\.)?" + re.escape(host + slash + path) + ("" if slash else "(?:/|$)")
    return Rule(host + slash + path, verdict, pattern, tuple(dict.fromkeys(_tokens(host) + _tokens(whole))), True)


def host_word_rule(verdict: str, word: str) -> Rule:
    """A rule for hosts with word as a whole word between dots and hyphens."""
    return Rule(word, verdict, rf"^(?:[^/]*[^a-z0-9/])?{re.escape(word)}(?:[^a-z0-9]|$)", tuple(_tokens(word)))


SITE_RULES = (
    site_rule("allow", "org/"),
    site_rule("block", "example.org/es/"),
    site_rule("block", "example.org/en/1"),
    site_rule("allow", "com/fr/"),
    site_rule("block", "com/de/"),
)
WORD_RULES = tuple(
    host_word_rule("block", word)
    for word in (
        "bet betting bets casino escort gambling jackpot loan loans lottery pharmacy pill pills poker porn "
        "sex slots torrent viagra warez xxx"
    ).split()
)


def rule_table(spark: SparkSession, rules: Iterable[Rule]) -> DataFrame:
    """Rules as a table: name, verdict, pattern, tokens, is_site."""
    rows = [
        F.struct(
            F.lit(r.name).alias("name"),
            F.lit(r.verdict).alias("verdict"),
            F.lit(r.pattern).alias("pattern"),
            F.array(*map(F.lit, r.tokens or ("",))).alias("tokens"),
            F.lit(r.is_site).alias("is_site"),
        )
        for r in rules
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def host_of(url: Column) -> Column:
    """What follows the first :// up to / ? # or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ? # or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def _address_tokens(address: Column) -> Column:
    """The distinct tokens of an address, and the empty one under which tokenless rules are filed."""
    found = F.regexp_extract_all(F.translate(address, UPPER, LOWER), F.lit("([a-z0-9]+)"), F.lit(1))
    return F.array_union(found, F.array(F.lit("")))


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """The columns of pages with host, path, rule, verdict and pattern_rule.

    rule names the longest fitting site rule, else null; pattern_rule the first by name of the
    other fitting rules, else null. The site rule decides, then the pattern rule, then default.
    A null url or one without :// has an empty host and path and fits only rules that fit the
    empty address. Columns of pages with one of these names are replaced. Repeated rows and
    rows with equal urls get equal results.
    """
    added = ("host", "path", "rule", "verdict", "pattern_rule")
    pages = pages.drop(*added).withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    addresses = pages.select(F.concat("host", "path").alias("address"))
    looked_up = addresses.select("address", F.explode(_address_tokens(F.col("address"))).alias("token"))
    literals = rules.select("*", F.explode("tokens").alias("token")).drop("tokens")
    counts = looked_up.join(literals.select("token").distinct(), "token").groupBy("token").count()
    index = (
        literals.join(counts, "token", "left")
        .groupBy("name", "verdict", "pattern", "is_site")
        .agg(F.min(F.struct(F.coalesce("count", F.lit(0)), "token")).alias("rarest"))
        .select("name", "verdict", "pattern", "is_site", "rarest.token")
    )
    fitting = looked_up.join(index, "token").where(F.expr("address rlike pattern"))
    found = fitting.groupBy("address").agg(
        F.max(F.when(F.col("is_site"), F.struct(F.length("name"), "name", "verdict"))).alias("site"),
        F.min(F.when(~F.col("is_site"), F.struct("name", "verdict"))).alias("other"),
    )
    return (
        pages.withColumn("address", F.concat("host", "path"))
        .join(found, "address", "left")
        .select(
            *pages.columns,
            F.col("site.name").alias("rule"),
            F.coalesce("site.verdict", "other.verdict", F.lit(default)).alias("verdict"),
            F.col("other.name").alias("pattern_rule"),
        )
    )
