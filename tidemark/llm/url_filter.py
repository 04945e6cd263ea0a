"""Judging urls by pattern rules, which are found by their rarest token."""

from __future__ import annotations

import re
import string
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

TOKEN = "[^a-z0-9]+"  # what separates tokens


class Rule(NamedTuple):
    """A verdict on urls whose host and path match ``pattern``.

    ``tokens``: lower-case runs of letters and digits that every such url has, one
    of which will be the rule's index entry; none makes it a candidate for all urls.
    Of the rules that match, the highest ``rank`` wins, then the longest ``length``,
    then the least ``name``.
    """

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    rank: int
    length: int


def place(verdict: str, name: str) -> Rule:
    """A rule on a host, its subdomains and the paths that start with the rule's: ``example.com/en/``."""
    host, slash, path = name.partition("/")
    runs = re.split(TOKEN, name.lower())
    # the last run of a path may go on in the url's own token
    if path and re.match("[a-z0-9]", path[-1].lower()):
        runs.pop()
    pattern = rf"(?s)^([^/]*\.)?{re.escape(host)}{re.escape(slash + path)}"
    return Rule(name, verdict, pattern, tuple(dict.fromkeys(r for r in runs if r)), 2, len(name))


def word(verdict: str, token: str) -> Rule:
    """A rule on a word that stands alone between marks of host or path, in small or capital letters."""
    return Rule(token, verdict, rf"(?i)(^|[^a-z0-9]){re.escape(token)}([^a-z0-9]|$)", (token,), 1, len(token))


#: Words that mark adult, gambling, drug and link-farm sites or pages without prose.
WORDS = (
    "porn xxx adult sexcam escort casino poker betting jackpot viagra cialis pills payday warez keygen torrent"
    " login signin signup logout register cart checkout wishlist unsubscribe"
).split()
DEFAULT = "allow"


def host(url: Column) -> Column:
    rest = F.when(F.locate("://", url) > 0, F.substr(url, F.locate("://", url) + 3))
    found = F.regexp_extract(F.coalesce(rest, F.lit("")), "^[^/?#]*", 0)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path(url: Column) -> Column:
    rest = F.when(F.locate("://", url) > 0, F.substr(url, F.locate("://", url) + 3))
    return F.regexp_extract(F.coalesce(rest, F.lit("")), "^[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """The rules as a table without repeats."""
    rows = [
        F.struct(
            *(F.lit(getattr(r, c)).alias(c) for c in ("name", "verdict", "pattern", "rank", "length")),
            F.array(*map(F.lit, r.tokens or ("",))).alias("tokens"),
        )
        for r in dict.fromkeys(rules)
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def rarest(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """``rules`` with ``token``: of its tokens the one that the fewest ``urls`` have (``tokens``), least first."""
    literals = rules.select("name", "verdict", "pattern", F.explode("tokens").alias("token"))
    seen = (
        urls.select(F.explode("tokens").alias("token"))
        .join(literals.select("token").distinct(), "token", "left_semi")
        .groupBy("token")
        .agg(F.count("*").alias("urls"))
    )
    counted = literals.join(seen, "token", "left").withColumn("urls", F.coalesce("urls", F.lit(0)))
    chosen = counted.groupBy("name", "verdict", "pattern").agg(F.min(F.struct("urls", "token"))["token"].alias("token"))
    return rules.drop("tokens").join(chosen, ["name", "verdict", "pattern"])


def judged(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = DEFAULT) -> DataFrame:
    """``key``, ``host``, ``path``, ``rule`` (null if none fits), ``verdict`` and ``place`` of every row.

    Every distinct url is cut into tokens; those fetch the rules indexed by them,
    and only on these the regular expressions run. A rule with no token is tried
    on all. A null url, or one without ``://``, has an empty host and path. Repeated
    rows and null keys stay; other columns are not read; no page gives no row.
    """
    named = pages.select(F.col(key).alias("key"), F.col(url).alias("url"))
    urls = named.where("url is not null").select("url").distinct()
    urls = urls.select("url", F.concat(host(F.col("url")), path(F.col("url"))).alias("spot"))
    lower = F.translate("spot", string.ascii_uppercase, string.ascii_lowercase)
    urls = urls.withColumn("tokens", F.array_union(F.array_distinct(F.split(lower, TOKEN)), F.array(F.lit(""))))
    candidates = urls.select("url", "spot", F.explode("tokens").alias("token")).join(rarest(rules, urls), "token")
    best = (
        candidates.where(F.regexp_like("spot", F.col("pattern")))
        .groupBy("url")
        .agg(F.max_by(F.struct("name", "verdict", "rank"), F.struct("rank", "length", F.col("name"))).alias("best"))
    )
    found = named.join(best, "url", "left")
    return found.select(
        F.col("key").alias(key),
        host(F.col("url")).alias("host"),
        path(F.col("url")).alias("path"),
        F.col("best.name").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        F.col("best.rank").alias("rank"),
    )
