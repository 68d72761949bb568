"""URL filters: rules found through their rarest literal token, in DataFrame functions only.

A rule is a regular expression on ``host + path`` and the literal tokens (maximal runs of a-z and 0-9)
that every URL it fits must contain.  The corpus decides which of a rule's tokens is rarest; the rule is
filed under that one.  The tokens of a URL fetch the rules filed under them, and only those run.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased.  Path: from there
up to ``?``, ``#`` or the end.  Null URLs and those without ``://`` have neither, and no rule fits them.
Every row is judged; equal URLs get equal verdicts, whatever their other columns.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Words of unwanted hosts (fixed values).
BLOCKED_WORDS = "adult ads bets casino gambling pills poker porn spam track viagra xxx".split()
SMALL_RULES = 20_000  # rules that may be broadcast


@dataclass(frozen=True)
class Rule:
    """``name`` is reported for site rules; pattern rules have none and only block or allow."""

    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    name: str | None = None


def site_rule(verdict: str, host: str, path: str) -> Rule:
    """Fits the host and its subdomains if the URL's path starts with the rule's."""
    literal = f"{host}{path}"
    tokens = re.findall("[a-z0-9]+", f"{host}{path}".lower())
    if path and re.search("[a-zA-Z0-9]$", path) and tokens:
        tokens.pop()  # the URL's own token may go on
    return Rule(verdict, rf"^([^/]*\.)?\Q{literal}\E", tuple(tokens), literal)


def word_rule(verdict: str, word: str) -> Rule:
    """Fits hosts that have the word as a whole token."""
    return Rule(verdict, rf"^([^/]*[^a-z0-9/])?{word}([^a-z0-9]|$)", (word,))


def host_of(url: Column) -> Column:
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _tokens(where: Column) -> Column:
    lower = F.translate(where, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.array_distinct(F.split(lower, "[^a-z0-9]+")), "")


def index(rules: Sequence[Rule], tokens: DataFrame) -> DataFrame:
    """Rules beside the rarest of their tokens; ``tokens`` has a row (token) per URL and token."""
    spark = tokens.sparkSession
    if any(not r.tokens for r in rules):
        raise ValueError("a rule without a literal token can't be indexed")
    names = ("id", "rule_verdict", "pattern", "name", "token")
    values = [(i, r.verdict, r.pattern, r.name, t) for i, r in enumerate(rules) for t in r.tokens]
    rows = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in values]
    table = spark.range(1).select(F.inline(F.array(*rows)))
    wanted = table.select("token").distinct()
    seen = tokens.join(_small(wanted, rules), "token", "left_semi").groupBy("token").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.coalesce("n", F.lit(0)), "token"))
    return table.join(seen, "token", "left").withColumn("rank", rank).where("rank = 1").drop("rank", "n")


def _small(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return F.broadcast(df) if len(rules) <= SMALL_RULES else df


def judge(pages: DataFrame, rules: Sequence[Rule], keep: Sequence[str] = ("page_id",), url: str = "url") -> DataFrame:
    """Columns ``keep`` with host, path, rule (longest site rule that fits) and verdict.

    Without a site rule, any fitting pattern rule that blocks decides, else ``allow``.  Each distinct
    URL is judged once; the verdicts go back to all rows by a join on the URL.
    """
    u = F.col(url)
    distinct = pages.select(u.alias("u")).where(u.contains("://")).distinct()
    parts = distinct.select("u", F.concat(host_of(F.col("u")), path_of(F.col("u"))).alias("where"))
    tokens = parts.select("u", "where", F.explode(_tokens(F.col("where"))).alias("token"))
    found = tokens.join(_small(index(rules, tokens), rules), "token").where(F.rlike("where", "pattern"))
    site = F.col("name").isNotNull()
    order = F.when(site, F.struct(F.char_length("name"), -F.col("id")))
    verdicts = found.groupBy("u").agg(
        F.max_by("name", order).alias("rule"),
        F.max_by("rule_verdict", order).alias("site_verdict"),
        F.max(~site & (F.col("rule_verdict") == "block")).alias("blocked"),
    )
    kept = pages.select(*[F.col(c) for c in keep], u.alias("u"))
    return kept.join(verdicts, "u", "left").select(
        *keep,
        host_of(F.col("u")).alias("host"),
        path_of(F.col("u")).alias("path"),
        "rule",
        F.coalesce("site_verdict", F.when(F.col("blocked"), F.lit("block")), F.lit("allow")).alias("verdict"),
    )
