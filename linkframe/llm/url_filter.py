"""URL filters (column expressions only): rules indexed by their rarest literal token.

A rule is a pattern (a Java regular expression over ``host + path`` of a URL) with its literal tokens: words that every
text the pattern matches holds as whole tokens. Token counts over all URLs tell which of a rule's tokens is rarest; the
rule is filed under that one alone. A URL's distinct tokens fetch candidate rules, and only those candidates run. A rule
without a literal token has nothing to be filed under and runs on every URL: a caller that has many should give them tokens.

Of the rules that match, the one with the highest ``rank`` decides. ``host_rule`` writes a rule for a host with its
subdomains and a path prefix; its rank is its length, so that the longest wins, and above that of every plain pattern.

Defined cases: null URLs and such without ``://`` have an empty host and path, hold no tokens and get ``default``; ties in
rank go to the smaller rule text; repeated URLs are judged each; an empty table or rule list gives no matches. The rules
are data that the caller writes, so their number doesn't grow with the URLs. Input columns with the name of a result
column are replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import materialize

AUTHORITY = r"(?s)^.*?://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HOST_RANK = 1_000_000


@dataclass(frozen=True)
class Rule:
    text: str
    pattern: str
    tokens: tuple[str, ...]
    verdict: str
    rank: int


def tokens_of(text: str) -> tuple[str, ...]:
    return tuple(dict.fromkeys(re.findall(r"[a-z0-9]+", text.translate(str.maketrans(UPPER, LOWER)))))


def host_rule(host: str, path: str, verdict: str) -> Rule:
    """Fits ``host`` and its subdomains if the path starts with ``path``."""
    pattern = rf"(?s)^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}"
    whole = path.rsplit("/", 1)[0]  # a token at the end of a prefix may go on in the URL
    return Rule(host + path, pattern, tokens_of(f"{host}/{whole}"), verdict, HOST_RANK + len(host + path))


def token_rule(name: str, words: str, verdict: str = "block") -> Rule:
    """Fits URLs that hold the words of ``words`` (``a-b``) as neighbouring whole tokens, whatever separates them."""
    parts = tokens_of(words)
    body = "[^a-z0-9]+".join(map(re.escape, parts))
    return Rule(name, rf"(?is)(?:^|[^a-z0-9]){body}(?:[^a-z0-9]|$)", parts, verdict, len(words))


#: What the query holds against URLs that no host rule fits.
SPAM = [token_rule(w, w) for w in (
    "casino", "casino-win", "free-bets", "online-poker", "cheap-pills", "buy-viagra", "payday-loans", "adult-chat", "xxx", "porn",
    "replica-watches", "crack-download",
)]


def host_and_path(url: Column) -> tuple[Column, Column]:
    body = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(body, AUTHORITY, 1), UPPER, LOWER), F.regexp_extract(body, AUTHORITY, 2)


def judge(pages: DataFrame, rules: list[Rule], url: str = "url", default: str = "allow", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all if not given) with host, path, ``rule`` (null if none) and ``verdict``."""
    spark = pages.sparkSession
    host, path = host_and_path(F.col(url))
    made = ("host", "path", "rule", "verdict")
    names = [c for c in (keep or pages.columns) if c not in made]
    # Equal URLs have equal verdicts, but one row each: nothing is regrouped by URL, matches come back by row.
    given = F.struct(*(F.col(c).alias(c) for c in names))  # apart, so that no name clashes
    rows = pages.select(given.alias("given"), host.alias("host"), path.alias("path"), F.monotonically_increasing_id().alias("row_"))
    rows = materialize(rows, "urls")
    body = F.concat("host", "path")
    # Distinct tokens of a URL; empty ones come from separators at the ends.
    words = F.array_distinct(F.split(F.translate(body, UPPER, LOWER), "[^a-z0-9]+"))
    table = [(i, r.text, r.pattern, list(r.tokens), r.verdict, r.rank) for i, r in enumerate(rules)]
    listed = spark.createDataFrame(table, "id_ int, rule string, pattern string, tokens array<string>, verdict string, rank long")

    exploded = rows.select("row_", body.alias("body"), F.explode(words).alias("token"))
    by_rule = listed.select("id_", F.explode("tokens").alias("token"))
    known = exploded.join(F.broadcast(by_rule.select("token").distinct()), "token", "left_semi")
    counts = known.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rarest = by_rule.join(counts, "token").groupBy("id_").agg(
        F.count(F.lit(1)).alias("present"), F.min(F.struct("n", "token"))["token"].alias("token"))
    # A rule one of whose tokens no URL holds can't match at all.
    index = rarest.join(listed, "id_").where(F.col("present") == F.size("tokens"))
    index = materialize(index.select("token", "rule", "pattern", "verdict", "rank"), "url-index")

    fits = exploded.join(F.broadcast(index), "token").where(F.expr("body rlike pattern")).select("row_", "rule", "verdict", "rank")
    if not all(r.tokens for r in rules):
        # Nothing tells where a rule without a token may fit: it meets every URL.
        always = listed.where(F.size("tokens") == 0).select("pattern", "rule", "verdict", "rank")
        fits = fits.unionByName(rows.select("row_", body.alias("body")).join(F.broadcast(always), F.expr("body rlike pattern")).select("row_", "rule", "verdict", "rank"))
    best = fits.groupBy("row_").agg(F.min(F.struct((-F.col("rank")).alias("rank"), "rule", "verdict")).alias("best"))
    return rows.join(best, "row_", "left").select(
        "given.*", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
