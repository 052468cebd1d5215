"""URL filter rules, indexed by their rarest literal token.

A rule is a pattern of a host and the start of a path, or a regular expression over both.
Its literal tokens (runs of letters and digits that a matching URL must have between
separators, or that one of its runs must begin with) are counted over all URLs, and the
rule is entered in the index under the one that fewest URLs have; a rule whose matches do
not share a literal is entered so once for each of its alternatives.  The tokens of each
distinct URL fetch the rules entered under them; only those run their regular expression.  Of the host rules that match, the longest
one decides; where none does, the pattern rules decide: a URL that one of them matches is
blocked, any other one allowed.

Only DataFrame operations run.  URLs are judged once each, so a URL that a third of the
pages share costs one row; the judgements are joined back to the pages.

Defined results: null urls, and those without ``://``, have an empty host and path, match
no rule and are allowed; rows that repeat are judged alike; other columns are not looked
at.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm.common import table

TOKEN = r"[a-z0-9]+"


class Rule(NamedTuple):
    """``name`` is the host and path of a host rule, or how a pattern rule is called."""

    name: str
    verdict: str
    pattern: str
    literals: tuple[tuple[str, ...], ...]  # every match has all literals of one alternative
    is_host: bool


def host_rule(verdict: str, name: str) -> Rule:
    """A rule for a host, its subdomains, and the paths that start with the rule's."""
    host, slash, path = name.partition("/")
    pattern = rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(slash + path)}"
    # the last token of the path may go on in the URL, so it is no token of its own there
    whole = re.findall(TOKEN, host) + re.findall(rf"{TOKEN}(?=[^A-Za-z0-9])", path)
    return Rule(name, verdict, pattern, (tuple(whole),), True)


def pattern_rule(verdict: str, name: str, pattern: str, *literals: tuple[str, ...]) -> Rule:
    """A rule whose regular expression needs each literal of one of the alternatives.

    A literal is a whole token, or with ``*`` behind it the beginning of one.
    """
    return Rule(name, verdict, pattern, literals, False)


# fixed values: the rules that decide by host and path
HOST_RULES = (
    host_rule("block", "net/"),
    host_rule("allow", "example.net/en/"),
    host_rule("block", "example.com/de/"),
    host_rule("allow", "org/fr/"),
)
# the method's own rules, for URLs that no host rule fits
PATTERN_RULES = (
    pattern_rule("block", "pills", r"^[^/]*\bcheap-pills\.", ("cheap", "pills")),
    pattern_rule("block", "spam farm", r"^[^/]*\bspam-farm\.", ("spam", "farm")),
    pattern_rule("block", "casino", r"^[^/]*\b(?:online-)?casino\b", ("casino",)),
    pattern_rule("block", "adult", r"^[^/]*\b(?:adult|xxx)-?[a-z]*\.", ("adult*",), ("xxx*",)),
    pattern_rule("block", "free download", r"/free-download(?:/|\.|$)", ("free", "download")),
    pattern_rule("block", "tracker", r"^(?:ads?|track(?:er|ing)?)\.",
                 ("ad",), ("ads",), ("track",), ("tracker",), ("tracking",)),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(after, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(after, r"(?s)^[^/?#]*(/[^?#]*)", 1)
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, capitals, capitals.lower()), path


def rule_table(spark: SparkSession, rules) -> DataFrame:
    return spark.createDataFrame(
        [(number, r.name, r.verdict, r.pattern, list(map(list, r.literals)), len(r.name), r.is_host) for number, r in enumerate(rules)],
        "number int, name string, rule_verdict string, pattern string, literals array<array<string>>, size int, is_host boolean")


def literals_of(target: Column, rules) -> Column:
    """The tokens of a host and path, and the beginnings of tokens that some rule could need."""
    found = lambda pattern: F.regexp_extract_all(F.lower(target), F.lit(pattern))
    sizes = sorted({len(word) - 1 for r in rules for needed in r.literals for word in needed if word.endswith("*")})
    begun = [F.transform(found(rf"(?<![a-z0-9])([a-z0-9]{{{size}}})"), lambda t: F.concat(t, F.lit("*"))) for size in sizes]
    return F.array_distinct(F.concat(found(f"({TOKEN})"), *begun))


def judged(pages: DataFrame, rules=HOST_RULES + PATTERN_RULES) -> DataFrame:
    """Per row of ``pages``: page_id, host, path, rule and verdict."""
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col("page_id"), "url").withColumns({"host": host, "path": path})
    urls = rows.select("host", "path").distinct()
    target = F.concat("host", "path")
    tokens = urls.select("host", "path", F.explode(literals_of(target, rules)).alias("token"))

    listed = rule_table(spark, rules)
    literals = listed.select("number", F.posexplode("literals").alias("way", "needed")).select(
        "number", "way", F.explode("needed").alias("token"))
    # how many URLs have each literal
    counts = tokens.join(literals.select("token").distinct(), "token", "left_semi").groupBy("token").count()
    rarest = literals.join(counts, "token", "left").groupBy("number", "way").agg(
        F.min(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "token")).alias("least"))
    index = listed.join(rarest, "number").select(
        F.col("least.token").alias("token"), "number", "name", "rule_verdict", "pattern", "size", "is_host")

    candidates = tokens.join(index, "token").filter(F.expr("concat(host, path) rlike pattern"))
    best = candidates.groupBy("host", "path").agg(
        F.max(F.when(F.col("is_host"), F.struct("size", "name", "rule_verdict"))).alias("by_host"),
        F.min(F.when(~F.col("is_host"), F.col("rule_verdict"))).alias("by_pattern"),
    )
    out = rows.join(best, ["host", "path"], "left")
    return out.select(
        "page_id", "host", "path", F.col("by_host.name").alias("rule"),
        F.coalesce("by_host.rule_verdict", "by_pattern", F.lit("allow")).alias("verdict"))


def op2_rarest_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by the rules."""
    return judged(table(spark, sf_dir, "pages"))


def _pattern_sql() -> str:
    return " OR ".join(
        f"regexp_matches(host || path, '{r.pattern}')" for r in PATTERN_RULES)


OP2_SQL = f"""
WITH a AS (SELECT page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://(.*)$', 1) AS rest FROM pages),
u AS (SELECT page_id,
  translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '(?s)^[^/?#]*(/[^?#]*)', 1) AS path FROM a),
r(name, verdict, h, p) AS (VALUES ('net/', 'block', 'net', '/'), ('example.net/en/', 'allow', 'example.net', '/en/'),
  ('example.com/de/', 'block', 'example.com', '/de/'), ('org/fr/', 'allow', 'org', '/fr/')),
m AS (SELECT page_id, host, path, name, r.verdict FROM u LEFT JOIN r
  ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(name) DESC NULLS LAST) = 1)
SELECT page_id, host, path, name AS rule,
  coalesce(verdict, CASE WHEN {_pattern_sql()} THEN 'block' ELSE 'allow' END) AS verdict FROM m"""
