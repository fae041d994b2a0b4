"""URL filters: pattern rules indexed by their rarest literal token.

Every rule has a regular expression over host + path and literal tokens that any matching URL must
contain. Each rule is filed under that of its tokens that is rarest among the given URLs. The tokens
of a URL fetch its candidate rules, and only those run their expression.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased. Path: from there up
to ``?``, ``#`` or the end. Null, or without ``://``: both are empty.

Defined results: a null or empty url fits no rule and is allowed; repeated urls are judged once and all
their rows get the result; rules without a usable token are tried on every url; an empty table gives an
empty result; other columns, html above all, are never read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arenamart.llm.common import ascii_lower, read

TOKEN = re.compile(r"[A-Za-z0-9]+")
SPLIT = r"[^A-Za-z0-9]+"


@dataclass(frozen=True)
class UrlRule:
    """``given`` rules win over the method's own patterns; among them the longest name wins."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    given: bool = True


def prefix_rule(name: str, verdict: str) -> UrlRule:
    """``host/path``: fits the host and its subdomains where the path starts with the rule's path."""
    # Whole tokens only: one that ends the rule may be the start of a longer token in a URL.
    whole = tuple(m.group() for m in TOKEN.finditer(name) if m.end() < len(name))
    return UrlRule(name, verdict, r"^(?:[^/]*\.)?\Q" + name + r"\E", whole)


def host_word_rule(word: str) -> UrlRule:
    """Blocks hosts in which the word stands between dots or hyphens."""
    return UrlRule(f"host word {word}", "block", rf"^(?:[^/]*[.-])?{word}(?:[.-][^/]*)?(?:/|$)", (word,), given=False)


RULES = (
    prefix_rule("com/", "allow"),
    prefix_rule("example.com/en/", "block"),
    prefix_rule("www.example.com/en/", "allow"),
    prefix_rule("net/es/", "block"),
    prefix_rule("net/fr/", "block"),
)
#: Own words of unwanted hosts, for URLs that no given rule fits.
HOST_WORDS = ("spam", "pills", "casino", "viagra", "porn", "xxx", "betting", "escort", "warez")
METHOD_RULES = tuple(host_word_rule(w) for w in HOST_WORDS)


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    # Possessive: where no path follows the host, a later :// in query or fragment is not tried.
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^(?:(?!://).)*+://[^/?#]*+(/[^?#]*)", 1)


def rule_index(urls: DataFrame, rules: tuple[UrlRule, ...]) -> DataFrame:
    """One row per rule: the rarest of its tokens among ``urls`` (column _tokens), or ''."""
    spark = urls.sparkSession
    schema = "_rule string, _verdict string, _pattern string, _given boolean, _token string"
    rows = [(r.name, r.verdict, r.pattern, r.given, t) for r in rules for t in (r.tokens or ("",))]
    listed = spark.createDataFrame(rows, schema)
    wanted = sorted({t for r in rules for t in r.tokens})
    counts = urls.select(F.explode("_tokens").alias("_token")).where(F.col("_token").isin(wanted)).groupBy("_token").count()
    ranked = listed.join(counts, "_token", "left")
    return ranked.groupBy("_rule", "_verdict", "_pattern", "_given").agg(
        F.min_by("_token", F.struct(F.coalesce("count", F.lit(0)), F.col("_token"))).alias("_token")
    )


def judge(pages: DataFrame, rules: tuple[UrlRule, ...] = RULES + METHOD_RULES) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages``."""
    pages = pages.select("page_id", "url")
    urls = pages.select("url").where(F.col("url").isNotNull()).distinct()
    urls = urls.select("url", F.concat(host_of(F.col("url")), path_of(F.col("url"))).alias("_key"))
    tokens = F.array_distinct(F.concat(F.split("_key", SPLIT), F.array(F.lit(""))))
    urls = urls.withColumn("_tokens", tokens)
    # The rules are a literal of the program, so their broadcast does not grow with the data.
    index = F.broadcast(rule_index(urls, rules))
    fetched = urls.select("url", "_key", F.explode("_tokens").alias("_token")).join(index, "_token")
    fits = fetched.where(F.rlike("_key", F.col("_pattern")))
    given = F.when(F.col("_given"), F.struct(F.length("_rule"), F.col("_rule"), F.col("_verdict").alias("v")))
    found = fits.groupBy("url").agg(
        F.max(given).alias("_best"), F.max(F.when(~F.col("_given"), F.col("_verdict"))).alias("_own")
    )
    joined = pages.join(found, "url", "left")
    return joined.select(
        "page_id",
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        F.col("_best._rule").alias("rule"),
        F.coalesce("_best.v", "_own", F.lit("allow")).alias("verdict"),
    )


def op5_url_filter(spark, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "pages"))


_GIVEN = ", ".join(f"('{r.name}', '{r.verdict}')" for r in RULES)
_WORDS = "|".join(HOST_WORDS)
OP5_SQL = rf"""
WITH p AS (SELECT row_number() OVER () AS r, page_id,
  translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*(/[^?#]*)', 1) AS path FROM pages),
given(rule, verdict) AS (VALUES {_GIVEN}),
fit AS (SELECT r, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM p JOIN given ON
  (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
  AND starts_with(path, substr(rule, length(split_part(rule, '/', 1)) + 1)) GROUP BY r)
SELECT page_id, host, path, rule,
  coalesce(verdict, CASE WHEN regexp_matches(host, '(^|[.-])({_WORDS})([.-]|$)') THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN fit USING (r)
"""
