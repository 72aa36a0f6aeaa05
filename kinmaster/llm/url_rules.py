"""URL verdicts from many pattern rules, without trying every rule on every URL.

A rule is a regular expression over ``host + path`` with literal tokens that any
URL it matches must contain as whole tokens. Each rule is indexed by the one of
its tokens that is rarest among the URLs at hand. A URL fetches candidate rules
by its own tokens, and only those run their expression.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinmaster.operators.joins import join_back

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Rules of the list: (verdict, host and path). Fixed values of the query.
SITE_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
# Words that mark unwanted sites, as whole tokens of the host or path; a parameter.
UNWANTED = ("adult", "bet", "casino", "crack", "escort", "gambling", "malware", "phishing", "pills", "poker", "porn", "scam", "sex", "spam", "torrent", "viagra", "warez", "xxx")

RULE_SCHEMA = "rule string, verdict string, pattern string, tokens array<string>, tier int, size int"


def host_of(url: Column) -> Column:
    after = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    return F.coalesce(F.translate(F.regexp_extract(after, r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    after = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    return F.coalesce(F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(key: Column) -> Column:
    return F.array_distinct(F.filter(F.split(key, "[^A-Za-z0-9]+"), lambda t: t != ""))


def site_rule(verdict: str, rule: str) -> tuple:
    """A rule ``host/path``: the host and all below it, paths that begin so.

    The tokens are those that stand between two separators, so a path that ends
    inside a word does not promise its last piece.
    """
    host, _, path = rule.partition("/")
    pattern = rf"(?s)^(?:[^/]*\.)?{_literal(host)}/{_literal(path)}.*"
    whole = host + "/" + (path if re.search(r"[^A-Za-z0-9]$", path) else re.sub(r"[A-Za-z0-9]+$", "", path))
    return rule, verdict, pattern, re.findall(r"[A-Za-z0-9]+", whole), 1, len(rule)


def word_rule(verdict: str, word: str) -> tuple:
    """A word as a whole token anywhere in the host or path."""
    return f"*{word}*", verdict, rf"(?s).*(?<![A-Za-z0-9]){_literal(word)}(?![A-Za-z0-9]).*", [word], 0, len(word)


def _literal(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9/_-])", r"\\\1", text)


def rule_table(spark: SparkSession, sites: Iterable[tuple[str, str]] = SITE_RULES, unwanted: Iterable[str] = UNWANTED) -> DataFrame:
    rows = [site_rule(*s) for s in sites] + [word_rule("block", w) for w in unwanted]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def index_rules(keys: DataFrame, rules: DataFrame) -> DataFrame:
    """Rules with ``token``: the rarest of theirs among ``keys``, or "" if they have none.

    A rule one of whose tokens no URL has cannot match and is left out.
    """
    wanted = rules.select(F.explode("tokens").alias("token")).distinct()
    seen = keys.select(F.explode(tokens_of(F.col("key"))).alias("token")).join(wanted, "token")
    counts = seen.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rarest = (
        rules.select("rule", "tier", F.explode("tokens").alias("token"))
        .join(counts, "token", "left")
        .groupBy("rule", "tier")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("least"))
    )
    literal = rules.join(rarest, ["rule", "tier"], "left")
    return literal.where("least IS NULL OR least.n > 0").withColumn("token", F.coalesce("least.token", F.lit(""))).drop("least")


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` (columns of those names are replaced).

    Site rules (tier 1) go before word rules; the longest wins, then the first
    by code point. ``rule`` is the site rule or null; where only word rules
    match theirs is the verdict, else ``default``. A null URL, or one without
    ``://``, has empty host and path and matches only rules without tokens
    whose expression accepts that. Repeated URLs are judged once.
    """
    placed = pages.drop("host", "path", "rule", "verdict").withColumns(
        {"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))}
    ).withColumn("__key", F.concat("host", "path"))
    keys = placed.select(F.col("__key").alias("key")).distinct()
    index = index_rules(keys, rules)
    fetched = keys.select("key", F.explode(F.concat(tokens_of(F.col("key")), F.array(F.lit("")))).alias("token"))
    hits = fetched.join(index, "token").where(F.regexp_like(F.col("key"), F.col("pattern")))
    # max of (tier, length), then the first by code point among those.
    best = (
        hits.groupBy("key", "tier", "size").agg(F.min(F.struct("rule", "verdict")).alias("first"))
        .groupBy("key").agg(F.max_by(F.struct("tier", "first"), F.struct("tier", "size")).alias("best"))
    )
    judged = join_back(placed, best, "__key", "key", "left")
    return judged.withColumns({
        "rule": F.when(F.col("best.tier") == 1, F.col("best.first.rule")),
        "verdict": F.coalesce("best.first.verdict", F.lit(default)),
    }).drop("best", "__key")


def op3_url_rules(spark, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages, rule_table(spark)).select("page_id", "host", "path", "rule", "verdict")


def _site_sql(verdict: str, rule: str) -> str:
    host, _, path = rule.partition("/")
    return (
        f"SELECT page_id, '{rule}' AS rule, '{verdict}' AS verdict FROM p "
        f"WHERE (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}')"
    )


OP3_SQL = rf"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
m AS ({' UNION ALL '.join(_site_sql(*s) for s in SITE_RULES)}),
b AS (SELECT page_id, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict FROM m GROUP BY page_id),
w AS (
  SELECT page_id FROM p WHERE len(list_intersect(regexp_split_to_array(host || path, '[^A-Za-z0-9]+'),
         [{', '.join(repr(w) for w in UNWANTED)}])) > 0)
SELECT p.page_id, host, path, b.rule, CASE WHEN b.rule IS NOT NULL THEN b.verdict WHEN w.page_id IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM p LEFT JOIN b ON b.page_id = p.page_id LEFT JOIN (SELECT DISTINCT page_id FROM w) w ON w.page_id = p.page_id
"""
