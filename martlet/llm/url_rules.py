"""URL rules: host-suffix and path-prefix expressions joined on short hash prefixes.

A rule is a host with a path, written ``host/path``. It fits its host and all subdomains if the
URL's path starts with the rule's path. Of the rules that fit a URL the longest wins; of two of
the same length the one with the longer host, then ``block``, then the greater text.

Every distinct URL is expanded into the expressions that a rule could equal: its last 1, 2, ...
host labels, each with the path cut to the lengths that rules have. Expressions and rules meet in an
equi-join on the first 8 hexadecimal digits of the SHA-256, and a hit counts only if the whole
digests agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.llm.shared import ascii_lower

PREFIX_DIGITS = 8

BASE_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

_URL = "(?s)^.*?://([^/?#]*)([^?#]*)"


def base_rules(spark) -> DataFrame:
    return spark.createDataFrame(BASE_RULES, "rule_host string, rule_path string, verdict string")


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, _URL, 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def _labels(host: Column) -> Column:
    return F.size(F.split(host, "[.]", -1))


def expressions(urls: DataFrame, label_counts: list[int], path_lengths: list[int]) -> DataFrame:
    """(url, expression) for a frame with ``url``: as many rows as suffixes times prefixes that rules can have."""
    host, path = F.col("_host"), F.col("_path")
    ints = lambda xs: F.array(*[F.lit(int(x)) for x in xs])
    return (
        urls.select("url", url_host(F.col("url")).alias("_host"), url_path(F.col("url")).alias("_path"))
        .filter(host != "")
        .withColumn("_suffixes", F.filter(ints(label_counts), lambda k: k <= _labels(host)))
        .withColumn("_cuts", F.filter(ints(path_lengths), lambda k: k <= F.char_length(path)))
        .select("url", "_host", "_path", "_cuts", F.explode("_suffixes").alias("_k"))
        .select("url", "_host", "_path", "_k", F.explode("_cuts").alias("_cut"))
        .select(
            "url",
            # substring_index wants a constant count: the lengths are few, so a CASE does
            F.concat(
                F.coalesce(*[F.when(F.col("_k") == k, F.substring_index(host, ".", -k)) for k in label_counts]),
                F.substring(path, F.lit(1), F.col("_cut")),
            ).alias("expression"),
        )
    )


def rule_hits(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, rule, verdict): the winning rule of each distinct non-null URL that some rule fits.

    The lengths of the rules' hosts and paths are collected: a few small numbers, bounded by the
    length of the longest rule, however many rules there are.
    """
    named = rules.filter("rule_host <> '' AND rule_path IS NOT NULL AND verdict IN ('allow', 'block')").select(
        ascii_lower(F.col("rule_host")).alias("_rule_host"), "rule_path", "verdict"
    )
    shapes = named.select(
        F.sort_array(F.collect_set(_labels(F.col("_rule_host")))), F.sort_array(F.collect_set(F.char_length("rule_path")))
    ).first()
    signed = named.withColumn("rule", F.concat("_rule_host", "rule_path")).withColumn("_digest", F.sha2("rule", 256))
    signed = signed.withColumn("_prefix", F.substring("_digest", 1, PREFIX_DIGITS)).withColumnRenamed("_digest", "_full")
    distinct = urls.select("url").filter(F.col("url").isNotNull()).distinct()
    if not shapes[0]:
        return distinct.filter(F.lit(False)).withColumn("rule", F.lit("")).withColumn("verdict", F.lit(""))
    asked = expressions(distinct, shapes[0], shapes[1]).withColumn("_digest", F.sha2("expression", 256))
    asked = asked.withColumn("_prefix", F.substring("_digest", 1, PREFIX_DIGITS))
    hits = asked.join(signed, "_prefix").filter(F.col("_digest") == F.col("_full"))
    strength = F.struct(
        F.char_length("rule").alias("a"), F.char_length("_rule_host").alias("b"), F.col("verdict").alias("c"), F.col("rule").alias("d")
    )
    best = hits.groupBy("url").agg(F.max(strength).alias("_best"))
    return best.select("url", F.col("_best.d").alias("rule"), F.col("_best.c").alias("verdict"))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    Null URLs and URLs without ``://`` have an empty host and path, fit no rule and get
    ``default``, as do all that no rule fits. Repeated rows are judged alike and all stay; other
    columns are ignored, so none can clash; an empty table gives no rows; rules with a null or
    empty host, a null path or another verdict are ignored.
    """
    asked = pages.select("page_id", "url")
    hits = rule_hits(asked, rules).withColumnRenamed("url", "_url")
    return asked.join(hits, F.col("url") == F.col("_url"), "left").select(
        "page_id",
        url_host(F.col("url")).alias("host"),
        url_path(F.col("url")).alias("path"),
        "rule",
        F.coalesce("verdict", F.lit(default)).alias("verdict"),
    )


ORACLE = """
WITH rules(rule_host, rule_path, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), p AS (
  SELECT page_id, url, coalesce(strpos(url, '://'), 0) AS sep FROM pages
), q AS (
  SELECT page_id,
         CASE WHEN sep = 0 THEN '' ELSE regexp_extract(substr(url, sep + 3), '(?s)^[^/?#]*') END AS raw_host,
         CASE WHEN sep = 0 THEN '' ELSE regexp_extract(substr(url, sep + 3), '(?s)^[^?#]*') END AS rest
  FROM p
), r AS (
  SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         substr(rest, length(raw_host) + 1) AS path FROM q
), m AS (
  SELECT r.page_id, max(struct_pack(n := length(rule_host || rule_path), h := length(rule_host), v := verdict,
                                    r := rule_host || rule_path)) AS best
  FROM r JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY r.page_id
)
SELECT r.page_id, host, path, best.r AS rule, coalesce(best.v, 'allow') AS verdict
FROM r LEFT JOIN m ON m.page_id = r.page_id
"""
