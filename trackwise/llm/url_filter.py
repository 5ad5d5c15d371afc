"""URL filter: a trie over reversed host labels and path segments.

Rules are (host, path, verdict). A rule fits its host and every subdomain, if
the url's path starts with the rule's path. Among the rules that fit, the one
with the most host labels wins, then the one with the longest path; if the
same (host, path) is listed as both, block wins. A url that no rule fits gets
the default verdict.

The rule list is an argument of the caller, bounded by MAX_BROADCAST_RULES and
MAX_RULE_CHARS per rule; within that bound the trie is broadcast and every url
takes one walk. A longer list is not broadcast: urls are joined with the rules
on each of their host suffixes (a shuffle join), with the same result.

Nulls, empty urls and urls without ``://`` have an empty host and path, fit no
rule and get the default. Repeated rows give repeated results; an empty table
gives an empty result. Columns of the input with the names of the result are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: (host, path, verdict)
Rule = tuple[str, str, str]
MAX_BROADCAST_RULES = 100_000
MAX_RULE_CHARS = 2_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def build_trie(rules: Sequence[Rule]) -> dict:
    """Host labels from the right; under None of a host its path segments;
    under None of a path level the beginnings of the next segment, with
    (rule, verdict)."""
    hosts: dict = {}
    for host, path, verdict in rules:
        node = hosts
        for label in reversed(host.split(".")):
            node = node.setdefault(label, {})
        *whole, tail = path.split("/")
        level = node.setdefault(None, {})
        for segment in whole:
            level = level.setdefault(segment, {})
        tails = level.setdefault(None, {})
        if tails.get(tail, ("", ""))[1] != "block":
            tails[tail] = (f"{host}{path}", verdict)
    return hosts


def longest_match(hosts: dict, host: str, path: str) -> tuple[str, str] | None:
    """(rule, verdict) of the longest rule that fits."""
    best, node = None, hosts
    segments = path.split("/")
    for label in reversed(host.split(".")):
        node = node.get(label)
        if node is None:
            break
        level, found = node.get(None), None
        for segment in segments:
            if level is None:
                break
            fits = [t for t in level.get(None, ()) if segment.startswith(t)]
            if fits:
                found = level[None][max(fits, key=len)]
            level = level.get(segment)
        best = found or best
    return best


def split_url(url):
    """Columns (host, path) of a url column."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    return (F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER),
            F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))


def filter_urls(pages: DataFrame, rules: Sequence[Rule], key: str = "page_id", url: str = "url",
                default: str = "allow", broadcast_rules: int = MAX_BROADCAST_RULES) -> DataFrame:
    """(key, url, host, path, rule, verdict) of every row."""
    if any(len(h) + len(p) > MAX_RULE_CHARS or v not in ("allow", "block") for h, p, v in rules):
        raise ValueError(f"a rule is longer than {MAX_RULE_CHARS} characters or neither allow nor block")
    urls = pages.select(F.col(key).alias("key"), F.col(url).alias("url"))
    host, path = split_url(F.col("url"))
    urls = urls.select("key", "url", F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))
    judged = _by_trie(urls, rules) if len(rules) <= broadcast_rules else _by_join(urls, rules)
    return judged.select(F.col("key").alias(key), F.col("url").alias(url), "host", "path", "rule",
                         F.coalesce("verdict", F.lit(default)).alias("verdict"))


def _by_trie(urls: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    trie = urls.sparkSession.sparkContext.broadcast(build_trie(rules))

    @F.pandas_udf("struct<rule string, verdict string>")
    def walk(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        hosts_trie = trie.value
        for hosts, paths in batches:
            yield pd.DataFrame([longest_match(hosts_trie, h, p) or (None, None) for h, p in zip(hosts, paths)],
                               columns=["rule", "verdict"])

    return urls.withColumn("found", walk("host", "path")).select("key", "url", "host", "path", "found.*")


def _by_join(urls: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """For rule lists beyond the broadcast bound: a row for each host suffix of
    a distinct (host, path), joined with the rules of that host."""
    spark = urls.sparkSession
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("r_host", "r_path", "r_verdict")])
    table = spark.createDataFrame(list(rules), schema).groupBy("r_host", "r_path").agg(
        F.max("r_verdict").alias("r_verdict"))
    distinct = urls.select("host", "path").distinct()
    suffixes = distinct.select("host", "path", F.explode(F.expr(
        "transform(sequence(1, size(split(host, '[.]'))), i -> array_join(slice(split(host, '[.]'), -i, i), '.'))"
    )).alias("suffix"))
    fits = suffixes.join(table, F.col("suffix") == F.col("r_host")).where(F.col("path").startswith(F.col("r_path")))
    best = fits.groupBy("host", "path").agg(F.max_by(
        F.struct(F.concat("r_host", "r_path").alias("rule"), F.col("r_verdict").alias("verdict")),
        F.struct(F.length("r_host"), F.length("r_path"))).alias("found"))
    return urls.join(best, ["host", "path"], "left").select("key", "url", "host", "path", "found.*")


#: the rules of the query
RULES: list[Rule] = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
]


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), RULES).drop("url")


OP4_SQL = f"""
WITH r(r_host, r_path, r_verdict) AS (VALUES {', '.join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)}),
u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
      FROM pages),
s AS (SELECT row_number() OVER () AS n, page_id,
             translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
f AS (SELECT s.*, r.*, row_number() OVER (PARTITION BY n ORDER BY length(r_host) DESC, length(r_path) DESC) AS k
      FROM s LEFT JOIN r ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path))
SELECT page_id, host, path, r_host || r_path AS rule, coalesce(r_verdict, 'allow') AS verdict FROM f WHERE k = 1
"""
