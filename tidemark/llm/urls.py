"""URL filters by hash-prefix lookup.

Each URL is expanded into expressions: every suffix of its host at a label border times every prefix of its path at a
slash. Rules and expressions meet in an equi-join on the first four bytes of the expressions' digest; a hit counts once
the full digests agree and the path goes on as the rule says. The longest rule decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
#: A place's urls are dealt to so many tasks; the column that says to which.
SALTS, _SALT = 8, "salt of judge"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "verdict string, host string, path string")


def _digest(host: Column, path: Column) -> Column:
    return F.unhex(F.sha2(F.concat(host, F.lit("\n"), path), 256))


def _short(digest: Column) -> Column:
    return F.conv(F.hex(F.substring(digest, 1, 4)), 16, 10).cast("long")


def _to_slash(path: Column) -> Column:
    """A path up to its last slash, included; none: empty."""
    return F.regexp_extract(path, r"(?s)^(.*/)?", 1)


def judge(df: DataFrame, rules: DataFrame, url: str = "url", otherwise: str = "allow") -> DataFrame:
    """df with host, path, rule and verdict; columns of df with these names are replaced.

    rules: (verdict, host, path). A rule fits its host and its subdomains where the url's path starts with the rule's;
    the longest (host and path together) decides, then the longer host, then block before allow. rule is host and path
    of the deciding rule, null without one; verdict is then `otherwise`. A url that is null or has no `://` has empty
    host and path and fits no rule (but one of an empty host and path). Rows are kept one by one, repeats too.
    Only as many host labels and path slashes are expanded as any rule has, so what a long url costs is bounded.
    """
    names = [c for c in df.columns if c not in ("host", "path", "rule", "verdict")]
    parsed = df.select(*names, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    known = rules.select("verdict", F.col("host").alias("r_host"), F.col("path").alias("r_path"), _to_slash(F.col("path")).alias("r_key")).distinct()
    labels, slashes = known.agg(F.max(F.size(F.split("r_host", r"\."))), F.max(F.length(F.regexp_replace("r_key", "[^/]", "")))).first()
    sites = parsed.select("host", "path").distinct()
    parts = F.split("host", r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(labels or 1))), lambda n: F.array_join(F.slice(parts, -n, n), "."))
    # cuts: a path's first pieces, each with its slash
    pieces = F.slice(F.regexp_extract_all("path", F.lit("[^/]*/"), F.lit(0)), 1, slashes or 1)
    starts = F.transform(F.sequence(F.lit(0), F.size(pieces)), lambda n: F.array_join(F.slice(pieces, 1, n), ""))
    spread = sites.select("host", "path", F.explode(F.array_distinct(ends)).alias("end")).select("host", "path", "end", F.explode(starts).alias("start"))
    hashed = spread.withColumn("digest", _digest(F.col("end"), F.col("start"))).withColumn("short", _short(F.col("digest")))
    keyed = known.withColumn("r_digest", _digest(F.col("r_host"), F.col("r_key"))).withColumn("short", _short(F.col("r_digest")))
    hits = hashed.join(keyed, "short").filter((F.col("digest") == F.col("r_digest")) & F.startswith("path", "r_path"))
    rank = F.struct((F.length("r_host") + F.length("r_path")).alias("n"), F.length("r_host").alias("h"), (F.col("verdict") == "block").alias("b"), F.concat("r_host", "r_path").alias("rule"), "verdict")
    best = hits.groupBy("host", "path").agg(F.max(rank).alias("best")).select(F.col("host").alias("b_host"), F.col("path").alias("b_path"), F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))
    # a place without a rule, such as the empty one of all broken urls, is not joined, and the others' urls are salted
    best = best.withColumn("b_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    told = parsed.withColumn(_SALT, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    same = (told["host"] == best["b_host"]) & (told["path"] == best["b_path"]) & (told[_SALT] == best["b_salt"])
    return told.join(best, same, "left").select(*[told[c] for c in names], told["host"], told["path"], best["rule"], F.coalesce(best["verdict"], F.lit(otherwise)).alias("verdict"))


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages, rule_table(spark, RULES)).select("page_id", "host", "path", "rule", "verdict")


OP5_SQL = r"""
WITH parsed AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), rules(v, h, p) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), sites AS (SELECT DISTINCT host, path FROM parsed),
hits AS (
  SELECT host, path, v, h || p AS rule, row_number() OVER (PARTITION BY host, path ORDER BY length(h) + length(p) DESC, length(h) DESC, v DESC) AS k
  FROM sites JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict
FROM parsed LEFT JOIN (SELECT * FROM hits WHERE k = 1) USING (host, path)
"""
