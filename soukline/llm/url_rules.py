"""URL filter rules by hashed expressions (operator 10).

A URL is expanded into host-suffix and path-prefix expressions (``host-suffix`` +
``path prefix``, the prefixes having the lengths that rules' paths have). The expressions
meet the rules in an equi-join on the first hex digits of their SHA-256; the full digest
then confirms the match and the longest rule wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# (verdict, host, path) of the registered query; fixed by its contract
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"),
         ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"),
         ("block", "net", "/fr/")]


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(_lower_ascii(host), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _lower_ascii(col: Column) -> Column:
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rule_frame(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(rules, "verdict string, host string, path string")


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow",
               prefix_digits: int = 8) -> DataFrame:
    """Verdict per row of ``pages``: ``page_id, host, path, rule, verdict``.

    ``rules`` has ``verdict, host, path``. A rule fits its host and all subdomains if the
    path starts with the rule's; the longest rule (host and path) wins, then the longest
    host, then block before allow (so a rule given twice with both verdicts blocks).
    Without a fitting rule the verdict is ``default``.

    Defined cases: a null URL or one without ``://`` has empty host and path and fits no
    rule; rows that repeat page_id and URL each get their row; a null page_id is kept;
    an empty host fits no rule; empty tables give no rows or only default verdicts.
    Further columns of either table are ignored.
    """
    known = (rules.select(F.col("host").alias("r_host"), F.col("path").alias("r_path"),
                          F.col("verdict").alias("r_verdict"))
             .dropna().dropDuplicates()
             .withColumn("digest", F.sha2(F.concat("r_host", F.lit("\n"), "r_path"), 256)))
    lengths = known.agg(F.sort_array(F.collect_set(F.length("r_path"))).alias("lengths"))
    urls = (pages.groupBy("page_id", "url").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("host", url_host(F.col("url")))
            .withColumn("path", url_path(F.col("url"))))
    # one row with the distinct lengths of rule paths
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.transform(
        F.filter(F.col("lengths"), lambda k: k <= F.length("path")),
        lambda k: F.substring(F.col("path"), F.lit(1), k))
    expressions = F.flatten(F.transform(suffixes, lambda h: F.transform(
        prefixes, lambda p: F.concat(h, F.lit("\n"), p))))
    expanded = (urls.join(F.broadcast(lengths))
                .withColumn("expression", F.explode_outer(
                    F.when(F.col("host") != "", expressions)))
                .withColumn("e_digest", F.sha2("expression", 256)))
    short = lambda c: F.substring(c, 1, prefix_digits)
    met = expanded.join(known, (short("e_digest") == short("digest")), "left")
    fits = F.col("e_digest") == F.col("digest")
    best = F.max(F.when(fits, F.struct(
        (F.length("r_host") + F.length("r_path")).alias("chars"),
        F.length("r_host").alias("host_chars"),
        F.col("r_verdict").alias("verdict"),
        F.concat("r_host", "r_path").alias("rule")))).alias("best")
    return (met.groupBy("page_id", "url", "host", "path", "n").agg(best)
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
            .select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))


ORACLE = r"""
WITH r(verdict, host, path) AS (VALUES
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
u AS (
  SELECT page_id, url, row_number() OVER () AS row_no,
         CASE WHEN contains(url, '://')
              THEN lower(regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*'))
              ELSE '' END AS host,
         CASE WHEN contains(url, '://')
              THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1)
              ELSE '' END AS path
  FROM pages),
m AS (
  SELECT u.*, r.host || r.path AS rule, r.verdict AS found,
         row_number() OVER (PARTITION BY u.row_no
                            ORDER BY length(r.host || r.path) DESC NULLS LAST) AS k
  FROM u LEFT JOIN r
    ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path))
SELECT page_id, host, path, rule, coalesce(found, 'allow') AS verdict FROM m WHERE k = 1
"""
