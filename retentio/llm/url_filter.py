"""Operator 10: URL filters by host-suffix and path-prefix expressions.

Each URL is expanded into expressions: every suffix of its host at a dot,
with every prefix of its path that ends in a slash (and the empty one), no
deeper than the deepest rule, so a long path costs no more than a short one. A
rule (host, path) is filed under its host and its path up to the last
slash. Expressions and rules meet in an equi-join on the first 32 bits of
a SHA-256 digest; the full digest and the rest of the rule's path are then
confirmed. The longest rule (host and path) wins; of equally long ones the
longer host, then `block`.

Verdicts depend on host and path only, so they are found once for each
different URL place and joined back: a URL that stands in a third of the
rows is one row per task. Rules are joined as a table; Spark broadcasts
them only when their size is under its threshold.

Defined cases: a null URL or one without `://` has an empty host and path
and fits no rule; a URL that fits no rule gets DEFAULT; a rule with null
host, or that repeats, counts once or not at all; rows that repeat a page
are judged one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retentio.plans.tables import materialize

from .common import ROW

DEFAULT = "allow"

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"),
         ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def host_of(url: Column) -> Column:
    raw = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                                  "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def _prefix(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def filed_rules(rules: DataFrame) -> DataFrame:
    """prefix, digest, rule_host, rule_path, rule_verdict."""
    path = F.coalesce("path", F.lit(""))
    digest = _digest(F.lower("host"), F.regexp_extract(path, r"(?s)^(?:.*/)?", 0))
    return (rules.filter(F.col("host").isNotNull())
            .select(_prefix(digest).alias("prefix"), digest.alias("rule_digest"),
                    F.lower("host").alias("rule_host"), path.alias("rule_path"),
                    F.col("verdict").alias("rule_verdict")).distinct())


def rule_depths(rules: DataFrame) -> tuple[int, int]:
    """Labels of the longest rule host and steps of the longest rule path:
    no longer expression can be filed."""
    r = rules.agg(F.max(F.size(F.split("host", r"\.", -1))).alias("labels"),
                  F.max(F.size(F.split(F.coalesce("path", F.lit("")), "/", -1)) - 1).alias("steps")).first()
    return max(r["labels"] or 0, 0), max(r["steps"] or 0, 0)


def expressions(places: DataFrame, most_labels: int, most_steps: int) -> DataFrame:
    """host, path, prefix, digest: the expressions of every place, as deep
    as the rules are (`rule_depths`)."""
    labels, steps = F.split("host", r"\.", -1), F.split("path", "/", most_steps + 2)
    n = F.size(labels)
    hosts = F.transform(F.sequence(F.greatest(n - most_labels + 1, F.lit(1)), n), lambda i: F.array_join(
        F.slice(labels, i, n - i + 1), "."))
    deepest = F.least(F.size(steps) - 1, F.lit(most_steps))
    paths = F.concat(F.array(F.lit("")), F.when(deepest > 0, F.transform(
        F.sequence(F.lit(1), deepest),
        lambda i: F.concat(F.array_join(F.slice(steps, F.lit(1), i), "/"), F.lit("/"))))
        .otherwise(F.array().cast("array<string>")))
    each = (places.filter(F.col("host") != "")
            .withColumn("h", F.explode(hosts)).withColumn("p", F.explode(paths))
            .withColumn("digest", _digest(F.col("h"), F.col("p"))))
    return each.select("host", "path", _prefix(F.col("digest")).alias("prefix"), "digest")


def judge(pages: DataFrame, rules: DataFrame, url: str = "url",
          default: str = DEFAULT) -> DataFrame:
    """`pages` with host, path, rule and verdict (columns of these names are
    replaced)."""
    u = F.col(f"`{url}`")
    own = [f"`{c}`" for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    read = pages.select(F.struct(*own).alias(ROW), host_of(u).alias("host"),
                        path_of(u).alias("path"))
    places = read.select("host", "path").distinct()
    fits = (expressions(places, *rule_depths(rules)).join(filed_rules(rules), "prefix")
            .filter((F.col("digest") == F.col("rule_digest"))
                    & F.col("path").startswith(F.col("rule_path"))))
    size = F.length("rule_host") + F.length("rule_path")
    # written, so that the join reads a table and AQE can split a hot place
    best = materialize(fits.groupBy("host", "path").agg(F.max(F.struct(
        size.alias("size"), F.length("rule_host").alias("host_size"),
        (F.col("rule_verdict") == "block").alias("blocks"),
        F.concat("rule_host", "rule_path").alias("rule"),
        F.col("rule_verdict").alias("verdict"))).alias("best")), "url_verdicts")
    return (read.join(best, ["host", "path"], "left")
            .select(f"{ROW}.*", "host", "path", "best.rule",
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))


def url_query(pages: DataFrame) -> DataFrame:
    out = judge(pages.select("page_id", "url"), rule_table(pages.sparkSession))
    return out.select("page_id", "host", "path", "rule", "verdict")


URL_SQL = """
WITH u AS (SELECT page_id, CASE WHEN url LIKE '%://%'
                  THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
p AS (SELECT page_id,
        translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
r(h, q, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
        ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
places AS (SELECT DISTINCT host, path FROM p),
f AS (SELECT host, path, h || q AS rule, verdict,
             row_number() OVER (PARTITION BY host, path
                 ORDER BY length(h) + length(q) DESC, length(h) DESC, verdict DESC) AS k
      FROM places, r
      WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM p LEFT JOIN f ON p.host = f.host AND p.path = f.path AND f.k = 1
"""
