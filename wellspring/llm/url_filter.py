"""URL filter rules, matched by expressions and hashes.

A url is expanded into host-suffix and path-prefix expressions; these meet the rules in an equi-join on short
hash prefixes, full SHA-256 digests then confirm, and the longest rule that fits wins.

Defined results: a null url, or one without "://", has an empty host and path and fits no rule; an empty path
does not start with "/", so no rule fits it; an empty rule table, or rules with a null host or path, leave urls to `default`,
and so does a fitting rule with a null verdict, whose name is shown; of rules that are equal the smaller verdict holds, and
rules of equal length that fit one url are the same rule; a very long url is expanded to no more prefixes than rules have
lengths; repeated rows are each judged; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.session import materialize

#: (verdict, host, path): the rules that op10 applies.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
#: Rules up to this many are broadcast (about 100 bytes each); a longer list is shuffled on its hash prefixes.
BROADCAST_RULES = 200_000
PREFIX_HEX = 8


def url_host(url: Column) -> Column:
    """Between the first :// and the next /, ? or #, with A-Z in lower case."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_suffixes(host: Column) -> Column:
    """example.com and com for example.com; every suffix that starts a label."""
    labels = F.split(host, r"\.", -1)
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "verdict string, host string, path string")


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """id, host, path, rule and verdict for every row of pages.

    Paths are expanded to prefixes of just those lengths that rule paths have: their number is bounded by
    the rules, not by the urls, and any rule path can match, whether or not it ends at a slash.
    """
    digest = lambda host, path: F.sha2(F.concat(host, path), 256)
    known = rules.where("host IS NOT NULL AND path IS NOT NULL").select(
        F.concat("host", "path").alias("rule"), "verdict", digest(F.col("host"), F.col("path")).alias("digest"), F.length(F.concat("host", "path")).alias("n"), F.length("path").alias("path_n")
    )
    # Of the same expression twice, the smaller verdict (allow before block) holds.
    known = known.groupBy("digest").agg(F.min(F.struct("verdict", "rule", "n", "path_n")).alias("r")).select(F.substring("digest", 1, PREFIX_HEX).alias("prefix"), "digest", "r.*")
    lengths, count = known.agg(F.sort_array(F.collect_set("path_n")), F.count("*")).first()
    urls = pages.select(F.col(id_col).alias("page_id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    if not count:
        return urls.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    # Distinct (host, path) pairs are judged once; a partial aggregate runs before the shuffle.
    parts = urls.select("host", "path").distinct()
    expressions = parts.select("host", "path", F.explode(host_suffixes(F.col("host"))).alias("h")).select(
        "host", "path", "h", F.explode(F.filter(F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths]), lambda x: x.isNotNull())).alias("p")
    )
    expressions = expressions.select("host", "path", digest(F.col("h"), F.col("p")).alias("full")).withColumn("prefix", F.substring("full", 1, PREFIX_HEX))
    known = known.drop("path_n")
    hits = expressions.join(F.broadcast(known) if count <= BROADCAST_RULES else known, "prefix").where(F.col("full") == F.col("digest"))
    best = hits.groupBy("host", "path").agg(F.max(F.struct("n", "rule", "verdict")).alias("r")).select("host", "path", "r.rule", "r.verdict")
    # Written first, so that the join's both sides are exchanged for it and a hot url can be split; the session's own threshold
    # (spark.sql.autoBroadcastJoinThreshold), which sees the written size, decides whether it's broadcast.
    joined = urls.join(materialize(best, "urls"), ["host", "path"], "left")
    return joined.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


ORACLE_SQL = """
WITH u AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
r(verdict, rh, rp) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
hit AS (
  SELECT page_id, host, path, verdict, rh || rp AS rule,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC) AS k
  FROM u JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT u.page_id, u.host, u.path, hit.rule, coalesce(hit.verdict, 'allow') AS verdict
FROM u LEFT JOIN hit ON u.page_id = hit.page_id AND hit.k = 1
"""


def query(spark, sf_dir: str) -> DataFrame:
    from wellspring.llm._common import table

    return filter_urls(table(spark, sf_dir, "pages"), rule_table(spark, RULES))
