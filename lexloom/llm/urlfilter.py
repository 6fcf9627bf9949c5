"""URL filters: host-suffix and path-prefix expressions matched by short hash prefixes.

Every URL becomes the expressions host suffix + path prefix that a rule could equal. Their SHA-256 prefixes meet those of
the rules in an equi join; the full digests confirm a hit, and the longest rule wins. Native column expressions only.
"""

from pyspark.sql import functions as F

from lexloom.llm.base import table
from lexloom.session import tune

# The rules that the query applies: host, path, verdict.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
PREFIX = 8  # hex digits of the joined hash prefix
DEFAULT = "allow"


def url_host(url):
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty if NULL or without `://`."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url):
    """After the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _suffixes(host, labels):
    """The ends of a host with as many labels as given, where it has so many."""
    n = F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1
    return F.array_compact(F.array(*[F.when(n >= m, F.substring_index(host, ".", -m)) for m in labels]))


def judge(pages, rules, default=DEFAULT):
    """host, path, rule and verdict for every row of pages (page_id, url); rules: host, path, verdict.

    A rule fits its host and all subdomains if the path starts with the rule's path. The longest rule (host and path)
    wins, then the longer host, then block before allow. Rows without a fitting rule get the default. NULL and malformed
    URLs have an empty host and path and fit no rule. Repeated rows are judged each; repeated rules count once.

    Distinct (host, cut path) pairs are expanded, so a URL or host shared by a third of the rows is expanded once. Only the
    numbers of host labels and the path lengths that rules have are tried, however long a URL is: these lists are bounded
    by the longest rule. Spark broadcasts the rules if their size allows, else it sorts and merges.
    """
    spark = tune(pages.sparkSession)
    rules = rules.select(F.lower("host").alias("rh"), F.col("path").alias("rp"), F.col("verdict").alias("rv")).na.drop().distinct()
    lengths = sorted(r[0] for r in rules.select(F.length("rp")).distinct().collect())
    labels = sorted(r[0] for r in rules.select(F.size(F.split("rh", r"\."))).distinct().collect())
    judged = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    if not lengths:
        return judged.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    longest = lengths[-1]
    judged = judged.withColumn("cut", F.substring("path", 1, longest))
    keys = judged.select("host", "cut").filter("host <> ''").distinct()
    paths = F.array(*[F.lit(n) for n in lengths])
    asked = (keys.withColumn("s", F.explode(_suffixes(F.col("host"), labels))).withColumn("n", F.explode(F.filter(paths, lambda n: n <= F.length("cut"))))
             .select("host", "cut", F.sha2(F.concat("s", F.substring(F.col("cut"), F.lit(1), F.col("n"))).cast("binary"), 256).alias("digest"))
             .withColumn("short", F.substring("digest", 1, PREFIX)))
    held = rules.select("*", F.concat("rh", "rp").alias("expression")).withColumn("rd", F.sha2(F.col("expression").cast("binary"), 256)).withColumn("short", F.substring("rd", 1, PREFIX))
    best = F.max(F.struct(F.length("expression").alias("n"), F.length("rh").alias("h"), (F.col("rv") == "block").alias("b"), F.col("expression").alias("rule"), F.col("rv").alias("verdict")))
    found = asked.join(held, "short").filter("digest = rd").groupBy("host", "cut").agg(best.alias("best"))
    out = judged.join(found, ["host", "cut"], "left")
    return out.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def op6_url_filters(spark, sf_dir):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules)


ORACLE = r"""
WITH p AS (
  SELECT page_id,
         CASE WHEN strpos(url, '://') > 0 THEN translate(regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
         CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
r(rh, rp, rv) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow'))
SELECT page_id, host, path,
       (SELECT arg_max(rh || rp, length(rh || rp)) FROM r WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)) AS rule,
       coalesce((SELECT arg_max(rv, length(rh || rp)) FROM r WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)), 'allow') AS verdict
FROM p
"""
