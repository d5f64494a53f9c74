"""URL filters: nested prefix rules found by a sort-merge range join.

A host is written backwards, label by label (``blog.example.org`` as ``org.example.blog.``),
so a host and its subdomains are the keys that start with its own key, and a rule is an
interval of keys; intervals of prefixes nest or are apart.  Points and interval starts
are sorted into ranges; a sweep over each range keeps the interval that began last, whose
enclosing intervals are the stack, and of these the ones that hold the point stay.  Two
sweeps decide a rule: over hosts, then over paths below each rule host of the stack.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = 64

# The rules of the registered query.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def rules_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def host_of(url: Column) -> Column:
    """After the first :// up to /, ? , # or the end, A-Z lower-cased; empty without ://."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ?, # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def stacks(intervals: DataFrame) -> DataFrame:
    """key and _stack: the keys of all intervals that hold this one, itself included.

    ``intervals`` holds distinct keys; a key has at most as many others around it as it
    has characters.
    """
    sizes = F.sequence(F.lit(1), F.length("key"))
    inner = intervals.select("key", F.explode(sizes).alias("_n")).select(
        "key", F.expr("substring(key, 1, _n)").alias("_outer")
    )
    outer = intervals.select(F.col("key").alias("_outer"))
    return inner.join(outer, "_outer").groupBy("key").agg(F.collect_list("_outer").alias("_stack"))


def sweep(points: DataFrame, intervals: DataFrame, parts: int = PARTS) -> DataFrame:
    """key and open: for each distinct point the intervals (prefixes) that hold it, one row each.

    Points and interval starts are sorted together into ranges of keys; every range first
    learns which interval began last before it, so no range waits for another.  A point
    without an interval gives no row.
    """
    starts = stacks(intervals)
    marks = points.select("key", F.lit(1).alias("_kind"), F.lit(None).cast("array<string>").alias("_stack")).unionByName(
        starts.select("key", F.lit(0).alias("_kind"), "_stack")
    )
    ranged = marks.repartitionByRange(parts, "key", "_kind").withColumn("_part", F.spark_partition_id())
    ranged = materialize(ranged, "sweep")
    ended = (
        ranged.filter("_kind = 0").groupBy("_part").agg(F.max_by("_stack", "key").alias("_last"))
        .join(ranged.select("_part").distinct(), "_part", "right")
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ended.select("_part", F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
    turn = Window.partitionBy("_part").orderBy("key", "_kind")
    swept = ranged.withColumn("_top", F.last("_stack", ignorenulls=True).over(turn)).filter("_kind = 1")
    top = F.coalesce("_top", "_carried")
    held = F.filter(top, lambda k: F.startswith(F.col("key"), k))
    return swept.join(carried, "_part").select("key", F.explode(held).alias("open"))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages``.

    ``rules`` has host, path and verdict.  A rule fits its host and all subdomains if the
    url's path starts with the rule's; the one with the longest host and path together
    wins, among equal ones the one with the longer host, of repeated rules the verdict
    that sorts last.  Urls that are null or have no :// have empty host and path and, like
    all that no rule fits, no rule and the default verdict.  Repeated pages stay; an empty
    table gives no rows; other columns are not looked at.

    Distinct hosts and distinct (rule host, path) pairs are swept, so a host with a third
    of all pages is one point; the result meets the pages in an equi-join that can be
    split where a host and path are frequent.
    """
    read = pages.select(F.col("page_id").cast("bigint"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    known = rules.select(
        host_key(F.col("host")).alias("_host"),
        F.col("path").alias("_path"),
        F.concat("host", "path").alias("rule"),
        "verdict",
        F.struct(F.length("host") + F.length("path"), F.length("host"), "verdict").alias("_weight"),
    )
    pairs = read.select("host", "path").distinct()
    hosts = pairs.select(host_key(F.col("host")).alias("key")).distinct()
    under = sweep(hosts, known.select(F.col("_host").alias("key")).distinct())
    # A blank keeps host and path apart: it is in neither's rules nor sorts inside them.
    points = pairs.withColumn("_key", host_key(F.col("host"))).join(
        under.select(F.col("key").alias("_key"), F.col("open").alias("_host")), "_key"
    ).select("host", "path", F.concat("_host", F.lit(" "), "path").alias("key"))
    known = known.withColumn("_rule_key", F.concat("_host", F.lit(" "), "_path"))
    fits = sweep(points.select("key").distinct(), known.select(F.col("_rule_key").alias("key")).distinct())
    winners = known.groupBy("_rule_key").agg(
        F.max(F.struct("_weight", "rule", "verdict")).alias("_best")
    )
    best = (
        fits.join(winners, fits["open"] == winners["_rule_key"]).groupBy("key").agg(F.max("_best").alias("_best"))
    )
    decided = points.join(best, "key").groupBy("host", "path").agg(F.max("_best").alias("_best"))
    return read.join(decided, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("_best.rule").alias("rule"),
        F.coalesce("_best.verdict", F.lit(default)).alias("verdict"),
    )


ORACLE = """
WITH r(host, path, verdict) AS (VALUES
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
u AS (SELECT page_id,
  coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages),
d AS (SELECT DISTINCT host, path FROM u),
w AS (SELECT d.host, d.path, arg_max(r.host || r.path, length(r.host) + length(r.path)) AS rule,
  arg_max(r.verdict, length(r.host) + length(r.path)) AS verdict
  FROM d JOIN r ON ends_with('.' || d.host, '.' || r.host) AND starts_with(d.path, r.path) GROUP BY ALL)
SELECT u.page_id, u.host, u.path, w.rule, coalesce(w.verdict, 'allow') AS verdict
FROM u LEFT JOIN w ON u.host = w.host AND u.path = w.path
"""
