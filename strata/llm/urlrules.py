"""URL filter rules by a sort-merge range join.

A rule (host, path, verdict) fits the urls of its host and all subdomains whose
path starts with the rule's. Hosts are written reversed, each label followed by
``/`` (``org/example/``), which no host holds, so that "host or subdomain" is a
prefix; a prefix is the interval of keys from itself up to itself + 0xFF, a
byte that UTF-8 never has. Intervals of prefixes nest or are disjoint.

``sweep`` sorts keys and interval bounds in one line, range-partitioned into
blocks, and keeps a stack: a running sum of +1 (an interval opens) and -1 (it
closes) is the height, and the prefix at a height is the one pushed last at that
height. A block starts by pushing again what was open where the block before
ended; these rows are few (blocks x nesting). Ties in the key are split by a
hash, so a hot host or url is spread over blocks like any other keys.

A rule limits host and path, two dimensions, so two sweeps are made: the first
puts reversed hosts against the rules' hosts and yields each url's stack of
scopes, the second puts scope + ``#`` + path against the rules of that scope and
yields the longest fitting path in each scope. Of the rules found the longest (characters of host and
path, then of the host) wins.

DataFrame operations only. Defined cases: a null url or one without ``://`` has
empty host and path; a url no rule fits gets a null rule and the default
verdict; an empty rule host fits every host; rules with a null column are
ignored, of equal rules with different verdicts block wins; rows are judged
each, so repeated or null ids stay; no rules or no pages work; columns other
than the id and url are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql import Window as W

from strata.llm.common import cut, n_partitions

#: The contract's rules: verdict, host, path.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]
DEFAULT = "allow"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_INHERITED, _BOUND, _POINT = -1, 0, 1


def rules_frame(spark: SparkSession, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    rows = [F.struct(*[F.lit(v).cast("string").alias(c) for v, c in zip(r, ("verdict", "host", "path"))]) for r in rules]
    if not rows:
        return spark.range(0).selectExpr("'' AS verdict", "'' AS host", "'' AS path")
    return spark.range(1).select(F.inline(F.array(*rows)))


def host(url: str | Column) -> Column:
    """The part after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0), _UPPER, _LOWER)


def path(url: str | Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: str | Column) -> Column:
    c = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))
    at = F.locate("://", c)
    return F.when(at > 0, F.substr(c, at + 3)).otherwise("")


def reversed_host(h: str | Column) -> Column:
    """Labels from the last to the first, each followed by ``/``; empty for an empty host."""
    c = F.col(h) if isinstance(h, str) else h
    return F.when(c == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split(c, r"\.")), "/"), F.lit("/")))


def sweep(points: DataFrame, prefixes: DataFrame, whole_stack: bool = False, salt: str = "p") -> DataFrame:
    """(p, prefix): for each point (key binary, p struct) the longest of ``prefixes`` (prefix binary, distinct)
    that its key starts with, null if none; ``whole_stack``: a row for each of them.

    ``salt``: what ties in the key are split by."""
    spark = points.sparkSession
    n, payload = n_partitions(spark), points.schema["p"].dataType
    nothing, no_prefix = F.lit(None).cast(payload), F.lit(None).cast("binary")

    def bound(key: Column, step: int) -> DataFrame:
        return prefixes.select(key.alias("key"), F.lit(_BOUND).alias("kind"), F.lit(0).cast("long").alias("salt"),
                               F.lit(step).alias("step"), F.col("prefix"), nothing.alias("p"))

    line = points.select("key", F.lit(_POINT).alias("kind"), F.xxhash64(salt).alias("salt"), F.lit(0).alias("step"),
                         no_prefix.alias("prefix"), "p") \
        .union(bound(F.col("prefix"), 1)).union(bound(F.concat("prefix", F.lit(b"\xff")), -1))
    line = line.repartitionByRange(n, "key", "kind", "salt").withColumn("block", F.spark_partition_id())
    line = cut(line, "urlrules-line")

    order = ["key", "kind", "salt"]
    bounds = line.filter(F.col("kind") == _BOUND).select("block", *order, "step", "prefix")
    # the height where each block starts, and the prefixes open there
    net = line.groupBy("block").agg(F.sum("step").alias("net"))
    before = W.orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    start = net.select("block", F.coalesce(F.sum("net").over(before), F.lit(0)).alias("start"))
    inside = W.partitionBy("block").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    pushed = bounds.withColumn("height", F.sum("step").over(inside)).filter("step = 1").join(start, "block") \
        .groupBy("block", (F.col("start") + F.col("height")).alias("height")).agg(F.max("prefix").alias("prefix"))
    wanted = start.filter("start > 0").select("block", F.explode(F.sequence(F.lit(1).cast("long"), "start")).alias("height"))
    lower = W.partitionBy("height").orderBy("block").rangeBetween(W.unboundedPreceding, -1)
    open_ = pushed.select("block", "height", "prefix", F.lit(False).alias("want")) \
        .unionByName(wanted.select("block", "height", no_prefix.alias("prefix"), F.lit(True).alias("want"))) \
        .withColumn("prefix", F.last("prefix", ignorenulls=True).over(lower)).filter("want")
    again = open_.select("block", F.lit(b"").alias("key"), F.lit(_INHERITED).alias("kind"), F.col("height").alias("salt"),
                         F.lit(1).alias("step"), "prefix", nothing.alias("p"))

    full = line.select("block", *order, "step", "prefix", "p").unionByName(again)
    full = full.withColumn("height", F.sum("step").over(inside)).filter("step >= 0")
    if whole_stack:  # a point reads every height up to its own
        levels = F.when((F.col("kind") == _POINT) & (F.col("height") > 0), F.sequence(F.lit(1).cast("long"), "height")) \
            .otherwise(F.array("height"))
        full = full.withColumn("height", F.explode(levels))
    top = W.partitionBy("block", "height").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return full.withColumn("top", F.last("prefix", ignorenulls=True).over(top)).filter(F.col("kind") == _POINT) \
        .select("p", F.col("top").alias("prefix"))


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", default: str = DEFAULT) -> DataFrame:
    """id, host, path, rule and verdict for every row of ``pages`` (id, url)."""
    r = rules.select(F.translate(F.col("host"), _UPPER, _LOWER).alias("rh"), F.col("path").alias("rp"), "verdict").dropna() \
        .withColumn("scope", reversed_host("rh").cast("binary"))
    r = r.groupBy("scope", "rh", "rp").agg(F.max("verdict").alias("v"))  # of allow and block, block
    r = r.withColumn("prefix", F.concat("scope", F.lit("#").cast("binary"), F.col("rp").cast("binary")))
    r = cut(r, "urlrules-rules")

    url = pages.select(F.col(id_col).alias("id"), host("url").alias("h"), path("url").alias("u"), F.monotonically_increasing_id().alias("n"))
    scopes = sweep(url.select(reversed_host("h").cast("binary").alias("key"), F.struct("id", "h", "u", "n").alias("p")),
                   r.select(F.col("scope").alias("prefix")).distinct(), whole_stack=True, salt="p.n")
    scopes = cut(scopes.select("p.*", F.col("prefix").alias("scope")), "urlrules-scopes")
    none = scopes.filter("scope IS NULL").select("id", "h", "u", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("v"))
    found = sweep(scopes.filter("scope IS NOT NULL")
                  .select(F.concat("scope", F.lit("#").cast("binary"), F.col("u").cast("binary")).alias("key"),
                          F.struct("id", "h", "u", "n").alias("p")),
                  r.select("prefix"), salt="p.n").select("p.*", "prefix")
    # a rule of another scope can't be on the stack, as its prefix has another "#"
    hit = found.join(r, "prefix", "left").select("id", "h", "u", "n", F.when(F.col("rh").isNotNull(), F.struct(
        (F.length("rh") + F.length("rp")).alias("size"), F.length("rh").alias("host_size"),
        F.concat("rh", "rp").alias("rule"), F.col("v"))).alias("best"))
    best = hit.groupBy("n").agg(F.first("id").alias("id"), F.first("h").alias("h"), F.first("u").alias("u"), F.max("best").alias("best")) \
        .select("id", "h", "u", "best.rule", "best.v")
    return best.union(none).select(F.col("id").alias(id_col), F.col("h").alias("host"), F.col("u").alias("path"), "rule",
                                   F.coalesce("v", F.lit(default)).alias("verdict"))


#: DuckDB: every rule against every url that it fits, longest first.
ORACLE = """
WITH rules(verdict, host, path) AS (VALUES """ + ", ".join(str(r) for r in RULES) + """),
u AS (SELECT page_id, row_number() OVER () AS n,
        translate(regexp_extract(coalesce(url, ''), '(?s)://([^/?#]*)([^?#]*)', 1),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '(?s)://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
fit AS (SELECT u.n, r.host || r.path AS rule, r.verdict,
        row_number() OVER (PARTITION BY u.n ORDER BY length(r.host) + length(r.path) DESC, length(r.host) DESC) AS k
        FROM u JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path))
SELECT u.page_id, u.host, u.path, fit.rule, coalesce(fit.verdict, '""" + DEFAULT + """') AS verdict
FROM u LEFT JOIN fit ON fit.n = u.n AND fit.k = 1
"""
