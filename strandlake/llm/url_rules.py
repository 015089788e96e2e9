"""URL filters as a sort-merge range join between URLs and nested host/path rules.

A rule (host, path) fits a URL if the URL's host is the rule's host or a subdomain of it
and the URL's path starts with the rule's path. The key of a rule is its reversed host
labels followed by its path, so what fits is the interval from the key up to the key
followed by a byte that no UTF-8 text holds. A URL has one point for each of its host's
suffixes. Rules with equal host are nested or disjoint, never crossing, so a sweep over the
sorted starts, ends and points needs a stack only: the depth is a running sum of +1 and -1,
slot d of the stack is the last start at depth d, and the top is the slot of the current depth.

Everything is DataFrame functions. Points are dealt over lanes of a host, and the rules of
that host are copied into each lane, so a host with a third of all rows doesn't meet in one
task. Equal URLs are judged once.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rules of the registered query: action, host, path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: URLs that one lane of a host should hold at most.
URLS_PER_LANE = 200_000


def rules_frame(spark: SparkSession, rules: Iterable[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame([tuple(r) for r in rules], "action string, host string, path string")


def url_host(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return F.coalesce(F.when(F.instr(url, "://") > 0, host), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.when(F.instr(url, "://") > 0, path), F.lit(""))


def reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def host_suffixes(host: Column, most: int) -> Column:
    """The host's last 1 to ``most`` labels, as far as it has so many: itself or parent domains."""
    n = F.size(F.split(host, r"\."))
    return F.transform(F.sequence(F.lit(1), F.least(n, F.lit(most))), lambda k: F.call_function("substring_index", host, F.lit("."), -k))


def sweep(points: DataFrame, rules: DataFrame, lanes: int) -> DataFrame:
    """For each point (``host_key``, ``path``, ``url``) the longest rule of that host whose path starts the point's."""
    starts = rules.select(
        F.col("host").alias("rule_host"),
        F.col("path").alias("rule_path"),
        "action",
        reversed_host(F.col("host")).alias("host_key"),
        F.col("path").cast("binary").alias("start_key"),
    )
    events = starts.select(
        "*",
        F.explode(
            F.array(
                F.struct(F.lit(1).alias("step"), F.lit(1).alias("kind"), F.col("start_key").alias("key")),
                F.struct(
                    F.lit(-1).alias("step"), F.lit(0).alias("kind"),
                    F.concat(F.col("start_key"), F.expr("X'FF'")).alias("key"),
                ),
            )
        ).alias("e"),
    ).select("host_key", "rule_host", "rule_path", "action", "e.*")
    # Ends at one key close the innermost rule first; starts at one key don't repeat as rules are distinct.
    order = [F.col("key"), F.col("kind")]
    depth = F.sum("step").over(Window.partitionBy("host_key").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    deepest = events.select(depth.alias("d")).agg(F.max("d")).first()[0] or 0
    if deepest == 0:
        nothing = F.lit(None).cast("string")
        return points.where(F.lit(False)).select(
            "url", nothing.alias("rule"), nothing.alias("action"), F.lit(0).alias("rule_len"), F.lit(0).alias("host_len")
        )
    dealt = points.select(
        "host_key", F.pmod(F.xxhash64("url"), F.lit(lanes)).alias("lane"), F.lit(0).alias("step"),
        F.lit(2).alias("kind"), F.col("path").cast("binary").alias("key"), "url",
        *(F.lit(None).cast("string").alias(c) for c in ("rule_host", "rule_path", "action")),
    )
    spread = events.select(
        "host_key", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(lanes - 1).cast("bigint"))).alias("lane"),
        "step", "kind", "key", F.lit(None).cast("string").alias("url"), "rule_host", "rule_path", "action",
    )
    running = Window.partitionBy("host_key", "lane").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    swept = dealt.unionByName(spread).withColumn("depth", F.sum("step").over(running))
    rule = F.struct("rule_host", "rule_path", "action")
    for d in range(1, deepest + 1):
        here = F.when((F.col("kind") == 1) & (F.col("depth") == d), rule)
        swept = swept.withColumn(f"slot_{d}", F.last(here, ignorenulls=True).over(running))
    top = F.coalesce(*(F.when(F.col("depth") == d, F.col(f"slot_{d}")) for d in range(1, deepest + 1)))
    return (
        swept.where((F.col("kind") == 2) & (F.col("depth") > 0))
        .select("url", top.alias("top"))
        .select(
            "url", F.concat("top.rule_host", "top.rule_path").alias("rule"), F.col("top.action").alias("action"),
            F.length(F.concat("top.rule_host", "top.rule_path")).alias("rule_len"),
            F.length("top.rule_host").alias("host_len"),
        )
    )


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", lanes: int | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages`` (``page_id``, ``url``; other columns are ignored).

    The rule with the longest host and path together wins, the longer host at a tie; of
    equal rules with different actions ``block`` holds. Without a fitting rule the rule is
    null and the verdict is ``default``. A null URL or one without ``://`` has empty host and
    path and fits no rule with a host. Repeated rows are kept; empty tables give no rows.
    Rules with a null in any column are ignored. Of a long host only as many labels are looked
    up as the longest rule has.
    """
    pages = pages.select("page_id", "url")
    rules = (
        rules.where(F.col("host").isNotNull() & F.col("path").isNotNull() & F.col("action").isNotNull())
        .groupBy(F.translate("host", UPPER, LOWER).alias("host"), "path")
        .agg(F.max("action").alias("action"))
    )
    if lanes is None:
        lanes = max(4, -(-pages.count() // URLS_PER_LANE))
    hosts = rules.select(F.col("host").alias("suffix")).distinct()
    most = hosts.agg(F.max(F.size(F.split("suffix", r"\.")))).first()[0] or 1  # no longer suffix can be a rule's host
    points = (
        pages.select("url").where(F.instr("url", "://") > 0).distinct()
        .select("url", url_path(F.col("url")).alias("path"), F.explode(host_suffixes(url_host(F.col("url")), most)).alias("suffix"))
        .join(hosts, "suffix", "left_semi")
        .select("url", "path", reversed_host(F.col("suffix")).alias("host_key"))
    )
    best = (
        sweep(points, rules, lanes)
        .groupBy("url")
        .agg(F.max(F.struct("rule_len", "host_len", "rule", "action")).alias("best"))
    )
    return pages.join(best, "url", "left").select(
        "page_id",
        url_host(F.col("url")).alias("host"),
        url_path(F.col("url")).alias("path"),
        F.col("best.rule").alias("rule"),
        F.coalesce("best.action", F.lit(default)).alias("verdict"),
    )


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules_frame(spark))


OP10_SQL = r"""
WITH parts AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages
), cut AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM parts
), rules(action, rhost, rpath) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
)
SELECT page_id, host, path,
       (SELECT arg_max(rhost || rpath, length(rhost || rpath)) FROM rules
        WHERE (host = rhost OR suffix(host, '.' || rhost)) AND starts_with(path, rpath)) AS rule,
       coalesce((SELECT arg_max(action, length(rhost || rpath)) FROM rules
        WHERE (host = rhost OR suffix(host, '.' || rhost)) AND starts_with(path, rpath)), 'allow') AS verdict
FROM cut
"""
