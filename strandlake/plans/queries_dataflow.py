"""Queries on the general dataflow operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandlake.functions import seq as sq
from strandlake.operators import dataflow as dfl
from strandlake.plans.registry import query
from strandlake.plans.views import sql, table, view

MD5_FOLD = lambda key, n: f"(((({_c(key, 1)} % {n}) * 4294967296 + {_c(key, 9)}) % {n} * 4294967296 + {_c(key, 17)}) % {n} * 4294967296 + {_c(key, 25)}) % {n}"


def _c(key: str, at: int) -> str:
    return f"('0x' || substr(md5({key}), {at}, 8))::BIGINT"


@query("map_identity", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def map_identity(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")


@query("md5_partition", f"SELECT c_name, CAST({MD5_FOLD('c_name', 97)} AS BIGINT) AS bucket FROM customer")
def md5_partition(spark, sf):
    return table(spark, sf, "customer").select("c_name", dfl.md5_bucket(F.col("c_name"), 97).alias("bucket"))


@query("mod_partition", "SELECT l_orderkey % 32 AS bucket, count(*) AS n FROM lineitem GROUP BY ALL")
def mod_partition(spark, sf):
    lines = table(spark, sf, "lineitem")
    return lines.select(dfl.mod_bucket(F.col("l_orderkey"), 32).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))


@query("sort_within", "SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) AS place FROM lineitem")
def sort_within(spark, sf):
    rows = dfl.sort_within(table(spark, sf, "lineitem"), ["l_orderkey"], [F.col("l_extendedprice").desc(), F.col("l_linenumber")])
    from pyspark.sql import Window

    w = Window.partitionBy("l_orderkey").orderBy(F.col("l_extendedprice").desc(), "l_linenumber")
    return rows.select("l_orderkey", "l_linenumber", F.row_number().over(w).cast("bigint").alias("place"))


@query("coordinate_sort", sql("SELECT sample, rname, pos, qname, alt, row_number() OVER (PARTITION BY sample, rname ORDER BY pos, qname, alt) AS place FROM v_alignments", "v_alignments"))
def coordinate_sort(spark, sf):
    from pyspark.sql import Window

    rows = dfl.sort_within(view(spark, sf, "v_alignments"), ["sample", "rname"], ["pos", "qname", "alt"])
    w = Window.partitionBy("sample", "rname").orderBy("pos", "qname", "alt")
    return rows.select("sample", "rname", "pos", "qname", "alt", F.row_number().over(w).cast("bigint").alias("place"))


@query("keyed_sum", "SELECT l_returnflag, l_linestatus, CAST(sum(l_linenumber) AS BIGINT) AS sum_l_linenumber, CAST(sum(l_partkey) AS BIGINT) AS sum_l_partkey FROM lineitem GROUP BY ALL")
def keyed_sum(spark, sf):
    return dfl.keyed_sums(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], ["l_linenumber", "l_partkey"])


@query("keyed_sum_float", "SELECT l_suppkey, round(sum(l_discount), 6) AS sum_l_discount, round(sum(l_tax), 6) AS sum_l_tax FROM lineitem GROUP BY ALL")
def keyed_sum_float(spark, sf):
    sums = dfl.keyed_sums(table(spark, sf, "lineitem"), ["l_suppkey"], ["l_discount", "l_tax"])
    return sums.select("l_suppkey", F.round("sum_l_discount", 6).alias("sum_l_discount"), F.round("sum_l_tax", 6).alias("sum_l_tax"))


@query("keyed_concat", "SELECT l_orderkey, string_agg(l_returnflag, ',' ORDER BY l_linenumber, l_returnflag) FILTER (WHERE l_returnflag <> 'N') AS joined FROM lineitem GROUP BY l_orderkey")
def keyed_concat(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("v", F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")))
    return dfl.keyed_concat(rows, ["l_orderkey"], "v", "l_linenumber")


@query("distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def distinct_rows(spark, sf):
    return table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag").distinct()


@query("union_all_inputs", "SELECT c_nationkey AS nationkey, 'c' AS origin FROM customer UNION ALL SELECT s_nationkey, 's' FROM supplier")
def union_all_inputs(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_nationkey").alias("nationkey"), F.lit("c").alias("origin"))
    s = table(spark, sf, "supplier").select(F.lit("s").alias("origin"), F.col("s_nationkey").alias("nationkey"))
    return dfl.union_all(c, s)


@query("multiplex_counts", "SELECT event_type AS tag, count(*) AS n FROM events GROUP BY ALL")
def multiplex_counts(spark, sf):
    events = table(spark, sf, "events")
    tags = sorted(r["event_type"] for r in events.select("event_type").distinct().collect())  # as many as outputs
    routed = dfl.multiplex(events, "event_type", tags)
    return dfl.union_all(*(d.groupBy(F.col("event_type").alias("tag")).agg(F.count("*").alias("n")) for d in routed.values()))


@query("counters_by_group", """
SELECT l_returnflag, unnest(['discounted', 'large', 'lines']) AS counter, unnest([count(*) FILTER (WHERE l_discount > 0.05), count(*) FILTER (WHERE l_quantity > 40), count(*)]) AS amount
FROM lineitem GROUP BY l_returnflag""")
def counters_by_group(spark, sf):
    lines = table(spark, sf, "lineitem")
    return dfl.counters(lines, "l_returnflag", {"discounted": F.col("l_discount") > 0.05, "large": F.col("l_quantity") > 40, "lines": F.lit(True)})


@query("broadcast_dim", "SELECT r_name, n_name, count(*) AS suppliers FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL")
def broadcast_dim(spark, sf):
    s, n, r = (table(spark, sf, t) for t in ("supplier", "nation", "region"))
    joined = s.join(dfl.small(n), s.s_nationkey == n.n_nationkey).join(dfl.small(r), F.col("n_regionkey") == r.r_regionkey)
    return joined.groupBy("r_name", "n_name").agg(F.count("*").alias("suppliers"))


@query("dim_chain_join", "SELECT o_orderpriority, n_name, r_name, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL")
def dim_chain_join(spark, sf):
    o, c, n, r = (table(spark, sf, t) for t in ("orders", "customer", "nation", "region"))
    joined = o.join(c, o.o_custkey == c.c_custkey).join(dfl.small(n), F.col("c_nationkey") == n.n_nationkey).join(dfl.small(r), F.col("n_regionkey") == r.r_regionkey)
    return joined.groupBy("o_orderpriority", "n_name", "r_name").agg(F.count("*").alias("orders"))


@query("left_join_default", "SELECT p_partkey, CAST(round(coalesce(q, 0) * 20) AS BIGINT) AS copies FROM part LEFT JOIN (SELECT l_partkey, avg(l_quantity) AS q FROM lineitem WHERE l_discount > 0.08 GROUP BY 1) ON p_partkey = l_partkey")
def left_join_default(spark, sf):
    level = table(spark, sf, "lineitem").where("l_discount > 0.08").groupBy("l_partkey").agg(F.avg("l_quantity").alias("q"))
    p = table(spark, sf, "part")
    return p.join(level, p.p_partkey == level.l_partkey, "left").select("p_partkey", F.round(F.coalesce("q", F.lit(0.0)) * 20).cast("bigint").alias("copies"))


@query("manifest_dim", "SELECT n_name AS sample_label, row_number() OVER (ORDER BY n_nationkey) - 1 AS sample_index FROM nation WHERE n_name NOT LIKE 'A%'")
def manifest_dim(spark, sf):
    from pyspark.sql import Window

    rows = table(spark, sf, "nation").where(~F.col("n_name").startswith("A"))
    return rows.select(F.col("n_name").alias("sample_label"), (F.row_number().over(Window.orderBy("n_nationkey")) - 1).cast("bigint").alias("sample_index"))


@query("count_inputs", sql("""
SELECT sample, count(*) AS records, CASE WHEN min(lo) >= 64 THEN 'Phred64' WHEN min(lo) < 59 THEN 'Sanger' WHEN max(hi) >= 94 THEN 'Solexa' ELSE 'Sanger' END AS encoding
FROM (SELECT sample, list_min([ord(x) FOR x IN string_split(CASE WHEN sample < 3 THEN qual ELSE qual64 END, '')]) AS lo,
             list_max([ord(x) FOR x IN string_split(CASE WHEN sample < 3 THEN qual ELSE qual64 END, '')]) AS hi FROM v_reads) GROUP BY sample""", "v_reads"))
def count_inputs(spark, sf):
    codes = sq.codes(F.when(F.col("sample") < 3, F.col("qual")).otherwise(F.col("qual64")))
    spans = view(spark, sf, "v_reads").select("sample", F.array_min(codes).alias("lo"), F.array_max(codes).alias("hi"))
    return spans.groupBy("sample").agg(F.count("*").alias("records"), sq.phred_format(F.min("lo"), F.max("hi")).alias("encoding"))


@query("balanced_splits", """
WITH s AS (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1),
p AS (SELECT CAST(ceil(sum(n) / 7.0) AS BIGINT) AS per FROM s),
c AS (SELECT l_suppkey, sum(n) OVER (ORDER BY l_suppkey) - n AS lo, sum(n) OVER (ORDER BY l_suppkey) AS hi FROM s),
e AS (SELECT l_suppkey, lo, hi, per, unnest(generate_series(CAST(lo // per AS BIGINT), CAST((hi - 1) // per AS BIGINT))) AS split FROM c, p)
SELECT l_suppkey, split, CAST(greatest(lo, split * per) - lo AS BIGINT) AS start, CAST(least(hi, (split + 1) * per) - greatest(lo, split * per) AS BIGINT) AS span FROM e""")
def balanced_splits(spark, sf):
    sizes = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n"))
    return dfl.balanced_splits(sizes, "l_suppkey", "n", 7)


@query("bad_record_filter", "SELECT event_id, event_type FROM events WHERE value IS NOT NULL AND value >= 0 AND length(event_type) > 4")
def bad_record_filter(spark, sf):
    return table(spark, sf, "events").where("value is not null and value >= 0 and length(event_type) > 4").select("event_id", "event_type")


@query("union_cogroup", sql("""
SELECT qname, count(*) FILTER (WHERE t = 0) AS postponed, count(*) FILTER (WHERE t = 1) AS realigned, max(as_score) AS best FROM (
  SELECT qname, as_score, 0 AS t FROM v_alignments WHERE alt % 2 = 0 UNION ALL SELECT qname, as_score, 1 FROM v_alignments WHERE alt % 2 = 1) GROUP BY qname""", "v_alignments"))
def union_cogroup(spark, sf):
    a = view(spark, sf, "v_alignments").select("qname", "as_score", (F.col("alt") % 2).alias("t"))
    both = dfl.union_all(a.where("t = 0"), a.where("t = 1"))
    return both.groupBy("qname").agg(F.count_if(F.col("t") == 0).alias("postponed"), F.count_if(F.col("t") == 1).alias("realigned"), F.max("as_score").alias("best"))


@query("first_match", """
WITH r AS (SELECT r_regionkey AS k, min(r_name) AS v FROM region GROUP BY ALL), n AS (SELECT n_nationkey AS k, min(n_name) AS v FROM nation GROUP BY ALL), s AS (SELECT s_suppkey AS k, min(s_name) AS v FROM supplier GROUP BY ALL)
SELECT o_orderkey, o_custkey % 60 AS k, coalesce(r.v, n.v, s.v) AS label FROM orders LEFT JOIN r ON r.k = o_custkey % 60 LEFT JOIN n ON n.k = o_custkey % 60 LEFT JOIN s ON s.k = o_custkey % 60""")
def first_match(spark, sf):
    from strandlake.operators.dataflow import first_match as matched

    rows = table(spark, sf, "orders").select("o_orderkey", (F.col("o_custkey") % 60).alias("k"))
    lookups = [(table(spark, sf, t), f"{t[0]}_{k}", f"{t[0]}_name") for t, k in (("region", "regionkey"), ("nation", "nationkey"), ("supplier", "suppkey"))]
    return matched(rows, "k", lookups, "label")
