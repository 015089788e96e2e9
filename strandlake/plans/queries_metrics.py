"""Queries on accuracy metrics and cross-sample statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandlake.operators import metrics as mt
from strandlake.plans.registry import query
from strandlake.plans.views import sql, table, view

KEY = ["rname", "start", "end_pos", "sample"]


@query("precision_recall", sql("""
WITH b AS (SELECT sample, t IS NOT NULL AS t, c IS NOT NULL AS c FROM (SELECT *, 1 AS t FROM v_truth) FULL JOIN (SELECT *, 1 AS c FROM v_called) USING (rname, start, end_pos, sample)),
n AS (SELECT sample, count(*) FILTER (WHERE t AND c) AS tp, count(*) FILTER (WHERE t) AS relevant, count(*) FILTER (WHERE c) AS retrieved FROM b GROUP BY sample)
SELECT sample, tp, relevant, retrieved, round(coalesce(tp / nullif(retrieved, 0), 1.0), 8) AS precision, round(coalesce(tp / nullif(relevant, 0), 1.0), 8) AS recall,
  round(coalesce(2 * coalesce(tp / nullif(retrieved, 0), 1.0) * coalesce(tp / nullif(relevant, 0), 1.0) / nullif(coalesce(tp / nullif(retrieved, 0), 1.0) + coalesce(tp / nullif(relevant, 0), 1.0), 0), 0.0), 8) AS f_score FROM n""", "v_truth", "v_called"))
def precision_recall(spark, sf):
    found = mt.precision_recall(view(spark, sf, "v_truth"), view(spark, sf, "v_called"), KEY, ["sample"])
    return found.select("sample", "tp", "relevant", "retrieved", *(F.round(c, 8).alias(c) for c in ("precision", "recall", "f_score")))


@query("intron_intersect", sql("SELECT rname, start, end_pos, sample FROM v_truth INTERSECT SELECT rname, start, end_pos, sample FROM v_called", "v_truth", "v_called"))
def intron_intersect(spark, sf):
    return view(spark, sf, "v_truth").select(*KEY).intersect(view(spark, sf, "v_called").select(*KEY))


@query("intron_except", sql("SELECT 'missed' AS kind, * FROM (SELECT rname, start, end_pos, sample FROM v_truth EXCEPT SELECT rname, start, end_pos, sample FROM v_called) UNION ALL SELECT 'false', * FROM (SELECT rname, start, end_pos, sample FROM v_called EXCEPT SELECT rname, start, end_pos, sample FROM v_truth)", "v_truth", "v_called"))
def intron_except(spark, sf):
    t, c = view(spark, sf, "v_truth").select(*KEY), view(spark, sf, "v_called").select(*KEY)
    return t.subtract(c).select(F.lit("missed").alias("kind"), "*").union(c.subtract(t).select(F.lit("false").alias("kind"), "*"))


@query("mean_stdev", sql("SELECT rname, round(avg(n), 8) AS mean, round(stddev_samp(n), 8) AS stdev FROM (SELECT rname, sample, count(*) AS n FROM v_truth GROUP BY ALL) GROUP BY rname", "v_truth"))
def mean_stdev(spark, sf):
    n = view(spark, sf, "v_truth").groupBy("rname", "sample").agg(F.count("*").alias("n"))
    return n.groupBy("rname").agg(F.round(F.avg("n"), 8).alias("mean"), F.round(F.stddev_samp("n"), 8).alias("stdev"))


@query("intron_sample_hist", sql("SELECT n_samples, count(*) AS n_features FROM (SELECT rname, start, end_pos, count(DISTINCT sample) AS n_samples FROM v_truth GROUP BY rname, start, end_pos) GROUP BY n_samples", "v_truth"))
def intron_sample_hist(spark, sf):
    return mt.sample_histogram(view(spark, sf, "v_truth"), ["rname", "start", "end_pos"])


@query("unique_to_sample", sql("SELECT rname, start, end_pos, min(sample) AS sample FROM v_truth GROUP BY rname, start, end_pos HAVING count(DISTINCT sample) = 1", "v_truth"))
def unique_to_sample(spark, sf):
    return mt.unique_to_sample(view(spark, sf, "v_truth"), ["rname", "start", "end_pos"])


_CELLS = ", ".join(f'CAST(coalesce(sum("count") FILTER (WHERE sample = {s}), 0) AS BIGINT) AS s{s}' for s in range(20))


@query("feature_matrix", sql(f"SELECT rname_strand, start, end_pos, {_CELLS} FROM v_junction_obs GROUP BY rname_strand, start, end_pos", "v_junction_obs"))
def feature_matrix(spark, sf):
    return mt.feature_matrix(view(spark, sf, "v_junction_obs"), ["rname_strand", "start", "end_pos"], range(20), "count")


@query("stratified_sample", "SELECT c_nationkey, c_custkey FROM (SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY md5(CAST(c_custkey AS VARCHAR)), c_custkey) AS r FROM customer) WHERE r <= 8")
def stratified_sample(spark, sf):
    return mt.stratified_sample(table(spark, sf, "customer").select("c_nationkey", "c_custkey"), "c_nationkey", "c_custkey", 8)


@query("intron_support", sql("""
SELECT rname, start, end_pos, count(*) FILTER (WHERE k = 't') AS true_support, count(*) FILTER (WHERE k = 'c') AS called_support
FROM (SELECT *, 't' AS k FROM v_truth UNION ALL SELECT *, 'c' FROM v_called) GROUP BY rname, start, end_pos""", "v_truth", "v_called"))
def intron_support(spark, sf):
    rows = view(spark, sf, "v_truth").withColumn("k", F.lit("t")).unionByName(view(spark, sf, "v_called").withColumn("k", F.lit("c")))
    return rows.groupBy("rname", "start", "end_pos").agg(F.count_if(F.col("k") == "t").alias("true_support"), F.count_if(F.col("k") == "c").alias("called_support"))


@query("threshold_curve", sql("""
WITH f AS (SELECT rname, start, end_pos, count(*) FILTER (WHERE k = 't') AS t, count(*) FILTER (WHERE k = 'c') AS c FROM (SELECT *, 't' AS k FROM v_truth UNION ALL SELECT *, 'c' FROM v_called) GROUP BY rname, start, end_pos)
SELECT CAST(i AS INT) AS i, count(*) FILTER (WHERE t = i) AS relevant, count(*) FILTER (WHERE t = i AND c > 0) AS found, count(*) FILTER (WHERE c >= i) AS retrieved, count(*) FILTER (WHERE c >= i AND t > 0) AS "right"
FROM f, (SELECT unnest(generate_series(1, 20)) AS i) GROUP BY i""", "v_truth", "v_called"))
def threshold_curve(spark, sf):
    rows = intron_support(spark, sf).withColumnsRenamed({"true_support": "true_cov", "called_support": "called_cov"})
    return mt.threshold_curve(rows, 20)


@query("truth_vs_called", sql("""
WITH t AS (SELECT transcript, min(start) AS s, max(end_pos) AS e FROM v_exons WHERE start % 3 <> 0 GROUP BY 1), c AS (SELECT transcript, start, end_pos FROM v_exons WHERE start % 3 = 0)
SELECT coalesce(t.transcript, c.transcript) AS transcript, CAST(max(greatest(0, least(t.e, c.end_pos) - greatest(t.s, c.start))) AS BIGINT) AS best, count(c.transcript) AS calls
FROM t FULL JOIN c ON t.transcript = c.transcript GROUP BY 1""", "v_exons"))
def truth_vs_called(spark, sf):
    exons = view(spark, sf, "v_exons")
    t = exons.where("start % 3 <> 0").groupBy("transcript").agg(F.min("start").alias("s"), F.max("end_pos").alias("e"))
    c = exons.where("start % 3 = 0").withColumn("called", F.lit(1))
    shared = F.greatest(F.lit(0).cast("bigint"), F.least("e", "end_pos") - F.greatest("s", "start"))
    return t.join(c, "transcript", "full").groupBy("transcript").agg(F.max(shared).alias("best"), F.count("called").alias("calls"))


@query("mate_matches", """
WITH x AS (SELECT l_orderkey, l_linenumber % 2 AS m, l_linenumber % 3 = 0 AS t, l_partkey % 6 AS v FROM lineitem),
s AS (SELECT l_orderkey, list(DISTINCT v) FILTER (WHERE t AND m = 0) AS t0, list(DISTINCT v) FILTER (WHERE t AND m = 1) AS t1, list(DISTINCT v) FILTER (WHERE NOT t AND m = 0) AS c0, list(DISTINCT v) FILTER (WHERE NOT t AND m = 1) AS c1 FROM x GROUP BY l_orderkey),
e AS (SELECT l_orderkey, coalesce(t0, []) AS t0, coalesce(t1, []) AS t1, coalesce(c0, []) AS c0, coalesce(c1, []) AS c1 FROM s)
SELECT l_orderkey, CAST(greatest(len(list_intersect(t0, c0)) + len(list_intersect(t1, c1)), len(list_intersect(t0, c1)) + len(list_intersect(t1, c0))) AS INT) AS matched,
  CAST(len(t0) + len(t1) AS INT) AS relevant, CAST(len(c0) + len(c1) AS INT) AS retrieved FROM e""")
def mate_matches(spark, sf):
    from strandlake.operators.metrics import mate_matches as matched

    mate, value, true = F.col("l_linenumber") % 2, F.col("l_partkey") % 6, F.col("l_linenumber") % 3 == 0
    of = lambda part, m: F.collect_set(F.when(part & (mate == m), value))
    both = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array(of(true, 0), of(true, 1)).alias("t"), F.array(of(~true, 0), of(~true, 1)).alias("c"))
    return matched(both.select("l_orderkey", F.col("t").alias("x")), both.select("l_orderkey", F.col("c").alias("x")), "l_orderkey", "x")


@query("regression_shares", """
WITH v AS (SELECT l_suppkey AS region, l_linenumber AS sample, sum(l_quantity) AS value FROM lineitem GROUP BY ALL),
j AS (SELECT region, value, CAST(sample * sample % 7 AS DOUBLE) AS x FROM v),
r AS (SELECT region, coalesce(regr_r2(value, x), 0) AS r2, var_pop(value) AS spread, var_pop(x) AS width FROM j GROUP BY region)
SELECT region, 'x' AS term, round(CASE WHEN spread > 0 AND width > 0 THEN r2 ELSE 0 END, 6) AS share FROM r UNION ALL
SELECT region, 'residual', round(CASE WHEN spread > 0 THEN 1 - CASE WHEN width > 0 THEN r2 ELSE 0 END ELSE 0 END, 6) FROM r""")
def regression_shares(spark, sf):
    from strandlake.operators.metrics import regression_shares as shares

    lines = table(spark, sf, "lineitem")
    values = lines.groupBy(F.col("l_suppkey").alias("region"), F.col("l_linenumber").alias("sample")).agg(F.sum("l_quantity").alias("value"))
    covariates = lines.select(F.col("l_linenumber").alias("sample")).distinct().withColumn("x", (F.col("sample") * F.col("sample") % 7).cast("double"))
    return shares(values, covariates, ["region"], ["x"]).withColumn("share", F.round("share", 6))
