"""Queries on coverage: diffs, running sums, segments, factors, cross-sample tracks."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandlake.operators import coverage as cv
from strandlake.plans.registry import query
from strandlake.plans.views import sql, view

DIFFS = """
diffs AS (
  SELECT rname, sample, uniq, pos, CAST(sum(diff) AS BIGINT) AS diff FROM (
    SELECT rname, sample, uniq, pos, 1 AS diff FROM v_intervals UNION ALL
    SELECT rname, sample, uniq, end_pos AS pos, -1 AS diff FROM v_intervals) GROUP BY ALL)"""
COVERAGE = DIFFS + """,
cov AS (
  SELECT rname, sample, pos, CAST(sum(c) OVER w AS BIGINT) AS cov, CAST(sum(u) OVER w AS BIGINT) AS ucov FROM (
    SELECT rname, sample, pos, sum(diff) AS c, sum(CASE WHEN uniq THEN diff ELSE 0 END) AS u FROM diffs GROUP BY ALL)
  WINDOW w AS (PARTITION BY rname, sample ORDER BY pos ROWS UNBOUNDED PRECEDING))"""


def runs_sql(value: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT rname, sample, prev - 1 AS start, pos - 1 AS end_pos, before AS value FROM (
    SELECT rname, sample, pos, lag(v, 1, 0) OVER w AS before, lag(pos, 1, 1) OVER w AS prev FROM (
      SELECT rname, sample, pos, {value} AS v, lag({value}, 1, 0) OVER (PARTITION BY rname, sample ORDER BY pos) AS o FROM cov
      UNION ALL SELECT rname, sample, length + 1, NULL, 0 FROM (SELECT DISTINCT rname, sample FROM cov) JOIN v_contigs USING (rname))
    WHERE v IS DISTINCT FROM o WINDOW w AS (PARTITION BY rname, sample ORDER BY pos))
  WHERE pos > prev)"""


def _diffs(spark, sf):
    return cv.collapse(cv.exon_diffs(view(spark, sf, "v_intervals")))


def _runs(spark, sf, value="cov"):
    return cv.segments(cv.binned_coverage(_diffs(spark, sf)), view(spark, sf, "v_contigs"), value)


@query("exon_diff_explode", sql("SELECT rname, sample, uniq, pos, CAST(1 AS BIGINT) AS diff FROM v_intervals UNION ALL SELECT rname, sample, uniq, end_pos, CAST(-1 AS BIGINT) FROM v_intervals", "v_intervals"))
def exon_diff_explode(spark, sf):
    return cv.exon_diffs(view(spark, sf, "v_intervals"))


@query("exon_diff_collapse", sql(f"WITH {DIFFS} SELECT * FROM diffs", "v_intervals"))
def exon_diff_collapse(spark, sf):
    return _diffs(spark, sf)


@query("coverage_running_sum", sql(f"WITH {COVERAGE} SELECT * FROM cov", "v_intervals"))
def coverage_running_sum(spark, sf):
    return cv.running_coverage(_diffs(spark, sf))


@query("coverage_binned", sql(f"WITH {COVERAGE} SELECT * FROM cov", "v_intervals"))
def coverage_binned(spark, sf):
    return cv.binned_coverage(_diffs(spark, sf)).select("rname", "sample", "pos", "cov", "ucov")


@query("bedgraph_segments", sql(f"WITH {COVERAGE}, {runs_sql('cov', 'runs')} SELECT * FROM runs", "v_intervals", "v_contigs"))
def bedgraph_segments(spark, sf):
    return _runs(spark, sf)


@query("bedgraph_unique", sql(f"WITH {COVERAGE}, {runs_sql('ucov', 'runs')} SELECT * FROM runs", "v_intervals", "v_contigs"))
def bedgraph_unique(spark, sf):
    return _runs(spark, sf, "ucov")


HIST = "hist AS (SELECT sample, value, CAST(sum(end_pos - start) AS BIGINT) AS bases FROM runs WHERE value > 0 GROUP BY ALL)"


@query("coverage_histogram", sql(f"WITH {COVERAGE}, {runs_sql('cov', 'runs')}, {HIST} SELECT * FROM hist", "v_intervals", "v_contigs"))
def coverage_histogram(spark, sf):
    return cv.histogram(_runs(spark, sf))


@query("upper_quartile_factor", sql(f"""
WITH {COVERAGE}, {runs_sql('cov', 'runs')}, {HIST}
SELECT sample, max(value) AS factor FROM (
  SELECT *, sum(bases) OVER (PARTITION BY sample ORDER BY value DESC) AS above, sum(bases) OVER (PARTITION BY sample) AS total FROM hist)
WHERE above > total * 0.25 GROUP BY sample""", "v_intervals", "v_contigs"))
def upper_quartile_factor(spark, sf):
    return cv.percentile_of(cv.histogram(_runs(spark, sf)))


@query("coverage_auc", sql(f"WITH {COVERAGE}, {runs_sql('cov', 'runs')} SELECT sample, CAST(sum(value * (end_pos - start)) AS BIGINT) AS auc FROM runs GROUP BY sample", "v_intervals", "v_contigs"))
def coverage_auc(spark, sf):
    return cv.auc(_runs(spark, sf))


@query("norm_factors", sql(f"""
WITH {COVERAGE}, {runs_sql('cov', 'r1')}, {runs_sql('ucov', 'r2')},
h AS (SELECT 'a' AS t, sample, value, sum(end_pos - start) AS bases FROM r1 WHERE value > 0 GROUP BY ALL
      UNION ALL SELECT 'u', sample, value, sum(end_pos - start) FROM r2 WHERE value > 0 GROUP BY ALL),
s AS (SELECT *, sum(bases) OVER (PARTITION BY t, sample ORDER BY value DESC) AS above, sum(bases) OVER (PARTITION BY t, sample) AS total FROM h)
SELECT sample, max(value) FILTER (WHERE t = 'a' AND above > total * 0.25) AS factor, max(value) FILTER (WHERE t = 'u' AND above > total * 0.25) AS unique_factor,
       CAST(sum(value * bases) FILTER (WHERE t = 'a') AS BIGINT) AS auc, CAST(sum(value * bases) FILTER (WHERE t = 'u') AS BIGINT) AS unique_auc
FROM s GROUP BY sample""", "v_intervals", "v_contigs"))
def norm_factors(spark, sf):
    return cv.norm_factors(_diffs(spark, sf), view(spark, sf, "v_contigs"))


WEIGHTS = "w AS (SELECT sample, 40e6 / count(*) AS weight FROM v_intervals GROUP BY sample)"


def _mapped(spark, sf):
    return view(spark, sf, "v_intervals").groupBy("sample").agg(F.count("*").alias("mapped"))


@query("mean_coverage", sql(f"""
WITH {COVERAGE}, {WEIGHTS},
p AS (SELECT rname, pos, sum(diff * weight) AS d FROM diffs JOIN w USING (sample) GROUP BY ALL)
SELECT rname, pos, round(sum(d) OVER (PARTITION BY rname ORDER BY pos) / (SELECT count(*) FROM w) + 1e-7, 3) AS mean FROM p""", "v_intervals"))
def mean_coverage(spark, sf):
    track = cv.mean_track(_diffs(spark, sf), _mapped(spark, sf))
    return track.select("rname", "pos", F.round(F.col("mean") + 1e-7, 3).alias("mean"))


@query("median_coverage", sql(f"""
WITH {COVERAGE}, {WEIGHTS},
grid AS (SELECT DISTINCT rname, pos, w.sample FROM cov, w),
filled AS (SELECT g.rname, g.pos, g.sample, coalesce(last_value(c.cov IGNORE NULLS) OVER (PARTITION BY g.rname, g.sample ORDER BY g.pos ROWS UNBOUNDED PRECEDING), 0) AS cov
           FROM grid g LEFT JOIN cov c ON g.rname = c.rname AND g.pos = c.pos AND g.sample = c.sample)
SELECT rname, pos, round(median(cov * weight), 6) AS median FROM filled JOIN w USING (sample) GROUP BY rname, pos""", "v_intervals"))
def median_coverage(spark, sf):
    cov = cv.binned_coverage(_diffs(spark, sf))
    return cv.median_track(cov, _mapped(spark, sf)).select("rname", "pos", F.round("median", 6).alias("median"))


@query("nonref_mean", sql(f"""
WITH {WEIGHTS},
d AS (SELECT rname, base, sample, pos, sum(diff) AS diff FROM (
  SELECT rname, base, sample, pos, 1 AS diff FROM v_intervals WHERE NOT is_ref AND base IN ('A','C','G','T') UNION ALL
  SELECT rname, base, sample, end_pos, -1 FROM v_intervals WHERE NOT is_ref AND base IN ('A','C','G','T')) GROUP BY ALL),
p AS (SELECT rname, base, pos, sum(diff * weight) AS d FROM d JOIN w USING (sample) GROUP BY ALL)
SELECT rname, base, pos, round(sum(d) OVER (PARTITION BY rname, base ORDER BY pos) / (SELECT count(*) FROM w) + 1e-7, 3) AS mean FROM p""", "v_intervals"))
def nonref_mean(spark, sf):
    mism = view(spark, sf, "v_intervals").where("not is_ref and base in ('A', 'C', 'G', 'T')")
    diffs = cv.exon_diffs(mism, ("rname", "base", "sample", "uniq"))
    track = cv.mean_track(diffs, _mapped(spark, sf), ("rname", "base"))
    return track.select("rname", "base", "pos", F.round(F.col("mean") + 1e-7, 3).alias("mean"))


@query("nonref_median", sql(f"""
WITH {WEIGHTS},
d AS (SELECT rname, base, sample, pos, sum(diff) AS diff FROM (
  SELECT rname, base, sample, pos, 1 AS diff FROM v_intervals WHERE NOT is_ref AND base IN ('A','C','G','T') UNION ALL
  SELECT rname, base, sample, end_pos, -1 FROM v_intervals WHERE NOT is_ref AND base IN ('A','C','G','T')) GROUP BY ALL),
cov AS (SELECT rname, base, sample, pos, sum(diff) OVER (PARTITION BY rname, base, sample ORDER BY pos) AS cov FROM d),
grid AS (SELECT DISTINCT rname, base, pos, w.sample FROM cov, w),
filled AS (SELECT g.rname, g.base, g.pos, g.sample, coalesce(last_value(c.cov IGNORE NULLS) OVER (PARTITION BY g.rname, g.base, g.sample ORDER BY g.pos ROWS UNBOUNDED PRECEDING), 0) AS cov
           FROM grid g LEFT JOIN cov c ON g.rname = c.rname AND g.base = c.base AND g.pos = c.pos AND g.sample = c.sample)
SELECT rname, base, pos, round(median(cov * weight), 6) AS median FROM filled JOIN w USING (sample) GROUP BY rname, base, pos""", "v_intervals"))
def nonref_median(spark, sf):
    mism = view(spark, sf, "v_intervals").where("not is_ref and base in ('A', 'C', 'G', 'T')")
    keys = ("rname", "base", "sample")
    cov = cv.binned_coverage(cv.exon_diffs(mism, (*keys, "uniq")), keys)
    return cv.median_track(cov, _mapped(spark, sf), keys=("rname", "base")).select("rname", "base", "pos", F.round("median", 6).alias("median"))


@query("interval_bins", sql("""
SELECT rname, sample, pos, end_pos, bin, bin * 5000 + 1 AS bin_start, (bin + 1) * 5000 + 1 AS bin_end FROM (
  SELECT rname, sample, pos, end_pos, unnest(generate_series(CAST(floor((pos - 2) / 5000.0) AS BIGINT), CAST(floor((end_pos - 2) / 5000.0) AS BIGINT))) AS bin FROM v_intervals)""", "v_intervals"))
def interval_bins(spark, sf):
    return cv.interval_bins(view(spark, sf, "v_intervals").select("rname", "sample", "pos", "end_pos"), "pos", "end_pos")


@query("expressed_regions", sql(f"""
WITH {COVERAGE}, {runs_sql('cov', 'runs')},
h AS (SELECT *, CASE WHEN start = coalesce(lag(end_pos) OVER w, -1) THEN 0 ELSE 1 END AS fresh FROM runs WHERE value >= 3 WINDOW w AS (PARTITION BY rname, sample ORDER BY start)),
r AS (SELECT *, sum(fresh) OVER (PARTITION BY rname, sample ORDER BY start) AS region FROM h),
g AS (SELECT rname, sample, min(start) AS start, max(end_pos) AS end_pos, sum(value * (end_pos - start)) * 1.0 / sum(end_pos - start) AS mean FROM r GROUP BY rname, sample, region),
f AS (SELECT *, CASE WHEN start - coalesce(lag(end_pos) OVER (PARTITION BY rname, sample ORDER BY start), -1099511627776) > 30 THEN 1 ELSE 0 END AS far FROM g)
SELECT rname, sample, start, end_pos, round(mean, 8) AS mean, CAST(sum(far) OVER (PARTITION BY rname, sample ORDER BY start) AS BIGINT) AS cluster FROM f""", "v_intervals", "v_contigs"))
def expressed_regions(spark, sf):
    return cv.expressed_regions(_runs(spark, sf), 3, 30, cv.KEYS).withColumn("mean", F.round("mean", 8))
