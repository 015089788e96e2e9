"""Coverage from interval ends: difference arrays, running sums, segments, factors, cross-sample tracks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandlake.operators.dataflow import prefix_sums, prior_max, small
from strandlake.session import written

BIN = 5000
KEYS = ("rname", "sample")


def interval_bins(df: DataFrame, start: str, end: str, bin_size: int = BIN) -> DataFrame:
    """One row per bin that [start, end) reaches, with the bin's own bounds; bin b begins at b * size + 1."""
    low, high = F.floor((F.col(start) - 2) / bin_size), F.floor((F.col(end) - 2) / bin_size)
    binned = df.withColumn("bin", F.explode(F.sequence(low, high)))
    return binned.withColumn("bin_start", F.col("bin") * bin_size + 1).withColumn("bin_end", (F.col("bin") + 1) * bin_size + 1)


def exon_diffs(intervals: DataFrame, keep: Sequence[str] = ("rname", "sample", "uniq"), weight: Column | None = None) -> DataFrame:
    """Two rows per interval [pos, end_pos): plus its weight at the start, minus it at the end."""
    w = F.lit(1).cast("bigint") if weight is None else weight
    ends = F.array(F.struct(F.col("pos").alias("pos"), w.alias("diff")), F.struct(F.col("end_pos").alias("pos"), (-w).alias("diff")))
    return intervals.select(*keep, F.explode(ends).alias("d")).select(*keep, "d.pos", "d.diff")


def collapse(diffs: DataFrame, keys: Sequence[str] = ("rname", "sample", "uniq")) -> DataFrame:
    """Diffs of equal key and position as one; summed in part before the shuffle."""
    return diffs.groupBy(*keys, "pos").agg(F.sum("diff").alias("diff"))


def _by_position(diffs: DataFrame, keys: Sequence[str]) -> DataFrame:
    return diffs.groupBy(*keys, "pos").agg(F.sum("diff").alias("cov"), F.sum(F.when(F.col("uniq"), F.col("diff")).otherwise(0)).alias("ucov"))


def running_coverage(diffs: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Coverage and unique coverage from each position on, by one window per key. For short contigs."""
    w = Window.partitionBy(*keys).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return _by_position(diffs, keys).select(*keys, "pos", F.sum("cov").over(w).alias("cov"), F.sum("ucov").over(w).alias("ucov"))


def binned_coverage(diffs: DataFrame, keys: Sequence[str] = KEYS, bin_size: int = BIN) -> DataFrame:
    """The same as ``running_coverage`` in two levels; also gives each row's bin and the values carried into it."""
    sums = prefix_sums(_by_position(diffs, keys), keys, "pos", ["cov", "ucov"], bin_size)
    return sums.select(*keys, "pos", "bin", "carry_cov", "carry_ucov", F.col("run_cov").alias("cov"), F.col("run_ucov").alias("ucov"))


def segments(coverage: DataFrame, lengths: DataFrame, value: str = "cov", keys: Sequence[str] = KEYS) -> DataFrame:
    """Runs of equal value as 0-based [start, end_pos): bedGraph rows, runs of zero and the contig's tail too.

    ``coverage`` comes from ``binned_coverage``; a bin's first row compares with the value
    carried in, and its last run ends at the next bin's first change.
    """
    inside = Window.partitionBy(*keys, "bin").orderBy("pos")
    changes = coverage.withColumn("_before", F.coalesce(F.lag(value).over(inside), F.col(f"carry_{value}"))).where(F.col(value) != F.col("_before"))
    changes = changes.select(*keys, "bin", "pos", value, F.lead("pos").over(inside).alias("_next"))
    firsts = changes.groupBy(*keys, "bin").agg(F.min("pos").alias("_first"))
    across = Window.partitionBy(*keys).orderBy("bin")
    firsts = firsts.select(*keys, "bin", F.lead("_first").over(across).alias("_next_bin"), F.min("_first").over(Window.partitionBy(*keys)).alias("_lowest"), "_first")
    whole = changes.join(firsts, [*keys, "bin"]).join(lengths.select("rname", "length"), "rname")
    end = F.coalesce("_next", "_next_bin", F.col("length") + 1) - 1
    runs = whole.select(*keys, (F.col("pos") - 1).alias("start"), end.alias("end_pos"), F.col(value).alias("value"))
    heads = firsts.where(F.col("_first") == F.col("_lowest")).select(*keys, F.lit(0).cast("bigint").alias("start"), (F.col("_lowest") - 1).alias("end_pos"), F.lit(0).cast("bigint").alias("value"))
    return runs.unionByName(heads).where("end_pos > start")


def histogram(runs: DataFrame, keys: Sequence[str] = ("sample",)) -> DataFrame:
    """Bases at each value above 0."""
    return runs.where("value > 0").groupBy(*keys, "value").agg(F.sum(F.col("end_pos") - F.col("start")).alias("bases"))


def percentile_of(hist: DataFrame, p: float = 0.75, keys: Sequence[str] = ("sample",)) -> DataFrame:
    """The largest value with more than (1 - p) of the bases at it or above; no row for a key without bases."""
    down = Window.partitionBy(*keys).orderBy(F.col("value").desc()).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    ranked = hist.select(*keys, "value", F.sum("bases").over(down).alias("_above"), F.sum("bases").over(whole).alias("_total"))
    return ranked.where(F.col("_above") > F.col("_total") * F.lit(1 - p)).groupBy(*keys).agg(F.max("value").alias("factor"))


def auc(runs: DataFrame, keys: Sequence[str] = ("sample",)) -> DataFrame:
    """Covered bases: value times length."""
    return runs.groupBy(*keys).agg(F.sum(F.col("value") * (F.col("end_pos") - F.col("start"))).alias("auc"))


def norm_factors(diffs: DataFrame, lengths: DataFrame, p: float = 0.75, bin_size: int = BIN) -> DataFrame:
    """Per sample the percentile factor and the covered bases, of all and of unique coverage."""
    cov = binned_coverage(diffs, KEYS, bin_size)
    parts = []
    for value, prefix in (("cov", ""), ("ucov", "unique_")):
        runs = segments(cov, lengths, value)
        hist = histogram(runs)
        total = hist.groupBy("sample").agg(F.sum(F.col("value") * F.col("bases")).alias(f"{prefix}auc"))
        parts.append(total.join(percentile_of(hist, p).withColumnRenamed("factor", f"{prefix}factor"), "sample", "left"))
    out = diffs.select("sample").distinct()
    for part in parts:
        out = out.join(part, "sample", "left")
    return out.select("sample", "factor", "unique_factor", F.coalesce("auc", F.lit(0)).alias("auc"), F.coalesce("unique_auc", F.lit(0)).alias("unique_auc"))


def weights(mapped: DataFrame, library_size: float = 40.0) -> DataFrame:
    """``sample, weight``: library size in millions over mapped reads; samples without any are left out."""
    return mapped.where("mapped > 0").select("sample", (F.lit(library_size * 1e6) / F.col("mapped")).alias("weight"))


def mean_track(diffs: DataFrame, mapped: DataFrame, keys: Sequence[str] = ("rname",), library_size: float = 40.0, bin_size: int = BIN) -> DataFrame:
    """Mean normalized coverage over all samples with mapped reads, at every position where some sample changes.

    The mean is linear, so weighted diffs are summed over samples first and no row per
    position and sample is made. Integer sums per sample are weighted last.
    """
    w = weights(mapped, library_size)
    n = w.count()
    if not n:
        return diffs.select(*keys, "pos", F.lit(0.0).alias("mean")).where(F.lit(False))
    per_sample = diffs.groupBy(*keys, "sample", "pos").agg(F.sum("diff").alias("diff"))
    at = per_sample.join(small(w), "sample").groupBy(*keys, "pos").agg(F.sum(F.col("diff") * F.col("weight")).alias("wdiff"))
    return prefix_sums(at, keys, "pos", ["wdiff"], bin_size).select(*keys, "pos", (F.col("run_wdiff") / n).alias("mean"))


def median_track(coverage: DataFrame, mapped: DataFrame, library_size: float = 40.0, keys: Sequence[str] = ("rname",), bin_size: int = BIN) -> DataFrame:
    """Median normalized coverage over samples with mapped reads, at every position where some sample changes.

    A median isn't linear: each position gets a row for each sample, whose value is carried on
    from its last change, inside bins of positions, and into a bin from the bins before it.
    """
    w = weights(mapped, library_size)
    samples = F.array(*(F.lit(r["sample"]) for r in w.select("sample").orderBy("sample").collect()))  # the samples' dimension
    own = coverage.select(*keys, "pos", "sample", "cov").withColumn("bin", F.floor(F.col("pos") / bin_size))
    grid = own.select(*keys, "bin", "pos").distinct().select("*", F.explode(samples).alias("sample"))
    known = grid.join(own, [*keys, "bin", "pos", "sample"], "left")
    on = Window.partitionBy(*keys, "sample", "bin").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    ends = own.groupBy(*keys, "sample", "bin").agg(F.max_by("cov", "pos").alias("_end"))
    bins = own.select(*keys, "bin").distinct().select("*", F.explode(samples).alias("sample")).join(ends, [*keys, "sample", "bin"], "left")
    before = Window.partitionBy(*keys, "sample").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    carried = bins.select(*keys, "sample", "bin", F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    filled = known.withColumn("_here", F.last("cov", ignorenulls=True).over(on)).join(carried, [*keys, "sample", "bin"])
    filled = filled.select(*keys, "pos", "sample", F.coalesce("_here", "_carried", F.lit(0)).alias("cov"))
    return filled.join(small(w), "sample").groupBy(*keys, "pos").agg(F.median(F.col("cov") * F.col("weight")).alias("median"))


def expressed_regions(runs: DataFrame, cutoff: float, max_gap: int = 3000, keys: Sequence[str] = ("rname",), bin_size: int = BIN) -> DataFrame:
    """Touching runs at ``cutoff`` or above as regions, and regions no more than ``max_gap`` apart as clusters.

    Runs of a key don't overlap, so the end before a run is the greatest among all before.
    Ends and running numbers are made in two levels, as elsewhere; runs and regions are written
    to the scratch folder, as each level reads them anew.
    """
    high = prior_max(written(runs.where(F.col("value") >= cutoff), "runs"), keys, "start", "end_pos", bin_size)
    marked = prefix_sums(high.withColumn("_new", (F.col("start") != F.coalesce("prior", F.lit(-1))).cast("int")), keys, "start", ["_new"], bin_size)
    bases = F.col("end_pos") - F.col("start")
    regions = marked.groupBy(*keys, F.col("run__new").alias("_region")).agg(F.min("start").alias("start"), F.max("end_pos").alias("end_pos"), (F.sum(F.col("value") * bases) / F.sum(bases)).alias("mean"))
    apart = prior_max(written(regions, "regions"), keys, "start", "end_pos", bin_size)
    apart = apart.withColumn("_far", (F.col("start") - F.coalesce("prior", F.lit(-(1 << 40))) > max_gap).cast("int"))
    return prefix_sums(apart, keys, "start", ["_far"], bin_size).select(*keys, "start", "end_pos", "mean", F.col("run__far").alias("cluster"))
