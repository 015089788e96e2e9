"""Splice-junction and indel evidence: filters, collections, overhangs, sinks' row formats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

JUNCTION = ("rname_strand", "start", "end_pos")


def merge_counts(obs: DataFrame, keys: Sequence[str] = JUNCTION) -> DataFrame:
    """Counts by feature and sample."""
    return obs.groupBy(*keys, "sample").agg(F.sum("count").alias("count"))


def passing(n_samples_col, max_count_col, n_samples: int, fraction: float, threshold: int):
    """In enough samples, or covered well enough in one (a threshold of -1 turns that off)."""
    enough = n_samples_col >= F.round(F.lit(float(n_samples * fraction)))
    return enough if threshold == -1 else enough | (max_count_col >= threshold)


def filter_junctions(obs: DataFrame, n_samples: int, fraction: float = 0.05, threshold: int = 5) -> DataFrame:
    """A row for each sample of each junction that passes; junctions that end before they begin never do.

    A junction has at most a row per sample by the time the window sees it.
    """
    w = Window.partitionBy(*JUNCTION)
    merged = merge_counts(obs.where("end_pos > start")).select("*", F.count("*").over(w).alias("_n"), F.max("count").over(w).alias("_most"))
    return merged.where(passing(F.col("_n"), F.col("_most"), n_samples, fraction, threshold)).select(*JUNCTION, "sample")


def collect_junctions(obs: DataFrame, keys: Sequence[str] = JUNCTION, inclusive_end: bool = True) -> DataFrame:
    """Per feature its samples in ascending order and their counts; groups are bounded by the samples."""
    pairs = F.array_sort(F.collect_list(F.struct("sample", "count")))
    out = merge_counts(obs, keys).groupBy(*keys).agg(pairs.alias("_p")).select(
        *keys, F.col("_p.sample").alias("samples"), F.col("_p.count").alias("counts")
    )
    return out.withColumn("end_pos", F.col("end_pos") - 1) if inclusive_end else out


def overhang_stats(evidence: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sum of counts and greatest left, right and smaller-side overhang."""
    return evidence.groupBy(*keys).agg(
        F.sum("count").alias("count"), F.max("left_disp").alias("max_left"), F.max("right_disp").alias("max_right"),
        F.max(F.least("left_disp", "right_disp")).alias("maximin"),
    )


def aggregate_indels(evidence: DataFrame, n_samples: int, fraction: float = 0.05, threshold: int = 5) -> tuple[DataFrame, DataFrame]:
    """(rows per feature and sample, rows per feature with sample and count lists).

    Insertions and deletions enter the second only if they pass; junctions always do.
    """
    feature = ["type", "rname", "start", "end_pos", "strand_or_seq"]
    per_sample = overhang_stats(evidence, [*feature, "sample"])
    pairs = F.array_sort(F.collect_list(F.struct("sample", "count")))
    across = per_sample.groupBy(*feature).agg(pairs.alias("_p"), F.max("count").alias("_most"))
    across = across.where((F.col("type") == "N") | passing(F.size("_p"), F.col("_most"), n_samples, fraction, threshold))
    return per_sample, across.select(*feature, F.col("_p.sample").alias("samples"), F.col("_p.count").alias("counts"))


def max_extensions(configs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Greatest extensions per configuration; what is available is unknown (null) as soon as one row doesn't know."""
    known = lambda c: F.when(F.count_if(F.col(c).isNull()) == 0, F.max(c)).alias(c)
    return configs.groupBy(*keys).agg(F.max("left_ext").alias("left_ext"), F.max("right_ext").alias("right_ext"), known("left_avail"), known("right_avail"))


def bed_rows(stats: DataFrame) -> DataFrame:
    """Junction rows of a BED file: 0-based, blocks of the overhangs, ids that start anew in each sample.

    ``stats`` has rname, start, end_pos, strand, sample, max_left, max_right, maximin, count.
    """
    number = F.row_number().over(Window.partitionBy("sample").orderBy("rname", "start", "end_pos", "strand"))
    low, high = F.col("start") - 1 - F.col("max_left"), F.col("end_pos") - 1 + F.col("max_right")
    name = F.concat(F.lit("JUNC"), F.lpad(number.cast("string"), 8, "0"), F.lit(";maximin_overhang="), F.col("maximin").cast("string"))
    line = F.concat_ws(
        "\t", "rname", low, high, name, "count", "strand", low, high, F.lit("227,29,118"), F.lit("2"),
        F.concat_ws(",", "max_left", "max_right"), F.concat_ws(",", F.lit("0"), F.col("max_left") + F.col("end_pos") - F.col("start")),
    )
    return stats.select("sample", line.alias("line"))


def tsv_rows(across: DataFrame, n_samples: int) -> DataFrame:
    """Rows of a cross-sample table: the feature, then the count of every sample, 0 where it has none."""
    by_sample = F.map_from_arrays("samples", "counts")
    cells = F.transform(F.sequence(F.lit(0), F.lit(n_samples - 1)), lambda s: F.coalesce(F.try_element_at(by_sample, s), F.lit(0)).cast("string"))
    head = F.concat_ws(";", "type", "rname", "strand_or_seq", "start", F.col("end_pos") - 1)
    return across.select(F.concat_ws("\t", head, F.array_join(cells, "\t")).alias("line"))
