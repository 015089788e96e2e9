"""Accuracy metrics and cross-sample statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """a / b, and 1 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(1.0))


def precision_recall(truth: DataFrame, called: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """True positives, precision, recall and F score of distinct rows, by group.

    One full pass: each side is tagged and counted by key, with no join of the two.
    """
    tagged = truth.select(*keys).distinct().withColumn("_t", F.lit(1)).withColumn("_c", F.lit(0)).unionByName(
        called.select(*keys).distinct().withColumn("_t", F.lit(0)).withColumn("_c", F.lit(1))
    )
    both = tagged.groupBy(*keys).agg(F.max("_t").alias("_t"), F.max("_c").alias("_c"))
    counted = both.groupBy(*by).agg(F.sum(F.col("_t") * F.col("_c")).alias("tp"), F.sum("_t").alias("relevant"), F.sum("_c").alias("retrieved"))
    p, r = ratio(F.col("tp"), F.col("retrieved")), ratio(F.col("tp"), F.col("relevant"))
    return counted.withColumn("precision", p).withColumn("recall", r).withColumn("f_score", F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)))


def unique_to_sample(rows: DataFrame, feature: Sequence[str]) -> DataFrame:
    """Features that only one sample has, with that sample."""
    return rows.groupBy(*feature).agg(F.min("sample").alias("sample"), F.max("sample").alias("_hi")).where("sample = _hi").drop("_hi")


def sample_histogram(rows: DataFrame, feature: Sequence[str]) -> DataFrame:
    """How many features are found in how many samples."""
    return rows.groupBy(*feature).agg(F.count_distinct("sample").alias("n_samples")).groupBy("n_samples").agg(F.count("*").alias("n_features"))


def feature_matrix(rows: DataFrame, feature: Sequence[str], samples: Sequence[int], value: str) -> DataFrame:
    """Features by samples with zeros where there is nothing."""
    wide = rows.groupBy(*feature).pivot("sample", list(samples)).agg(F.sum(value))
    return wide.na.fill(0).select(*feature, *(F.col(f"`{s}`").alias(f"s{s}") for s in samples))


def positional_rates(reads: DataFrame, events: str, length: Column) -> DataFrame:
    """Events per read at each offset from 0, over the reads that reach it; ``events`` is an array of offsets."""
    reach = reads.select(F.explode(F.sequence(F.lit(0), length - 1)).alias("at")).groupBy("at").agg(F.count("*").alias("reads"))
    hits = reads.select(F.explode(events).alias("at")).groupBy("at").agg(F.count("*").alias("hits"))
    return reach.join(hits, "at", "left").select("at", "reads", F.coalesce("hits", F.lit(0)).cast("bigint").alias("hits"), (F.coalesce("hits", F.lit(0)) / F.col("reads")).alias("rate"))


def stratified_sample(rows: DataFrame, stratum: str, key: str, n: int) -> DataFrame:
    """``n`` rows of each stratum by the MD5 of a key: smaller samples lie within larger ones."""
    w = Window.partitionBy(stratum).orderBy(F.md5(F.col(key).cast("string")), key)
    return rows.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def threshold_curve(rows: DataFrame, most: int) -> DataFrame:
    """For thresholds 1..most: relevant, retrieved and both, at exactly and at or above the threshold.

    ``rows`` has a feature's true and retrieved coverage (0 if missing). Counts are made per
    coverage first; the cumulative ones are running sums over at most ``most`` rows.
    """
    capped = lambda c: F.least(F.col(c), F.lit(most)).cast("int")
    relevant = rows.where("true_cov between 1 and %d" % most).groupBy(F.col("true_cov").cast("int").alias("i")).agg(F.count("*").alias("relevant"), F.count_if(F.col("called_cov") > 0).alias("found"))
    retrieved = rows.where("called_cov >= 1").groupBy(capped("called_cov").alias("i")).agg(F.count("*").alias("n"), F.count_if(F.col("true_cov") > 0).alias("right"))
    steps = rows.sparkSession.range(1, most + 1).select(F.col("id").cast("int").alias("i"))
    joined = steps.join(relevant, "i", "left").join(retrieved, "i", "left").na.fill(0)
    up = Window.orderBy(F.col("i").desc()).rowsBetween(Window.unboundedPreceding, 0)  # as many rows as thresholds
    return joined.select("i", "relevant", "found", F.sum("n").over(up).alias("retrieved"), F.sum("right").over(up).alias("right"))


def regression_shares(values: DataFrame, covariates: DataFrame, group: Sequence[str], terms: Sequence[str]) -> DataFrame:
    """Per group, the share of the variance of ``value`` that each covariate explains when they are fitted one after another.

    ``values`` has the group's columns, ``sample`` and ``value``; ``covariates`` a numeric column per
    term and sample. The rest is the row ``residual``. A group has a row per sample.
    """
    import numpy as np
    import pandas as pd

    from strandlake.session import shipped

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        y = rows["value"].to_numpy(float)
        base = np.ones((len(y), 1))
        left = ((y - y.mean()) ** 2).sum()
        total, out = left, []
        for t in terms:
            base = np.column_stack([base, rows[t].to_numpy(float)])
            fit = base @ np.linalg.lstsq(base, y, rcond=None)[0]
            now = ((y - fit) ** 2).sum()
            out.append((t, (left - now) / total if total else 0.0))
            left = now
        out.append(("residual", left / total if total else 0.0))
        return pd.DataFrame([(*(rows[g].iloc[0] for g in group), t, float(s)) for t, s in out], columns=[*group, "term", "share"])

    joined = shipped(values).join(covariates, "sample").select(*group, "sample", "value", *terms)
    schema = ", ".join([*(f"{g} {dict(values.dtypes)[g]}" for g in group), "term string", "share double"])
    return joined.groupBy(*group).applyInPandas(run, schema)


def mate_matches(truth: DataFrame, called: DataFrame, key: str, items: str) -> DataFrame:
    """Matches between the two mates' sets of a pair when it isn't known which is which.

    Each side has one row per ``key`` with ``items``: an array of two arrays. The better of the
    straight and the switched pairing counts; ``relevant`` and ``retrieved`` are the set sizes.
    """
    t, c = truth.select(key, F.col(items).alias("t")), called.select(key, F.col(items).alias("c"))
    both = t.join(c, key, "full")
    part = lambda col, i: F.coalesce(F.array_distinct(F.get(F.col(col), F.lit(i))), F.array())
    shared = lambda i, j: F.size(F.array_intersect(part("t", i), part("c", j)))
    return both.select(
        key, F.greatest(shared(0, 0) + shared(1, 1), shared(0, 1) + shared(1, 0)).alias("matched"),
        (F.size(part("t", 0)) + F.size(part("t", 1))).alias("relevant"), (F.size(part("c", 0)) + F.size(part("c", 1))).alias("retrieved"),
    )
