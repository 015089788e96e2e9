"""Partitioning, grouping, splitting and keyed sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def let(value: Column, f) -> Column:
    """``f(value)`` with ``value`` computed once, for functions over arrays that use it at each step."""
    return F.get(F.transform(F.array(value), f), 0)


def small(df: DataFrame, most_rows: int = 100_000) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``most_rows`` rows, which is checked; else as it is."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df


def md5_bucket(key: Column, n: int) -> Column:
    """The 128-bit MD5 of a key modulo ``n``, folded 32 bits at a time."""
    digest, out = F.md5(key), F.lit(0).cast("bigint")
    for i in range(4):
        chunk = F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint")
        out = (out * F.lit(1 << 32) + chunk) % n
    return out


def mod_bucket(key: Column, n: int) -> Column:
    """``abs(key) % n`` for a whole number, the MD5 bucket for anything else."""
    number = key.try_cast("bigint")
    return F.coalesce(F.abs(number) % n, md5_bucket(key.cast("string"), n))


def sort_within(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Rows of equal ``keys`` in one partition, each partition sorted by keys and ``order``."""
    return df.repartition(*keys).sortWithinPartitions(*keys, *order)


def keyed_sums(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Sums of ``values`` by ``keys``; partial sums are made before the shuffle."""
    return df.groupBy(*keys).agg(*(F.sum(v).alias(f"sum_{v}") for v in values))


def keyed_concat(df: DataFrame, keys: Sequence[str], value: str, order: str, sep: str = ",") -> DataFrame:
    """Non-null values joined in order, null if there is none. Meant for groups of bounded size."""
    pairs = F.array_sort(F.collect_list(F.when(F.col(value).isNotNull(), F.struct(F.col(order), F.col(value).cast("string").alias("v")))))
    joined = F.array_join(F.transform(pairs, lambda p: p["v"]), sep)
    return df.groupBy(*keys).agg(F.when(F.size(pairs) > 0, joined).alias("joined"))


def union_all(*frames: DataFrame) -> DataFrame:
    """Rows of all inputs by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def multiplex(df: DataFrame, tag: str, tags: Sequence[str]) -> dict[str, DataFrame]:
    """One DataFrame per tag; the sink counterpart is ``write.partitionBy(tag)``."""
    return {t: df.where(F.col(tag) == t) for t in tags}


def counters(df: DataFrame, group: str, conditions: dict[str, Column]) -> DataFrame:
    """Counts of rows that meet each condition, by group, one row per group and counter."""
    counts = df.groupBy(group).agg(*(F.count_if(c).alias(n) for n, c in conditions.items()))
    return counts.unpivot([group], list(conditions), "counter", "amount")


def balanced_splits(samples: DataFrame, key: str, size: str, n_splits: int) -> DataFrame:
    """Cuts of samples laid end to end at multiples of an equal split size: (key, split, start, span).

    The order is by key; there is one row per sample before the cut.
    """
    total = samples.agg(F.sum(size)).first()[0] or 0
    per = max(1, -(-total // n_splits))
    end = F.sum(size).over(Window.orderBy(key))  # samples only, never reads
    placed = samples.where(F.col(size) > 0).select(key, (end - F.col(size)).alias("lo"), end.alias("hi"))
    cut = placed.select("*", F.explode(F.sequence(F.floor(F.col("lo") / per), F.floor((F.col("hi") - 1) / per))).alias("split"))
    lo, hi = F.greatest("lo", F.col("split") * per), F.least("hi", (F.col("split") + 1) * per)
    return cut.select(key, F.col("split").cast("bigint").alias("split"), (lo - F.col("lo")).cast("bigint").alias("start"), (hi - lo).cast("bigint").alias("span"))


def task_ordinal() -> Column:
    """The number of the task that makes a row. It changes with the plan, so it names tasks, never rows."""
    return F.spark_partition_id()


def hash_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """``n`` rows chosen by a hash of ``key``, the same ones however the rows are dealt; each task sends ``n`` at most."""
    return df.orderBy(F.md5(F.col(key).cast("string")), key).limit(n)


def first_match(rows: DataFrame, key: str, lookups: Sequence[tuple[DataFrame, str, str]], name: str) -> DataFrame:
    """``rows`` with ``name``: what the first of the lookups (table, its key, its value) that has ``key`` says, null if none has.

    Of several values for a key in one lookup the least counts.
    """
    out, found = rows, []
    for i, (table, own, value) in enumerate(lookups):
        one = table.where(F.col(own).isNotNull()).groupBy(F.col(own).alias(f"_k{i}")).agg(F.min(value).cast("string").alias(f"_v{i}"))
        out = out.join(one, F.col(key) == F.col(f"_k{i}"), "left")
        found.append(F.col(f"_v{i}"))
    return out.select(*rows.columns, F.coalesce(*found).alias(name))


def packed_files(files: DataFrame, size: str, target: int) -> DataFrame:
    """``files`` with ``pack``: small files laid end to end in order of path and cut at multiples of ``target`` bytes.

    One row per file; the running sum is made inside buckets of a hash and then over the buckets.
    """
    bucket = F.pmod(F.xxhash64("path"), F.lit(1_000))
    inside = Window.partitionBy("_bucket").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    dealt = files.withColumn("_bucket", bucket)
    before = dealt.groupBy("_bucket").agg(F.sum(size).alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    placed = dealt.withColumn("_at", F.coalesce(F.sum(size).over(inside), F.lit(0))).join(F.broadcast(before.drop("_n")), "_bucket")  # 1,000 rows
    return placed.select(*files.columns, F.floor((F.col("_at") + F.col("_before")) / target).alias("pack"))


def distinct_then_fan_out(df: DataFrame, key: str, work) -> DataFrame:
    """Do ``work`` once per distinct ``key`` and join what it gives back to every row."""
    return df.join(work(df.select(key).distinct()), key)


def prior_max(df: DataFrame, keys: Sequence[str], pos: str, value: str, bin_size: int) -> DataFrame:
    """``df`` with ``prior``: the greatest ``value`` of all rows at a lower ``pos`` within ``keys``, null for the first.

    Made inside bins of ``bin_size`` positions and then across a key's bins, like ``prefix_sums``.
    Needs one row per key and position.
    """
    binned = df.withColumn("_bin", F.floor(F.col(pos) / bin_size))
    inside = Window.partitionBy(*keys, "_bin").orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = binned.groupBy(*keys, "_bin").agg(F.max(value).alias("_most"))
    bins = bins.select(*keys, "_bin", F.max("_most").over(before).alias("_before"))
    joined = binned.withColumn("_here", F.max(value).over(inside)).join(bins, [*keys, "_bin"])
    return joined.select(*df.columns, F.greatest("_here", "_before").alias("prior"))


def prefix_sums(df: DataFrame, keys: Sequence[str], pos: str, values: Sequence[str], bin_size: int) -> DataFrame:
    """Running sums of ``values`` by ``pos`` within ``keys``, in two levels.

    Rows are summed inside bins of ``bin_size`` positions and the bins' totals across a key,
    so the largest sort is a bin's rows or a key's bins, never all of a key's rows. Needs one
    row per key and position. Adds ``bin``, ``run_<v>`` and ``carry_<v>`` (the sum before the bin).
    """
    binned = df.withColumn("bin", F.floor(F.col(pos) / bin_size))
    inside = Window.partitionBy(*keys, "bin").orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    totals = binned.groupBy(*keys, "bin").agg(*(F.sum(v).alias(f"_t_{v}") for v in values))
    carry = totals.select(*keys, "bin", *(F.coalesce(F.sum(f"_t_{v}").over(before), F.lit(0)).alias(f"carry_{v}") for v in values))
    running = binned.select("*", *(F.sum(v).over(inside).alias(f"_in_{v}") for v in values))
    joined = running.join(carry, [*keys, "bin"])
    return joined.select(
        *df.columns, "bin", *(f"carry_{v}" for v in values), *((F.col(f"_in_{v}") + F.col(f"carry_{v}")).alias(f"run_{v}") for v in values)
    )
