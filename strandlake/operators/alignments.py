"""Choosing among alignments of a read: best, ties, weighted breaks, counts, joins of reads and results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandlake.functions import align


def draw(key: Column, total: Column) -> Column:
    """A number in [0, total) from the MD5 of a key: the same on every run."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") % total


def tie_candidates(alignments: DataFrame, margin: float = 0, read: str = "qname") -> DataFrame:
    """Alignments whose score is within the margin of their read's best."""
    best = F.max("as_score").over(Window.partitionBy(read))
    return alignments.withColumn("_best", best).where(F.col("as_score") >= F.col("_best") - align.margin_of(F.col("read_length"), margin)).drop("_best")


def break_ties(alignments: DataFrame, read: str = "qname") -> DataFrame:
    """One alignment per read.

    Only those with the fewest junctions count. Without junctions the best-scoring ones are
    equally likely; with them the chance follows ``weight`` (all equal if every weight is 0).
    Rows are laid out by ``alt``, and the draw is a hash of the read's name.
    """
    w = Window.partitionBy(read)
    few = alignments.withColumn("_few", F.min("n_junctions").over(w)).where("n_junctions = _few")
    few = few.withColumn("_best", F.max("as_score").over(w)).where("_few > 0 or as_score = _best")
    raw = F.when(F.col("_few") == 0, F.lit(1).cast("bigint")).otherwise(F.col("weight"))
    weighed = few.withColumn("_w", raw).withColumn("_w", F.when(F.sum("_w").over(w) == 0, F.lit(1).cast("bigint")).otherwise(F.col("_w")))
    upto = F.sum("_w").over(w.orderBy("alt").rowsBetween(Window.unboundedPreceding, 0))
    placed = weighed.withColumn("_hi", upto).withColumn("_total", F.sum("_w").over(w))
    at = draw(F.col(read), F.col("_total"))
    return placed.where((at < F.col("_hi")) & (at >= F.col("_hi") - F.col("_w"))).select(*alignments.columns)


def top_k(alignments: DataFrame, k: int, read: str = "qname") -> DataFrame:
    """The ``k`` best by score, then fewest junctions; ties at the end are kept."""
    w = Window.partitionBy(read).orderBy(F.col("as_score").desc(), F.col("n_junctions"))
    return alignments.withColumn("_rank", F.rank().over(w)).where(F.col("_rank") <= k).drop("_rank")


def second_best(alignments: DataFrame, read: str = "qname") -> DataFrame:
    """Each read's best score and second-best one, null if it has a single alignment."""
    w = Window.partitionBy(read).orderBy(F.col("as_score").desc(), "alt")
    ranked = alignments.withColumn("_r", F.row_number().over(w)).where("_r <= 2")
    return ranked.groupBy(read).agg(F.max(F.when(F.col("_r") == 1, F.col("as_score"))).alias("best"), F.max(F.when(F.col("_r") == 2, F.col("as_score"))).alias("second"))


def with_nh(alignments: DataFrame, read: str = "qname") -> DataFrame:
    """Adds ``nh``, the number of alignments reported for the read."""
    return alignments.withColumn("nh", F.count("*").over(Window.partitionBy(read)))


def read_counts(alignments: DataFrame) -> DataFrame:
    """Primary and unique rows by sample and contig (``*`` for unmapped ones, which count as unique)."""
    unmapped = align.has_flag(F.col("flag"), align.UNMAPPED)
    contig = F.when(unmapped, "*").otherwise(F.col("rname"))
    unique = unmapped | align.is_unique(F.col("as_score"), F.col("xs_score"), F.length("seq"))
    primary = alignments.where(~align.has_flag(F.col("flag"), align.SECONDARY)).withColumn("_contig", contig).withColumn("_unique", unique)
    return primary.groupBy("sample", F.col("_contig").alias("rname")).agg(F.count("*").alias("total"), F.count_if("_unique").alias("unique"))


def count_matrix(counts: DataFrame, samples: DataFrame, contigs: list[str]) -> DataFrame:
    """Samples by contigs, ``total,unique`` in each cell, and the mapped totals; samples without reads get zeros."""
    cells = counts.groupBy("sample").pivot("rname", [*contigs, "*"]).agg(F.first("total").alias("total"), F.first("unique").alias("unique"))
    full = samples.select(F.col("sample_index").alias("sample"), "sample_label").join(cells, "sample", "left").na.fill(0)
    cell = lambda c: F.concat_ws(",", F.col(f"`{c}_total`"), F.col(f"`{c}_unique`"))
    named = {"*": "unmapped"}
    mapped = [sum((F.col(f"`{c}_{k}`") for c in contigs), F.lit(0)) for k in ("total", "unique")]
    return full.select("sample_label", *(cell(c).alias(f"reads_{named.get(c, c)}") for c in [*contigs, "*"]), F.concat_ws(",", *mapped).alias("mapped"))


def best_representatives(reads: DataFrame) -> DataFrame:
    """The copy of each canonical sequence with the best mean quality, the greatest name at a tie."""
    from strandlake.functions.seq import mean_quality

    scored = reads.withColumn("mean_qual", mean_quality(F.col("qual")))
    return scored.groupBy("canon_seq").agg(F.max(F.struct("mean_qual", "qname", "qual")).alias("b")).select("canon_seq", "b.qname", "b.qual", "b.mean_qual")


def multiplicity(reads: DataFrame) -> DataFrame:
    """Copies of each canonical sequence by sample and orientation."""
    return reads.groupBy("canon_seq", "sample", "is_reversed").agg(F.count("*").alias("copies"))


def seed_hits(readlets: DataFrame, kmers: DataFrame, max_hits: int = 30) -> DataFrame:
    """Exact matches of readlet sequences to reference k-mers, none for k-mers with more than ``max_hits``.

    The limit is the aligner's rule for repeats, applied before the join. A reference has many
    more k-mers than the chunks they are cut from let Spark's estimate tell, so neither side is
    broadcast: both are merged by k-mer.
    """
    few = kmers.groupBy("kmer").count().where(F.col("count") <= max_hits).select("kmer")
    rare = kmers.join(few.hint("merge"), "kmer", "left_semi")
    return readlets.join(rare.hint("merge"), "kmer")


def tie_coverage(ties: DataFrame, coverage: DataFrame, keys: list[str]) -> DataFrame:
    """Tied alignments with the summed coverage of their junction, 0 where it has none."""
    total = coverage.groupBy(*keys).agg(F.sum("count").alias("coverage"))
    return ties.join(total, keys, "left").withColumn("coverage", F.coalesce("coverage", F.lit(0).cast("bigint")))
