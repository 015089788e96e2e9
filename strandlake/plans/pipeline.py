"""From alignments to deliverables: a lazy graph of DataFrames of which only what is asked for runs."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.functions import align
from strandlake.operators import alignments as al
from strandlake.operators import coverage as cv
from strandlake.operators import junctions as jn
from strandlake.session import clear_scratch


@dataclass
class Parameters:
    """Defaults of the command line."""

    bin_size: int = 5000
    library_size: float = 40.0
    percentile: float = 0.75
    tie_margin: float = 0.0
    k: int = 1
    drop_deletions: bool = False
    junction_fraction: float = 0.05
    junction_threshold: int = 5
    indel_fraction: float = 0.05
    indel_threshold: int = 5


@dataclass
class Cohort:
    """Alignments of many samples and what can be derived from them. Each method returns a DataFrame."""

    alignments: DataFrame
    contigs: DataFrame
    samples: DataFrame
    parameters: Parameters = field(default_factory=Parameters)
    _primary: DataFrame | None = None

    def keep(self) -> Cohort:
        """Keep the chosen alignments in executors' memory and disk, where several deliverables are wanted."""
        if self._primary is None:
            self._primary = self.primary().persist(StorageLevel.MEMORY_AND_DISK)
        return self

    def release(self) -> None:
        if self._primary is not None:
            self._primary.unpersist()
            self._primary = None

    def primary(self) -> DataFrame:
        """One alignment per read and sample: the best by score, ties broken by junction coverage."""
        if self._primary is not None:
            return self._primary
        flagged = self.alignments.where(~align.has_flag(F.col("flag"), align.UNMAPPED))
        scored = flagged.withColumn("n_junctions", align.n_junctions(F.col("cigar"))).withColumn("read_length", F.length("seq"))
        scored = scored.withColumn("read", F.concat_ws("\u001f", F.col("sample").cast("string"), "qname")).withColumn("alt", F.xxhash64("rname", "pos", "cigar"))
        tied = al.tie_candidates(scored, self.parameters.tie_margin, "read")
        ops = align.placed_ops(F.col("cigar"), F.col("pos"))
        support = self._spans(scored, align.junctions(ops, F.length("seq"))).groupBy("rname", "start", "end_pos", "sample").agg(F.count("*").alias("count"))
        crossing = self._spans(tied, align.junctions(ops, F.length("seq")), ["read", "alt"])
        weight = crossing.join(support, ["rname", "start", "end_pos", "sample"], "left").groupBy("read", "alt").agg(F.min(F.coalesce("count", F.lit(0))).alias("weight"))
        weighed = tied.join(weight, ["read", "alt"], "left").withColumn("weight", F.coalesce("weight", F.lit(0).cast("bigint")))
        return al.break_ties(weighed, "read")

    @staticmethod
    def _spans(rows: DataFrame, spans, keep: list[str] | None = None) -> DataFrame:
        kept = ["rname", "sample", *(keep or [])]
        return rows.select(*kept, F.explode(spans).alias("x")).select(*kept, "x.*")

    def diffs(self) -> DataFrame:
        primary = self.primary()
        unique = align.is_unique(F.col("as_score"), F.col("xs_score"), F.length("seq"), self.parameters.tie_margin)
        ops = align.placed_ops(F.col("cigar"), F.col("pos"))
        exons = primary.select("rname", "sample", unique.alias("uniq"), F.explode(align.exons(ops, self.parameters.drop_deletions)).alias("x"))
        return cv.collapse(cv.exon_diffs(exons.select("rname", "sample", "uniq", F.col("x.start").alias("pos"), "x.end_pos")))

    def mismatch_diffs(self) -> DataFrame:
        """Diffs of mismatching bases, with the base as one more key; N doesn't count."""
        ops = align.placed_ops(F.col("cigar"), F.col("pos"))
        unique = align.is_unique(F.col("as_score"), F.col("xs_score"), F.length("seq"), self.parameters.tie_margin)
        rows = self.primary().select("rname", "sample", unique.alias("uniq"), F.explode(align.mismatches(ops, F.col("md"), F.col("seq"))).alias("x"))
        spans = rows.where("x.base in ('A', 'C', 'G', 'T')").select("rname", "sample", "uniq", "x.base", "x.pos", (F.col("x.pos") + 1).alias("end_pos"))
        keys = ("rname", "sample", "uniq", "base")
        return cv.collapse(cv.exon_diffs(spans, keys), keys)

    def coverage(self) -> DataFrame:
        return cv.binned_coverage(self.diffs(), cv.KEYS, self.parameters.bin_size)

    def bedgraph(self, unique: bool = False) -> DataFrame:
        return cv.segments(self.coverage(), self.contigs, "ucov" if unique else "cov")

    def normalization(self) -> DataFrame:
        return cv.norm_factors(self.diffs(), self.contigs, self.parameters.percentile, self.parameters.bin_size)

    def mapped(self) -> DataFrame:
        return self.counts().where("rname <> '*'").groupBy("sample").agg(F.sum("total").alias("mapped"))

    def mean(self) -> DataFrame:
        return cv.mean_track(self.diffs(), self.mapped(), ("rname",), self.parameters.library_size, self.parameters.bin_size)

    def median(self) -> DataFrame:
        return cv.median_track(self.coverage(), self.mapped(), self.parameters.library_size)

    def nonref_mean(self) -> DataFrame:
        return cv.mean_track(self.mismatch_diffs(), self.mapped(), ("rname", "base"), self.parameters.library_size, self.parameters.bin_size)

    def nonref_median(self) -> DataFrame:
        cov = cv.binned_coverage(self.mismatch_diffs(), ("rname", "base", "sample"), self.parameters.bin_size)
        return cv.median_track(cov, self.mapped(), self.parameters.library_size, ("rname", "base"), self.parameters.bin_size)

    def counts(self) -> DataFrame:
        return al.read_counts(self.alignments)

    def evidence(self) -> DataFrame:
        """Junctions and indels of the primary alignments, one row per occurrence."""
        ops = align.placed_ops(F.col("cigar"), F.col("pos"))
        primary = self.primary().withColumn("_ops", ops)
        strand = F.lit(".") if "strand" not in primary.columns else F.col("strand")
        base = ["rname", "sample"]
        n = primary.select(*base, strand.alias("s"), F.explode(align.junctions(F.col("_ops"), F.length("seq"))).alias("x")).select(
            F.lit("N").alias("type"), "rname", "x.start", "x.end_pos", F.col("s").alias("strand_or_seq"), "sample", F.col("x.left").alias("left_disp"), F.col("x.right").alias("right_disp")
        )
        none = F.lit(None).cast("int")
        i = primary.select(*base, F.explode(align.insertions(F.col("_ops"), F.col("seq"))).alias("x")).select(
            F.lit("I").alias("type"), "rname", F.col("x.pos").alias("start"), F.col("x.pos").alias("end_pos"), F.col("x.seq").alias("strand_or_seq"), "sample", none.alias("left_disp"), none.alias("right_disp")
        )
        d = primary.select(*base, F.explode(align.deletions(F.col("_ops"), F.col("md"))).alias("x")).select(
            F.lit("D").alias("type"), "rname", F.col("x.pos").alias("start"), (F.col("x.pos") + F.length("x.seq")).alias("end_pos"), F.col("x.seq").alias("strand_or_seq"), "sample", none.alias("left_disp"), none.alias("right_disp")
        )
        return n.unionByName(i).unionByName(d).withColumn("count", F.lit(1).cast("bigint"))

    def indels(self) -> tuple[DataFrame, DataFrame]:
        return jn.aggregate_indels(self.evidence(), self.samples.count(), self.parameters.indel_fraction, self.parameters.indel_threshold)

    def bed(self) -> DataFrame:
        per_sample, _ = self.indels()
        return jn.bed_rows(per_sample.where("type = 'N'").withColumnRenamed("strand_or_seq", "strand"))

    def tables(self) -> DataFrame:
        _, across = self.indels()
        return jn.tsv_rows(across, self.samples.count())

    def deliverable(self, name: str) -> DataFrame:
        """``bw``, ``bw_unique``, ``bed``, ``tsv``, ``norm``, ``mean``, ``median``, ``nonref``, ``nonref_median`` or ``counts``; nothing else is computed."""
        makers = {
            "bw": self.bedgraph, "bw_unique": lambda: self.bedgraph(True), "bed": self.bed, "tsv": self.tables, "norm": self.normalization,
            "mean": self.mean, "median": self.median, "nonref": self.nonref_mean, "nonref_median": self.nonref_median, "counts": self.counts,
        }
        return makers[name]()

    def explain(self, *names: str) -> dict[str, str]:
        """The physical plan of each deliverable, without running it; what is only planned by running part of it is still run."""
        out = {}
        for name in names:
            df = self.deliverable(name)
            out[name] = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        return out

    def write(self, folder: str, *names: str, resume: bool = True, clear: bool = False) -> dict[str, DataFrame]:
        """Deliverables as Parquet below ``folder``, read back.

        With ``resume`` those that a run before has ended are not made again: a table counts as
        ended when its commit mark is there. ``clear`` deletes the intermediate tables at the end.
        """
        spark = self.alignments.sparkSession
        out = {}
        for name in names:
            path = f"{folder}/{name}"
            if not (resume and _exists(spark, f"{path}/_SUCCESS")):
                self.deliverable(name).write.mode("overwrite").parquet(path)
            out[name] = spark.read.parquet(path)
        if clear:
            clear_scratch(spark)
        return out


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    found, system = _path(spark, path)
    return system.exists(found)


def copied(spark: SparkSession, source: str, target: str) -> list[str]:
    """Copy a folder from one file system to another after a run; gives the names in the copy, sorted."""
    (a, from_system), (b, to_system) = _path(spark, source), _path(spark, target)
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(from_system, a, to_system, b, False, True, spark._jsc.hadoopConfiguration())
    return sorted(x.getPath().getName() for x in to_system.listStatus(b))
