"""Sinks. They convert to the coordinates of their formats and write with Spark's committers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_bedgraph(runs: DataFrame, path: str) -> None:
    """Runs of coverage as bedGraph lines, one folder per sample, sorted by contig and start in each file."""
    ordered = runs.repartition("sample", "rname").sortWithinPartitions("sample", "rname", "start")
    ordered.select("sample", F.concat_ws("\t", "rname", "start", "end_pos", "value").alias("line")).write.partitionBy("sample").option("compression", "gzip").text(path)


def write_bed(lines: DataFrame, path: str) -> None:
    """BED lines (``sample``, ``line``), one folder per sample."""
    lines.select("sample", "line").write.partitionBy("sample").text(path)


def write_tsv(df: DataFrame, path: str) -> None:
    """Columns as gzipped tab-separated values with a header."""
    df.write.option("sep", "\t").option("header", True).option("compression", "gzip").csv(path)


def sam_lines(alignments: DataFrame) -> DataFrame:
    """Alignments as SAM lines: XS is renamed to ZS, names are cut to 254 characters, mapping quality is 255."""
    tag = lambda name, col: F.when(F.col(col).isNotNull(), F.concat(F.lit(name), F.col(col).cast("string")))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("*"))
    line = F.concat_ws(
        "\t", F.substring("qname", 1, 254), "flag", "rname", "pos", F.lit("255"), text("cigar"), text("rnext"), F.coalesce("pnext", F.lit(0)),
        F.coalesce("tlen", F.lit(0)), text("seq"), text("qual"), tag("AS:i:", "as_score"), tag("ZS:i:", "xs_score"), tag("NM:i:", "nm"), tag("MD:Z:", "md"),
    )
    return alignments.select("sample", "rname", "pos", line.alias("line"))


def sam_header(contigs: DataFrame) -> str:
    """Header lines; contigs by descending length."""
    rows = contigs.orderBy("rank_by_len").collect()  # the contigs' dimension
    return "\n".join(["@HD\tVN:1.0\tSO:coordinate", *(f"@SQ\tSN:{r['rname']}\tLN:{r['length']}" for r in rows), "@PG\tID:strandlake"]) + "\n"


def write_sam(alignments: DataFrame, path: str, contigs: DataFrame | None = None) -> None:
    """SAM text by sample and contig, sorted by position in each file, behind a header if ``contigs`` are given."""
    lines = sam_lines(alignments).withColumn("_order", F.lit(1 << 30))
    if contigs is not None:
        head = F.array(*(F.struct(F.lit(i).alias("_order"), F.lit(x).alias("line")) for i, x in enumerate(sam_header(contigs).splitlines())))
        each = lines.select("sample", "rname").distinct().select("sample", "rname", F.lit(-1).cast("bigint").alias("pos"), F.explode(head).alias("x"))
        lines = lines.unionByName(each.select("sample", "rname", "pos", "x.line", "x._order"))
    ordered = lines.repartition("sample", "rname").sortWithinPartitions("sample", "rname", "_order", "pos")
    ordered.select("sample", "rname", "line").write.partitionBy("sample", "rname").text(path)


def write_in_order(df: DataFrame, order: Sequence[str], path: str) -> None:
    """Text lines (``line``) in one file, in order: for consumers that need a whole in sequence, such as an index builder.

    The sort is spread over all tasks; one task writes what they send it, without holding it.
    """
    df.orderBy(*order).select("line").coalesce(1).write.option("compression", "gzip").text(path)


def fasta_lines(fragments: DataFrame) -> DataFrame:
    """Fragments (see ``intervals.fragments``) as FASTA: a header with contig, strand, start, exon and intron sizes, then the bases."""
    sizes = lambda c: F.array_join(F.col(c).cast("array<string>"), ",")
    head = F.concat(F.lit(">"), F.concat_ws(";", F.concat("rname", "strand"), F.col("start").cast("string"), sizes("exon_sizes"), sizes("intron_sizes")))
    return fragments.select("rname", "start", head.alias("name"), F.explode(F.array(F.struct(F.lit(0).alias("o"), head.alias("line")), F.struct(F.lit(1).alias("o"), F.col("sequence").alias("line")))).alias("x")).select("rname", "start", "name", "x.o", "x.line")


def write_fragments(fragments: DataFrame, path: str) -> None:
    """All fragments as one gzipped FASTA file, which an aligner's index is built from, in order of contig and start."""
    write_in_order(fasta_lines(fragments), ["rname", "start", "name", "o"], path)


def write_reads(reads: DataFrame, path: str, records_per_file: int = 80_000) -> None:
    """Preprocessed reads as Parquet files of bounded size."""
    reads.write.option("maxRecordsPerFile", records_per_file).parquet(path)
