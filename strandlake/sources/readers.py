"""Text sources of sequencing data as typed DataFrames."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandlake.functions import seq as sq
from strandlake.plans.spec import one_row_tasks
from strandlake.session import shipped


class BadRecords(ValueError):
    """More records are malformed than allowed."""


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Three or five tab-separated fields a line; ``#`` comments and blank lines are skipped; samples number from 0 in file order."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("line", "text"))
    fields = lines.where((F.trim("text") != "") & ~F.trim("text").startswith("#")).select("line", F.split("text", "\t").alias("f"))
    n = F.size("f")
    checked = fields.where(F.when(~n.isin(3, 5), F.raise_error(F.concat(F.lit("manifest line has a wrong number of fields: "), F.array_join("f", " ")))).otherwise(True))
    pair = n == 5
    return checked.select(
        (F.row_number().over(Window.orderBy("line")) - 1).alias("sample_index"),  # one row per sample
        F.col("f")[0].alias("url1"), F.col("f")[1].alias("md5_1"), F.when(pair, F.get("f", F.lit(2))).alias("url2"), F.when(pair, F.get("f", F.lit(3))).alias("md5_2"),
        F.element_at("f", -1).alias("sample_label"),
    )


READS = "file string, record long, qname string, seq string, qual string"
#: Bytes of a plain file that one task reads records from.
SPLIT_BYTES = 128 << 20


def _uri(path: str) -> str:
    """A path as Hadoop names it, as a URI that pyarrow takes."""
    if path.startswith("file:/") and not path.startswith("file:///"):
        return "file:///" + path.removeprefix("file:").lstrip("/")
    return "s3" + path[path.index(":") :] if path.startswith(("s3a:", "s3n:")) else path


def _lines(handle, at: int = 0) -> Iterator[tuple[int, str]]:
    """Lines with their places, from a stream; a gzip stream that is cut short ends where it does."""
    try:
        for raw in handle:
            yield at, raw.decode("latin-1").rstrip("\r\n")
            at += len(raw)
    except EOFError:
        return


def _records(lines: Iterator[tuple[int, str]], end: float = float("inf")) -> Iterator[tuple[int, str, str, str, bool]]:
    """(place, name, sequence, quality, malformed) of FASTQ or FASTA lines, of records that begin before ``end``.

    FASTA gets the quality ``h`` throughout.
    """
    lines = ((at, x) for at, x in lines)
    first = next((x for x in lines if x[1]), None)
    if first is not None and first[1][0] in ">;":
        at, name, parts = first[0], first[1][1:].split(" ")[0], []
        for here, line in lines:
            if line[:1] in (">", ";") and line:
                yield at, name, "".join(parts), "h" * sum(map(len, parts)), False
                at, name, parts = here, line[1:].split(" ")[0], []
                if at >= end:
                    return
            else:
                parts.append(line)
        yield at, name, "".join(parts), "h" * sum(map(len, parts)), False
        return
    while first is not None and first[0] < end:
        seq, plus, qual = (next(lines, (0, None))[1] for _ in range(3))
        bad = qual is None or not first[1].startswith("@") or not plus.startswith("+") or len(seq) != len(qual)
        yield first[0], first[1][1:].split(" ")[0], seq or "", qual or "", bad
        first = next((x for x in lines if x[1]), None)


def _from_range(handle, start: int) -> Iterator[tuple[int, str]]:
    """Lines from the first record that begins at ``start`` or later on.

    A FASTQ record begins with ``@``, has ``+`` two lines on, and as many qualities as bases; a
    FASTA record begins with its cue. Where the file's first byte is a FASTA cue, only that is looked for.
    """
    import itertools

    fasta = handle.read(1) in (b">", b";")
    if start == 0:
        handle.seek(0)
        return _lines(handle)
    handle.seek(start - 1)
    start += len(handle.readline()) - 1  # what is left of the line that begins before
    lines = _lines(handle, start)
    if fasta:
        return itertools.dropwhile(lambda x: x[1][:1] not in (">", ";") or not x[1], lines)
    held: list[tuple[int, str]] = []
    for line in lines:
        held.append(line)
        if len(held) < 4:
            continue
        a, b, c, d = (x[1] for x in held[-4:])
        if a.startswith("@") and c.startswith("+") and len(b) == len(d):
            return itertools.chain(held[-4:], lines)
    return iter(())


def _streams(path: str, start: int, end: int, split: int) -> Iterator[tuple[str, Iterator[tuple[int, str]], float]]:
    """Streams of lines with the name of what they come from: a range of a plain file; in the task of the first range, a
    gzipped file or the members of an archive, lanes in order of name, as a whole."""
    import gzip

    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(_uri(path))
    with system.open_input_file(name) as raw:
        packed = raw.read(2) == b"\x1f\x8b"
        raw.seek(0)
        if ".tar" in path.rsplit("/", 1)[-1]:
            if start == 0:
                with tarfile.open(fileobj=raw) as tar:
                    for member in sorted((m for m in tar.getmembers() if m.isfile()), key=lambda m: m.name):
                        inner = tar.extractfile(member)
                        yield f"{path}:{member.name}", _lines(gzip.open(inner) if member.name.endswith(".gz") else inner), float("inf")
        elif packed:
            if start == 0:
                yield path, _lines(gzip.GzipFile(fileobj=raw)), float("inf")
        else:
            yield path, _from_range(io.BufferedReader(raw), start), end


def read_sequences(spark: SparkSession, paths: str | list[str], skip_bad: bool = False, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Records of FASTQ and FASTA files, plain or gzipped (told by magic bytes), alone or in tar archives.

    Files stream through the tasks and are never held whole. A plain file is read in ranges of
    ``split_bytes``, each record by the range that it begins in; a gzipped file or an archive is
    one task's work. ``record`` is a record's place in its file or stream. A malformed record fails
    the query unless ``skip_bad``; the rest of a range is read on from the next line but three.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, size in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for name, lines, end in _streams(path, start, min(start + split_bytes, size), split_bytes):
                    rows, held = [], 0
                    for place, qname, seq, qual, bad in _records(lines, end):
                        if bad and not skip_bad:
                            raise BadRecords(f"malformed record at {place} ({qname}) in {name}")
                        if not bad:
                            rows.append((name, place, qname, seq, qual))
                            held += len(seq)
                        if len(rows) >= 20_000 or held > 8 << 20:
                            yield _batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows)

    def _batch(rows):
        cols = list(zip(*rows))
        types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["file", "record", "qname", "seq", "qual"])

    files = spark.read.format("binaryFile").load(paths).select("path", "length").where("length > 0")  # their bytes aren't read here
    ranges = files.select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long"))).alias("start"), "length")
    return shipped(one_row_tasks(ranges)).mapInArrow(run, READS)


def paired(left: DataFrame, right: DataFrame) -> DataFrame:
    """Mates of two sets of records (see ``read_sequences``) in one row: those with equal names but for ``/1`` and ``/2``.

    A read without a mate stays, with nulls on the other side. Names must be unique in a set.
    """
    side = lambda df, n: df.select(sq.mate_free(F.col("qname")).alias("qname"), F.col("seq").alias(f"seq{n}"), F.col("qual").alias(f"qual{n}"))
    return side(left, 1).join(side(right, 2), "qname", "full")


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of JSON lines; lines that aren't valid are passed over. Compressed files are read by Hadoop's codecs, LZO too where it has one."""
    parsed = spark.read.text(path).select(F.from_json("value", schema + ", _bad string", {"columnNameOfCorruptRecord": "_bad"}).alias("x"))
    return parsed.where("x is not null and x._bad is null").select("x.*").drop("_bad")


def canonical_reads(reads: DataFrame, sample: int, encoding: str | None = None, bin_qualities: bool = True) -> DataFrame:
    """Reads as canonical sequences with Sanger qualities; the encoding is told from all qualities if it isn't given."""
    if encoding is None:
        span = reads.agg(F.min(F.array_min(sq.codes(F.col("qual")))).alias("lo"), F.max(F.array_max(sq.codes(F.col("qual")))).alias("hi"))
        encoding = span.select(sq.phred_format(F.col("lo"), F.col("hi")).alias("f")).first()["f"]
    convert = {"Sanger": sq.clamp_sanger, "Phred64": sq.phred64_to_sanger, "Solexa": sq.solexa_to_sanger}[encoding]
    qual = convert(F.col("qual"))
    qual = sq.bin_qualities(qual) if bin_qualities else qual
    clean = reads.withColumn("seq", sq.sanitize(F.col("seq"))).withColumn("qual", qual)
    canon, reversed_ = sq.canonical(F.col("seq"))
    return clean.select(
        canon.alias("canon_seq"), reversed_.alias("is_reversed"), "qname",
        F.when(reversed_, F.reverse("qual")).otherwise(F.col("qual")).alias("qual"), F.lit(sample).alias("sample"), F.lit(None).cast("string").alias("mate_seq"),
    )


def read_sam(spark: SparkSession, path: str, sample: int = 0, allowed_bad: float = 0.0001) -> DataFrame:
    """Alignments of SAM text. Lines with fewer than 11 fields or a wrong number are dropped, up to a share of them."""
    fields = spark.read.text(path).where(~F.col("value").startswith("@")).select(F.split("value", "\t").alias("f"))
    f = F.col("f")
    good = (F.size(f) >= 11) & f[1].try_cast("int").isNotNull() & f[3].try_cast("bigint").isNotNull()
    tally = fields.agg(F.count("*").alias("n"), F.count_if(~F.coalesce(good, F.lit(False))).alias("bad")).first()
    if tally["bad"] > allowed_bad * tally["n"]:
        raise BadRecords(f"{tally['bad']} of {tally['n']} alignments are malformed")
    parts = F.transform(F.slice(f, 12, 1 << 20), lambda t: F.split(t, ":", 3))
    tags = F.map_from_entries(F.transform(F.filter(parts, lambda p: F.size(p) == 3), lambda p: F.struct(p[0], p[2])))
    tag = lambda name: F.try_element_at("tags", F.lit(name))
    return fields.where(good).withColumn("tags", tags).select(
        F.lit(sample).alias("sample"), f[0].alias("qname"), f[1].cast("int").alias("flag"), f[2].alias("rname"), f[3].cast("bigint").alias("pos"),
        f[4].try_cast("int").alias("mapq"), f[5].alias("cigar"), f[6].alias("rnext"), f[7].try_cast("bigint").alias("pnext"), f[8].try_cast("bigint").alias("tlen"),
        f[9].alias("seq"), f[10].alias("qual"), tag("AS").try_cast("int").alias("as_score"), F.coalesce(tag("XS"), tag("ZS")).try_cast("int").alias("xs_score"),
        tag("NM").try_cast("int").alias("nm"), tag("MD").alias("md"), "tags",
    )


def read_bed12(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a BED12 file with block sizes and offsets as arrays; trailing commas are fine."""
    f = F.split("value", "\t")
    numbers = lambda c: F.transform(F.filter(F.split(c, ","), lambda x: x != ""), lambda x: x.cast("bigint"))
    rows = spark.read.text(path).where(~F.col("value").rlike("^(track|browser|#)") & (F.size(f) >= 12))
    return rows.select(f[0].alias("rname"), f[1].cast("bigint").alias("start"), f[2].cast("bigint").alias("end_pos"), f[3].alias("name"), f[5].alias("strand"), numbers(f[10]).alias("sizes"), numbers(f[11]).alias("offsets"))


def read_gtf_exons(spark: SparkSession, path: str) -> DataFrame:
    """Exons of a GTF file, 1-based and half-open, with their transcript."""
    f = F.split("value", "\t")
    rows = spark.read.text(path).where(~F.col("value").startswith("#") & (f[2] == "exon"))
    return rows.select(f[0].alias("rname"), f[3].cast("bigint").alias("start"), (f[4].cast("bigint") + 1).alias("end_pos"), f[6].alias("strand"), F.regexp_extract(f[8], 'transcript_id "([^"]*)"', 1).alias("transcript"))


def read_reference(spark: SparkSession, path: str, chunk_size: int = 65_536) -> tuple[DataFrame, DataFrame]:
    """(contigs with both ranks, chunks of bases) of FASTA files."""
    records = read_sequences(spark, path)
    lengths = records.select(F.col("qname").alias("rname"), F.length("seq").cast("bigint").alias("length"))
    contigs = lengths.select(  # one row per contig
        "rname", "length", (F.row_number().over(Window.orderBy(F.col("length").desc(), "rname")) - 1).alias("rank_by_len"),
        (F.row_number().over(Window.orderBy("rname")) - 1).alias("rank_by_name"),
    )
    chunk = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.length("seq") - 1) / chunk_size)))
    chunks = records.where("length(seq) > 0").select(F.col("qname").alias("rname"), F.upper("seq").alias("seq"), chunk.alias("chunk"))
    bases = F.substring(F.col("seq"), (F.col("chunk") * chunk_size + 1).cast("int"), F.lit(chunk_size))
    return contigs, chunks.select("rname", "chunk", bases.alias("bases"))
