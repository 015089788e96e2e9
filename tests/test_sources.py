"""Readers, sinks, the cohort pipeline and the stream extension."""

import gzip
import io
import random
import struct
import tarfile

import pytest

from strandlake.plans.pipeline import Cohort, Parameters
from strandlake.sources import readers, writers

FASTQ = "@good x\nACGTAC\n+\nIIIIII\n@second\nTTTT\n+\n!!!!\n"
BAD = "@bad\nACGT\n+\nI\n@good\nAC\n+\nII\n"


def test_manifest(spark, tmp_path):
    path = tmp_path / "m"
    path.write_text("# note\n\nftp://x_1\t0\tftp://x_2\t0\tlabel-1\nhttp://y\t0\tlabel-2\n")
    rows = readers.read_manifest(spark, str(path)).orderBy("sample_index").collect()
    assert [(r["sample_index"], r["url1"], r["url2"], r["sample_label"]) for r in rows] == [(0, "ftp://x_1", "ftp://x_2", "label-1"), (1, "http://y", None, "label-2")]
    path.write_text("a\tb\n")
    with pytest.raises(Exception, match="wrong number of fields"):
        readers.read_manifest(spark, str(path)).collect()


def test_sequences(spark, tmp_path):
    (tmp_path / "a.fastq").write_text(FASTQ)
    (tmp_path / "b.anything").write_bytes(gzip.compress(FASTQ.encode()))
    (tmp_path / "c.fa").write_text(">one more\nAC\nGT\n;two\nTT\n")
    with tarfile.open(tmp_path / "d.tar.gz", "w:gz") as tar:
        for name in ("l2.fastq", "l1.fastq"):
            info = tarfile.TarInfo(name)
            info.size = len(FASTQ)
            tar.addfile(info, io.BytesIO(FASTQ.encode()))
    (tmp_path / "e.fastq").write_text("")
    cut = gzip.compress((FASTQ * 3000).encode())
    (tmp_path / "f.gz").write_bytes(cut[: len(cut) // 2])
    read = lambda n, **k: [(r["qname"], r["seq"], r["qual"]) for r in readers.read_sequences(spark, str(tmp_path / n), **k).orderBy("file", "record").collect()]
    two = [("good", "ACGTAC", "IIIIII"), ("second", "TTTT", "!!!!")]
    assert read("a.fastq") == two and read("b.anything") == two and read("d.tar.gz") == two + two and read("e.fastq") == []
    assert read("c.fa") == [("one", "ACGT", "hhhh"), ("two", "TT", "hh")]
    assert len(read("f.gz", skip_bad=True)) > 100


def test_ranges_and_mates(spark, tmp_path):
    """Records are read once whatever the ranges, also where a quality begins like a name; mates meet by name."""
    rng = random.Random(2)
    want, texts = {}, {1: "", 2: ""}
    for i in range(300):
        for mate in (1, 2):
            n = rng.randint(1, 40)
            seq, qual = "".join(rng.choices("ACGT", k=n)), "".join(rng.choices("@+AI!", k=n))
            want.setdefault(f"r{i}", []).append((seq, qual))
            texts[mate] += f"@r{i}/{mate} x\n{seq}\n+\n{qual}\n"
    for mate, text in texts.items():
        (tmp_path / f"m{mate}.fastq").write_text(text)
    sides = [readers.read_sequences(spark, str(tmp_path / f"m{mate}.fastq"), split_bytes=size) for mate, size in ((1, 997), (2, 1 << 20))]
    rows = readers.paired(*sides).collect()
    assert {r["qname"]: [(r["seq1"], r["qual1"]), (r["seq2"], r["qual2"])] for r in rows} == want and len(rows) == 300
    fasta = "".join(f">c{i}\n" + "ACGT\n" * rng.randint(0, 9) for i in range(50))
    (tmp_path / "c.fa").write_text(fasta)
    found = {r["qname"]: r["seq"] for r in readers.read_sequences(spark, str(tmp_path / "c.fa"), split_bytes=61).collect()}
    assert found == {p.split("\n")[0]: "".join(p.split("\n")[1:]) for p in fasta.split(">")[1:]}


def test_json_lines(spark, tmp_path):
    (tmp_path / "j").write_text('{"a": 1}\nnot json\n{"a": 2, "b": "x"}\n{"a": \n')
    assert sorted(map(tuple, readers.read_json_lines(spark, str(tmp_path / "j"), "a int, b string").collect()), key=str) == [(1, None), (2, "x")]


def test_fetch_and_programs(spark, tmp_path):
    import hashlib

    from strandlake.sources import fetch

    (tmp_path / "a.txt").write_text("hello\n")
    digest = hashlib.md5(b"hello\n").hexdigest()
    rows = [(f"file://{tmp_path}/a.txt", digest, None, None, "s"), ("say:ACC1", "0", None, None, "t")]
    manifest = spark.createDataFrame(rows, "url1 string, md5_1 string, url2 string, md5_2 string, sample_label string")
    files = fetch.fetched(manifest, f"file://{tmp_path}/got", programs={"say": ("echo",)}).collect()
    assert {(tmp_path / "got" / r["file"].rsplit("/", 1)[1]).read_text() for r in files} == {"hello\n", "ACC1\n"} and {r["bytes"] for r in files} == {5, 6}
    wrong = manifest.limit(1).replace(digest, "1" * 32)
    with pytest.raises(Exception, match="MD5"):
        fetch.fetched(wrong, f"file://{tmp_path}/no", tries=2, wait=0.01).collect()
    assert not [p for p in (tmp_path / "no").iterdir() if not p.name.startswith(".")]
    accessions = fetch.accession_manifest(spark.createDataFrame([("SRR1", "one")], "accession string, sample_label string")).first()
    assert (accessions["url1"], accessions["md5_1"], accessions["sample_label"]) == ("sra:SRR1", "0", "one")
    lines = fetch.piped(spark.range(5000).selectExpr("id", "'x' as t").repartition(3), ("tr", "x", "y")).collect()
    assert sorted(int(r[0].split("\t")[0]) for r in lines) == list(range(5000)) and lines[0][0].endswith("\ty")
    with pytest.raises(Exception, match="ended with"):
        fetch.piped(spark.range(5), ("false",)).collect()


def test_bad_records(spark, tmp_path):
    (tmp_path / "bad.fastq").write_text(BAD)
    assert [r["qname"] for r in readers.read_sequences(spark, str(tmp_path / "bad.fastq"), skip_bad=True).collect()] == ["good"]
    with pytest.raises(Exception, match="malformed record"):
        readers.read_sequences(spark, str(tmp_path / "bad.fastq")).collect()


def test_canonical_reads(spark, tmp_path):
    (tmp_path / "a.fastq").write_text(FASTQ)
    rows = readers.canonical_reads(readers.read_sequences(spark, str(tmp_path / "a.fastq")), 3, bin_qualities=False).orderBy("qname").collect()
    assert [(r["canon_seq"], r["is_reversed"], r["sample"]) for r in rows] == [("ACGTAC", False, 3), ("AAAA", True, 3)]


SAM = [
    ("r1", 0, "c1", 10, "10M", "ACGTACGTAC", 0, None, "10"), ("r1", 256, "c1", 40, "10M", "ACGTACGTAC", -3, None, "10"),
    ("r2", 0, "c1", 12, "4M20N6M", "ACGTACGTAC", 0, -5, "10"), ("r3", 0, "c2", 5, "5M1I4M", "ACGTACGTAC", 0, None, "4A4"),
    ("r4", 4, "*", 0, "*", "ACGTACGTAC", 0, None, "0"), ("r5", 0, "c2", 6, "4M2D6M", "ACGTACGTAC", -1, None, "4^GT6"),
]


@pytest.fixture(scope="module")
def cohort(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sam")
    lines = ["@HD\tVN:1.0"]
    for q, f, r, p, c, s, a, x, md in SAM:
        lines.append("\t".join(map(str, [q, f, r, p, 255, c, "*", 0, 0, s, "I" * 10, f"AS:i:{a}", *([f"XS:i:{x}"] if x is not None else []), "NM:i:0", f"MD:Z:{md}"])))
    (folder / "s.sam").write_text("\n".join(lines) + "\n")
    alignments = readers.read_sam(spark, str(folder / "s.sam"), 0)
    contigs = spark.createDataFrame([("c1", 100, 0, 0), ("c2", 50, 1, 1)], "rname string, length long, rank_by_len int, rank_by_name int")
    samples = spark.createDataFrame([(0, "s0"), (1, "s1")], "sample_index int, sample_label string")
    return Cohort(alignments, contigs, samples, Parameters(bin_size=16))


def test_cohort_coverage(cohort):
    base = {"c1": [0] * 100, "c2": [0] * 50}
    for rname, start, end in (("c1", 10, 20), ("c1", 12, 16), ("c1", 36, 42), ("c2", 5, 14), ("c2", 6, 18)):
        for x in range(start - 1, end - 1):
            base[rname][x] += 1
    runs = cohort.deliverable("bw").collect()
    for rname, want in base.items():
        mine = sorted((r["start"], r["end_pos"], r["value"]) for r in runs if r["rname"] == rname)
        assert [v for s, e, v in mine for _ in range(e - s)] == want
    norm = cohort.deliverable("norm").first()
    assert norm["auc"] == sum(map(sum, base.values())) and norm["unique_auc"] == norm["auc"]


def test_cohort_rest(cohort):
    assert {(r["rname"], r["total"], r["unique"]) for r in cohort.deliverable("counts").collect()} == {("c1", 2, 2), ("c2", 2, 2), ("*", 1, 1)}
    per, _ = cohort.indels()
    assert {(r["type"], r["start"], r["end_pos"], r["strand_or_seq"]) for r in per.collect()} == {("N", 16, 36, "."), ("I", 9, 9, "C"), ("D", 10, 12, "GT")}
    assert cohort.deliverable("bed").count() == 1 and cohort.deliverable("tsv").count() == 3
    mean = {(r["rname"], r["pos"]): r["mean"] for r in cohort.deliverable("mean").collect()}
    assert mean["c1", 12] == pytest.approx(2 * 40e6 / 4) and mean["c1", 42] == pytest.approx(0)
    median = {(r["rname"], r["pos"]): r["median"] for r in cohort.deliverable("median").collect()}
    assert median["c1", 12] == pytest.approx(mean["c1", 12])
    assert {(r["base"], r["pos"]) for r in cohort.deliverable("nonref").collect()} == {("A", 9), ("A", 10)}


def test_malformed_sam(spark, tmp_path):
    (tmp_path / "x.sam").write_text("a\tb\n")
    with pytest.raises(readers.BadRecords):
        readers.read_sam(spark, str(tmp_path / "x.sam"))


def test_other_sources(spark, tmp_path):
    (tmp_path / "t.bed").write_text("track name=x\nc\t10\t200\tn\t0\t+\t10\t200\t0\t3\t10,20,5,\t0,50,185,\n")
    bed = readers.read_bed12(spark, str(tmp_path / "t.bed")).first()
    assert bed["sizes"] == [10, 20, 5] and bed["offsets"] == [0, 50, 185]
    (tmp_path / "g.gtf").write_text('#c\nc\tx\texon\t5\t9\t.\t+\t.\tgene_id "g"; transcript_id "t1";\nc\tx\tCDS\t5\t9\t.\t+\t.\ttranscript_id "t1";\n')
    gtf = readers.read_gtf_exons(spark, str(tmp_path / "g.gtf")).collect()
    assert [(r["start"], r["end_pos"], r["transcript"]) for r in gtf] == [(5, 10, "t1")]
    (tmp_path / "r.fa").write_text(">a\nACGTAC\n>bb\n" + "T" * 25 + "\n")
    contigs, chunks = readers.read_reference(spark, str(tmp_path / "r.fa"), 10)
    assert {(r["rname"], r["length"], r["rank_by_len"], r["rank_by_name"]) for r in contigs.collect()} == {("a", 6, 1, 0), ("bb", 25, 0, 1)}
    assert sorted((r["rname"], r["chunk"], len(r["bases"])) for r in chunks.collect()) == [("a", 0, 6), ("bb", 0, 10), ("bb", 1, 10), ("bb", 2, 5)]


def test_sinks(spark, cohort, tmp_path):
    writers.write_bedgraph(cohort.deliverable("bw"), str(tmp_path / "bw"))
    lines = [r["value"] for r in spark.read.text(str(tmp_path / "bw")).collect()]
    assert "c1\t0\t9\t0" in lines
    writers.write_bed(cohort.deliverable("bed"), str(tmp_path / "bed"))
    assert "JUNC00000001" in spark.read.text(str(tmp_path / "bed")).first()["value"]
    writers.write_sam(cohort.alignments, str(tmp_path / "sam"))
    assert spark.read.text(str(tmp_path / "sam")).count() == len(SAM)
    assert any("ZS:i:-5" in r["value"] for r in spark.read.text(str(tmp_path / "sam")).collect())
    assert writers.sam_header(cohort.contigs).splitlines()[1] == "@SQ\tSN:c1\tLN:100"
    writers.write_tsv(cohort.counts(), str(tmp_path / "tsv"))
    assert spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "tsv")).count() == 3


def test_bam(spark, cohort, tmp_path):
    """Records read back byte by byte, through any reader of gzip members."""
    from strandlake.sources import bam

    files = bam.write_bam(cohort.alignments, cohort.contigs, f"file://{tmp_path}/bam").collect()
    assert sum(r["records"] for r in files) == len(SAM) and {r["rname"] for r in files} == {"c1", "c2", "*"}
    seen = []
    for f in files:
        raw = (tmp_path / "bam" / f["file"].rsplit("/", 1)[1]).read_bytes()
        assert raw.endswith(bam.END)
        data = gzip.decompress(raw)
        assert data[:4] == b"BAM\1"
        size = struct.unpack_from("<i", data, 4)[0]
        assert data[8 : 8 + size].decode() == writers.sam_header(cohort.contigs)
        at, names = 12 + size, []
        for _ in range(struct.unpack_from("<i", data, 8 + size)[0]):
            n = struct.unpack_from("<i", data, at)[0]
            names.append((data[at + 4 : at + 3 + n].decode(), struct.unpack_from("<i", data, at + 4 + n)[0]))
            at += 8 + n
        assert names == [("c1", 100), ("c2", 50)]
        last = -1
        while at < len(data):
            length, ref, pos, n_name, mapq, bin_, n_ops, flag, n_seq = struct.unpack_from("<iiiBBHHHi", data, at)
            body = data[at + 36 : at + 4 + length]
            name, ops = body[: n_name - 1].decode(), struct.unpack_from(f"<{n_ops}I", body, n_name)
            cigar = "".join(f"{o >> 4}{bam.OPERATIONS[o & 15]}" for o in ops) or "*"
            packed = body[n_name + 4 * n_ops : n_name + 4 * n_ops + (n_seq + 1) // 2]
            seq = "".join(bam.BASES[x >> 4] + bam.BASES[x & 15] for x in packed)[:n_seq]
            tags = body[n_name + 4 * n_ops + (n_seq + 1) // 2 + n_seq :]
            assert pos >= last and bin_ == bam.bin_of(max(pos, 0), max(pos, 0) + 1)
            last = pos
            seen.append((name, flag, names[ref][0] if ref >= 0 else "*", pos + 1, cigar, seq, b"ZSi" in tags, tags[tags.index(b"MDZ") + 3 : -1].decode()))
            at += 4 + length
    assert sorted(seen) == sorted((q, f, r, p, c, s, x is not None, md) for q, f, r, p, c, s, _, x, md in SAM)
    blocks = bam.bgzf(b"x" * 1000)
    assert struct.unpack_from("<H", blocks, 16)[0] == len(blocks) - 1 and [bam.bin_of(0, 1), bam.bin_of(0, 1 << 14), bam.bin_of(16383, 16385), bam.bin_of(0, 1 << 29)] == [4681, 4681, 585, 0]


def test_sam_header_and_single_files(spark, cohort, tmp_path):
    writers.write_sam(cohort.alignments, str(tmp_path / "s"), cohort.contigs)
    files = list((tmp_path / "s").rglob("*.txt"))
    assert len(files) == 3 and all(f.read_text().startswith(writers.sam_header(cohort.contigs)) for f in files)
    some = spark.createDataFrame([("b", "+", 5, [3, 2], [10], "ACGTA"), ("a", "+", 9, [1, 1], [7], "CC")], "rname string, strand string, start long, exon_sizes array<long>, intron_sizes array<long>, sequence string")
    writers.write_fragments(some, str(tmp_path / "f"))
    (one,) = (tmp_path / "f").glob("*.gz")
    assert gzip.decompress(one.read_bytes()).decode() == ">a+;9;1,1;7\nCC\n>b+;5;3,2;10\nACGTA\n"


def test_runs_end_and_resume(spark, cohort, tmp_path):
    from strandlake.plans import pipeline

    made = cohort.write(f"file://{tmp_path}/out", "counts", "bed")
    mark = (tmp_path / "out" / "counts" / "_SUCCESS").stat().st_mtime_ns
    again = cohort.write(f"file://{tmp_path}/out", "counts")
    assert (tmp_path / "out" / "counts" / "_SUCCESS").stat().st_mtime_ns == mark and again["counts"].count() == made["counts"].count() == 3
    assert "Scan text" in cohort.explain("counts")["counts"]
    names = pipeline.copied(spark, f"file://{tmp_path}/out/counts", f"file://{tmp_path}/copy")
    assert "_SUCCESS" in names and spark.read.parquet(f"file://{tmp_path}/copy").count() == 3


def test_scratch(spark):
    from strandlake.session import removed, scratch_root, smaller_batches, written

    frame = written(spark.range(5).toDF("x"), "some")
    folder = frame.inputFiles()[0].rsplit("/", 1)[0]
    assert scratch_root(spark).removeprefix("file://").removeprefix("file:") in folder and sorted(r[0] for r in frame.collect()) == list(range(5))
    removed(frame)
    with pytest.raises(Exception):
        spark.read.parquet(folder).count()
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    smaller_batches(spark)
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == str(4 << 20)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", before)


def test_stream(spark, tmp_path):
    from strandlake.streaming.keyed import run_to_table, windowed_sums

    source = spark.createDataFrame([(i * 600, "ab"[i % 2], float(i)) for i in range(30)], "t long, k string, v double")
    source.selectExpr("cast(t as timestamp) as t", "k", "v").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("t timestamp, k string, v double").parquet(str(tmp_path / "in"))
    run_to_table(windowed_sums(stream, "t", ["k"], ["v"]), "sums", str(tmp_path / "cp"), "complete")
    assert spark.table("sums").agg({"sum_v": "sum", "n": "sum"}).first().asDict() == {"sum(sum_v)": 435.0, "sum(n)": 30}
