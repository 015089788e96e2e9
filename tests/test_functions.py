"""Scalar functions against worked cases and plain Python."""

import random

from pyspark.sql import functions as F

from strandlake.functions import align
from strandlake.functions import seq as sq


def one(spark, value, **cols):
    names = list(cols)
    return spark.createDataFrame([tuple(cols.values())], names).select(value.alias("v")).first()["v"]


def test_reverse_complement_and_canonical(spark):
    assert one(spark, sq.revcomp(F.col("s")), s="AACGTN") == "NACGTT"
    rows = spark.createDataFrame([("ACGT",), ("TTTT",), ("AAAA",)], "s string")
    canon, flipped = sq.canonical(F.col("s"))
    assert [(r[0], r[1]) for r in rows.select(canon, flipped).collect()] == [("ACGT", True), ("AAAA", True), ("AAAA", False)]


def test_qualities(spark):
    assert one(spark, sq.bin_qualities(F.col("s")), s="!+5?I") == "#05Hh"
    assert one(spark, sq.phred64_to_sanger(F.col("s")), s="@h~") == "!II"
    assert one(spark, sq.clamp_sanger(F.col("s")), s="!~") == "!]"
    assert one(spark, sq.mean_quality(F.col("s")), s="AC") == 66.0
    assert one(spark, sq.mean_quality(F.col("s")), s="") is None
    for lo, hi, name in ((64, 70, "Phred64"), (33, 104, "Sanger"), (60, 100, "Solexa"), (60, 80, "Sanger")):
        assert one(spark, sq.phred_format(F.col("lo"), F.col("hi")), lo=lo, hi=hi) == name


def test_cap_sizes():
    assert sq.cap_sizes(15, 25, 1.1) == [15, 16, 17, 18, 19, 20, 22, 24, 25]
    assert sq.cap_sizes(25, 25, 1.5) == [25]


def test_readlets(spark):
    pieces = one(spark, sq.readlets(F.col("s"), 25, 50, 5, 2.0), s="A" * 100)
    found = {(p["start"], p["size"]) for p in pieces}
    assert (0, 50) in found and (75, 25) in found and (5, 50) in found and (45, 50) in found and (50, 50) in found
    assert not [p for p in found if p[0] in range(46, 50)]
    assert one(spark, sq.readlets(F.col("s"), 15, 25), s="ACGT") == []


def test_global_score(spark):
    rng = random.Random(1)

    def slow(a, b):
        row = list(range(0, -len(b) - 1, -1))
        for i, x in enumerate(a, 1):
            new = [-i]
            for j, y in enumerate(b, 1):
                new.append(max(row[j] - 1, new[-1] - 1, row[j - 1] - (x != y or x == "N")))
            row = new
        return row[-1]

    pairs = [("".join(rng.choices("ACGTN", k=rng.randint(0, 12))), "".join(rng.choices("ACGTN", k=rng.randint(0, 12)))) for _ in range(60)]
    got = spark.createDataFrame(pairs, "a string, b string").select(sq.global_score(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == [slow(a, b) for a, b in pairs]


def test_sequence_names():
    for s in ("A", "ATCGN", "NNNATC"):
        assert sq.decode_sequence(sq.encode_sequence(s)) == s


def made_alignment(rng):
    """A random alignment with its CIGAR and MD strings, and what it consists of, noted while it is made."""
    pos = rng.randint(100, 10**7)
    ops, md, seq, at, run = [], "", "", pos, 0
    ins, dels, juncs, spans, kept, mism = [], [], [], [], [], []
    kinds = ["M"]
    for _ in range(rng.randint(0, 4)):
        kinds += [rng.choice("IDN"), "M"]
    if rng.random() < 0.3:
        kinds = ["S", *kinds]
    for kind in kinds:
        n = rng.randint(3, 20)
        ops.append(f"{n}{kind}")
        if kind == "M":
            for k in range(n):
                base = rng.choice("ACGT")
                if rng.random() < 0.1:
                    wrong = rng.choice([b for b in "ACGT" if b != base])
                    md, run = f"{md}{run}{base}", 0
                    mism.append((at + k, wrong))
                    base = wrong
                else:
                    run += 1
                seq += base
            spans.append((at, at + n))
            kept.append((at, at + n))
            at += n
        elif kind == "D":
            gone = "".join(rng.choices("ACGT", k=n))
            md, run = f"{md}{run}^{gone}", 0
            dels.append((at, gone))
            kept.append((at, at + n))
            at += n
        elif kind == "N":
            juncs.append((at, at + n, len(seq)))
            at += n
        else:
            new = "".join(rng.choices("ACGT", k=n))
            if kind == "I":
                ins.append((at - 1, new))
            seq += new

    def merged(xs):
        out = []
        for a, b in xs:
            if out and out[-1][1] == a:
                out[-1] = (out[-1][0], b)
            else:
                out.append((a, b))
        return out

    juncs = [(a, b, d, len(seq) - d) for a, b, d in juncs]
    return ("".join(ops), f"{md}{run}", pos, seq), (ins, dels, juncs, merged(spans), merged(kept), mism)


def test_decomposition(spark):
    rng = random.Random(20)
    cases = [made_alignment(rng) for _ in range(120)]
    ops = align.placed_ops(F.col("cigar"), F.col("pos"))
    rows = spark.createDataFrame([(i, *given) for i, (given, _) in enumerate(cases)], "i int, cigar string, md string, pos long, seq string").select(
        "i", align.insertions(ops, F.col("seq")).alias("ins"), align.deletions(ops, F.col("md")).alias("dels"), align.junctions(ops, F.length("seq")).alias("juncs"),
        align.exons(ops, True).alias("spans"), align.exons(ops, False).alias("kept"), align.mismatches(ops, F.col("md"), F.col("seq")).alias("mism"),
    ).collect()
    for r in rows:
        assert tuple([tuple(x) for x in r[c]] for c in ("ins", "dels", "juncs", "spans", "kept", "mism")) == cases[r["i"]][1], cases[r["i"]]


def test_flags_and_clips(spark):
    assert one(spark, align.clip_size(F.col("c"), "right"), c="5S20M7S") == 7
    assert one(spark, align.clip_size(F.col("c")), c="20M") == 0
    assert one(spark, align.passes_clip_filter(F.col("c"), 9), c="8S20M") is False
    assert [align.clip_filter_size(x) for x in ("none", "mild", "strict", "4")] == [1, 6, 9, 4]
    assert one(spark, align.n_junctions(F.col("c")), c="5M10N5M7N3M") == 2
