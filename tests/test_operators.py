"""Operators against slow ways of finding the same, on random and planted cases, and invariants between them."""

import hashlib
import itertools
import random
import re

from pyspark.sql import functions as F

from strandlake.operators import alignments as al
from strandlake.operators import chains as ch
from strandlake.operators import coverage as cv
from strandlake.operators import dataflow as dfl
from strandlake.operators import intervals as iv
from strandlake.operators import introns as ir
from strandlake.operators import junctions as jn
from strandlake.operators import metrics as mt
from strandlake.operators import paths as pt

OBS = "rname_strand string, start long, end_pos long, sample int, count long"


def observations(spark, rows):
    flat = [(r, s, e, x, c) for r, s, e, xs, cs in rows for x, c in zip(xs, cs)]
    return spark.createDataFrame(flat, OBS)


def test_junction_filter(spark):
    rows = [("chr1+", 100, 140, [0], [6]), ("chr2-", 171, 185, [1, 2], [2, 3]), ("chr3+", 23, 85, [1], [2])]
    kept = jn.filter_junctions(observations(spark, rows), 3, 0.5, 5).collect()
    assert {(r[0], r["sample"], r[1], r[2]) for r in kept} == {("chr1+", 0, 100, 140), ("chr2-", 1, 171, 185), ("chr2-", 2, 171, 185)}
    kept = jn.filter_junctions(observations(spark, [*rows, ("chr3+", 23, 85, [1], [5])]), 5, 0.5, 5).collect()
    assert {(r[0], r["sample"]) for r in kept} == {("chr1+", 0), ("chr3+", 1)}
    assert jn.filter_junctions(observations(spark, [("chr1+", 10, 10, [0], [99])]), 1, 0.5, 5).count() == 0
    assert jn.filter_junctions(observations(spark, rows), 3, 0.5, -1).count() == 2


def test_indels(spark):
    schema = "type string, rname string, start long, end_pos long, strand_or_seq string, sample int, left_disp int, right_disp int, count long"
    rows = [
        ("I", "0", 140, 140, "ATAC", 0, None, None, 6), ("I", "0", 140, 140, "ATAC", 0, None, None, 6), ("I", "2", 170, 170, "CT", 1, None, None, 4),
        ("D", "1", 150, 156, "AACCTT", 0, None, None, 3), ("D", "1", 150, 156, "AACCTT", 1, None, None, 3), ("N", "3", 3567, 3890, "+", 2, 3, 3, 2),
    ]
    per, across = jn.aggregate_indels(spark.createDataFrame(rows, schema), 3, 0.5, 5)
    assert {(r["type"], r["rname"], r["sample"], r["count"]) for r in per.collect()} == {("I", "0", 0, 12), ("I", "2", 1, 4), ("D", "1", 0, 3), ("D", "1", 1, 3), ("N", "3", 2, 2)}
    assert {(r["type"], tuple(r["samples"]), tuple(r["counts"])) for r in across.collect()} == {("I", (0,), (12,)), ("D", (0, 1), (3, 3)), ("N", (2,), (2,))}
    lines = {r[0] for r in jn.tsv_rows(across, 3).collect()}
    assert "N;3;+;3567;3889\t0\t0\t2" in lines


def test_coverage_invariants(spark):
    rng = random.Random(3)
    rows = [("c", i % 2, p := rng.randint(1, 900), p + rng.randint(1, 60), rng.random() < 0.5) for i in range(200)]
    diffs = cv.collapse(cv.exon_diffs(spark.createDataFrame(rows, "rname string, sample int, pos long, end_pos long, uniq boolean")))
    plain = {tuple(r) for r in cv.running_coverage(diffs).collect()}
    for size in (7, 64, 5000):
        binned = cv.binned_coverage(diffs, cv.KEYS, size)
        assert {tuple(r) for r in binned.select("rname", "sample", "pos", "cov", "ucov").collect()} == plain
        lengths = spark.createDataFrame([("c", 1000)], "rname string, length long")
        runs = cv.segments(binned, lengths).collect()
        for sample in (0, 1):
            base = [0] * 1000
            for _, s, p, e, _u in rows:
                if s == sample:
                    for x in range(p - 1, e - 1):
                        base[x] += 1
            mine = sorted((r["start"], r["end_pos"], r["value"]) for r in runs if r["sample"] == sample)
            drawn = [v for s, e, v in mine for _ in range(e - s)]
            assert drawn == base and all(a[1] == b[0] and a[2] != b[2] for a, b in zip(mine, mine[1:]))
    auc = {r["sample"]: r["auc"] for r in cv.auc(cv.segments(cv.binned_coverage(diffs), lengths)).collect()}
    assert auc == {s: sum(e - p for _, x, p, e, _u in rows if x == s) for s in (0, 1)}


def test_percentile(spark):
    hist = spark.createDataFrame([(0, v, 1) for v in range(1, 101)], "sample int, value long, bases long")
    assert cv.percentile_of(hist, 0.75).collect()[0]["factor"] == 75
    assert cv.percentile_of(hist.where("value < 0")).count() == 0


def test_bins(spark):
    rows = spark.createDataFrame([("a", 27, 5001), ("b", 20, 10002), ("c", 1, 3)], "k string, pos long, end_pos long")
    got = {(r["k"], r["bin"], r["bin_start"], r["bin_end"]) for r in cv.interval_bins(rows, "pos", "end_pos").collect()}
    assert got == {("a", 0, 1, 5001), ("b", 0, 1, 5001), ("b", 1, 5001, 10001), ("b", 2, 10001, 15001), ("c", -1, -4999, 1), ("c", 0, 1, 5001)}


def test_md5_bucket(spark):
    import hashlib

    keys = ["", "a", "chr1;12", "é"]
    got = spark.createDataFrame([(k,) for k in keys], "k string").select(dfl.md5_bucket(F.col("k"), 97)).collect()
    assert [r[0] for r in got] == [int(hashlib.md5(k.encode()).hexdigest(), 16) % 97 for k in keys]
    got = spark.createDataFrame([("-7",), ("x",)], "k string").select(dfl.mod_bucket(F.col("k"), 4)).collect()
    assert [r[0] for r in got] == [3, int(hashlib.md5(b"x").hexdigest(), 16) % 4]


def test_groups_and_duplicates(spark):
    rows = [("chr1", "1", "a")] * 2 + [("chr1", "1", "i"), ("chr3", "2", "i"), ("chr1", "2", "i"), ("chr1", "2", "j")]
    df = spark.createDataFrame(rows, "k1 string, k2 string, v string")
    assert {(r["k1"], r["k2"]): r["count"] for r in df.groupBy("k1", "k2").count().collect()} == {("chr1", "1"): 3, ("chr3", "2"): 1, ("chr1", "2"): 2}
    assert df.distinct().count() == 5
    assert dfl.keyed_sums(spark.createDataFrame([], "k string, v long"), ["k"], ["v"]).count() == 0


def test_balanced_splits(spark):
    sizes = spark.createDataFrame([(0, 10), (1, 0), (2, 25), (3, 7)], "s int, n long")
    cut = sorted((r["split"], r["s"], r["start"], r["span"]) for r in dfl.balanced_splits(sizes, "s", "n", 3).collect())
    assert cut == [(0, 0, 0, 10), (0, 2, 0, 4), (1, 2, 4, 14), (2, 2, 18, 7), (2, 3, 0, 7)]


def test_tie_break(spark):
    schema = "qname long, alt int, weight long, as_score int, n_junctions int, read_length int"
    rows = [(q, a, w, 0, 1, 50) for q in range(600) for a, w in ((1, 1), (2, 2))]
    picked = al.break_ties(spark.createDataFrame(rows, schema)).groupBy("alt").count().collect()
    share = {r["alt"]: r["count"] / 600 for r in picked}
    assert abs(share[1] - 1 / 3) < 0.07 and abs(share[2] - 2 / 3) < 0.07
    zero = spark.createDataFrame([(q, a, 0, 0, 1, 50) for q in range(100) for a in (1, 2)], schema)
    assert al.break_ties(zero).count() == 100
    mixed = spark.createDataFrame([(1, 1, 9, -5, 1, 50), (1, 2, 0, -9, 0, 50), (1, 3, 0, -3, 0, 50)], schema)
    assert [r["alt"] for r in al.break_ties(mixed).collect()] == [3]


def test_direct_successors(spark):
    rng = random.Random(5)
    nodes = {(s := rng.randint(1, 400), s + rng.randint(5, 60)) for _ in range(60)}
    want = {(a, b) for a in nodes for b in nodes if b[0] >= a[1] + 3 and not any(c[0] >= a[1] + 3 and b[0] >= c[1] + 3 for c in nodes)}
    df = spark.createDataFrame([("x", *n) for n in nodes], "k string, start long, end_pos long")
    got = {((r["a_start"], r["a_end"]), (r["b_start"], r["b_end"])) for r in iv.direct_successors(df, ["k"], 3, 64).collect()}
    assert got == want


def bases(rng, n):
    return "".join(rng.choices("ACGT", k=n))


def cut_up(genome, size, name="a"):
    return [(name, i, genome[i * size : i * size + size]) for i in range(-(-len(genome) // size))]


def test_configurations(spark):
    """Runs on random introns against a walk over edges made by their definition."""
    rng = random.Random(9)
    for size, overlap, span, least in ((30, 1, 2, 12), (21, 1, 1, 1), (40, 5, 2, 25), (60, 3, 3, 30)):
        nodes = {(s := rng.randint(1, 300), s + rng.randint(3, 40)) for _ in range(25)}
        edges = {a: [b for b in nodes if b[0] >= a[1] + overlap and not any(c[0] >= a[1] + overlap and b[0] >= c[1] + overlap for c in nodes)] for a in nodes}
        want = set()

        def walk(run, gaps, left, left_avail):
            last = run[-1]
            for b in edges[last] or [None]:
                gap = b[0] - last[1] if b else None
                if gap is None or sum(gaps) + gap >= size - 1:
                    want.add((tuple(s for s, _ in run), tuple(e for _, e in run), left, size - 1 if gap is None else min(size - 1, gap), left_avail, gap))
                elif len(gaps) + 1 < span or sum([*gaps, gap][-span:]) >= least:
                    walk([*run, b], [*gaps, gap], left, left_avail)

        for a in nodes:
            before = [a[0] - p[1] for p in nodes if a in edges[p]]
            avail = max(before) if before else None
            walk([a], [], min(size - 1, avail if before else a[0] - max(a[0] - size + 1, 1)), avail)
        frame = spark.createDataFrame([("k", *n) for n in nodes], "k string, start long, end_pos long")
        rows = pt.intron_configurations(frame, ["k"], size, overlap, span, least).collect()
        got = [(tuple(r["starts"]), tuple(r["ends"]), r["left_ext"], r["right_ext"], r["left_avail"], r["right_avail"]) for r in rows]
        assert len(got) == len(set(got)) and set(got) == want


def test_combined_runs(spark):
    """Random cojunctions of reads against paths found one by one."""
    rng = random.Random(4)
    rows, want = [], {}
    for read in range(25):
        runs = set()
        for _ in range(rng.randint(1, 7)):
            at, run = rng.randint(1, 120), []
            for _ in range(rng.randint(1, 3)):
                run.append((at, at + rng.randint(2, 20)))
                at = run[-1][1] + rng.randint(1, 9)
            runs.add(tuple(run))
        span = 45
        inside = lambda r: sum(b[0] - a[1] for a, b in zip(r, r[1:]))
        after = {a: [b for b in runs if b[0][0] > a[-1][1] and b[0][0] - a[-1][1] + inside(a) + inside(b) + 2 <= span] for a in runs}
        entered = {b for bs in after.values() for b in bs}
        found = [list(r) for r in runs if bool(after[r]) == (r in entered)]

        def walk(path, last):
            if not after[last]:
                found.append(path)
            for b in after[last]:
                walk(path + list(b), b)

        for a in runs:
            if after[a] and a not in entered:
                walk(list(a), a)
        parts = {tuple(p) for f in found for p in ((f, f[1:], f[:-1], f[1:-1]) if len(runs) > 1 else (f,)) if p}
        want[f"r{read}"] = parts
        rows += [(f"r{read}", "c+", [s for s, _ in r], [e for _, e in r]) for r in runs]
    frame = spark.createDataFrame(rows + rows[:5], "read string, rname_strand string, starts array<long>, ends array<long>")
    got = {}
    for r in pt.combined_runs(frame, 45, None).collect():
        got.setdefault(r["read"], []).append(tuple(zip(r["starts"], r["ends"])))
    assert {k: set(v) for k, v in got.items()} == want and all(len(v) == len(set(v)) for v in got.values())
    few = {}
    for r in pt.combined_runs(frame, 45, 4).collect():
        few.setdefault(r["read"], []).append(tuple(zip(r["starts"], r["ends"])))
    for read, runs in few.items():
        assert sorted(map(len, runs)) == sorted(map(len, want[read]))[:4] and set(runs) <= want[read]


def test_suffix_match(spark):
    rng = random.Random(6)
    pairs = []
    for _ in range(150):
        query = bases(rng, rng.randint(4, 14))
        window = bases(rng, rng.randint(0, 25))
        for _ in range(rng.randint(0, 3)):
            window += query[rng.randint(0, len(query) - 4) :] + bases(rng, rng.randint(0, 8))
        pairs.append((query, window))

    def slow(q, w):
        places = [p for p in range(len(q) - 4, len(w) - 3) if w[p : p + 4] == q[-4:]]
        if not places or len(places) > 3 or places[0] == len(q) - 4:
            return None
        best = None
        for p in places:
            k = max(k for k in range(4, min(len(q), p + 4) + 1) if w[p + 4 - k : p + 4] == q[-k:])
            best = min(best or (0, 0), (-k, p + 4 - k))
        return best[1], -best[0]

    frame = spark.createDataFrame(pairs, "q string, w string").select("q", "w", ir.suffix_match(F.col("q"), F.col("w"), 4, 3).alias("m"))
    rows = frame.collect()
    assert [tuple(r["m"]) if r["m"] else None for r in rows] == [slow(q, w) for q, w in pairs] and any(r["m"] for r in rows)


HITS = "read_id long, sample int, read_seq string, piece int, rname string, reverse boolean, pos long, end_pos long, disp int"


def searched(spark, genome, rows, **options):
    chunks = spark.createDataFrame(cut_up(genome, 16), "rname string, chunk long, bases string")
    contigs = spark.createDataFrame([("a", len(genome))], "rname string, length long")
    found = ir.search_junctions(spark.createDataFrame(rows, HITS), chunks, 16, contigs, **options)
    return sorted((r["sample"], r["rname_strand"], r["start"], r["end_pos"], r["count"]) for r in found.collect())


def test_planted_introns(spark):
    """Reads over planted introns: plain, read in reverse, with a small exon between two introns, and with a lost first piece."""
    rng = random.Random(31)
    flip = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    quiet = lambda n: "".join(rng.choices("CT", k=n))  # holds no motif
    one, two = bases(rng, 60), bases(rng, 60)
    mid = bases(rng, 12)
    # exons and introns laid out from 1: one, GT..AG, two; then again with a small exon in the middle
    first = quiet(40) + one + "GT" + quiet(100) + "AG" + two + quiet(50)
    second = one[::-1] + "GC" + quiet(70) + "AG" + mid + "GT" + quiet(80) + "AG" + two[::-1] + quiet(30)
    genome = first + second
    s, e = 41 + 60, 41 + 60 + 104
    read = one[-30:] + two[:30]
    hits = [(s - 30, s - 5, 0), (e + 4, e + 30, 34)]
    rows = [(1, 0, read, i, "a", False, p, q, d) for i, (p, q, d) in enumerate(hits)]
    rows += [(2, 1, flip(read), i, "a", True, p, q, d) for i, (p, q, d) in enumerate(hits)]
    base = len(first)
    s1, e1 = base + 61, base + 61 + 74
    s2, e2 = e1 + 12, e1 + 12 + 84
    joined = one[::-1][-25:] + mid + two[::-1][:25]
    rows += [(3, 2, joined, 0, "a", False, s1 - 25, s1 - 2, 0), (3, 2, joined, 1, "a", False, e2 + 1, e2 + 25, 38)]
    rows += [(4, 3, read, 1, "a", False, e + 4, e + 30, 34)]  # the first half must be found upstream
    assert searched(spark, genome, rows, max_edits=0) == sorted([(0, "a+", s, e, 1), (1, "a+", s, e, 1), (2, "a+", s1, e1, 1), (2, "a+", s2, e2, 1), (3, "a+", s, e, 1)])
    wrong = [(5, 4, read[:20] + ("A" if read[20] != "A" else "C") + read[21:], i, "a", False, p, q, d) for i, (p, q, d) in enumerate(hits)]
    assert searched(spark, genome, wrong, max_edits=0) == [] and searched(spark, genome, wrong, max_edits=2) == [(4, "a+", s, e, 1)]
    assert searched(spark, genome, rows[:2], min_intron=200) == [] and searched(spark, genome, rows[:0]) == []


def test_chains(spark):
    """Longest chains against all subsets, and clusters against pivots taken one after another."""
    rng = random.Random(8)
    rows = []
    for read in range(40):
        places = [rng.randint(1, 6) for _ in range(rng.randint(1, 7))]
        rows += [(read, *h) for h in sorted({("c" if rng.random() < 0.9 else "d", rng.random() < 0.1, p, p + 5, rng.randint(0, 5), rng.randint(0, 3)) for p in places})]
    frame = spark.createDataFrame(rows, "read_id long, rname string, reverse boolean, pos long, end_pos long, disp int, piece int")

    def fit(a, b):
        if a[:2] != b[:2] or (a[4] == b[4]) != (a[2] == b[2]):
            return False
        return a[4] == b[4] or (a[4] < b[4]) == (a[2] < b[2])

    def largest(hits):
        sets = [[h for i, h in enumerate(hits) if mask >> i & 1] for mask in range(1, 1 << len(hits))]
        sets = [x for x in sets if all(fit(a, b) for i, a in enumerate(x) for b in x[:i])]
        most = max(map(len, sets))
        return most, [x for x in sets if len(x) == most]

    size = {r["read_id"]: (r["size"], r["ways"]) for r in ch.longest_chains(frame, ["read_id"]).collect()}
    clusters, chosen = {}, {}
    for r in ch.pivot_clusters(frame, ["read_id"]).collect():
        clusters.setdefault(r["read_id"], {}).setdefault(r["cluster"], set()).add(tuple(r[c] for c in ch.HIT))
    for r in ch.selected_hits(frame, ["read_id"]).collect():
        chosen.setdefault(r["read_id"], set()).add(tuple(r[c] for c in ch.HIT))
    for read in range(40):
        hits = sorted(r[1:] for r in rows if r[0] == read)
        assert size[read] == (largest(hits)[0], len(largest(hits)[1]))
        rank = {h: hashlib.md5(":".join([str(read), h[0], str(h[1]).lower(), *map(str, h[2:])]).encode()).hexdigest() for h in hits}
        left, want = list(hits), []
        while left:
            pivot = min(left, key=rank.get)
            near = {pivot}
            for h in left:
                between = {x[5] for x in hits[min(hits.index(pivot), hits.index(h)) + 1 : max(hits.index(pivot), hits.index(h))]}
                if h != pivot and h[5] != pivot[5] and fit(h, pivot) and not between & {h[5], pivot[5]}:
                    near.add(h)
            want.append(near)
            left = [h for h in left if h not in near]
        assert sorted(map(sorted, clusters[read].values())) == sorted(map(sorted, want))
        best = [largest(sorted(c)) for c in want]
        tops = [x for most, sets in best if most == max(b[0] for b in best) for x in sets]
        assert chosen.get(read, set()) == (set(tops[0]) if len(tops) == 1 else set())


def test_lift_over(spark):
    """Random alignments to fragments: every base keeps its place, worked out base by base."""
    rng = random.Random(15)
    rows = []
    for i in range(80):
        exons = [rng.randint(3, 20) for _ in range(rng.randint(1, 4))]
        introns = [rng.randint(10, 90) for _ in exons[1:]]
        offset, room = (o := rng.randint(0, sum(exons) - 2)), sum(exons) - o
        ops = [(rng.randint(1, 4), "S")] if rng.random() < 0.3 else []
        while room > 0:
            n = min(room, rng.randint(1, 9))
            kind = rng.choice("MMMD") if ops and ops[-1][1] == "M" else "M"
            ops.append((n, kind)) if not ops or ops[-1][1] != kind else ops.__setitem__(-1, (ops[-1][0] + n, kind))
            room -= n
            if rng.random() < 0.3:
                break
            if rng.random() < 0.2:
                ops.append((rng.randint(1, 3), "I"))
        rows.append((i, 100 + i, exons, introns, offset, "".join(f"{n}{o}" for n, o in ops)))

    def slow(start, exons, introns, offset, cigar):
        place, at = [], start
        for k, n in enumerate(exons):
            place += range(at, at + n)
            at += n + (introns[k] if k < len(introns) else 0)
        out, here, last, crossed = [], offset, None, False
        for n, op in re.findall(r"(\d+)([A-Z])", cigar):
            for _ in range(int(n)):
                if op in "MD":
                    if last is not None and place[here] != last + 1:
                        out += ["N"] * (place[here] - last - 1)
                        crossed = True
                    last, here = place[here], here + 1
                out.append(op)
        return (place[offset], "".join(f"{len(list(g))}{k}" for k, g in itertools.groupby(out))) if crossed else (None, None)

    frame = spark.createDataFrame(rows, "i long, start long, exons array<long>, introns array<long>, offset long, cigar string")
    got = {r["i"]: (r["genome_pos"], r["genome_cigar"]) for r in ir.lift_over(frame, "start", "exons", "introns", "offset", "cigar").collect()}
    assert got == {i: slow(*rest) for i, *rest in rows} and any(p for p, _ in got.values())


def test_stretches(spark):
    genome = bases(random.Random(1), 87)
    chunks = spark.createDataFrame(cut_up(genome, 10), "rname string, chunk long, bases string")
    asked = [("a", o, n) for o in (-15, -3, 0, 7, 82, 86, 95) for n in (0, 1, 6, 30)]
    got = iv.stretches(spark.createDataFrame(asked, "rname string, offset long, size long"), chunks, 10).collect()
    for r in got:
        want = "".join(genome[i] if 0 <= i < len(genome) else "N" for i in range(r["offset"], r["offset"] + r["size"]))
        assert r["seq"] == want, (r["offset"], r["size"])
    assert len(got) == len(asked)


def test_fragments(spark):
    genome = bases(random.Random(2), 280)
    chunks = spark.createDataFrame(cut_up(genome, 10), "rname string, chunk long, bases string")
    configs = spark.createDataFrame([("a", "+", [31, 81], [51, 101], 12, 9)], "rname string, strand string, starts array<long>, ends array<long>, left_ext long, right_ext long")
    row = iv.fragments(configs, chunks, 10).first()
    assert row["start"] == 19 and row["exon_sizes"] == [12, 30, 9] and row["intron_sizes"] == [20, 20]
    assert row["sequence"] == genome[18:30] + genome[50:80] + genome[100:109]


def test_overlaps(spark):
    rng = random.Random(2)
    make = lambda n: [("k%d" % rng.randint(0, 1), s := rng.randint(0, 90), s + rng.randint(0, 40), i) for i in range(n)]
    a, b = make(40), make(40)
    frames = [spark.createDataFrame(x, "k string, start long, end_pos long, id long") for x in (a, b)]
    want = {(x[3], y[3]) for x in a for y in b if x[0] == y[0] and x[1] < y[2] and y[1] < x[2] and x[2] > x[1] and y[2] > y[1]}
    got = [(r["id"], r["id_b"]) for r in iv.overlap_join(*frames, ["k"], 8).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_precision_recall(spark):
    s = "k int, sample int"
    t, c = spark.createDataFrame([(1, 0), (2, 0), (2, 0)], s), spark.createDataFrame([(2, 0), (3, 0), (9, 1)], s)
    got = {r["sample"]: (r["tp"], r["precision"], r["recall"]) for r in mt.precision_recall(t, c, ["k", "sample"], ["sample"]).collect()}
    assert got == {0: (1, 0.5, 0.5), 1: (0, 0.0, 1.0)}


def test_regions(spark):
    """Regions and clusters of runs over many bins against one walk."""
    rng = random.Random(3)
    at, runs = 0, []
    for _ in range(200):
        at += rng.choice([0, 0, 0, 5, 40, 200])
        size = rng.randint(1, 30)
        runs.append(("c", at, at + size, rng.randint(0, 6)))
        at += size
    want, cluster, last = [], 0, None
    for _, s, e, v in (r for r in runs if r[3] >= 3):
        if want and want[-1][1] == s:
            want[-1][1:3] = [e, want[-1][2] + v * (e - s)]
        else:
            cluster += last is None or s - last > 50
            want.append([s, e, v * (e - s), cluster])
        last = e
    for size in (16, 100, 10**6):
        got = cv.expressed_regions(spark.createDataFrame(runs, "rname string, start long, end_pos long, value long"), 3, 50, bin_size=size).collect()
        assert sorted((r["start"], r["end_pos"], round(r["mean"], 6), r["cluster"]) for r in got) == [(s, e, round(v / (e - s), 6), c) for s, e, v, c in want]
