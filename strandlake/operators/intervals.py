"""Interval joins and sequential interval operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandlake.functions.align import clip_size


def overlap_join(a: DataFrame, b: DataFrame, keys: Sequence[str], bin_size: int = 1024, kind: str = "any") -> DataFrame:
    """Pairs of rows with equal keys whose [start, end_pos) overlap; b's columns get the suffix ``_b``.

    Both sides are put into bins, the join is an equi-join on keys and bin, and a pair that
    meets in several bins counts in the first common one. ``kind`` may also be ``equal``,
    ``start`` or ``end``, which are plain equi-joins on the bounds.
    """
    right = b.select(*keys, *(F.col(c).alias(f"{c}_b") for c in b.columns if c not in keys))
    if kind != "any":
        bounds = {"equal": ["start", "end_pos"], "start": ["start"], "end": ["end_pos"]}[kind]
        right = right.select(*(F.col(k).alias(f"_{k}") for k in keys), *(c for c in right.columns if c not in keys))
        on = [F.col(k) == F.col(f"_{k}") for k in keys] + [F.col(x) == F.col(f"{x}_b") for x in bounds]
        return a.join(right, on).drop(*(f"_{k}" for k in keys))
    bins = lambda s, e: F.explode(F.sequence(F.floor(F.col(s) / bin_size), F.floor((F.col(e) - 1) / bin_size)))
    left = a.where("end_pos > start").withColumn("_bin", bins("start", "end_pos"))
    right = right.where("end_pos_b > start_b").withColumn("_bin", bins("start_b", "end_pos_b"))
    met = left.join(right, [*keys, "_bin"]).where((F.col("start") < F.col("end_pos_b")) & (F.col("start_b") < F.col("end_pos")))
    return met.where(F.col("_bin") == F.floor(F.greatest("start", "start_b") / bin_size)).drop("_bin")


def direct_successors(introns: DataFrame, keys: Sequence[str], min_overlap: int = 1, bin_size: int = 4096) -> DataFrame:
    """Pairs A, B of introns with B right of A and none between: the edges of the intron graph.

    What follows A directly begins before the least end among all that begin behind A. That
    end, and where the first of them begins, come from sweeps over starts from the right, inside
    cells of ``bin_size`` positions and then across a key's cells, and the pairs from a binned
    join, so no intron is compared with all behind it and no task sorts a whole contig.
    """
    nodes = introns.select(*keys, "start", "end_pos").distinct()
    points = nodes.select(*keys, (F.col("end_pos") + min_overlap).alias("at"), F.lit(None).cast("bigint").alias("stop"), F.lit(1).alias("ask"), "start", "end_pos")
    stops = nodes.select(*keys, F.col("start").alias("at"), F.col("end_pos").alias("stop"), F.lit(0).alias("ask"), "start", "end_pos")
    events = points.unionByName(stops).withColumn("_cell", F.floor(F.col("at") / bin_size)).withColumn("begin", F.when(F.col("ask") == 0, F.col("at")))
    back = Window.partitionBy(*keys, "_cell").orderBy(F.col("at").desc(), "ask").rowsBetween(Window.unboundedPreceding, 0)
    behind = Window.partitionBy(*keys).orderBy(F.col("_cell").desc()).rowsBetween(Window.unboundedPreceding, -1)
    cells = events.groupBy(*keys, "_cell").agg(F.min("stop").alias("_stop"), F.min("begin").alias("_begin"))
    cells = cells.select(*keys, "_cell", F.min("_stop").over(behind).alias("_stop"), F.min("_begin").over(behind).alias("_begin"))
    asked = events.withColumn("_s", F.min("stop").over(back)).withColumn("_b", F.min("begin").over(back)).where("ask = 1").join(cells, [*keys, "_cell"])
    asked = asked.withColumn("least", F.least("_s", "_stop")).where("least is not null")
    reach = asked.select(*keys, F.col("start").alias("a_start"), F.col("end_pos").alias("a_end"), F.least("_b", "_begin").alias("lo"), (F.col("least") + min_overlap).alias("hi"))
    reach = reach.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("lo") / bin_size), F.floor((F.col("hi") - 1) / bin_size))))
    begin = nodes.select(*keys, F.col("start").alias("b_start"), F.col("end_pos").alias("b_end"), F.floor(F.col("start") / bin_size).alias("_bin"))
    return reach.join(begin, [*keys, "_bin"]).where("b_start >= lo and b_start < hi").select(*keys, "a_start", "a_end", "b_start", "b_end")


def exon_gaps(exons: DataFrame, key: str, least: int = 5) -> DataFrame:
    """Introns between consecutive exons of a transcript, of ``least`` bases or more."""
    w = Window.partitionBy(key).orderBy("start", "end_pos")
    return exons.select(key, F.lag("end_pos").over(w).alias("intron_start"), F.col("start").alias("intron_end")).where(F.col("intron_end") - F.col("intron_start") >= least)


def sizes_to_introns(rows: DataFrame, start: str, exon_sizes: str, intron_sizes: str, keep: Sequence[str]) -> DataFrame:
    """Intron bounds from a first position and alternating exon and intron sizes."""
    steps = F.arrays_zip(F.col(exon_sizes).alias("e"), F.col(intron_sizes).alias("i"))
    begin = F.struct(F.col(start).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,end_pos:bigint>>").alias("out"))

    def step(s, x):
        low = s["at"] + x["e"]
        high = low + x["i"]
        span = F.array(F.struct(low.cast("bigint").alias("start"), high.cast("bigint").alias("end_pos")))
        return F.struct(F.coalesce(high, low).cast("bigint").alias("at"), F.when(x["i"].isNull(), s["out"]).otherwise(F.concat(s["out"], span)).alias("out"))

    return rows.select(*keep, F.explode(F.aggregate(steps, begin, step, lambda s: s["out"])).alias("x")).select(*keep, "x.start", "x.end_pos")


def blocks_to_introns(rows: DataFrame, start: str, sizes: str, offsets: str, keep: Sequence[str]) -> DataFrame:
    """Intron bounds between the blocks of a BED12 row (offsets from its start)."""
    n = F.size(sizes)
    gap = lambda i: F.struct(
        (F.col(start) + F.get(F.col(offsets), i) + F.get(F.col(sizes), i)).alias("start"), (F.col(start) + F.get(F.col(offsets), i + 1)).alias("end_pos")
    )
    gaps = F.when(n > 1, F.transform(F.sequence(F.lit(0), n - 2), gap))
    return rows.select(*keep, F.explode(gaps).alias("x")).select(*keep, "x.start", "x.end_pos")


def stretches(asked: DataFrame, chunks: DataFrame, chunk_size: int) -> DataFrame:
    """Reference bases ``seq`` for each (rname, offset, size), 0-based, with N outside the contig and its chunks.

    ``chunks`` has rname, chunk and bases, ``chunk_size`` bases in each but the last one.
    """
    keyed = asked.select("rname", "offset", "size").distinct()
    wanted = keyed.where("size > 0").withColumn("chunk", F.explode(F.sequence(F.floor(F.col("offset") / chunk_size), F.floor((F.col("offset") + F.col("size") - 1) / chunk_size))))
    met = wanted.join(chunks, ["rname", "chunk"], "left")
    first = F.col("chunk") * chunk_size
    low, high = F.greatest("offset", first), F.least(F.col("offset") + F.col("size"), first + chunk_size)
    piece = F.rpad(F.substring(F.coalesce("bases", F.lit("")), (low - first + 1).cast("int"), (high - low).cast("int")), (high - low).cast("int"), "N")
    parts = met.groupBy("rname", "offset", "size").agg(F.array_sort(F.collect_list(F.struct("chunk", piece.alias("p")))).alias("parts"))
    found = parts.select("rname", "offset", "size", F.array_join(F.col("parts.p"), "").alias("seq"))
    return asked.join(found, ["rname", "offset", "size"], "left").withColumn("seq", F.coalesce("seq", F.lit("")))


def clipped_slices(alignments: DataFrame, chunks: DataFrame, chunk_size: int, keys: Sequence[str]) -> DataFrame:
    """Reference bases next to an alignment under its soft clips: ``left_bases``, ``right_bases``, empty without a clip.

    ``alignments`` has the keys, rname, pos and cigar; a row comes back for each with a clip.
    """
    left, right = clip_size(F.col("cigar"), "left").cast("bigint"), clip_size(F.col("cigar"), "right").cast("bigint")
    taken = F.regexp_extract_all(F.col("cigar"), F.lit(r"(\d+)[MDN=X]"), F.lit(1))
    end = F.col("pos") + F.aggregate(F.transform(taken, lambda n: n.cast("bigint")), F.lit(0).cast("bigint"), lambda a, n: a + n)
    sides = F.array(
        F.struct(F.lit("left_bases").alias("side"), (F.col("pos") - 1 - left).alias("offset"), left.alias("size")),
        F.struct(F.lit("right_bases").alias("side"), (end - 1).alias("offset"), right.alias("size")),
    )
    asked = alignments.select(*keys, "rname", F.explode(sides).alias("x")).select(*keys, "rname", "x.*").where("size > 0")
    side = lambda name: F.coalesce(F.max(F.when(F.col("side") == name, F.col("seq"))), F.lit("")).alias(name)
    return stretches(asked, chunks, chunk_size).groupBy(*keys).agg(side("left_bases"), side("right_bases"))


def fragments(configs: DataFrame, chunks: DataFrame, chunk_size: int) -> DataFrame:
    """Spliced reference of each configuration (rname, strand, starts, ends, left_ext, right_ext): a header and its bases.

    The header has the 1-based start, exon sizes and intron sizes; the bases are the left
    extension, the exons between the introns, and the right extension, cut at the contig's start.
    """
    left = F.greatest(F.col("starts")[0] - F.col("left_ext"), F.lit(1)).cast("bigint")
    begins = F.concat(F.array(left), F.col("ends"))
    stops = F.concat(F.col("starts"), F.array(F.element_at("ends", -1) + F.col("right_ext")))
    placed = configs.withColumn("start", left).withColumn("exon_sizes", F.zip_with(stops, begins, lambda s, b: s - b)).withColumn(
        "intron_sizes", F.zip_with("ends", "starts", lambda e, s: e - s)
    )
    parts = placed.select("*", F.posexplode(F.arrays_zip(begins.alias("b"), stops.alias("s"))).alias("part", "x")).select(
        *placed.columns, "part", (F.col("x.b") - 1).alias("offset"), (F.col("x.s") - F.col("x.b")).alias("size")
    )
    bases = stretches(parts, chunks, chunk_size)
    keys = ["rname", "strand", "start", "exon_sizes", "intron_sizes"]
    whole = bases.groupBy(*keys).agg(F.array_sort(F.collect_set(F.struct("part", "seq"))).alias("p"))
    return whole.select(*keys, F.array_join(F.col("p.seq"), "").alias("sequence"))
