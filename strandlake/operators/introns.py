"""Introns inferred from the hits of a read's pieces, and alignments to fragments lifted back over introns.

Reads and the reference around their gaps are joined as rows; motifs, matches and scores are
array and string functions inside a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandlake.functions.seq import FORWARD_MOTIFS, REVERSE_MOTIFS, global_score, revcomp
from strandlake.operators.dataflow import let, union_all
from strandlake.operators.intervals import stretches
from strandlake.session import written


def suffix_match(query: Column, window: Column, least: int = 8, most: int = 5) -> Column:
    """Struct of ``offset`` and ``size`` of the longest suffix of ``query`` in ``window``, the nearest to its start among equals.

    Only places of the last ``least`` bases count at which the whole query has room before
    them. Null if there are none or more than ``most``, or if the first is the very first
    place that has the room.
    """
    return let(query, lambda q: let(window, lambda w: _suffix_match(q, w, least, most)))


def _suffix_match(query: Column, window: Column, least: int, most: int) -> Column:
    room = F.length(query) - least

    def places(tail):
        """Up to one place more than ``most``, each looked for from behind the one before."""
        def look(s, _):
            at = F.call_function("locate", tail, window, s["next"] + 1)
            return F.when(at > 0, F.struct(at.alias("next"), F.concat(s["found"], F.array(at - 1)).alias("found"))).otherwise(F.struct(F.length(window).alias("next"), s["found"].alias("found")))

        begin = F.struct(room.alias("next"), F.array().cast("array<int>").alias("found"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(most + 1)), begin, look, lambda s: s["found"])

    def longest(p):
        """As many bases as agree when both are read backwards from the end of the tail."""
        sizes = F.sequence(F.lit(1), F.least(F.length(query), p + least))
        backward = lambda text, end, k: F.substring(text, end - k + 1, F.lit(1))
        differs = F.array_position(F.transform(sizes, lambda k: backward(query, F.length(query), k) == backward(window, p + least, k)), F.lit(False)).cast("int")
        return let(differs, lambda d: let(F.when(d == 0, F.size(sizes)).otherwise(d - 1), lambda size: F.struct((-size).alias("less"), (p + least - size).alias("offset"))))

    def best(found):
        fine = (F.size(found) > 0) & (F.size(found) <= most) & (F.get(found, 0) > room)
        return F.when(fine, let(F.array_min(F.transform(found, longest)), lambda x: F.struct(x["offset"].alias("offset"), (-x["less"]).alias("size"))))

    tail = F.substring(query, room + 1, F.lit(least))
    return F.when((room >= 0) & (F.length(window) - least >= room), let(let(tail, places), best))


def _motif(first: Column, last: Column, allowed) -> Column:
    """Whether an intron that begins with ``first`` and ends with ``last`` is on the reverse strand; null if no motif fits."""
    pair = F.concat(first, last)
    forward = ["".join(m) for m in FORWARD_MOTIFS if m in allowed]
    backward = ["".join(m) for m in REVERSE_MOTIFS if m in allowed]
    return F.when(pair.isin(*backward) if backward else F.lit(False), True).when(pair.isin(*forward) if forward else F.lit(False), False)


def _with_stretches(rows: DataFrame, asked: dict[str, tuple[Column, Column]], chunks: DataFrame, chunk_size: int) -> DataFrame:
    """``rows``, written already, with the upper-case reference bases of each (offset, size) on ``rname`` by name; none for a null or no size."""
    spans = {n: (o.cast("bigint").alias("offset"), F.greatest(F.coalesce(k, F.lit(0)), F.lit(0)).cast("bigint").alias("size")) for n, (o, k) in asked.items()}
    wanted = union_all(*(rows.select("rname", o, k) for o, k in spans.values())).where("size > 0").distinct()
    found = written(stretches(wanted, chunks, chunk_size), "stretches")
    for name, (offset, size) in spans.items():
        mine = found.select(F.col("rname").alias("_rname"), F.col("offset").alias("_offset"), F.col("size").alias("_size"), F.upper("seq").alias(name))
        keyed = rows.withColumn("_o", offset).withColumn("_k", size)
        same = (F.col("rname") == F.col("_rname")) & (F.col("_o") == F.col("_offset")) & (F.col("_k") == F.col("_size"))
        rows = keyed.join(mine, same, "left").withColumn(name, F.coalesce(name, F.lit(""))).drop("_rname", "_offset", "_size", "_o", "_k")
    return rows


def extended_hits(reads: DataFrame, chunks: DataFrame, chunk_size: int, window: int, min_exon: int) -> DataFrame:
    """``reads`` with a hit more at either end of ``hits`` where the bases beyond it are found nearby.

    Before the first hit the longest prefix of the read is looked for, behind the last one the
    longest suffix, up to ``window`` bases away and the nearest first.
    """
    first, last = F.get("hits", 0), F.element_at("hits", -1)
    rest = F.length("read") - (last["end_pos"] - last["pos"] + last["disp"])
    low, at = F.greatest(first["pos"] - 1 - window, F.lit(0)), last["end_pos"] - 1
    opens, closes = first["disp"] >= min_exon, (rest >= min_exon) & (last["end_pos"] + rest - 1 <= F.col("length"))
    rows = _with_stretches(reads, {
        "_before": (low, F.when(opens, first["pos"] - 1 - low)), "_behind": (at, F.when(closes, F.least(F.lit(window), F.col("length") - at))),
    }, chunks, chunk_size)
    rows = rows.withColumns({
        "_head": F.when(opens, F.reverse(F.substring(F.col("read"), F.lit(1), first["disp"]))), "_before": F.reverse("_before"),
        "_tail": F.when(closes, F.substring(F.col("read"), (F.length("read") - rest + 1).cast("int"), rest.cast("int"))),
    })
    rows = rows.withColumns({"_a": suffix_match(F.col("_head"), F.col("_before"), min_exon), "_b": suffix_match(F.col("_tail"), F.col("_behind"), min_exon)})
    hit = lambda disp, pos, end: F.array(F.struct(disp.cast("int").alias("disp"), pos.cast("bigint").alias("pos"), end.cast("bigint").alias("end_pos")))
    none = F.array().cast("array<struct<disp:int,pos:bigint,end_pos:bigint>>")
    stop, begin = first["pos"] - F.col("_a.offset"), last["end_pos"] + F.col("_b.offset")
    hits = F.concat(
        F.when(F.col("_a").isNotNull(), hit(F.lit(0), stop - F.col("_a.size"), stop)).otherwise(none), "hits",
        F.when(F.col("_b").isNotNull(), hit(F.length("read") - F.col("_b.size"), begin, begin + F.col("_b.size"))).otherwise(none),
    )
    return rows.withColumn("hits", hits).select(*reads.columns)


def search_junctions(
    hits: DataFrame, chunks: DataFrame, chunk_size: int, contigs: DataFrame, *, min_exon: int = 9, min_intron: int = 10, max_intron: int = 500_000,
    window: int = 1000, radius: int = 5, stranded: bool = False, max_edits: float | None = None,
) -> DataFrame:
    """Introns that explain the gaps between the consistent hits of each read, one row per read that shows one.

    ``hits`` has read_id, sample, read_seq, rname, reverse, pos, end_pos, disp (see
    ``chains.selected_hits``); ``contigs`` rname and length; ``chunks`` the reference.

    Between neighbouring hits the reference is longer than the read by the unexplained bases. An
    intron begins near the left hit's end or as far as these from the right hit's begin, and
    ends likewise, within ``radius``, and has a splice motif. One of just that size is scored by
    aligning the read there to the reference without it. One longer by ``min_exon`` or more
    leaves bases of the read over: these, with motifs on both sides, are looked for as a small
    exon in the first or last ``window`` bases inside, which makes two introns. The best
    score's introns are kept, unless it is below minus ``max_edits`` percent of the read.
    """
    keys = ["read_id", "sample"]
    hit = F.struct(F.col("disp").cast("int").alias("disp"), F.col("pos").cast("bigint").alias("pos"), F.col("end_pos").cast("bigint").alias("end_pos"))
    seq = F.upper("read_seq")
    reads = hits.groupBy(*keys, "rname", "reverse").agg(F.array_sort(F.collect_set(hit)).alias("hits"), F.first(F.when(F.col("reverse"), revcomp(seq)).otherwise(seq)).alias("read"))
    reads = written(reads.join(contigs.select("rname", F.col("length").cast("bigint")), "rname"), "reads")
    if window:
        reads = extended_hits(reads, chunks, chunk_size, window, min_exon)
    pairs = F.zip_with(F.slice("hits", F.lit(1), F.size("hits") - 1), F.slice("hits", F.lit(2), F.size("hits")), lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    gaps = reads.select(*keys, "rname", "reverse", "read", F.posexplode(pairs).alias("gap", "p")).select(
        *keys, "rname", "reverse", "read", "gap", F.col("p.x.pos").alias("ls"), F.col("p.x.end_pos").alias("le"), F.col("p.x.disp").alias("ld"),
        F.col("p.y.pos").alias("rs"), F.col("p.y.end_pos").alias("re"), F.col("p.y.disp").alias("rd"),
    )
    c = F.col
    gaps = gaps.withColumn("span", c("rd") + c("re") - c("rs") - c("ld")).withColumn("missing", c("re") - c("ls") - c("span")).where(c("missing") > min_intron)
    # where introns may begin and end
    gaps = gaps.select(
        "*", (F.least("le", c("rs") - c("missing")) - radius).alias("s0"), (F.greatest("le", c("rs") - c("missing")) + radius - 2).alias("s1"),
        (F.least("rs", c("le") + c("missing")) - radius).alias("e0"), (F.greatest("rs", c("le") + c("missing")) + radius).alias("e1"),
        F.substring("read", c("ld") + 1, c("span").cast("int")).alias("part"),
    ).where("s1 >= s0").withColumn("at", F.least("ls", "s0")).withColumn("upto", F.greatest("re", "e1"))
    gaps = written(gaps, "gaps")
    gaps = _with_stretches(gaps, {"left": (c("at") - 1, c("s1") + 2 - c("at")), "right": (c("e0") - 3, c("upto") - c("e0") + 2)}, chunks, chunk_size)
    bases = lambda text, begin, lo, hi: F.substring(text, (lo - begin + 1).cast("int"), F.greatest(hi - lo, F.lit(0)).cast("int"))
    left = lambda lo, hi: bases(c("left"), c("at"), lo, hi)
    right = lambda lo, hi: bases(c("right"), c("e0") - 2, lo, hi)
    flanked = lambda s, between, e: F.concat(left(c("ls"), s), between, right(e, c("re")))
    every = {*FORWARD_MOTIFS, *REVERSE_MOTIFS}

    def motif(first, last):
        if not stranded:
            return _motif(first, last, every)
        return F.when(c("reverse"), _motif(first, last, set(REVERSE_MOTIFS))).otherwise(_motif(first, last, set(FORWARD_MOTIFS)))

    def intron(s, e):
        return F.struct(s.alias("s"), e.alias("e"), motif(left(s, s + 2), right(e - 2, e)).alias("back"))

    fits = lambda x: x["back"].isNotNull() & (x["e"] - x["s"]).between(min_intron, max_intron)
    starts = F.filter(F.sequence("s0", "s1"), lambda s: left(s, s + 2).isin(*sorted({m[0] for m in every})))
    stops = F.filter(F.sequence("e0", "e1"), lambda e: right(e - 2, e).isin(*sorted({m[1] for m in every})))
    plain = F.filter(F.transform("starts", lambda s: intron(s, s + c("missing"))), fits)
    scored = F.transform(plain, lambda x: F.struct(global_score(c("part"), flanked(x["s"], F.lit(""), x["e"])).alias("score"), x["back"].alias("back"), x["s"].alias("s"), x["e"].alias("e")))
    found = gaps.withColumn("starts", starts).withColumn("plain", scored)
    if window:
        behind = lambda s, stops: F.transform(F.filter(stops, lambda e: e >= s + c("missing") + min_exon), lambda e: intron(s, e))
        longer = let(stops, lambda stops: F.flatten(F.transform("starts", lambda s: F.filter(behind(s, stops), fits))))
        found = found.withColumn("longer", longer)
    found = written(found, "candidates")
    candidates = found.select(*keys, "rname", "gap", F.explode("plain").alias("x"), F.length("read").alias("n")).select(*keys, "rname", "gap", "n", "x.*")
    if window:
        candidates = candidates.unionByName(_small_exons(found.where(F.size("longer") > 0), chunks, chunk_size, keys, window, min_intron, max_intron, motif, flanked))
    best = Window.partitionBy(*keys, "gap")
    kept = candidates.withColumn("best", F.max("score").over(best)).where("score = best")
    if max_edits is not None:
        kept = kept.where(F.col("score") >= -max_edits * F.col("n") / 100)
    strand = F.concat("rname", F.when(F.col("back"), "-").otherwise("+"))
    return kept.select("read_id", strand.alias("rname_strand"), c("s").alias("start"), c("e").alias("end_pos"), c("sample").cast("int").alias("sample")).distinct().select(
        "rname_strand", "start", "end_pos", "sample", F.lit(1).cast("bigint").alias("count"))


def _small_exons(gaps: DataFrame, chunks: DataFrame, chunk_size: int, keys: list[str], window: int, min_intron: int, max_intron: int, motif, flanked) -> DataFrame:
    """Candidates of two introns with a small exon between, from the gaps' ``longer`` pairs of ends."""
    c = F.col
    rows = gaps.withColumn("lo", F.array_min(F.transform("longer", lambda x: x["s"]))).withColumn("hi", F.array_max(F.transform("longer", lambda x: x["e"])))
    short = c("hi") - c("lo") <= 2 * window + 2 * chunk_size
    reach = F.when(short, c("hi") - c("lo")).otherwise(F.array_max(F.transform("longer", lambda x: x["s"])) + window - c("lo"))
    rows = rows.withColumn("reach", reach).withColumn("far", F.when(~short, F.array_min(F.transform("longer", lambda x: x["e"])) - window))
    rows = _with_stretches(written(rows, "longer"), {"near_text": (c("lo") - 1, c("reach")), "far_text": (c("far") - 1, c("hi") - c("far"))}, chunks, chunk_size)
    one = rows.withColumn("x", F.explode("longer")).drop("longer", "plain").withColumn("s", c("x.s")).withColumn("e", c("x.e"))
    # bases of the read that neither side explains, and the parts of the intron to look for them in
    begin = c("ld") + c("s") - c("ls")
    one = one.withColumn("exon", F.substring("read", (begin + 1).cast("int"), (c("e") - c("s") - c("missing")).cast("int"))).where((begin >= 0) & (F.length("exon") == c("e") - c("s") - c("missing")))
    span = lambda a, b: F.struct(a.alias("a"), b.alias("b"))
    parts = F.when(c("e") - c("s") <= 2 * window, F.array(span(c("s"), c("e")))).otherwise(F.array(span(c("s"), c("s") + window), span(c("e") - window, c("e"))))
    one = one.withColumn("part_of", F.explode(parts)).withColumn("a", c("part_of.a")).withColumn("b", c("part_of.b"))
    near = c("b") <= c("lo") + c("reach")
    cut = lambda text, low: F.substring(text, (c("a") - low + 1).cast("int"), (c("b") - c("a")).cast("int"))
    one = one.withColumn("text", F.when(near, cut(c("near_text"), c("lo"))).otherwise(cut(c("far_text"), c("far")))).where(F.col("text").contains(c("exon")))
    size = F.length("exon")
    places = F.filter(F.sequence(F.lit(1), F.length("text")), lambda i: F.substring("text", i, size) == c("exon"))
    one = one.withColumn("i", F.explode(places)).withColumn("at_exon", c("a") + c("i") - 1).where("i > 2 and i + length(exon) + 1 <= length(text)")
    after, prior = F.substring("text", c("i") - 2, F.lit(2)), F.substring("text", c("i") + size, F.lit(2))
    # the bases at the outer ends are in the texts of the gap
    outer_first = F.substring("left", (c("s") - c("at") + 1).cast("int"), F.lit(2))
    outer_last = F.substring("right", (c("e") - c("e0") + 1).cast("int"), F.lit(2))
    one = one.withColumn("first_back", motif(outer_first, after)).withColumn("last_back", motif(prior, outer_last)).where("first_back is not null and last_back is not null")
    score = global_score(c("part"), flanked(c("s"), c("exon"), c("e")))
    two = F.array(F.struct(c("first_back").alias("back"), c("s").alias("s"), c("at_exon").alias("e")), F.struct(c("last_back").alias("back"), (c("at_exon") + size).alias("s"), c("e").alias("e")))
    split = one.select(*keys, "rname", "gap", F.length("read").alias("n"), score.alias("score"), F.explode(two).alias("y")).select(*keys, "rname", "gap", "n", "score", "y.back", "y.s", "y.e")
    return split.where((c("e") - c("s")).between(min_intron, max_intron))


def lift_over(rows: DataFrame, start: str, exon_sizes: str, intron_sizes: str, offset: str, cigar: str) -> DataFrame:
    """``rows`` with ``genome_pos`` and ``genome_cigar`` of alignments to fragments, their introns put back in.

    ``offset`` is 0-based on the fragment; ``exon_sizes`` has one entry more than ``intron_sizes``.
    Both results are null if the alignment crosses no intron. Each operation that takes up
    reference is cut at the borders inside of it; an intron goes before what begins at a border
    behind the alignment's start, and equal neighbours in the result become one.
    """
    c = F.col
    entry = "array<struct<n:bigint,op:string>>"
    sizes = F.transform(F.regexp_extract_all(c(cigar), F.lit(r"(\d+)[A-Z=]"), F.lit(1)), lambda x: x.cast("bigint"))
    letters = F.regexp_extract_all(c(cigar), F.lit(r"\d+([A-Z=])"), F.lit(1))
    ops = F.zip_with(sizes, letters, lambda n, o: F.struct(n.alias("n"), o.alias("op")))
    ends = F.aggregate(
        F.slice(c(exon_sizes), F.lit(1), F.size(intron_sizes)), F.array().cast("array<bigint>"),
        lambda a, n: F.concat(a, F.array((F.coalesce(F.get(a, F.size(a) - 1), F.lit(0)) + n).cast("bigint"))),
    )
    borders = F.zip_with(ends, c(intron_sizes), lambda b, n: F.struct(b.alias("at"), n.cast("bigint").alias("n")))
    named = rows.select("*", F.col(offset).cast("bigint").alias("_from"), borders.alias("_borders"), ops.alias("_ops"))

    def place(state, x):
        takes = x["op"].isin("M", "D", "N")
        stop = state["here"] + F.when(takes, x["n"]).otherwise(F.lit(0))
        inside = F.filter("_borders", lambda b: takes & (b["at"] >= state["here"]) & (b["at"] < stop) & (b["at"] > c("_from")))
        # cuts: from each border to the next one or the end
        starts = F.transform(inside, lambda b: b["at"])
        head = F.struct((F.coalesce(F.get(starts, 0), stop) - state["here"]).alias("n"), x["op"].alias("op"))
        pieces = F.flatten(F.transform(inside, lambda b, i: F.array(
            F.struct(b["n"].alias("n"), F.lit("N").alias("op")), F.struct((F.coalesce(F.get(starts, i + 1), stop) - b["at"]).alias("n"), x["op"].alias("op")))))
        new = F.when(takes, F.filter(F.concat(F.array(head), pieces), lambda p: p["n"] > 0)).otherwise(F.array(x))
        return F.struct(stop.alias("here"), F.concat(state["out"], new.cast(entry)).alias("out"))

    placed = F.aggregate("_ops", F.struct(c("_from").alias("here"), F.array().cast(entry).alias("out")), place, lambda s: s["out"])

    def join(out, x):
        last = F.get(out, F.size(out) - 1)
        both = F.concat(F.slice(out, F.lit(1), F.size(out) - 1), F.array(F.struct((last["n"] + x["n"]).alias("n"), x["op"].alias("op"))))
        return F.when(last["op"] == x["op"], both).otherwise(F.concat(out, F.array(x)))

    before = F.aggregate(F.filter("_borders", lambda b: b["at"] <= c("_from")), F.lit(0).cast("bigint"), lambda t, b: t + b["n"])
    named = named.withColumn("_placed", placed).withColumn("_merged", F.aggregate("_placed", F.array().cast(entry), join))
    crosses = F.size("_placed") > F.size(F.filter("_ops", lambda o: o["n"] > 0))
    text = F.array_join(F.transform("_merged", lambda x: F.concat(x["n"].cast("string"), x["op"])), "")
    return named.select(
        *rows.columns, F.when(crosses, c(start) + c("_from") + before).alias("genome_pos"), F.when(crosses, text).alias("genome_cigar")
    )
