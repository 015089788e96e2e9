"""Functions on alignments: flags, scores, CIGAR and MD strings, as Column expressions.

All of them work inside a row: a CIGAR is parsed into an array of operations with the
reference and read offset of each, so decomposing an alignment shuffles nothing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNMAPPED, REVERSE, MATE_2, SECONDARY = 4, 16, 128, 256


def has_flag(flag: Column, bit: int) -> Column:
    return flag.bitwiseAND(F.lit(bit)) != 0


def set_secondary(flag: Column) -> Column:
    return flag.bitwiseOR(F.lit(SECONDARY))


def set_primary(flag: Column) -> Column:
    return flag.bitwiseAND(F.lit(~SECONDARY))


def flip_strand(flag: Column) -> Column:
    return flag.bitwiseXOR(F.lit(REVERSE))


def clip_size(cigar: Column, side: str = "left") -> Column:
    """Soft-clipped bases at one end."""
    found = F.regexp_extract(cigar, r"^(\d+)S" if side == "left" else r"(\d+)S$", 1)
    return F.when(found == "", 0).otherwise(found.try_cast("int"))


def passes_clip_filter(cigar: Column, least: int = 1) -> Column:
    """Whether an end is clipped by ``least`` bases or more."""
    return (clip_size(cigar, "left") >= least) | (clip_size(cigar, "right") >= least)


def clip_filter_size(name: str, min_exon: int = 9) -> int:
    """``none``, ``mild`` and ``strict`` clip filters, or a number, as bases."""
    return {"none": 1, "mild": min_exon * 2 // 3, "strict": min_exon}.get(name) or int(name)


def is_exact(nm: Column, cigar: Column) -> Column:
    return (nm == 0) & ~cigar.contains("S")


def margin_of(length: Column, margin: float) -> Column:
    """Score margin for a read of a length, halves away from zero."""
    return F.round(F.lit(float(margin)) * length / 100).cast("int")


def is_unique(as_score: Column, xs_score: Column, length: Column, margin: float = 0) -> Column:
    """Whether the second-best score is missing or falls short of the best by more than the margin."""
    return F.coalesce(xs_score + margin_of(length, margin) < as_score, F.lit(True))


def cigar_ops(cigar: Column) -> Column:
    """Array of (op, size) of a CIGAR string."""
    found = F.regexp_extract_all(cigar, F.lit(r"\d+[MINDS]"), F.lit(0))
    return F.transform(
        found, lambda x: F.struct(F.right(x, F.lit(1)).alias("op"), F.substring(x, F.lit(1), F.length(x) - 1).cast("int").alias("size"))
    )


def md_tokens(md: Column) -> Column:
    """An MD string cut where digits, letters and carets meet, without zeros."""
    return F.filter(F.regexp_extract_all(md, F.lit(r"\^+|[A-Za-z]+|\d+"), F.lit(0)), lambda t: t != "0")


def placed_ops(cigar: Column, pos: Column) -> Column:
    """Operations with where each begins: on the reference, in the read, and among aligned and deleted bases."""
    kind = "array<struct<op:string,size:int,ref:bigint,read:int,aligned:int>>"
    start = F.struct(
        F.array().cast(kind).alias("out"), pos.cast("bigint").alias("ref"), F.lit(0).alias("read"), F.lit(0).alias("aligned")
    )

    def step(s, x):
        place = F.struct(x["op"].alias("op"), x["size"].alias("size"), s["ref"].alias("ref"), s["read"].alias("read"), s["aligned"].alias("aligned"))
        moved = lambda ops: F.when(x["op"].isin(*ops), x["size"]).otherwise(0)
        return F.struct(
            F.concat(s["out"], F.array(place)).alias("out"), (s["ref"] + moved("MDN")).alias("ref"),
            (s["read"] + moved("MIS")).alias("read"), (s["aligned"] + moved("MD")).alias("aligned"),
        )

    return F.aggregate(cigar_ops(cigar), start, step, lambda s: s["out"])


def junctions(ops: Column, length: Column) -> Column:
    """(start, end_pos, left, right) of skipped reference, with read bases on both sides."""
    return F.transform(
        F.filter(ops, lambda o: o["op"] == "N"),
        lambda o: F.struct(o["ref"].alias("start"), (o["ref"] + o["size"]).alias("end_pos"), o["read"].alias("left"), (length - o["read"]).alias("right")),
    )


def insertions(ops: Column, seq: Column) -> Column:
    """(pos, seq) of inserted bases; ``pos`` is the base before."""
    return F.transform(
        F.filter(ops, lambda o: o["op"] == "I"),
        lambda o: F.struct((o["ref"] - 1).alias("pos"), F.substring(seq, o["read"] + 1, o["size"]).alias("seq")),
    )


def exons(ops: Column, drop_deletions: bool = False) -> Column:
    """(start, end_pos) of covered reference, touching stretches as one; deletions count unless dropped."""
    covered = F.filter(ops, lambda o: (o["op"] == "M") if drop_deletions else o["op"].isin("M", "D"))
    empty = F.array().cast("array<struct<start:bigint,end_pos:bigint>>")

    def step(out, o):
        last = F.get(out, F.size(out) - 1)
        end = o["ref"] + o["size"]
        longer = F.array(F.struct(last["start"].alias("start"), end.alias("end_pos")))
        return F.when(last["end_pos"] == o["ref"], F.concat(F.slice(out, 1, F.size(out) - 1), longer)).otherwise(
            F.concat(out, F.array(F.struct(o["ref"].alias("start"), end.alias("end_pos"))))
        )

    return F.aggregate(covered, empty, step)


def md_events(md: Column) -> Column:
    """(at, bases, deleted) of mismatching and deleted reference bases; ``at`` counts aligned and deleted bases before."""
    empty = F.array().cast("array<struct<at:int,bases:string,deleted:boolean>>")
    start = F.struct(empty.alias("out"), F.lit(0).alias("at"), F.lit(False).alias("caret"))

    def step(s, t):
        number = t.rlike(r"^\d+$")
        caret = t.startswith("^")
        event = F.struct(s["at"].alias("at"), t.alias("bases"), s["caret"].alias("deleted"))
        return F.struct(
            F.when(number | caret, s["out"]).otherwise(F.concat(s["out"], F.array(event))).alias("out"),
            (s["at"] + F.when(number, t.try_cast("int")).when(caret, 0).otherwise(F.length(t))).alias("at"),
            caret.alias("caret"),
        )

    return F.aggregate(md_tokens(md), start, step, lambda s: s["out"])


def _block_of(ops: Column, at: Column, op: str) -> Column:
    """The operation of a kind that holds an offset among aligned and deleted bases."""
    return F.get(F.filter(ops, lambda o: (o["op"] == op) & (o["aligned"] <= at) & (at < o["aligned"] + o["size"])), F.lit(0))


def mismatches(ops: Column, md: Column, seq: Column) -> Column:
    """(pos, base) where the read differs; a run of letters in MD counts once, at its first base."""
    def place(e):
        block = _block_of(ops, e["at"], "M")
        return F.struct(
            (block["ref"] + e["at"] - block["aligned"]).alias("pos"),
            F.substring(seq, block["read"] + e["at"] - block["aligned"] + 1, F.lit(1)).alias("base"),
        )

    return F.transform(F.filter(md_events(md), lambda e: ~e["deleted"]), place)


def deletions(ops: Column, md: Column) -> Column:
    """(pos, seq) of deleted reference bases, one per deletion in the CIGAR, with the bases from MD."""
    def place(o):
        event = F.get(F.filter(md_events(md), lambda e: e["deleted"] & (e["at"] <= o["aligned"]) & (o["aligned"] < e["at"] + F.length(e["bases"]))), F.lit(0))
        return F.struct(o["ref"].alias("pos"), F.substring(event["bases"], o["aligned"] - event["at"] + 1, o["size"]).alias("seq"))

    return F.transform(F.filter(ops, lambda o: o["op"] == "D"), place)


def clipped_share(cigar: Column, length: Column) -> Column:
    """Soft-clipped bases over the read's length."""
    return (clip_size(cigar, "left") + clip_size(cigar, "right")) / length


def n_junctions(cigar: Column) -> Column:
    return F.length(cigar) - F.length(F.replace(cigar, F.lit("N"), F.lit("")))
