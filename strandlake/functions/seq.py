"""Functions on nucleotide and quality strings, as Column expressions."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column
from pyspark.sql import functions as F

# Complement, exemplars of the five quality bins, motif pairs.
BASES, COMPLEMENT = "ATCG", "TAGC"
BIN_EXEMPLARS = "#05Hh"
FORWARD_MOTIFS = (("GT", "AG"), ("GC", "AG"), ("AT", "AC"))
REVERSE_MOTIFS = (("CT", "AC"), ("CT", "GC"), ("GT", "AT"))


def revcomp(seq: Column) -> Column:
    """Reverse complement; bases other than A, T, C, G stay."""
    return F.translate(F.reverse(seq), BASES, COMPLEMENT)


def canonical(seq: Column) -> tuple[Column, Column]:
    """The lesser of a sequence and its reverse complement, and whether it was reversed (palindromes are)."""
    forward = seq < revcomp(seq)
    return F.when(forward, seq).otherwise(revcomp(seq)), ~forward


def sanitize(seq: Column) -> Column:
    """Upper case, with N for all but A, T, C, G, N."""
    return F.regexp_replace(F.upper(seq), "[^ATCGN]", "N")


def _table(convert, low: int = 33, high: int = 126) -> tuple[str, str]:
    codes = [chr(c) for c in range(low, high + 1)]
    return "".join(codes), "".join(convert(ord(c)) for c in codes)


def bin_qualities(qual: Column) -> Column:
    """Phred+33 qualities to one exemplar of five bins."""
    return F.translate(qual, *_table(lambda c: BIN_EXEMPLARS[4 * min(c - 33, 40) // 40]))


def phred64_to_sanger(qual: Column) -> Column:
    """Phred+64 to Phred+33, clamped to 64..104."""
    return F.translate(qual, *_table(lambda c: chr(min(max(c, 64), 104) - 31)))


def clamp_sanger(qual: Column) -> Column:
    """Phred+33 clamped to 33..93."""
    return F.translate(qual, *_table(lambda c: chr(min(max(c, 33), 93))))


def solexa_to_sanger(qual: Column) -> Column:
    """Solexa odds-based qualities to Phred+33, clamped to 59..104."""
    from math import log10

    def convert(code: int) -> str:
        odds = 10 ** ((min(max(code, 59), 104) - 64) / 10)
        return chr(int(10 * log10(1 + odds) + 33 + 0.5))

    return F.translate(qual, *_table(convert))


def phred_format(least: Column, greatest: Column) -> Column:
    """Encoding told from the least and greatest code in use; Sanger where nothing tells."""
    return (
        F.when(least >= 64, "Phred64").when(least < 59, "Sanger").when(greatest >= 94, "Solexa").otherwise("Sanger")
    )


def codes(qual: Column) -> Column:
    """Character codes; an empty string has none."""
    return F.when(F.length(qual) == 0, F.array().cast("array<int>")).otherwise(
        F.transform(F.split(qual, ""), lambda c: F.ascii(c))
    )


def mean_quality(qual: Column) -> Column:
    """Mean character code; null for an empty string."""
    return F.aggregate(codes(qual), F.lit(0), lambda a, c: a + c) / F.nullif(F.length(qual), F.lit(0))


def is_poly(seq: Column, min_exon: int = 9) -> Column:
    """Whether all but ``max(min_exon - 1, 1)`` bases at one end are A, or are T."""
    keep = max(min_exon - 1, 1)
    head = F.substring(seq, F.lit(1), F.greatest(F.length(seq) - keep, F.lit(0)))
    tail = F.substring(seq, F.lit(keep + 1), F.length(seq))
    return head.rlike("^(A*|T*)$") | tail.rlike("^(A*|T*)$")


def cap_sizes(least: int = 15, most: int = 25, multiplier: float = 1.1) -> list[int]:
    """Sizes of prefixes and suffixes: each ``multiplier`` times the last, at least one more, and the largest."""
    sizes, size = [], least
    while size <= most:
        sizes.append(size)
        size = max(int(size * multiplier), size + 1)
    return sizes if sizes and sizes[-1] == most else [*sizes, most]


def readlets(seq: Column, least: int = 15, most: int = 25, interval: int = 4, multiplier: float = 1.1) -> Column:
    """Overlapping pieces of a read: array of (start, size) from 0.

    Prefixes and suffixes of each cap size, and pieces of the largest size at every
    ``interval`` bases inside. Reads shorter than the least size have none.
    """
    n = F.length(seq)
    piece = lambda start, size: F.struct(start.cast("int").alias("start"), size.cast("int").alias("size"))
    caps = []
    for size in cap_sizes(least, most, multiplier):
        fit = F.least(F.lit(size), n)
        caps += [piece(F.lit(0), fit), piece(n - fit, fit)]
    inner = F.when(
        n - most > interval,
        F.transform(F.sequence(F.lit(interval), n - most - 1, F.lit(interval)), lambda j: piece(j, F.lit(most))),
    ).otherwise(F.array().cast("array<struct<start:int,size:int>>"))
    return F.when(n >= least, F.concat(F.array(*caps), inner)).otherwise(F.array().cast("array<struct<start:int,size:int>>"))


def global_score(a: Column, b: Column) -> Column:
    """Global alignment score with match 0, mismatch and gap -1; N matches nothing, not even N."""
    return -F.levenshtein(F.translate(a, "N", "\u0001"), F.translate(b, "N", "\u0002"))


def motif_strand(left: Column, right: Column) -> Column:
    """``+`` or ``-`` for a splice motif pair, null for any other."""
    pair = F.concat_ws("-", left, right)
    return F.when(pair.isin(*map("-".join, FORWARD_MOTIFS)), "+").when(pair.isin(*map("-".join, REVERSE_MOTIFS)), "-")


def base36(number: Column) -> Column:
    """A number of 0 or more in base 36, digits then small letters."""
    return F.lower(F.conv(number.cast("string"), 10, 36))


def encode_sequence(seq: str) -> str:
    """A short sequence of A, T, C, G, N as a base-36 number, for names; the empty one is empty."""
    return "".join(_digits(int(seq.translate(str.maketrans("ATCGN", "12345")), 6), 36)) if seq else ""


def decode_sequence(text: str) -> str:
    """What ``encode_sequence`` was given."""
    return "".join(_digits(int(text, 36), 6)).translate(str.maketrans("12345", "ATCGN")) if text else ""


def _digits(value: int, base: int) -> Iterator[str]:
    head, digit = divmod(value, base)
    if head:
        yield from _digits(head, base)
    yield "0123456789abcdefghijklmnopqrstuvwxyz"[digit]


NAME_SEPARATOR = "\u001d"


def composite_name(qname: Column, mate: Column, sample: Column) -> Column:
    """A read's name with a digest of its mate's sequence and its sample, so that it is unique over samples and mates."""
    digest = F.when(mate.isNotNull(), F.substring(F.md5(mate), 1, 8)).otherwise(F.lit(""))
    return F.concat_ws(NAME_SEPARATOR, qname, digest, sample.cast("string"))


def name_parts(name: Column) -> Column:
    """Struct of ``qname``, ``mate`` (the digest, null without a mate) and ``sample`` of a composite name."""
    parts = F.split(name, NAME_SEPARATOR)
    back = lambda i: F.get(parts, F.size(parts) - i)  # noqa: E731  the name itself may hold anything
    own = F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 2), NAME_SEPARATOR)
    return F.struct(own.alias("qname"), F.nullif(back(2), F.lit("")).alias("mate"), back(1).cast("int").alias("sample"))


def mate_free(qname: Column) -> Column:
    """A read's name without the ``/1`` or ``/2`` that tells mates apart."""
    return F.regexp_replace(qname, "/[12]$", "")


def short_name(record: Column, sample: Column) -> Column:
    """A name made of the record's number in base 36 and the sample, the same on every run."""
    return F.concat_ws("_", base36(record), sample.cast("string"))
