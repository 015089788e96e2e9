"""BAM files: blocks of gzip members with their size in an extra field, and binary alignment records."""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.session import shipped
from strandlake.sources.writers import sam_header

# Fixed values of the format: letters of operations and bases, the block that ends a file, bytes of a block.
OPERATIONS = "MIDNSHP=X"
BASES = "=ACMGRSVTWYHKDBN"
END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
BLOCK = 65_280

FILES = "file string, sample int, rname string, records long"
COLUMNS = ("sample", "rname", "qname", "flag", "pos", "mapq", "cigar", "seq", "qual", "as_score", "xs_score", "nm", "md")


def bgzf(data: bytes) -> bytes:
    """One block of at most ``BLOCK`` bytes."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    head = struct.pack("<4BI2BH2BHH", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(body) + 25)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data))


def bin_of(begin: int, end: int) -> int:
    """The smallest of the index's bins (2^14 bases, then eight times as many at each level) that holds [begin, end)."""
    for level, shift in enumerate((14, 17, 20, 23, 26)):
        if begin >> shift == (end - 1) >> shift:
            return ((1 << 3 * (5 - level)) - 1) // 7 + (begin >> shift)
    return 0


def record(ref: int, row: dict) -> bytes:
    """An alignment. Null tags are left out; XS becomes ZS, names are cut to 254 characters, mapping quality is 255 if null."""
    name = (row["qname"] or "*").encode("ascii", "replace")[:254] + b"\0"
    seq, qual = row["seq"] or "", row["qual"] or ""
    ops = [(int(n), OPERATIONS.index(o)) for n, o in re.findall(r"(\d+)([MIDNSHP=X])", row["cigar"] or "")]
    size = sum(n for n, o in ops if OPERATIONS[o] in "MDN=X")
    begin = (row["pos"] or 0) - 1
    codes = [BASES.find(c) if c in BASES else 15 for c in seq.upper()]
    packed = bytes((a << 4) | b for a, b in zip(codes[::2], [*codes[1::2], 0]))
    qualities = bytes(ord(c) - 33 for c in qual) if len(qual) == len(seq) else b"\xff" * len(seq)
    tags = b"".join(n + b"i" + struct.pack("<i", row[c]) for n, c in ((b"AS", "as_score"), (b"ZS", "xs_score"), (b"NM", "nm")) if row[c] is not None)
    if row["md"] is not None:
        tags += b"MDZ" + row["md"].encode() + b"\0"
    mapq = 255 if row["mapq"] is None else row["mapq"]
    fixed = struct.pack("<iiBBHHHiiii", ref, begin, len(name), mapq, bin_of(max(begin, 0), max(begin, 0) + max(size, 1)), len(ops), row["flag"], len(seq), -1, -1, 0)
    body = fixed + name + b"".join(struct.pack("<I", n << 4 | o) for n, o in ops) + packed + qualities + tags
    return struct.pack("<i", len(body)) + body


def write_bam(alignments: DataFrame, contigs: DataFrame, folder: str) -> DataFrame:
    """A BAM file per sample and contig, sorted by position; gives a table of the files.

    The header has all contigs by descending length. A contig and sample is one task's work,
    whose rows stream through it. A file's name holds the attempt that wrote it, and only files in
    the table count. ``folder`` is a URI that driver and executors share.
    """
    header = sam_header(contigs).encode()
    named = [(r["rname"], r["length"]) for r in contigs.orderBy("rank_by_len").collect()]  # the contigs' dimension
    places = {name: i for i, (name, _) in enumerate(named)}
    front = b"BAM\1" + struct.pack("<i", len(header)) + header + struct.pack("<i", len(named))
    front += b"".join(struct.pack("<i", len(n.encode()) + 1) + n.encode() + b"\0" + struct.pack("<i", k) for n, k in named)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        now, out, held, made, n, name = None, None, b"", [], 0, ""

        def flush(all_of_it):
            nonlocal held
            while len(held) >= BLOCK or (all_of_it and held):
                out.write(bgzf(held[:BLOCK]))
                held = held[BLOCK:]

        def close():
            flush(True)
            out.write(END)
            out.close()
            made.append({"file": f"{folder}/{name}", "sample": now[0], "rname": now[1], "records": n})

        for batch in batches:
            for row in batch.to_pylist():
                key = row["sample"], row["rname"]
                if key != now:
                    if now is not None:
                        close()
                    now, held, n = key, front, 0
                    safe = re.sub(r"[^A-Za-z0-9._-]", "_", row["rname"])
                    name = f"{row['sample']}-{safe}-{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex[:8]}.bam"
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                held += record(places.get(row["rname"], -1), row)
                n += 1
                if len(held) > 1 << 20:
                    flush(False)
        if now is not None:
            close()
        yield pa.RecordBatch.from_pylist(made, pa.schema([("file", pa.string()), ("sample", pa.int32()), ("rname", pa.string()), ("records", pa.int64())]))

    rows = alignments.select(*COLUMNS).repartition("sample", "rname").sortWithinPartitions("sample", "rname", F.col("pos"), "qname")
    return shipped(rows).mapInArrow(run, FILES)
