"""WARC archives: a writer with revisit records, and a splittable reader.

Each record is a gzip member of its own. The reader's tasks get byte ranges of files. A
task looks for the gzip magic in its range, takes a place where the magic stands as a
candidate, decodes it, and accepts it if it begins with a WARC version line and headers with
a type, an id and a content length. Records belong to the range in which they begin, so every
record is read once, whatever the ranges.

Files are opened through ``pyarrow.fs`` by URI (local, HDFS, S3), never by local path.
"""

from __future__ import annotations

import hashlib
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.llm.common import materialize, read_table, scratch_path, tidy
from strandlake.session import shipped

MAGIC = b"\x1f\x8b\x08"
LEAST_REVISIT_BYTES = 100
SPLIT_BYTES = 32 << 20
READ_BYTES = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

FILES = "file string, file_bytes long, records long"
RECORDS = "record_id string, record_type string, target_uri string, refers_to_id string, payload_bytes long, payload_digest string, payload binary, file string, file_offset long"


def _uri(text: str | None) -> str:
    return urllib.parse.quote(text or "", safe="%/:?#[]@!$&'()*+,;=~")


def record_bytes(record_id: str, uri: str | None, payload: bytes | None, digest: str, n_bytes: int, refers_to: str | None, level: int) -> bytes:
    """One compressed record; ``refers_to`` makes it a revisit, which keeps the HTTP headers and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{record_id}>",
        f"WARC-Date: {DATE}", f"WARC-Target-URI: {_uri(uri)}", f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head[5:5] = [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {PROFILE}"]
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return b"".join((packer.compress("\r\n".join(head).encode() + b"\r\n\r\n"), packer.compress(block), packer.compress(b"\r\n\r\n"), packer.flush()))


def decide_types(pages: DataFrame, least_bytes: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """``pages`` (``page_id``, ``url``, ``html``) with payload size, digest and, for revisits, the response's ``page_id``.

    Only digests that occur more than once are joined back; their counts are added up in the
    tasks before any shuffle, and they are written first, so that the join with the pages has
    an exchange on both sides that can be split where one digest has very many pages.
    """
    html = F.coalesce("html", F.lit(""))
    pages = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"),
        F.octet_length(html).cast("long").alias("n_bytes"), F.sha2(html, 256).alias("digest"),
    )
    repeated = (
        pages.where(F.col("n_bytes") >= least_bytes).groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    )
    repeated = materialize(repeated, "digests")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return pages.join(repeated, "digest", "left").select(
        "page_id", "url", "html", "n_bytes", "digest", F.when(revisit, F.col("first_id")).alias("refers_to")
    )


def write_warc(pages: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """Write typed pages (see ``decide_types``) as one archive per task; a table of the files comes back.

    Every row becomes a record, repeated ones and those with equal or null ids too; a null url
    is an empty target. An empty table gives archives without records. A page is held in memory
    as a whole. Other columns are ignored.

    A file's name holds the attempt that wrote it, and only files in the table count, so
    what failed or speculative attempts leave behind is never read.
    """
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}.warc.gz"
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        size = records = 0
        with system.open_output_stream(f"{root}/{name}", compression=None) as out:
            for batch in batches:
                columns = [c.to_pylist() for c in batch.columns]
                for page_id, url, html, n_bytes, digest, refers_to in zip(*columns):
                    data = record_bytes(
                        f"urn:page:{page_id}", url, html.encode("utf-8"), digest, n_bytes,
                        None if refers_to is None else f"urn:page:{refers_to}", level,
                    )
                    out.write(data)
                    size += len(data)
                    records += 1
        yield pa.RecordBatch.from_pylist([{"file": f"{folder}/{name}", "file_bytes": size, "records": records}], pa.schema([("file", pa.string()), ("file_bytes", pa.int64()), ("records", pa.int64())]))

    columns = pages.select("page_id", "url", F.when(F.col("refers_to").isNull(), F.col("html")).otherwise("").alias("html"), "n_bytes", "digest", "refers_to")
    return materialize(shipped(columns).mapInArrow(run, FILES), "warc-files")


class _Window:
    """A file read forward in steps, with the bytes from a place on."""

    def __init__(self, handle, at: int):
        self.handle, self.at, self.data = handle, at, b""
        handle.seek(at)

    def more(self) -> bool:
        new = self.handle.read(READ_BYTES)
        self.data += new
        return bool(new)

    def skip(self, n: int) -> None:
        self.data = self.data[n:]
        self.at += n


def _headers(raw: bytes) -> tuple[dict[str, str], int] | None:
    """WARC headers at the start of a decoded member and where its block begins; None if it isn't a record."""
    if not raw.startswith(b"WARC/1."):
        return None
    end = raw.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for line in raw[:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not ({"warc-type", "warc-record-id", "content-length"} <= fields.keys()) or not fields["content-length"].isdigit():
        return None
    return fields, end + 4


def _member(window: _Window, with_payload: bool) -> dict | None:
    """The record that begins at the window's place; moves the window behind it. None if there is no record."""
    start = window.at
    if len(window.data) < 18:
        window.more()
    unpack = zlib.decompressobj(31)
    head, found, used = b"", None, 0
    digest, payload, n_payload, body, block_left, http = hashlib.sha256(), [], 0, False, 0, b""
    try:
        while not unpack.eof:
            if used == len(window.data):
                if found is not None:  # a validated record: its bytes aren't needed again
                    window.skip(used)
                    used = 0
                if not window.more():
                    return None
            piece = window.data[used : used + (1 << 16)]
            raw = unpack.decompress(piece)
            used += len(piece) - len(unpack.unused_data)
            if found is None:
                head += raw
                if not b"WARC/1.".startswith(head[:7]):
                    return None
                if b"\r\n\r\n" not in head:
                    continue
                found = _headers(head)
                if found is None:
                    return None
                raw, block_left = head[found[1] :], int(found[0]["content-length"])
                body = not found[0].get("content-type", "").lower().startswith("application/http")
            raw, block_left = raw[:block_left], block_left - min(block_left, len(raw))
            if not body:
                http += raw
                at = http.find(b"\r\n\r\n")
                if at < 0:
                    continue
                raw, http, body = http[at + 4 :], http[:at], True
            digest.update(raw)
            n_payload += len(raw)
            if with_payload:
                payload.append(raw)
    except zlib.error:
        return None
    if found is None or block_left:
        return None
    window.skip(used)
    fields = found[0]
    kind = fields["warc-type"]
    sha = digest.hexdigest()
    if kind == "revisit":
        sha = fields.get("warc-payload-digest", "").removeprefix("sha256:")
        lengths = [x.partition(b":")[2] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
        n_payload = int(lengths[0]) if lengths else None
    clean = lambda x: x.strip("<>") if x is not None else None
    return {
        "record_id": clean(fields["warc-record-id"]), "record_type": kind, "target_uri": fields.get("warc-target-uri"),
        "refers_to_id": clean(fields.get("warc-refers-to")), "payload_bytes": n_payload, "payload_digest": sha,
        "payload": b"".join(payload) if with_payload and kind != "revisit" else None, "file_offset": start,
    }


def records_in(handle, start: int, end: int, with_payload: bool = False) -> Iterator[dict]:
    """Records that begin at ``start`` or later and before ``end``."""
    window = _Window(handle, start)
    while window.at < end:
        at = window.data.find(MAGIC)
        if at < 0:
            window.skip(max(0, len(window.data) - len(MAGIC) + 1))
            if not window.more():
                return
            continue
        window.skip(at)
        if window.at >= end:
            return
        here = window.at
        record = _member(window, with_payload)
        if record is not None:
            yield record
        elif window.at != here:  # a broken record of which the front is gone
            handle.seek(here + 1)
            window.at, window.data = here + 1, b""
        else:
            window.skip(1)


def read_warc(files: DataFrame, split_bytes: int = SPLIT_BYTES, with_payload: bool = False) -> DataFrame:
    """The records of archives (``file``, ``file_bytes``), in byte ranges dealt over tasks.

    Broken members are passed over. Digest and size of a revisit are what its headers say. A
    record of any size is read whole, with headers of any length; its payload is in memory only
    if asked for. Records with equal ids are all given, each once, whatever the ranges; a file
    named twice is read twice, one of 0 bytes or with a null size not at all. Other columns are ignored; an
    empty table gives no rows.
    """
    splits = files.where("file_bytes > 0").select(
        "file", F.explode(F.sequence(F.lit(0).cast("long"), F.col("file_bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start"),
        "file_bytes",
    )
    n = max(1, splits.count())
    splits = splits.repartition(min(n, 100_000))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("refers_to_id", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()), ("file", pa.string()), ("file_offset", pa.int64())])
        for batch in batches:
            for file, start, size in zip(*(c.to_pylist() for c in batch.columns)):
                system, path = fs.FileSystem.from_uri(file)
                with system.open_input_file(path) as handle:
                    rows, held = [], 0
                    for row in records_in(handle, start, min(start + split_bytes, size), with_payload):
                        rows.append(row | {"file": file})
                        held += len(row["payload"] or b"")
                        if len(rows) >= 5_000 or held > 16 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema)

    return shipped(splits).mapInArrow(run, RECORDS)


def archive_and_read(pages: DataFrame, folder: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Write ``pages`` (``page_id``, ``url``, ``html``) to ``folder`` and read every record back.

    Gives ``page_id, payload_bytes, payload_digest, record_type, refers_to``. Of equal payloads of at
    least 100 bytes the smallest ``page_id`` is the response; rows that share that id and
    payload are all responses. A null html is empty, a null url an empty target. Pages with a
    null id are revisits of the smallest id if there is one, else responses. An empty table
    gives no rows.
    """
    records = read_warc(write_warc(decide_types(pages), folder), split_bytes)
    page = lambda c: F.expr(f"try_cast(substring({c}, 10) AS BIGINT)")  # noqa: E731  behind "urn:page:"
    return records.select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page("refers_to_id").alias("refers_to"),
    )


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_and_read(read_table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))


OP1_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM f
"""
