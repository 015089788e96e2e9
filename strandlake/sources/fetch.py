"""Files from elsewhere: addresses fetched with retries, accessions read by an external program, rows through a program."""

from __future__ import annotations

import hashlib
import subprocess
import threading
import time
import urllib.request
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.plans.spec import one_row_tasks
from strandlake.session import shipped

#: What a scheme's address is given to, where a plain download won't do; the program's output is the file.
PROGRAMS = {"sra": ("fastq-dump", "--split-spot", "-Z"), "dbgap": ("fastq-dump", "--split-spot", "-Z")}


class FetchError(OSError):
    """An address couldn't be fetched whole, in all tries."""


def accession_manifest(accessions: DataFrame, scheme: str = "sra") -> DataFrame:
    """Manifest rows of accessions (``accession``, ``sample_label``): one address each, without a digest."""
    none = F.lit(None).cast("string")
    return accessions.select(F.concat(F.lit(f"{scheme}:"), "accession").alias("url1"), F.lit("0").alias("md5_1"), none.alias("url2"), none.alias("md5_2"), "sample_label")


def _chunks(url: str, programs: dict[str, Sequence[str]]) -> Iterator[bytes]:
    scheme, _, rest = url.partition(":")
    if scheme in programs:
        with subprocess.Popen([*programs[scheme], rest], stdout=subprocess.PIPE) as process:
            while data := process.stdout.read(1 << 20):
                yield data
        if process.returncode:
            raise FetchError(f"{programs[scheme][0]} ended with {process.returncode}")
        return
    with urllib.request.urlopen(url, timeout=60) as answer:
        while data := answer.read(1 << 20):
            yield data


def fetched(manifest: DataFrame, folder: str, tries: int = 5, wait: float = 1.0, programs: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """``url, file, bytes`` of every address of a manifest, copied to ``folder``; an address is a task of its own.

    A failed try, or a file with another MD5 than the manifest's (``0`` is none), is done again
    after twice the wait each time; after ``tries`` the query fails. A file appears under its
    name only when it is whole. ``programs`` names an external program by scheme, which must be
    on the executors.
    """
    known = PROGRAMS if programs is None else programs
    pairs = F.explode(F.array(F.struct(F.col("url1").alias("url"), F.col("md5_1").alias("md5")), F.struct(F.col("url2").alias("url"), F.col("md5_2").alias("md5"))))
    addresses = one_row_tasks(manifest.select(pairs.alias("x")).select("x.url", "x.md5").where("url is not null").distinct())

    def one(url: str, md5: str | None) -> dict:
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        name = hashlib.md5(url.encode()).hexdigest()[:8] + "-" + url.rstrip("/").rsplit("/", 1)[-1].replace(":", "_")
        for attempt in range(tries):
            part = f"{root}/.{name}.{uuid.uuid4().hex}"
            try:
                digest, size = hashlib.md5(), 0
                with system.open_output_stream(part, compression=None) as out:
                    for data in _chunks(url, known):
                        digest.update(data)
                        out.write(data)
                        size += len(data)
                if md5 not in (None, "", "0") and digest.hexdigest() != md5:
                    raise FetchError(f"MD5 of {url} is {digest.hexdigest()}, not {md5}")
                system.move(part, f"{root}/{name}")
                return {"url": url, "file": f"{folder}/{name}", "bytes": size}
            except OSError as error:
                if attempt + 1 == tries:
                    raise FetchError(f"{url}: {error}") from error
                time.sleep(wait * 2**attempt)
        raise FetchError(url)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [one(url, md5) for url, md5 in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("url", pa.string()), ("file", pa.string()), ("bytes", pa.int64())]))

    return shipped(addresses).mapInArrow(run, "url string, file string, bytes long")


def piped(df: DataFrame, command: Sequence[str]) -> DataFrame:
    """Output lines (``value``) of a program that each task runs once over its rows, columns joined by tabs.

    The way to bring in an aligner or any other program that reads and writes lines. Rows stream
    in while lines stream out; a program that ends with an error fails the task.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        process = subprocess.Popen(list(command), stdin=subprocess.PIPE, stdout=subprocess.PIPE)
        failed: list[BaseException] = []

        def feed():
            try:
                for batch in batches:
                    process.stdin.write("".join(f"{x}\n" for x in batch.column(0).to_pylist()).encode())
                process.stdin.close()
            except BrokenPipeError:
                pass  # the program has read enough
            except BaseException as error:  # noqa: BLE001  raised again below
                failed.append(error)
                process.kill()

        feeder = threading.Thread(target=feed, daemon=True)
        feeder.start()
        lines: list[str] = []
        for line in process.stdout:
            lines.append(line.decode("utf-8", "replace").rstrip("\n"))
            if len(lines) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])
                lines = []
        feeder.join()
        if failed:
            raise failed[0]
        if process.wait():
            raise RuntimeError(f"{command[0]} ended with {process.returncode}")
        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])

    line = F.concat_ws("\t", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns))
    return shipped(df).select(line.alias("line")).mapInArrow(run, "value string")
