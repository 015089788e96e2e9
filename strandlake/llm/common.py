"""Helpers shared by the training-data operators: scratch tables, word hashing, bounded samples."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
import unicodedata
import uuid
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandlake.session import removed as drop_scratch  # noqa: F401  for the operators
from strandlake.session import scratch_root
from strandlake.session import written as materialize  # noqa: F401

#: Words kept by a worker's hash cache before it starts over, and the longest of them; bounds its memory to about 35 MB.
CACHE_WORDS = 200_000
CACHE_BYTES = 64

_WHITE = bytes(range(9, 14)) + b" "
_ALNUM = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
#: Byte table: A-Z lower-cased, ASCII other than letters and digits to spaces, the rest kept.
FOLD_ALNUM = bytes(
    (b + 32 if 65 <= b <= 90 else b) if b in _ALNUM or b >= 0x80 else 32 for b in range(256)
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(columns: Sequence[str], wanted: str) -> str:
    """``wanted``, behind as many ``_`` as it takes to be no column's name (names differ in case for no reason)."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


#: Signs of Latin-1, general punctuation, and that of East Asian scripts.
_MARKS = re.compile("[\u00a0-\u00a9\u00ab-\u00b4\u00b6-\u00b9\u00bb-\u00bf\u2000-\u206f\u3000-\u303f]+")


def tidy(run):
    """``run``, a function over record batches, giving freed memory back to the system at the end of its task.

    Python workers live on after a task, next to those of other cores.
    """
    def inner(batches):
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL(None).malloc_trim(0)

    return inner


class WordHash(dict):
    """64-bit hashes of words (bytes), remembered for the words seen last unless they are long."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= CACHE_BYTES:
            self[word] = value
        return value

    def of(self, words: Sequence[bytes]) -> np.ndarray:
        if len(self) > CACHE_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: One odd multiplier for each place in an n-gram, made by mixing its number.
_ODD = mix(np.arange(1, 33, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash for each run of ``n`` word hashes; fewer words give one hash of them all, none gives none."""
    if len(words) == 0:
        return words
    n_here = min(n, len(words))
    count = len(words) - n_here + 1
    total = np.full(count, n_here, np.uint64)
    for j in range(n_here):
        total += words[j : j + count] * _ODD[j % len(_ODD)]
    return mix(total)


def white_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return text.encode("utf-8", "replace").lower().split() if text else []


def fold_words(text: str | None) -> list[bytes]:
    """Words of letters and digits, lower-cased and in one Unicode form, without the usual punctuation beyond ASCII."""
    if not text:
        return []
    if not text.isascii():
        text = _MARKS.sub(" ", unicodedata.normalize("NFKC", text).lower())
    return text.encode("utf-8", "replace").translate(FOLD_ALNUM).split()


def crc_of_id(col):
    return F.crc32(col.cast("string").cast("binary"))


def bounded_ids(labelled: DataFrame, id_col: str, label_col: str, per_label: int, most_labels: int = 1_000, most_rows: int | None = None) -> DataFrame:
    """At most ``per_label`` ids of each label, and about ``most_rows`` in all, those with the lowest hash of the id; all columns are kept.

    The labels are counted first, more than ``most_labels`` are an error, and only ids with a
    hash low enough for a little more than ``per_label`` of their label are ranked.
    """
    spark = labelled.sparkSession
    place = F.xxhash64(F.col(id_col), F.lit(17))
    counts = labelled.groupBy(label_col).agg(F.count("*").alias("n")).limit(most_labels + 1).collect()
    if len(counts) > most_labels:
        raise ValueError(f"more than {most_labels} labels")
    if most_rows:
        per_label = max(1, min(per_label, most_rows // max(1, len(counts))))
    wanted = per_label + 6 * per_label**0.5 + 50
    shares = spark.createDataFrame([(r[0], min(1.0, wanted / r["n"])) for r in counts], T.StructType([labelled.schema[label_col], T.StructField("_share", T.DoubleType())]))
    near = labelled.join(F.broadcast(shares), label_col)  # a row per label
    near = near.where(place.cast("double") <= F.lit(-(2.0**63)) + F.col("_share") * F.lit(2.0**64)).drop("_share")
    w = Window.partitionBy(label_col).orderBy(place, id_col)
    return near.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= per_label).select(*labelled.columns)
