"""Packing by power-of-two decomposition.

A document of n tokens is cut into whole sequences of ``max_len`` tokens and the powers of
two in the binary form of the rest, longest first. Every piece is a sequence of its own, so
no sequence crosses documents and none needs padding; pieces of equal length form a bucket
from which batches are drawn. The operator is a map over documents: no shuffle, and no task
needs more than one document at a time.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.llm.common import materialize, read_table, tidy
from strandlake.session import shipped

MAX_LEN = 4096
END_ID = 2
#: Chunks, and words, whose ids a worker remembers at most: about 200 MB, as longer ones than these are not remembered.
REMEMBERED = 500_000
REMEMBERED_LENGTH = 48

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PIECES_IDS = PIECES + ", ids array<int>"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder(dict):
    """Token ids of texts as little-endian unsigned 32-bit bytes, remembered by chunks between white space.

    The tokenizer drops white space and never joins what white space parts, and its special
    tokens hold none, so a text's ids are its chunks' ids in order. A chunk of plain letters,
    with a mark behind it or not, is looked up by its lower-cased word, and a new word goes to
    the vocabulary's merges at once; any other chunk goes through the whole tokenizer, where a
    special token's text gives that token's id.
    """

    def __init__(self, path: str):
        super().__init__()
        self.remembered = REMEMBERED
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.words: dict[str, bytes] = {}

    def _merged(self, word: str) -> bytes:
        found = self.words.get(word)
        if found is None:
            spelled = word if word.isascii() else word.encode().decode("latin-1").translate(_SPELLED)
            ids = [t.id for t in self.model.tokenize(spelled)]
            found = struct.pack(f"<{len(ids)}I", *ids)
            if len(word) <= REMEMBERED_LENGTH:
                self.words[word] = found
        return found

    def __missing__(self, chunk: str) -> bytes:
        plain = _PLAIN.fullmatch(chunk)
        if plain is None:
            ids = self.tokenizer.encode_batch_fast([chunk], add_special_tokens=False)[0].ids
            found = struct.pack(f"<{len(ids)}I", *ids)
        else:
            found = self._merged(plain[1].lower())
            if plain[2]:
                found += self._merged(plain[2])
        if len(chunk) <= REMEMBERED_LENGTH:
            self[chunk] = found
        return found

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if len(self) > self.remembered:
            self.clear()
        if len(self.words) > self.remembered:
            self.words.clear()
        chunks = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        return b"".join(map(self.__getitem__, chunks))


#: Latin letters that lower-casing keeps one letter, then at most one mark.
_PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+)([.,;:!?]?)")
#: How byte-level vocabularies spell bytes that aren't printable: from 256 on, in order.
_SPELLED = {b: 256 + i for i, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174))}
_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str, remembered: int = REMEMBERED) -> Encoder:
    """One per worker process, so what it remembers outlives a task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    _ENCODERS[path].remembered = remembered
    return _ENCODERS[path]


def cut(n_tokens: int, max_len: int = MAX_LEN) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole sequences, then falling powers of two."""
    out = [(s, max_len) for s in range(0, n_tokens - max_len + 1, max_len)]
    at = len(out) * max_len
    bit = max_len
    while bit:
        if bit < max_len and n_tokens - at >= bit:
            out.append((at, bit))
            at += bit
        bit >>= 1
    return out


def pieces_of(docs: DataFrame, tokenizer_path: str | None = None, max_len: int = MAX_LEN, end_id: int = END_ID, with_ids: bool = False, remembered: int = REMEMBERED) -> DataFrame:
    """One row per piece of every document (``doc_id``, ``text``; other columns are ignored).

    ``start`` counts the document's ids before the piece, ``doc_tokens`` all of them with the
    end id. A null or empty text is the end id alone. Rows with equal or null ids are
    documents of their own; an empty table gives no rows. ``with_ids`` adds the ids.
    ``remembered`` bounds a worker's memory for the ids of chunks and of words.
    """
    if max_len & (max_len - 1) or max_len < 1:
        raise ValueError("max_len must be a power of two")
    path = tokenizer_path or vocabulary_path()
    end = int(end_id).to_bytes(4, "little")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, remembered).encode
        for batch in batches:
            ids, start, length, crc, total, tokens = [], [], [], [], [], []

            def flush():
                cols = [pa.array(ids, pa.int64()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(total, pa.int64())]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    cols.append(pa.array(tokens, pa.list_(pa.int32())))
                    names.append("ids")
                out = pa.RecordBatch.from_arrays(cols, names=names)
                for x in (ids, start, length, crc, total, tokens):
                    x.clear()
                return out

            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = encode(text.as_py()) + end
                n = len(raw) // 4
                for s, k in cut(n, max_len):
                    part = raw[4 * s : 4 * (s + k)]
                    ids.append(doc_id)
                    start.append(s)
                    length.append(k)
                    crc.append(zlib.crc32(part))
                    total.append(n)
                    if with_ids:
                        tokens.append(np.frombuffer(part, "<u4").astype(np.int32))
                if len(ids) >= (500 if with_ids else 20_000):
                    yield flush()
            if ids:
                yield flush()

    return shipped(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES_IDS if with_ids else PIECES)


def pack(docs: DataFrame, tokenizer_path: str | None = None, max_len: int = MAX_LEN, end_id: int = END_ID, with_ids: bool = False, remembered: int = REMEMBERED) -> DataFrame:
    """``pieces_of`` with ``sequence_id`` and ``offset``: each piece is a whole sequence, so its offset is 0.

    The pieces are written to the shared scratch folder first, so an id, made of a file split
    and a row in it, stays the same when a lost executor's work is done again. ``length`` is
    the bucket: ``write_buckets`` lays the sequences out by it.
    """
    fixed = materialize(pieces_of(docs, tokenizer_path, max_len, end_id, with_ids, remembered), "pieces")
    return fixed.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))


def write_buckets(packed: DataFrame, path: str) -> None:
    """One folder per sequence length, each with files from many tasks."""
    packed.withColumn("bucket", F.col("length")).write.partitionBy("bucket").parquet(path)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))
