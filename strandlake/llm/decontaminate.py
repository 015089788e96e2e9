"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

A local alignment of score S (match 1, mismatch and gap -1) with E edits has E + 1 runs of
matches at most, so S - 1 or more of the item's word pairs stand in the text unchanged. An item
of L words that needs a score of T can thus lose any L - T of its L - 1 pairs, and of any
L - T + k of them at least k are left. No passing copy is lost by this filter:

1. The word pairs of all test items are put into a bitmap of fixed size. A pass over the
   corpus counts those of its pairs that are in it, added up in each task first.
2. An item's seeds are its L - T + k rarest pairs by that count, with k = 3 or T - 1 if that is
   less. How rare is relative to the item, so an item that stands in very many documents keeps
   its seeds too.
3. A second pass cuts windows around seeds out of the training texts, as far as a passing
   alignment can reach; windows and items that share k seeds are joined.
4. Each pair of window and item is aligned word by word. The best local score over the item's
   length is its score: 1 for a copy, less with each edit.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandlake.llm.common import WordHash, fold_words, free_name, materialize, ngram_hashes, read_table, tidy
from strandlake.session import shipped

GRAM = 2
BITS = 24
LEAST_SCORE = 0.4
#: Least matched score in words, or the whole item if it is shorter.
LEAST_WORDS = 8
#: Seeds that a window and an item must share, or all that its least score guarantees if they are fewer.
SHARED_SEEDS = 3


def smith_waterman(item: np.ndarray, window: np.ndarray) -> tuple[int, int]:
    """Best local score, and where in the window it ends (exclusive)."""
    steps = np.arange(1, len(window) + 1)
    row = np.zeros(len(window) + 1, np.int64)
    best, end = 0, 0
    for word in item:
        cell = np.maximum(np.maximum(row[:-1] + np.where(window == word, 1, -1), row[1:] - 1), 0)
        row[1:] = np.maximum.accumulate(cell + steps) - steps  # gaps in the item
        at = int(row.argmax())
        if row[at] > best:
            best, end = int(row[at]), at
    return best, end


def _row_keys() -> Iterator[int]:
    """Keys for the rows that this task makes; the rows are written before they are used."""
    return itertools.count(TaskContext.get().partitionId() << 33)


def _item_grams(items: DataFrame) -> DataFrame:
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, keys = WordHash(), _row_keys()
        for batch in batches:
            ids, words, grams = [], [], []
            for item_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                w = known.of(fold_words(text.as_py()))
                if len(w):
                    ids.append(item_id)
                    words.append(w.view(np.int64))
                    grams.append(ngram_hashes(w, GRAM).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array([next(keys) for _ in ids], pa.int64()), pa.array(ids, pa.int64()), pa.array(words, pa.list_(pa.int64())), pa.array(grams, pa.list_(pa.int64()))], names=["item", "item_id", "words", "grams"])

    return shipped(items).mapInArrow(run, "item long, item_id long, words array<long>, grams array<long>")


def _bitmap(grams: DataFrame) -> np.ndarray:
    """A bitmap of fixed size over the top bits of the column ``h``."""
    words = grams.select(
        F.expr(f"cast(shiftrightunsigned(h, {64 - BITS + 6}) as int)").alias("word"),
        F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {64 - BITS}) & 63 as int))").alias("bits"),
    ).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    table = words.toArrow()  # 2^18 rows at most
    out = np.zeros(1 << (BITS - 6), np.int64)
    out[table.column("word").to_numpy()] = table.column("bits").to_numpy()
    return out


def _marked(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    bit = (h >> np.uint64(64 - BITS)).astype(np.int64)
    return np.flatnonzero((bitmap[bit >> 6] >> (bit & 63)) & 1)


def _counts(docs: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """How often each marked pair stands in the corpus (in how many documents)."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, bitmap, counts = WordHash(), shared.value, {}

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(np.fromiter(counts, np.uint64, len(counts)).view(np.int64)), pa.array(np.fromiter(counts.values(), np.int64, len(counts)))], names=["h", "n"])
            counts.clear()
            return out

        for batch in batches:
            for text in batch.column(0):
                h = ngram_hashes(known.of(fold_words(text.as_py())), GRAM)
                for x in set(h[_marked(bitmap, h)].tolist()):
                    counts[x] = counts.get(x, 0) + 1
            if len(counts) > 200_000:
                yield flush()
        if counts:
            yield flush()

    return shipped(docs).select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def _dense(at: np.ndarray, k: int, reach: int) -> np.ndarray:
    """Those of the ascending places ``at`` that are among ``k`` within ``reach``."""
    first = np.flatnonzero(at[k - 1 :] - at[: max(0, len(at) - k + 1)] <= reach)
    kept = np.zeros(len(at), bool)
    for j in range(k):
        kept[first + j] = True
    return at[kept]


def _windows(docs: DataFrame, bitmap: np.ndarray, k: int, reach: int) -> DataFrame:
    """Stretches of the texts' words around ``k`` marked pairs within ``reach``, with the distinct marked pairs in them."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, bitmap, keys = WordHash(), shared.value, _row_keys()
        schema = pa.schema([("window", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("words", pa.list_(pa.int64())), ("grams", pa.list_(pa.int64()))])
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                w = known.of(fold_words(text.as_py()))
                h = ngram_hashes(w, GRAM)
                at = _dense(_marked(bitmap, h), k, reach)
                if not len(at):
                    continue
                for group in np.split(at, np.flatnonzero(np.diff(at) > reach) + 1):
                    start, end = max(0, int(group[0]) - reach), int(group[-1]) + reach + GRAM
                    rows.append({"window": next(keys), "doc_id": doc_id, "start": start, "words": w[start:end].view(np.int64), "grams": np.unique(h[group]).view(np.int64)})
                if len(rows) >= 500:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)

    return shipped(docs).mapInArrow(run, "window long, doc_id long, start long, words array<long>, grams array<long>")


def _align(pairs: DataFrame) -> DataFrame:
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, item, start, a, b = (batch.column(i) for i in range(5))
            rows = []
            for i in range(batch.num_rows):
                words = a[i].values.to_numpy()
                best, end = smith_waterman(words, b[i].values.to_numpy())
                rows.append((best, best / len(words), len(words), start[i].as_py() + end))
            best, score, n, end = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([doc, item, pa.array(best, pa.int64()), pa.array(score, pa.float64()), pa.array(n, pa.int64()), pa.array(end, pa.int64())], names=["doc_id", "item_id", "matched", "score", "item_words", "end_word"])

    return shipped(pairs).select("doc_id", "item_id", "start", "of_item", "words").mapInArrow(run, "doc_id long, item_id long, matched long, score double, item_words long, end_word long")


def contaminated(docs: DataFrame, items: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """``doc_id, item_id, score, matched, item_words, end_word``: the best alignment of each document and item that passes.

    A pair passes if its score is ``least_score`` or more and at least 8 words, or the whole
    item if it is shorter, are matched net of edits; every such pair is found. Null or empty texts and items match
    nothing; documents with equal ids are one in the result; an empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = materialize(_item_grams(items.select(F.col("item_id").cast("long").alias("item_id"), "text")), "items")
    size = F.size("words")
    need = F.least(size, F.greatest(F.ceil(size * least_score - 1e-9), F.least(F.lit(LEAST_WORDS), size))).cast("int")  # T
    share = F.greatest(F.lit(1), F.least(F.lit(SHARED_SEEDS), need - 1))  # k
    needs = items.select("item", share.alias("share"), (size - need + share).alias("n_seeds"), (2 * size - need).alias("reach"), "grams")
    k, reach = needs.agg(F.min("share"), F.max("reach")).first()
    grams = needs.select("item", "share", "n_seeds", F.explode("grams").alias("h")).groupBy("item", "share", "n_seeds", "h").agg(F.count("*").alias("places"))
    ranked = grams.join(_counts(docs, _bitmap(grams)), "h", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rarer = Window.partitionBy("item").orderBy("n", "h").rowsBetween(Window.unboundedPreceding, -1)  # an item's own pairs
    seeds = ranked.withColumn("before", F.coalesce(F.sum("places").over(rarer), F.lit(0))).where("before < n_seeds")
    seeds = materialize(seeds.select("item", "share", "h", "places"), "seeds")
    windows = materialize(_windows(docs, _bitmap(seeds), k or 1, reach or 0), "windows")
    met = (
        windows.select("window", F.explode("grams").alias("h")).join(seeds, "h")
        .groupBy("window", "item", "share").agg(F.sum("places").alias("places")).where("places >= share").select("window", "item")
    )
    pairs = met.join(windows.drop("grams"), "window").join(items.select("item", "item_id", F.col("words").alias("of_item")), "item")
    passed = _align(pairs).where((F.col("score") >= least_score) & (F.col("matched") >= F.least(F.lit(LEAST_WORDS), F.col("item_words"))))
    best = passed.groupBy("doc_id", "item_id").agg(F.max(F.struct("score", "matched", "item_words", "end_word")).alias("best"))
    return best.select("doc_id", "item_id", "best.*")


def drop_contaminated(docs: DataFrame, items: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs`` that no item was found in, with all their columns, whatever those are called.

    A row is judged by its text, told by a 64-bit hash: rows with equal or null ids and unlike
    texts don't share their fate, repeated rows do. Null and empty texts stay; an empty table
    gives none, and without items all rows stay.
    """
    told = F.xxhash64("text")
    found = contaminated(docs.select(told.alias("doc_id"), "text"), items, least_score)
    name = free_name(docs.columns, "_found")
    found = materialize(found.select(F.col("doc_id").alias(name)).distinct(), "contaminated")
    return docs.join(found, told == F.col(name), "left_anti")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
