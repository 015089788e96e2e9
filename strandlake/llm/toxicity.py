"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word has two rows, picked by two hashes from two tables, so a word that is hit by chance in
one is told apart by the other. Filters of several widths run over the words, the greatest
response of each filter over the whole text is kept, and a logistic layer gives the score.
Each dimension that starts from the words' log odds gives the training a place to begin.

Thresholds are calibrated by language on rows kept aside, drawn towards the common one where
a language has few. They bear on decisions only; a score never sees the language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandlake.llm.common import WordHash, bounded_ids, crc_of_id, fold_words, free_name, read_table, tidy
from strandlake.session import shipped

BUCKETS = 1 << 16
DIM = 4  # of each table
WIDTHS = (1, 2, 3)
FILTERS = 8  # of each width
#: Labelled rows of each label that are learned from, at most, and the longest text among them, in words.
PER_LABEL = 3_000
TRAIN_WORDS = 4_000
#: Words handled at once when scoring.
PIECE = 1 << 16


def word_rows(text: str | None, known: WordHash) -> np.ndarray:
    """Two table rows for each word of the whole text."""
    h = known.of(fold_words(text))
    return np.stack([(h & np.uint64(BUCKETS - 1)), ((h >> np.uint64(32)) & np.uint64(BUCKETS - 1))], 1).astype(np.int32)


@dataclass
class ToxicityModel:
    """Tables, filters, the logistic layer, and thresholds."""

    tables: np.ndarray  # 2, BUCKETS, DIM
    filters: list[np.ndarray]  # by width: width, 2 * DIM, FILTERS
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: float
    threshold: float = 0.5
    by_language: dict[str, float] = field(default_factory=dict)

    def embed(self, rows: np.ndarray) -> np.ndarray:
        return np.concatenate([self.tables[0][rows[:, 0]], self.tables[1][rows[:, 1]]], 1)

    def pooled(self, rows: np.ndarray) -> np.ndarray:
        """The greatest response of each filter over a text; texts longer than a piece in overlapping pieces."""
        best = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        reach = max(WIDTHS) - 1
        for at in range(0, len(rows), PIECE):
            x = self.embed(rows[max(0, at - reach) : at + PIECE])
            for k, width in enumerate(WIDTHS):
                n = len(x) - width + 1
                if n > 0:
                    r = sum(x[j : j + n] @ self.filters[k][j] for j in range(width))
                    best[k] = np.maximum(best[k], r.max(0) + self.bias[k])
        return np.concatenate(best)

    def raw(self, rows: np.ndarray) -> float:
        return float(self.pooled(rows) @ self.out + self.out_bias)

    def score(self, rows: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.raw(rows), -30, 30))))


def _start(rows: list[np.ndarray], y: np.ndarray, rng: np.random.Generator) -> ToxicityModel:
    tables = np.zeros((2, BUCKETS, DIM), np.float32)
    n = np.array([max(1, (y == 0).sum()), max(1, (y == 1).sum())], np.float32)
    for t in range(2):
        seen = np.zeros((2, BUCKETS), np.float32)
        for r, label in zip(rows, y):
            seen[label, np.unique(r[:, t])] += 1
        odds = np.log((seen[1] + 0.5) / (n[1] + 1)) - np.log((seen[0] + 0.5) / (n[0] + 1))
        often = np.minimum(1, seen.sum(0) / 20)  # rare words start near 0
        tables[t, :, 0] = np.clip(odds, -4, 4) * often / 4
    filters = [rng.normal(0, 0.3, (w, 2 * DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    filters[0][0, :, 0] = 0
    filters[0][0, [0, DIM], 0] = 2.0
    out = np.full(len(WIDTHS) * FILTERS, 0.05, np.float32)
    out[0] = 2.0
    return ToxicityModel(tables, filters, [np.full(FILTERS, -0.5, np.float32) for _ in WIDTHS], out, -1.0)


def fit(rows: list[np.ndarray], y: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.01, seed: int = 11) -> ToxicityModel:
    """Gradient descent (Adam) on the logistic loss with both labels weighted alike."""
    rng = np.random.default_rng(seed)
    model = _start(rows, y, rng)
    if len(set(y.tolist())) < 2:
        model.out[:] = 0
        model.out_bias = 5.0 if len(y) and y[0] == 1 else -5.0
        return model
    params = [model.tables, *model.filters, *model.bias, model.out]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    mb = vb = 0.0
    weight = np.where(y == 1, 0.5 / max(1e-9, (y == 1).mean()), 0.5 / max(1e-9, (y == 0).mean()))
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), batch):
            grads = [np.zeros_like(p) for p in params[1:]]
            touched: list[tuple[np.ndarray, np.ndarray]] = []
            gb = 0.0
            chosen = order[at : at + batch]
            for i in chosen:
                r = rows[i]
                x = model.embed(r)
                values, places = [], []
                for k, width in enumerate(WIDTHS):
                    n = len(x) - width + 1
                    if n <= 0:
                        values.append(np.zeros(FILTERS, np.float32))
                        places.append(None)
                        continue
                    resp = sum(x[j : j + n] @ model.filters[k][j] for j in range(width)) + model.bias[k]
                    places.append(resp.argmax(0))
                    values.append(np.maximum(resp.max(0), 0))
                pooled = np.concatenate(values)
                z = float(pooled @ model.out + model.out_bias)
                d = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[i]) * weight[i] / len(chosen)
                gb += d
                grads[-1] += d * pooled
                for k, width in enumerate(WIDTHS):
                    if places[k] is None:
                        continue
                    pull = d * model.out[k * FILTERS : (k + 1) * FILTERS] * (values[k] > 0)
                    grads[len(WIDTHS) + k] += pull
                    for j in range(width):
                        where = places[k] + j
                        grads[k][j] += (x[where] * pull[:, None]).T
                        touched.append((r[where], pull[:, None] * model.filters[k][j].T))
            step += 1
            fix1, fix2 = 1 - 0.9**step, 1 - 0.999**step
            for p, g, a, b in zip(params[1:], grads, m[1:], v[1:]):
                a *= 0.9
                a += 0.1 * g
                b *= 0.999
                b += 0.001 * g * g
                p -= rate * (a / fix1) / (np.sqrt(b / fix2) + 1e-8)
            mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
            model.out_bias -= rate * (mb / fix1) / (np.sqrt(vb / fix2) + 1e-8)
            if touched:  # the tables' rows that were hit, by plain steps
                hit = np.concatenate([t[0] for t in touched])
                pull = np.concatenate([t[1] for t in touched])
                for t in range(2):
                    np.add.at(model.tables[t], hit[:, t], -2.0 * rate * pull[:, t * DIM : (t + 1) * DIM])
    return model


def calibrate(model: ToxicityModel, raw: np.ndarray, y: np.ndarray, languages: list[str | None], share: float) -> None:
    """Move the scores so that 0.5 is the best common threshold for ``share`` of label 1, and set thresholds by language."""
    def best(raw, y):
        if not len(raw) or len(set(y.tolist())) < 2:
            return None
        weight = np.where(y == 1, share / max(1, (y == 1).sum()), (1 - share) / max(1, (y == 0).sum()))
        cuts = np.unique(raw)
        cuts = np.concatenate([[cuts[0] - 1], (cuts[1:] + cuts[:-1]) / 2, [cuts[-1] + 1]])
        order = np.argsort(raw)
        hit, miss = np.cumsum(np.where(y[order] == 1, weight[order], 0)), np.cumsum(np.where(y[order] == 0, weight[order], 0))
        below = np.searchsorted(raw[order], cuts)
        wrong = np.append(0, hit)[below] + (miss[-1] - np.append(0, miss)[below])
        good = np.flatnonzero(wrong <= wrong.min() + 1e-9)
        return float(cuts[good[len(good) // 2]])

    common = best(raw, y)
    if common is None:
        return
    model.out_bias -= common
    for name in sorted({x for x in languages if x is not None}):
        own = np.array([x == name for x in languages])
        cut = best(raw[own], y[own])
        if cut is not None:
            n = int(min((y[own] == 1).sum(), (y[own] == 0).sum()))
            moved = (cut - common) * n / (n + 50.0)
            model.by_language[name] = float(1 / (1 + np.exp(-np.clip(moved, -4, 4))))


def train(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, max_words: int = TRAIN_WORDS) -> ToxicityModel:
    """Fit on at most ``per_label`` documents of each value of ``labels.toxic``, of at most ``max_words`` words each.

    A quarter of them sets the thresholds. Rows without a label or an id are left out; with
    one label only, every text scores that label, and with none, as in empty tables, all
    texts score alike. An id with both labels counts as toxic. Chosen are the ids with the lowest
    hash, so order and ties don't matter; rows of ``docs`` with equal ids are all learned from.
    Columns other than ``doc_id``, ``text``, ``lang`` and ``toxic`` are ignored, whatever their names.
    """
    labels = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)")
    labels = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in labels.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    ids = bounded_ids(labels, "doc_id", "toxic", per_label)
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    chosen = docs.select("doc_id", "text", lang.alias("lang")).join(F.broadcast(ids), "doc_id")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHash()
        for batch in batches:
            ids, toxic, lang, raw = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), []
            for text in batch.column(3):
                rows = word_rows(text.as_py(), known)
                raw.append(rows.tobytes() if len(rows) <= max_words else None)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(toxic, pa.int32()), pa.array(lang, pa.string()), pa.array(raw, pa.binary())], names=["doc_id", "toxic", "lang", "rows"])

    table = shipped(chosen).select(F.col("doc_id").cast("long").alias("doc_id"), "toxic", "lang", "text").mapInArrow(run, "doc_id long, toxic int, lang string, rows binary").where("rows is not null").toArrow()
    found = sorted(zip(*(table.column(c).to_pylist() for c in ("doc_id", "toxic", "lang", "rows"))), key=lambda r: (r[0], r[3]))
    rows = [np.frombuffer(r[3], np.int32).reshape(-1, 2) for r in found]
    y = np.array([r[1] for r in found], np.int64)
    order = np.random.default_rng(5).permutation(len(found))
    aside, used = order[: len(order) // 4], order[len(order) // 4 :]
    model = fit([rows[i] for i in used], y[used])
    if len(aside):
        share = counts.get(1, 0) / max(1, sum(counts.values()))
        calibrate(model, np.array([model.raw(rows[i]) for i in aside]), y[aside], [found[i][2] for i in aside], share)
    return model


def score_documents(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` with ``score`` (0 to 1), the whole text's; a null text is scored as an empty one.

    A text of any length is read whole, a piece at a time. A column ``score`` of ``docs`` is
    replaced. Every row gives one row, repeated ones and those with equal or null ids too; an
    empty table gives none.
    """
    docs = docs.select(*(c for c in docs.columns if c.lower() != "score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 tables of 65,536 rows
    kept = docs.columns
    at = kept.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = shared.value, WordHash()
        for batch in batches:
            scores = [model.score(word_rows(t.as_py(), known)) for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*kept, "score"])

    return shipped(docs).mapInArrow(run, schema)


def reject_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """Rows of ``docs`` whose score stays below the threshold of their ``lang``, or the common one.

    All columns are kept, one named ``score`` too. A null text is judged as an empty one, a
    null or unknown ``lang`` by the common threshold; a score at the threshold goes.
    Repeated rows are judged alike; an empty table gives none.
    """
    kept = docs.columns
    own = free_name(kept, "_own_score")
    limit = F.lit(model.threshold)
    if "lang" in kept:
        for name, value in sorted(model.by_language.items()):
            limit = F.when(F.col("lang") == name, F.lit(value)).otherwise(limit)
    return score_documents(docs.withColumnRenamed("score", own), model).where(F.col("score") < limit).drop("score").toDF(*kept)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    held_out = F.coalesce(crc_of_id(F.col("doc_id")) % 5 == 0, F.lit(False))
    model = train(docs, labels.where(~held_out))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text")
    return score_documents(rows, model).select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
