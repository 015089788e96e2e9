"""Language identification by error-correcting output codes.

Each language has a codeword. For each bit of the codewords a binary classifier (logistic
regression over hashed character n-grams, trained in numpy) is fitted. A text's bit scores
are compared with every codeword by a logistic loss, each bit weighted by how well its
classifier does on rows kept aside; the codeword with the smallest loss names the language,
and a small lead over the second flags the text as ambiguous.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.llm.common import bounded_ids, crc_of_id, mix, read_table, tidy
from strandlake.session import shipped

UNKNOWN = "und"
FEATURES = 4096
#: Labelled documents that are learned from, at most: of each language, and in all. A document is 16 KB of counts on the driver.
PER_LANGUAGE = 600
MOST_ROWS = 12_000
MAX_LANGUAGES = 400
#: Code points handled at once.
PIECE = 1 << 20
AMBIGUOUS_LEAD = 0.1


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """``n`` rows of -1 and 1: every split of the classes for up to 6, else random columns, far apart by choice."""
    if n <= 1:
        return np.ones((n, 1), np.float32)
    if n <= 6:
        columns = [[1, *bits] for bits in itertools.product((1, -1), repeat=n - 1) if -1 in bits]
        return np.array(columns, np.float32).T
    rng = np.random.default_rng(seed)
    width = int(12 * np.ceil(np.log2(n)))
    best, apart = None, -1
    for _ in range(50):
        code = rng.choice(np.array([-1, 1], np.float32), (n, width))
        far = min(int((code[i] != code[j]).sum()) for i in range(n) for j in range(i))
        if far > apart and np.all(np.abs(code.sum(0)) < n):
            best, apart = code, far
    return best


def ngram_counts(text: str | None) -> tuple[np.ndarray, int]:
    """Counts of hashed character 1- to 3-grams of the lower-cased text, and how many letters it has."""
    counts, letters = np.zeros(FEATURES, np.float32), 0
    for at in range(0, len(text or ""), PIECE):
        part = text[max(0, at - 2) : at + PIECE].lower()
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        plain = codes < 128
        letter = (codes - 97 < 26) & plain
        if not plain.all():
            wide = np.flatnonzero(~plain)
            values, where = np.unique(codes[wide], return_inverse=True)
            letter[wide] = np.array([chr(v).isalpha() for v in values])[where]
        letters += int(letter.sum())
        codes = np.where(letter, codes, 32).astype(np.uint64)
        keep = np.ones(len(codes), bool)  # runs of what isn't a letter count as one blank
        keep[1:] = letter[1:] | letter[:-1]
        codes = codes[keep]
        for n in (1, 2, 3):
            if len(codes) < n:
                break
            total = codes[: len(codes) - n + 1] + np.uint64(n << 32)
            for j in range(1, n):
                total = total * np.uint64(1_000_003) + codes[j : len(codes) - n + 1 + j]
            counts += np.bincount((mix(total) % np.uint64(FEATURES)).astype(np.int64), minlength=FEATURES)
    return counts, letters


def features(counts: np.ndarray) -> np.ndarray:
    """Square roots of shares: rows of length 1 whatever the text's length."""
    total = counts.sum(axis=-1, keepdims=True)
    return np.sqrt(counts / np.maximum(total, 1)).astype(np.float32)


@dataclass
class LanguageModel:
    """Codewords, bit classifiers and the weight of each bit."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def losses(self, x: np.ndarray) -> np.ndarray:
        bits = x @ self.weights + self.bias
        loss = np.logaddexp(0, -self.code[None] * bits[:, None, :])
        return (loss * self.trust).sum(2) / self.trust.sum()

    def predict(self, counts: np.ndarray, letters: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Languages, scores in 0..1, and whether the lead is small."""
        if not self.languages:
            return [UNKNOWN] * len(counts), np.zeros(len(counts)), np.ones(len(counts), bool)
        loss = self.losses(features(counts))
        share = np.exp(-8 * (loss - loss.min(1, keepdims=True)))
        share /= share.sum(1, keepdims=True)
        best = loss.argmin(1)
        ordered = np.sort(loss, 1)
        close = ordered[:, 1] - ordered[:, 0] < AMBIGUOUS_LEAD if loss.shape[1] > 1 else np.zeros(len(loss), bool)
        known = letters > 0
        names = [self.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
        return names, np.where(known, share[np.arange(len(best)), best], 0.0), close | ~known


def fit(x: np.ndarray, y: np.ndarray, languages: list[str], rounds: int = 300, rate: float = 2.0, seed: int = 3) -> LanguageModel:
    """Train the bit classifiers by gradient descent with momentum; a fifth of the rows is kept aside for the weights."""
    code = codewords(len(languages))
    if len(languages) < 2:
        return LanguageModel(languages, code, np.zeros((FEATURES, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32), np.ones(code.shape[1], np.float32))
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(x))
    aside, used = order[: len(x) // 5], order[len(x) // 5 :]
    share = np.bincount(y[used], minlength=len(languages)).astype(np.float32)
    weight = (1 / np.maximum(share, 1))[y[used]]
    weight /= weight.sum()
    target, x_used = code[y[used]], x[used]
    w, b = np.zeros((FEATURES, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    vw, vb = np.zeros_like(w), np.zeros_like(b)
    for _ in range(rounds):
        margin = np.clip(target * (x_used @ w + b), -30, 30)
        pull = -(target / (1 + np.exp(margin))) * weight[:, None]
        vw = 0.9 * vw - rate * (x_used.T @ pull + 1e-6 * w)
        vb = 0.9 * vb - rate * pull.sum(0)
        w, b = w + vw, b + vb
    model = LanguageModel(languages, code, w, b, np.ones(code.shape[1], np.float32))
    if len(aside):
        right = (np.sign(x[aside] @ w + b) == code[y[aside]]).mean(0)
        model.trust = np.maximum(right - 0.5, 0.01).astype(np.float32)
    return model


def train(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> LanguageModel:
    """Fit on at most ``per_language`` rows of each language of ``labelled`` (``doc_id``, ``text``, ``lang``), and ``MOST_ROWS`` in all.

    The counts of whole texts are made on the executors; the driver gets 4096 numbers for each
    chosen row. Rows with a null in any of the three columns, or without a letter, are left
    out, other columns ignored whatever their names; chosen are those with the lowest hash of
    the id, so order and ties don't matter. Rows with equal ids are chosen together, repeated
    rows as well. An empty table gives a model that knows no language, which calls every text
    ``und``; one language only is predicted for every text with a letter.
    """
    labelled = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    labels = labelled.select("doc_id", "lang").where("doc_id is not null")
    ids = bounded_ids(labels, "doc_id", "lang", per_language, most_rows=MOST_ROWS).select("doc_id").distinct()
    chosen = labelled.select("doc_id", "text", "lang").join(F.broadcast(ids), "doc_id")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, raw = [], []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts, letters = ngram_counts(text.as_py())
                if letters:
                    lang.append(name)
                    raw.append(counts.astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(raw, pa.binary())], names=["lang", "counts"])

    table = shipped(chosen).select("lang", "text").mapInArrow(run, "lang string, counts binary").toArrow()
    names = table.column("lang").to_pylist()
    raw = [np.frombuffer(c, np.float32) for c in table.column("counts").to_pylist()]
    order = sorted(range(len(names)), key=lambda i: (names[i], raw[i].tobytes()))  # whatever order the tasks end in
    languages = sorted(set(names))
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages are labelled")
    x = features(np.array([raw[i] for i in order], np.float32).reshape(-1, FEATURES))
    y = np.array([languages.index(names[i]) for i in order], np.int64)
    return fit(x, y, languages)


def predict_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``lang_pred``, ``score`` and ``ambiguous`` for every row of ``docs``, next to its other columns but ``text``.

    A null text or one without a letter is ``und`` with score 0, and ambiguous. A text of any
    length is read whole, a piece at a time. Of languages with equal losses the first by name
    is taken. Columns of ``docs`` with these three names are replaced. Every row gives one row,
    repeated ones and those with equal or null ids too; an empty table gives none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the features and languages
    kept = [c for c in docs.columns if c.lower() not in ("text", "lang_pred", "score", "ambiguous")]
    schema = docs.select(*kept).schema.add("lang_pred", "string").add("score", "double").add("ambiguous", "boolean")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                found = [ngram_counts(t.as_py()) for t in batch.column(len(kept))]
                names, score, close = model.predict(np.array([f[0] for f in found]), np.array([f[1] for f in found]))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i) for i in range(len(kept))), pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(close, pa.bool_())],
                    names=[*kept, "lang_pred", "score", "ambiguous"],
                )

    return shipped(docs).select(*kept, "text").mapInArrow(run, schema)


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_of_id(F.col("doc_id")) % 3 == 1, F.lit(False))
    model = train(docs.where(~held_out))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text")
    return predict_languages(rows, model).drop("ambiguous")
