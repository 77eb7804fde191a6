"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

Every pair of features interacts through a low-rank product. The pair sum is taken in linear time with the
sum-of-squares identity: half of (sum of v x) squared less the sum of (v x) squared, per factor.

Training takes at most ``MAX_TRAINING_ROWS`` labelled documents, those with the smallest hash of their id; features are
made on executors, and the bounded sample is fitted on the driver. Scoring reads every whole text, shuffles nothing and
never looks at labels, language, source or id.

Defined cases: null and empty texts have zero statistics and are scored like others; a null ``n_chars`` (or no such
column) counts as the length of the text; documents labelled twice use the smaller label; without labelled rows every
score is 0.5; repeated rows are scored each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.llm import textkit

WORD_CELLS = 2048
BINS = 8
FACTORS = 8
EPOCHS = 40
MAX_TRAINING_ROWS = 6000
SLICE_ROWS = 512  # a row takes a few times WORD_CELLS numbers
THRESHOLD = 0.7
STATISTICS = 13

_ASCII = np.arange(256)
UPPER = (_ASCII >= 65) & (_ASCII <= 90)
LOWER = (_ASCII >= 97) & (_ASCII <= 122)
DIGIT = (_ASCII >= 48) & (_ASCII <= 57)
COMMON_MARKS = np.isin(_ASCII, [ord(c) for c in ".,;:'\"?-()"])
SYMBOL = (_ASCII > 32) & (_ASCII < 127) & ~UPPER & ~LOWER & ~DIGIT & ~COMMON_MARKS


def raw_features(texts: pa.Array, n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Statistics (texts x STATISTICS) and word frequencies by hash (texts x WORD_CELLS), each row of unit length."""
    count = len(texts)
    offsets, word, vocabulary = textkit.words(pc.ascii_lower(texts))
    row, n = textkit.rows_of(offsets), np.diff(offsets)
    cell = (textkit.hash_strings(vocabulary) % np.uint64(WORD_CELLS)).astype(np.int64)
    tf = np.bincount(row * WORD_CELLS + cell[word], minlength=count * WORD_CELLS).reshape(count, WORD_CELLS)
    tf = np.log1p(tf.astype(np.float32))
    tf /= np.maximum(np.sqrt((tf * tf).sum(axis=1, keepdims=True)), 1e-6)

    size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    data = np.frombuffer(b"".join(texts.cast(pa.large_binary()).to_pylist()), np.uint8)
    starts = np.concatenate(([0], np.cumsum(size)))

    def total(mark: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(mark[data])))[starts])

    upper, lower, symbol, lines = total(UPPER), total(LOWER), total(SYMBOL), total(_ASCII == 10)
    some, letters = np.maximum(size, 1), np.maximum(upper + lower, 1)
    many = np.maximum(n, 1)
    same = np.zeros(len(word), bool)
    same[1:] = (word[1:] == word[:-1]) & (row[1:] == row[:-1])
    pair = row * max(1, len(vocabulary)) + word
    distinct, times = np.unique(pair, return_counts=True)
    owner = distinct // max(1, len(vocabulary))
    most = np.zeros(count)
    np.maximum.at(most, owner, times)
    length = pc.binary_length(vocabulary).to_numpy(zero_copy_only=False)[word] if len(word) else np.zeros(0)
    statistics = np.stack(
        [
            np.log1p(n_chars),
            np.log1p(n),
            np.bincount(row, weights=length, minlength=count) / many,
            upper / letters,
            total(DIGIT) / some,
            total(COMMON_MARKS) / some,
            symbol / some,
            total(_ASCII == 124) / many,
            total(_ASCII >= 128) / some,
            np.bincount(owner, minlength=count) / many,
            most / many,
            np.bincount(row[same], minlength=count) / many,
            (lines + 1) / many,
        ],
        axis=1,
    )
    return statistics, tf


@dataclass
class QualityModel:
    edges: np.ndarray  # STATISTICS x (BINS - 1)
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def design(self, statistics: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """Features: word cells, then one indicator per statistic and bin."""
        marks = np.zeros((len(tf), STATISTICS * BINS), np.float32)
        for k in range(STATISTICS):
            at = np.searchsorted(self.edges[k], statistics[:, k], side="right")
            marks[np.arange(len(tf)), k * BINS + at] = 1 / np.sqrt(STATISTICS)
        return np.concatenate((tf, marks), axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        z, _ = margin(x, self.bias, self.linear, self.factors)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30).astype(np.float64)))


def margin(x: np.ndarray, bias: float, linear: np.ndarray, factors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Value of the machine per row, and the factor sums that its gradient needs too."""
    sums = x @ factors
    return bias + x @ linear + 0.5 * (sums * sums - (x * x) @ (factors * factors)).sum(axis=1), sums


def fit(statistics: np.ndarray, tf: np.ndarray, label: np.ndarray, seed: int = 1, epochs: int = EPOCHS) -> QualityModel:
    """Logistic loss by Adam over a bounded sample. The same sample and seed give the same model."""
    rng = np.random.default_rng(seed)
    edges = np.quantile(statistics, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T
    model = QualityModel(edges, 0.0, np.zeros(0), np.zeros((0, 0)))
    x, y = model.design(statistics, tf), label.astype(np.float32)
    width = x.shape[1]
    parameters = [
        np.zeros(1, np.float32),
        np.zeros(width, np.float32),
        rng.normal(0, 0.05, (width, FACTORS)).astype(np.float32),
    ]
    first = [np.zeros_like(p) for p in parameters]
    second = [np.zeros_like(p) for p in parameters]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for k in range(0, len(y), 256):
            rows = order[k : k + 256]
            bias, linear, factors = parameters
            part = x[rows]
            z, sums = margin(part, float(bias[0]), linear, factors)
            error = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[rows]) / len(rows)).astype(np.float32)
            gradient = [
                np.array([error.sum()], np.float32),
                part.T @ error + 1e-4 * linear,
                part.T @ (error[:, None] * sums) - ((part * part).T @ error)[:, None] * factors + 1e-4 * factors,
            ]
            step += 1
            for p, g, m, v in zip(parameters, gradient, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    bias, linear, factors = parameters
    return QualityModel(edges, float(bias[0]), linear, factors)


def length_of(docs: DataFrame) -> Column:
    """The metadata column ``n_chars``, or else the length of the text."""
    length = F.coalesce(F.char_length(F.col("text").cast("string")), F.lit(0)).cast("long")
    return F.coalesce(F.col("n_chars").cast("long"), length) if "n_chars" in docs.columns else length


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> QualityModel | None:
    """Model from ``labels(doc_id, quality)`` and their documents. ``labels`` must hold training rows only."""
    docs = textkit.in_small_batches(docs)
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    sample = (
        known.groupBy(F.col("doc_id").cast("long").alias("label_id"))
        .agg(F.min("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("label_id"), "label_id")
        .limit(max_rows)
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textkit.slices(batch, "text", rows=SLICE_ROWS):
                n = np.maximum(part.column("n_chars").to_numpy(zero_copy_only=False), 0)
                statistics, tf = raw_features(textkit.texts_of(part.column("text")), n)
                rows, cells = np.nonzero(tf)
                ends = np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=len(tf)))))
                fixed = np.arange(len(tf) + 1) * STATISTICS
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("quality"),
                        textkit.list_array(fixed, pa.array(statistics.ravel())),
                        textkit.list_array(ends, pa.array(cells, pa.int32())),
                        textkit.list_array(ends, pa.array(tf[rows, cells], pa.float32())),
                    ],
                    ["quality", "statistics", "cells", "weights"],
                )

    # The broadcast holds at most max_rows rows of two numbers; one text per id, so at most max_rows come back.
    rows = (
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
            length_of(docs).alias("n_chars"),
        )
        .join(F.broadcast(sample), F.col("doc_id") == F.col("label_id"))
        .groupBy("doc_id", "quality")
        .agg(F.min(F.struct("text", "n_chars")).alias("document"))
        .select("document.text", "document.n_chars", "quality")
        .mapInArrow(extract, "quality int, statistics array<double>, cells array<int>, weights array<float>")
        .toArrow()
        .combine_chunks()
    )
    if not rows.num_rows:
        return None
    cells, owner = rows["cells"].combine_chunks(), np.arange(rows.num_rows)
    owner = np.repeat(owner, pc.list_value_length(cells).to_numpy(zero_copy_only=False))
    tf = np.zeros((rows.num_rows, WORD_CELLS), np.float32)
    tf[owner, cells.flatten().to_numpy()] = rows["weights"].combine_chunks().flatten().to_numpy()
    statistics = rows["statistics"].combine_chunks().flatten().to_numpy().reshape(-1, STATISTICS)
    return fit(statistics, tf, rows["quality"].to_numpy() > 0)


def scored(docs: DataFrame, model: QualityModel | None, column: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score in ``column`` (which replaces one of that name). Nothing is shuffled."""
    kept = textkit.in_small_batches(docs).drop(column)
    own = textkit.unused(kept, "quality ")
    text, chars = f"{own}text", f"{own}length"
    schema = kept.schema.add(column, "double")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textkit.slices(batch, text, rows=SLICE_ROWS):
                n = np.maximum(part.column(chars).to_numpy(zero_copy_only=False), 0)
                if model is None:
                    value = np.full(part.num_rows, 0.5)
                else:
                    value = model.score(model.design(*raw_features(textkit.texts_of(part.column(text)), n)))
                yield pa.RecordBatch.from_arrays([*part.columns[:-2], pa.array(value)], schema.names)

    full = kept.withColumns({text: F.col("text").cast("string"), chars: length_of(docs)})
    return full.mapInArrow(apply, schema)
