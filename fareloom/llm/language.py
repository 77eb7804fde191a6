"""Language identification as inference of a mixture of languages.

Training counts byte trigrams of words per language over all training documents; each task adds them up before a row
travels. A document is then a mixture: expectation-maximisation finds the proportions of the languages from the
likelihoods of its words, and the set of languages is grown as long as the log-likelihood, less half the logarithm of the
number of words per language more, rises. The language with the largest proportion is the prediction.

The model has a fixed number of cells per language. Languages are distinct values of a column and few; more than
``MAX_LANGUAGES`` raise an error instead of filling the driver.

Defined cases: a text that is null or has no letter is ``und`` with score 0; so is every text when nothing was learned;
null languages are not learned; ties go to the smaller language name; repeated rows count each; further columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm import textkit
from fareloom.session import materialise

CELLS = 1 << 14
SMOOTHING = 0.05
EM_STEPS = 6
MAX_LANGUAGES = 1000
UNKNOWN = "und"

# Bytes that are not part of a word: ASCII other than letters. Bytes from 0x80 on belong to letters of other scripts.
FOLDED = np.array([b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint32)


def trigram_cells(vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the byte trigrams of each word with a blank at both ends: (offset of each word's first, cells)."""
    binary = vocabulary.cast(pa.large_binary())
    size = pc.binary_length(binary).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(size)
    data = np.frombuffer(b"".join(binary.to_pylist()), np.uint8)
    # One blank before each word and one after the last: word k starts at ends[k - 1] + k + 1.
    padded = np.full(len(data) + len(size) + 1, 32, np.uint32)
    padded[np.arange(len(data)) + np.repeat(np.arange(len(size)), size) + 1] = FOLDED[data]
    codes = (padded[:-2] << np.uint32(16)) | (padded[1:-1] << np.uint32(8)) | padded[2:]
    own = np.ones(len(codes), bool)
    own[(ends + np.arange(len(size)))[:-1]] = False  # trigrams that straddle two words
    cells = (codes[own] * np.uint32(0x9E3779B1)) >> np.uint32(32 - CELLS.bit_length() + 1)
    return np.concatenate(([0], ends)), cells.astype(np.int64)


@dataclass
class LanguageModel:
    languages: list[str]
    log_probability: np.ndarray  # cells x languages


def trigram_counts(docs: DataFrame) -> DataFrame:
    """``lang, cell, n`` over all rows of ``docs(text, lang)`` with a language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in textkit.slices(batch, "text"):
                names = part.column("lang").dictionary_encode()
                for k, name in enumerate(names.dictionary.to_pylist()):
                    texts = textkit.texts_of(part.column("text").filter(pc.equal(names.indices, k)))
                    _, word, vocabulary = textkit.words(pc.utf8_lower(texts))
                    if not len(vocabulary):
                        continue
                    starts, cells = trigram_cells(vocabulary)
                    times = np.repeat(np.bincount(word, minlength=len(vocabulary)), np.diff(starts))
                    total.setdefault(name, np.zeros(CELLS))
                    total[name] += np.bincount(cells, weights=times, minlength=CELLS)
        for name, n in total.items():
            cell = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(cell), pa.string()), pa.array(cell, pa.int32()), pa.array(n[cell].astype(np.int64))],
                ["lang", "cell", "n"],
            )

    known = textkit.in_small_batches(docs).filter(F.col("lang").isNotNull()).select(
        F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    )
    partial = known.mapInArrow(count, "lang string, cell int, n long")
    return partial.groupBy("lang", "cell").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, max_languages: int = MAX_LANGUAGES) -> LanguageModel:
    """Model from all rows of ``docs(text, lang)``. The driver gets one row per language and cell."""
    counts = materialise(trigram_counts(docs), "trigrams")
    languages = sorted(r[0] for r in counts.select("lang").distinct().limit(max_languages + 1).collect())
    if len(languages) > max_languages:
        raise ValueError(f"more than {max_languages} languages; is this the right column?")
    table = np.full((CELLS, len(languages)), SMOOTHING)
    found = counts.toArrow()
    column = pc.index_in(found["lang"], pa.array(languages, found["lang"].type)).to_numpy()
    table[found["cell"].to_numpy(), column] += found["n"].to_numpy()
    return LanguageModel(languages, np.log(table / table.sum(axis=0)).astype(np.float32))


def mixtures(
    offsets: np.ndarray, word: np.ndarray, likelihood: np.ndarray, steps: int = EM_STEPS
) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of the languages in each text, zero outside the chosen set; and the size of that set.

    ``likelihood`` holds, per distinct word, the likelihood in each language over that of its best language.
    """
    n, k = np.diff(offsets), likelihood.shape[1]
    texts = np.flatnonzero(n)
    chosen, size = np.zeros((len(n), k), np.float64), np.zeros(len(n), np.int64)

    def fit(rows: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """EM over the given texts with the allowed languages only: proportions and log-likelihoods."""
        take = np.repeat(offsets[rows] - np.concatenate(([0], np.cumsum(n[rows])[:-1])), n[rows]) + np.arange(n[rows].sum())
        own = np.repeat(np.arange(len(rows)), n[rows])
        starts = np.concatenate(([0], np.cumsum(n[rows])[:-1]))
        e = likelihood[word[take]]
        share = allowed / allowed.sum(axis=1, keepdims=True)
        for _ in range(steps):
            joint = e * share[own].astype(np.float32)
            joint /= joint.sum(axis=1, keepdims=True)
            share = np.add.reduceat(joint, starts, axis=0, dtype=np.float64) / n[rows, None]
        fitted = np.log((e * share[own].astype(np.float32)).sum(axis=1) + np.float32(1e-30))
        return share, np.add.reduceat(fitted, starts, dtype=np.float64)

    if not len(texts):
        return chosen, size
    full, _ = fit(texts, np.ones((len(texts), k)))
    rank = np.argsort(np.argsort(-full, axis=1, kind="stable"), axis=1)
    active, best = np.arange(len(texts)), np.full(len(texts), -np.inf)
    for m in range(1, k + 1):
        rows = texts[active]
        share, fitted = fit(rows, (rank[active] < m).astype(np.float64))
        value = fitted - 0.5 * (m - 1) * np.log(n[rows])
        better = value > best[active]
        gained = active[better]
        best[gained], chosen[texts[gained]], size[texts[gained]] = value[better], share[better], m
        active = gained
        if not len(active):
            break
    return chosen, size


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id, lang_pred, score, languages`` of every row: ``score`` is the proportion of the predicted language,
    ``languages`` the number of languages found."""

    def infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.languages, UNKNOWN], object)
        for batch in batches:
            for part in textkit.slices(batch, "text"):
                texts = textkit.texts_of(part.column("text"))
                usable = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
                label, score = np.full(len(texts), len(model.languages)), np.zeros(len(texts))
                found = np.zeros(len(texts), np.int64)
                if model.languages and usable.any():
                    offsets, word, vocabulary = textkit.words(pc.utf8_lower(texts))
                    starts, cells = trigram_cells(vocabulary)
                    logs = np.add.reduceat(model.log_probability[cells], starts[:-1], axis=0)
                    likelihood = np.maximum(np.exp(logs - logs.max(axis=1, keepdims=True)), np.float32(1e-20))
                    share, found = mixtures(offsets, word, likelihood)
                    label = np.where(usable, share.argmax(axis=1), label)
                    score = np.where(usable, share.max(axis=1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(names[label], pa.string()),
                        pa.array(np.clip(score, 0, 1)),
                        pa.array(np.where(usable, found, 0), pa.int32()),
                    ],
                    ["doc_id", "lang_pred", "score", "languages"],
                )

    narrow = textkit.in_small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(infer, "doc_id long, lang_pred string, score double, languages int")
