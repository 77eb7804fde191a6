"""Exact histogram of encoded lengths, and what its suffix sums answer.

Documents are counted by their exact number of tokens. Suffix sums over the histogram then give, for every context
limit: documents and tokens at or above it, and the tokens that remain if each document is cut there.

Suffix sums run in two levels (blocks of lengths, then lengths within a block), so no task holds the whole histogram.

Defined cases: null and empty texts have length 0; repeated rows count each; an empty table gives an empty histogram,
zero totals and null quantiles; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareloom.llm import textkit, tokens

BLOCK = 1024


def token_counts(docs: DataFrame, vocabulary_path: str | None = None) -> DataFrame:
    """One row per document: ``doc_id, tokens``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokens.coder(vocabulary_path)
        for batch in batches:
            for part in textkit.slices(batch, "text"):
                n = coder.count(textkit.texts_of(part.column("text")))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64())], ["doc_id", "tokens"])

    narrow = textkit.in_small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(count, "doc_id long, tokens long")


def histogram(docs: DataFrame, vocabulary_path: str | None = None) -> DataFrame:
    """Documents per exact length: ``tokens, documents``. Lengths are counted in the task before any row travels."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokens.coder(vocabulary_path)
        for batch in batches:
            found = [coder.count(textkit.texts_of(p.column("text"))) for p in textkit.slices(batch, "text")]
            length, n = np.unique(np.concatenate(found or [np.zeros(0, np.int64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(length, pa.int64()), pa.array(n, pa.int64())], ["tokens", "documents"]
            )

    partial = textkit.in_small_batches(docs).select(F.col("text").cast("string").alias("text")).mapInArrow(count, "tokens long, documents long")
    return partial.groupBy("tokens").agg(F.sum("documents").alias("documents"))


def with_suffix_sums(counts: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per length that occurs, as a context limit L:

    ``documents`` of that length; ``documents_at_least`` and ``tokens_at_least`` for length >= L; ``truncated_tokens``,
    the corpus cut at L; ``share_within``, the part of documents not longer than L.
    """
    cell = counts.withColumn("block", F.floor(F.col("tokens") / block))
    sums = cell.groupBy("block").agg(
        F.sum("documents").alias("n"), F.sum(F.col("documents") * F.col("tokens")).alias("t")
    )
    # One row per block of lengths: as many as the longest document has thousands of tokens.
    above = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    sums = sums.select(
        "block",
        F.coalesce(F.sum("n").over(above), F.lit(0)).alias("n_above"),
        F.coalesce(F.sum("t").over(above), F.lit(0)).alias("t_above"),
        F.sum("n").over(everything).alias("n_all"),
        F.sum("t").over(everything).alias("t_all"),
    )
    suffix = Window.partitionBy("block").orderBy(F.desc("tokens"))
    return (
        cell.join(sums, "block")
        .withColumn("documents_at_least", F.sum("documents").over(suffix) + F.col("n_above"))
        .withColumn("tokens_at_least", F.sum(F.col("documents") * F.col("tokens")).over(suffix) + F.col("t_above"))
        .select(
            "tokens",
            "documents",
            "documents_at_least",
            "tokens_at_least",
            (F.col("t_all") - F.col("tokens_at_least") + F.col("documents_at_least") * F.col("tokens")).alias(
                "truncated_tokens"
            ),
            ((F.col("n_all") - F.col("documents_at_least") + F.col("documents")) / F.col("n_all")).alias(
                "share_within"
            ),
        )
    )


def truncated_totals(counts: DataFrame, limits: list[int]) -> DataFrame:
    """``context, tokens`` kept when every document is cut at each limit. ``limits`` is a short list."""
    keep = [
        F.sum(F.col("documents") * F.least(F.col("tokens"), F.lit(limit))).alias(f"total_{k}")
        for k, limit in enumerate(limits)
    ]
    pairs = [
        F.struct(F.lit(limit).alias("context"), F.coalesce(F.col(f"total_{k}"), F.lit(0)).alias("tokens"))
        for k, limit in enumerate(limits)
    ]
    return counts.agg(*keep).select(F.inline(F.array(*pairs)))


def quantiles(counts: DataFrame, shares: list[float]) -> DataFrame:
    """``share, tokens``: least length that at least that share of documents does not exceed; null without documents."""
    summed = with_suffix_sums(counts)
    best = [
        F.min(F.when(F.col("share_within") >= share, F.col("tokens"))).alias(f"least_{k}") for k, share in enumerate(shares)
    ]
    pairs = [F.struct(F.lit(share).alias("share"), F.col(f"least_{k}").alias("tokens")) for k, share in enumerate(shares)]
    return summed.agg(*best).select(F.inline(F.array(*pairs)))
