"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents that the one before kept, written as Parquet and read again, so a lost executor costs the
stage at work and nothing before it. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.llm import chunks, jaccard, mixing, packing, quality, textkit
from fareloom.session import materialise

SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 80


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from labels outside the held-out fold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(textkit.id_fold("doc_id", 4) != 2)
    score = textkit.unused(docs, "score of the quality stage")
    scored = quality.scored(docs, quality.train(docs, labels), score)
    return scored.filter(F.col(f"`{score}`") >= quality.THRESHOLD).drop(score)


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near copies: the smallest id's, a null id counting last, then any of equal ids.

    Rows get a number of their own for that, so rows without an id and rows that share one are told apart. Texts
    without words are in no class; their rows stay.
    """
    row, owner = (f"{textkit.unused(docs, 'stage ')}{label}" for label in ("row number", "class"))
    numbered = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = jaccard.classes(numbered.select(F.col(f"`{row}`").alias("doc_id"), "text"), SHINGLE_WORDS, SIMILARITY_PERCENT)
    ids = numbered.select(F.col(f"`{row}`").alias(row), F.col("doc_id").alias("stage id"))
    found = found.select(F.col("doc_id").alias(row), F.col("component_id").alias(owner)).join(ids, row)
    best = F.struct(F.col("`stage id`").isNull(), F.col("`stage id`"), F.col(f"`{row}`").alias("row"))
    first = found.groupBy(owner).agg(F.min(best).alias("best")).select(F.col("best.row").alias(row))
    return numbered.join(first, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return chunks.deduplicated(docs)


def mixed_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources; a document taken more than once is there as many times."""
    return mixing.mixed_documents(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good_documents),
    ("n-gram Jaccard join", one_of_each_class),
    ("substring dedup", without_repeated_passages),
    ("mixing sources to target weights", mixed_to_weights),
    ("packing", packed_sequences),
]

# Hashes, a fitted model and a tokenizer are beyond SQL; tests compare what the stages keep and cut with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = materialise(docs, f"stage-{number}")
    return docs
