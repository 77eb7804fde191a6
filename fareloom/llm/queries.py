"""One registered query per operator: the operator on its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.llm import (
    chunks,
    collocations,
    jaccard,
    language,
    lengths,
    licenses,
    mixing,
    neighbours,
    packing,
    periodic,
    quality,
    spotsigs,
    textkit,
    topk,
)
from fareloom.session import materialise


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document less its repeated passages."""
    return chunks.deduplicated(table(spark, folder, "documents"), report=True)


def op4_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    """What the mix takes of every document."""
    mixed = mixing.mixture(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document, learned from labels outside the held-out fold."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = quality.train(docs, labels.filter(textkit.id_fold("doc_id", 4) != 2))
    return quality.scored(docs.select("doc_id", "text", "n_chars"), model).select(
        "doc_id",
        F.coalesce(textkit.id_fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned outside the held-out fold."""
    docs = table(spark, folder, "documents")
    model = language.train(docs.filter(textkit.id_fold("doc_id", 3) != 1))
    return language.predict(docs, model).select(
        "doc_id",
        F.coalesce(textkit.id_fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
        "languages",
    )


def op7_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """Five best inner products of every query vector."""
    vectors = (
        table(spark, folder, "embeddings")
        .filter(F.col("vec_id").isNotNull() & topk.usable(F.col("embedding")))
        .select(F.col("vec_id").cast("long").alias("vec_id"), topk.scaled(F.col("embedding")).alias("v"))
    )
    return topk.top_k(vectors.filter(F.col("vec_id") % 50 == 0), vectors, 5)


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Histogram of encoded lengths with its suffix sums."""
    counted = materialise(lengths.histogram(table(spark, folder, "documents")), "histogram")  # read twice below
    return lengths.with_suffix_sums(counted)


def op1_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Class of every document and its number of links, under four-word shingles and a similarity of 0.85."""
    return jaccard.classes(table(spark, folder, "documents"), width=4, percent=85, links=True)


def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Known licenses in every document."""
    return licenses.scan(table(spark, folder, "documents"))


def op9_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and how alike they are."""
    return spotsigs.edited_fingerprints(table(spark, folder, "documents"))


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents in windows of 4096 tokens."""
    return packing.packed(table(spark, folder, "documents"))


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The 2000 strongest collocations of every language."""
    mined = collocations.mine(table(spark, folder, "documents"))
    return collocations.strongest(mined, 2000).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Links, component and representative of every vector."""
    return neighbours.near_duplicates(table(spark, folder, "embeddings"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of repeated words in every document, one in ten with planted repeats."""
    found = periodic.detect(periodic.with_planted_repeats(table(spark, folder, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    joined = F.concat_ws("\n", F.concat(lines, F.array(F.lit(""))))
    return found.withColumn("best", periodic.strongest(F.col("runs"))).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, joined).otherwise(F.lit("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_license_scan": op2_license_scan,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_source_mix": op4_source_mix,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_language_id": op6_language_id,
    "op7_top_k": op7_top_k,
    "op8_token_counts": op8_token_counts,
    "op9_fingerprints": op9_fingerprints,
    "op10_packing": op10_packing,
    "op11_collocations": op11_collocations,
    "op12_embedding_near_dedup": op12_embedding_near_dedup,
    "op13_periodic_runs": op13_periodic_runs,
}
