"""Mixing sources to target weights by systematic sampling.

Every source gets a target in words and all of its documents the same number of expected copies, target over size.
Documents of a source stand in a fixed order; their expected copies are summed up along it, one offset is added, and a
document is taken once per whole number its stretch crosses. Long documents stand with documents of like length, so what
a source gives stays within about one document of its target.

The order is by blocks (length class, hash slice), then id within a block. Prefix sums run in two levels: over the block
counts of a source, then within a block. A source, a length or a text that holds a third of all rows is thus never
gathered in one task.

Targets: weights repeat along the sources by code point, null last, and share all words; what exceeds ``cap`` times a
source's size is shared again by weight until nothing exceeds. That is one water level: sources are ordered by cap over
weight, and those before the level are full.

Defined cases: null and empty texts have size 0 and are taken as their source's others are, at no words; a source
without words has target 0 and takes nothing; a null source is a source; repeated rows count each; an empty table gives
no rows; a null id is ordered first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.llm import textkit
from fareloom.session import materialise

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3
SLICES = 64
OFFSET_STEPS = 1 << 20


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size`` of all documents."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        textkit.word_count(F.col("text").cast("string")).alias("size"),
    )


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``source, source_size, target`` per source; one row each, so the windows run over sources, not documents."""
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    choices = F.array(*[F.lit(float(w)) for w in weights])
    weighed = per_source.withColumn("weight", F.element_at(choices, (place % len(weights) + 1).cast("int")))
    limit = F.col("source_size") * F.lit(float(cap))
    order = [(limit / F.col("weight")).asc(), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(before), F.lit(0.0))) / F.sum(
        "weight"
    ).over(onward)
    rising = weighed.withColumn("level", level)
    water = F.max(F.when(F.col("level") * F.col("weight") <= limit, F.col("level"))).over(everything)
    return rising.withColumn("water", water).select(
        "source", "source_size", F.least(limit, F.col("water") * F.col("weight")).alias("target")
    )


def length_class(size: Column) -> Column:
    """Text that orders sizes by their binary magnitude and next three bits."""
    digits = F.bin(size)
    return F.concat(F.lpad(F.length(digits).cast("string"), 2, "0"), F.rpad(F.substring(digits, 1, 4), 4, "0"))


def taken_copies(
    sizes: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    cap: int = CAP,
    slices: int = SLICES,
    seed: int = 7,
) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies`` per document. ``sizes`` is read several times."""
    keyed = sizes.select(
        "*",
        length_class(F.col("size")).alias("class"),
        (F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long") % slices)
        .cast("int")
        .alias("slice"),
    )
    block = ["source", "class", "slice"]
    goals = targets(sizes, weights, cap)
    # Documents before each block: at most some thousand blocks per source.
    earlier = (
        Window.partitionBy("source").orderBy(F.desc("class"), "slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    blocks = (
        keyed.groupBy(*block)
        .agg(F.count("*").alias("rows"))
        .withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
        .drop("rows")
    )
    plan = blocks.alias("b").join(goals.alias("g"), F.col("b.source").eqNullSafe(F.col("g.source"))).select(
        *[F.col(f"b.{c}").alias(f"b_{c}") for c in block], "before", "source_size", "target"
    )
    joined = keyed.join(
        plan,
        F.col("source").eqNullSafe(F.col("b_source"))
        & (F.col("class") == F.col("b_class"))
        & (F.col("slice") == F.col("b_slice")),
    )
    start = F.conv(
        F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("source"), F.lit("")))), 1, 8), 16, 10
    ).cast("long") % OFFSET_STEPS
    rank = F.col("before") + F.row_number().over(
        Window.partitionBy(*block).orderBy(F.col("doc_id").asc_nulls_first(), "size")
    )
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = start.cast("double") / OFFSET_STEPS
    ranked = joined.withColumn("rank", rank)
    copies = F.floor(F.col("rank") * each + offset) - F.floor((F.col("rank") - 1) * each + offset)
    return ranked.select("doc_id", "source", "size", "source_size", "target", copies.cast("long").alias("copies"))


def mixture(docs: DataFrame, **options) -> DataFrame:
    """One row per document: what the mix takes of it, in copies and words."""
    copies = taken_copies(materialise(sized(docs), "sized"), **options)
    return copies.withColumn("taken", F.col("size") * F.col("copies"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of ``docs`` once per copy taken, all columns kept.

    Copies are decided per (doc_id, source, size); rows that share these take each their own number of copies, in turn.
    """
    key, own = ["doc_id", "source", "size"], textkit.unused(docs, "mix_")
    chosen = mixture(docs, **options).filter(F.col("copies") > 0)
    turn = Window.partitionBy(*key).orderBy(F.desc("copies"))
    chosen = chosen.withColumn("turn", F.row_number().over(turn)).select(
        *[F.col(k).alias(f"{own}{k}") for k in key], F.col("turn").alias(f"{own}turn"), F.col("copies").alias(f"{own}copies")
    )
    rows = docs.withColumns(
        {
            f"{own}own_size": textkit.word_count(F.col("text").cast("string")),
            f"{own}own_id": F.col("doc_id").cast("long"),
        }
    )
    rows = rows.withColumn(
        f"{own}own_turn",
        F.row_number().over(Window.partitionBy(f"{own}own_id", "source", f"{own}own_size").orderBy("text")),
    )
    joined = rows.join(
        chosen,
        F.col(f"{own}own_id").eqNullSafe(F.col(f"{own}doc_id"))
        & F.col("source").eqNullSafe(F.col(f"{own}source"))
        & (F.col(f"{own}own_size") == F.col(f"{own}size"))
        & (F.col(f"{own}own_turn") == F.col(f"{own}turn")),
    )
    repeated = joined.withColumn(f"{own}copy", F.explode(F.sequence(F.lit(1), F.col(f"{own}copies").cast("int"))))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])
