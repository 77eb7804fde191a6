"""Document fingerprints from spots: chains of content words that follow common words.

Common words (anchors) are everywhere in prose and rare in boilerplate. Each anchor contributes the next ``CHAIN``
words that are not anchors themselves; the hashed chains form the fingerprint, a set. A text with fewer than one spot in
``SPARSE`` words (tables, lists) adds all runs of ``CHAIN`` words, and one with fewer words than a run is taken whole, so
no fingerprint is empty.

Fingerprints are compared by Jaccard. With a bound ``least``, comparing is pruned by set length: lengths are partitioned so
that sets whose likeness can reach it are in the same or the next partition; others are 0 without a comparison. Without
one every likeness is exact. All of it is built-in expressions.

Defined cases: a null text is an empty one; empty texts are alike (1.0); rows stand by id, null first, then by text, so
repeated rows follow each other; the only row of a table is its own next; an empty table gives no rows; further columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHAIN = 2
SPARSE = 8
CELLS = 4096
BUCKET_ROWS = 500
MAX_BUCKETS = 28_000

# Frequent function words of English, French, German and Spanish (fixed values).
ANCHORS = (
    "the of and to in is that it was for on are as with his they be at this have from or had by but not what all were "
    "le la les de des du un une et est que qui dans pour sur par au aux en ne pas plus "
    "der die das und ist von zu mit den dem ein eine im nicht auf für als auch es "
    "el los las y del al por con para se su una lo como más"
).split()


MARK = "\u0001"


def anchor_pattern(anchors: list[str] | tuple[str, ...]) -> str:
    """Any of the anchors as a whole word with the blank after it; alternatives are grouped by first letter."""
    groups: dict[str, list[str]] = {}
    for word in sorted(anchors, key=lambda w: (-len(w), w)):
        groups.setdefault(word[0], []).append(word[1:])
    return "(?<= )(?:" + "|".join(f"{first}(?:{'|'.join(rests)})" for first, rests in groups.items()) + ") "


def normalised(text: Column) -> Column:
    """Lower-case words of letters and digits, one blank around each."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), "[^\\p{L}\\p{N}]+", " ")), F.lit(" "))


def with_signature(
    df: DataFrame,
    text: str,
    name: str,
    anchors: list[str] | tuple[str, ...] = tuple(ANCHORS),
    chain: int = CHAIN,
) -> DataFrame:
    """Adds the sorted distinct 32-bit hashes of the spots of a text column.

    One pass turns each anchor into a mark, so that finding the words after a mark needs no list of words. The steps are
    columns of their own because each is used more than once.
    """
    plain, spots = f"{name} plain", f"{name} spots"
    content = f"{MARK}*+[^ {MARK}]+ "
    marked = F.regexp_replace(F.col(f"`{plain}`"), anchor_pattern(anchors), MARK)
    found = F.regexp_extract_all(marked, F.lit(f"{MARK}(?=({content * chain}))"), F.lit(1))
    words = F.char_length(f"`{plain}`") - F.char_length(F.replace(F.col(f"`{plain}`"), F.lit(" "), F.lit(""))) - 1
    runs = F.regexp_extract_all(F.col(f"`{plain}`"), F.lit(f"(?<= )(?=({'[^ ]+ ' * chain}))"), F.lit(1))
    own = F.col(f"`{spots}`")
    chosen = (
        F.when(F.size(own) * SPARSE >= words, own)
        .when(words >= chain, F.concat(own, runs))
        .otherwise(F.array(F.col(f"`{plain}`")))
    )
    hashed = F.transform(chosen, lambda s: F.pmod(F.xxhash64(F.replace(s, F.lit(MARK), F.lit(""))), F.lit(1 << 32)))
    return (
        df.withColumn(plain, normalised(F.col(text)))
        .withColumn(spots, found)
        .withColumn(name, F.sort_array(F.array_distinct(hashed)))
        .drop(plain, spots)
    )


def printed(signatures: Column) -> Column:
    """The fingerprint as text: one number per spot."""
    return F.array_join(signatures.cast("array<string>"), " ")


def length_partition(size: Column, least: float) -> Column:
    """Sets that can be alike to ``least`` are in the same or in neighbouring partitions."""
    return F.floor(F.log(size.cast("double")) / math.log(1 / least))


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard of two signatures; 0 where lengths alone keep it below ``least``, if that is above 0."""
    m, n = F.size(a), F.size(b)
    if not least:
        common = F.size(F.array_intersect(a, b))
        return common / (m + n - common)
    near = F.abs(length_partition(m, least) - length_partition(n, least)) <= 1
    reachable = near & (F.least(m, n) >= least * F.greatest(m, n))
    common = F.size(F.array_intersect(a, b))
    return F.when(reachable, common / (m + n - common)).otherwise(F.lit(0.0))


def followed(
    docs: DataFrame, carried: list[str], derive: Callable[[DataFrame], DataFrame] = lambda rows: rows, derived: Sequence[str] = ()
) -> DataFrame:
    """Each row with ``next_<column>`` of the row that follows by id; the first follows the last.

    Columns ``derived`` from the carried ones by ``derive`` are made once per row, after rows were dealt out, and carried
    as well.

    Rows are dealt into id ranges of about ``BUCKET_ROWS`` rows, found from counts in equal cells of the id range, and
    each range is read in order. The first row of a range is also put at the end of the range before it. There are at
    most ``CELLS + MAX_BUCKETS`` ranges, so the table of their first ids is bounded and is broadcast.
    """
    keys = docs.select("doc_id")
    low, high, rows = keys.agg(F.min("doc_id"), F.max("doc_id"), F.count("*")).first()
    low, high = float(low or 0), float(high or 0)
    place = F.coalesce((F.col("doc_id").cast("double") - low) / (high - low + 1) * CELLS, F.lit(-1.0))
    cell = F.least(F.floor(place), F.lit(CELLS - 1)).cast("int")
    ratio = min(1 / BUCKET_ROWS, MAX_BUCKETS / max(1, rows))
    cells = (
        keys.groupBy(cell.alias("cell"))
        .agg(
            F.min("doc_id").cast("double").alias("low"),
            F.max("doc_id").cast("double").alias("high"),
            F.ceil(F.count("*") * ratio).alias("parts"),
        )
    )
    part = F.least(
        F.floor((F.col("doc_id").cast("double") - F.col("low")) / (F.col("high") - F.col("low") + 1) * F.col("parts")),
        F.col("parts") - 1,
    )

    def dealt(df: DataFrame) -> DataFrame:
        return (
            df.withColumn("cell", cell)
            .join(F.broadcast(cells), "cell")
            .withColumn("part", F.coalesce(part, F.lit(0)))
            .drop("low", "high", "parts")
        )

    firsts = dealt(keys).groupBy("cell", "part").agg(F.min("doc_id").alias("first_id"))
    own = Window.partitionBy("cell").orderBy("part")
    ends = firsts.groupBy("cell").agg(F.max("part").alias("last_part"))
    last = Window.orderBy("cell")  # one row per cell
    whole = Window.partitionBy()
    before = ends.select(
        F.col("cell").alias("end_cell"),
        F.lag("cell").over(last).alias("prev_cell"),
        F.lag("last_part").over(last).alias("prev_last"),
        F.max(F.struct("cell", "last_part")).over(whole).alias("top"),
    )
    extra = (
        firsts.withColumn("prev_part", F.lag("part").over(own))
        .join(F.broadcast(before), F.col("cell") == F.col("end_cell"))
        .select(
            "first_id",
            F.when(F.col("prev_part").isNotNull(), F.col("cell"))
            .otherwise(F.coalesce("prev_cell", F.col("top.cell")))
            .alias("to_cell"),
            F.coalesce("prev_part", "prev_last", F.col("top.last_part")).alias("to_part"),
            (F.col("prev_part").isNull() & F.col("prev_cell").isNull()).alias("wraps"),
        )
    )
    columns = [F.col(c) for c in carried]
    heads = (
        docs.join(F.broadcast(extra), F.col("doc_id").eqNullSafe(F.col("first_id")))
        .groupBy("to_cell", "to_part", "wraps", "doc_id")
        .agg(F.min(F.struct(*columns)).alias("head"))
        .select("doc_id", *[F.col(f"head.{c}") for c in carried], F.col("to_cell").alias("cell"), F.col("to_part").alias("part"), F.when(F.col("wraps"), 2).otherwise(1).alias("extra"))
    )
    real = dealt(docs.select("doc_id", *columns)).withColumn("extra", F.lit(0))
    order = Window.partitionBy("cell", "part").orderBy("extra", F.col("doc_id").asc_nulls_first(), *columns)
    return (
        derive(real.unionByName(heads))
        .select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in (*carried, *derived)])
        .filter(F.col("extra") == 0)
        .drop("cell", "part", "extra")
    )


def edited_fingerprints(docs: DataFrame, least: float = 0.0) -> DataFrame:
    """Fingerprints of each document and of its edited text, whose last quarter is the start of the next document."""
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    pairs = followed(base, ["text"], lambda rows: with_signature(rows, "text", "spots"), ["spots"])
    n = F.char_length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), n - quarter), F.substring(F.col("next_text"), F.lit(1), quarter)
    )
    edits = pairs.select("doc_id", n.cast("long").alias("n_chars"), "spots", "next_spots", edited.alias("edited"))
    return with_signature(edits, "edited", "edited_spots").select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        printed(F.col("spots")).alias("fingerprint"),
        printed(F.col("edited_spots")).alias("edited_fingerprint"),
        likeness(F.col("spots"), F.col("edited_spots"), least).alias("near_edited"),
        likeness(F.col("spots"), F.col("next_spots"), least).alias("near_next"),
    )
