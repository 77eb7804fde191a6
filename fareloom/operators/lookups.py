"""Row-level lookups: broadcast after a size check, otherwise a shuffle join with heavy keys spread out."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, AtomicType, BinaryType, DataType, StringType, StructType

BROADCAST_BYTES = 64 * 1024 * 1024
# A key with more rows than this is split into pieces of about so many.
ROWS_PER_PIECE = 1_000_000
# At most this many keys are split, the heaviest ones, so that the table of them stays small. Each gets as many pieces as
# its rows need; a key too light for the table has less than one in so many of all rows.
SPLIT_KEYS = 5_000
# Counters of the heavy-hitter sketch.
TRACKED_KEYS = 10 * SPLIT_KEYS

_HASH = "__key_hash"
_PIECES = "__pieces"
_SALT = "__salt"
_ROW_BYTES = 16
_FIELD_BYTES = 8


def measured_bytes(df: DataFrame) -> int:
    """Approximate in-memory size, from one distributed aggregate over the data itself."""
    sizes: list[Column] = [F.lit(_ROW_BYTES + _FIELD_BYTES * len(df.columns))]
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (StringType, BinaryType)):
            sizes.append(F.coalesce(F.octet_length(column), F.lit(0)))
        elif not isinstance(field.dataType, AtomicType):
            sizes.append(F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)))
    row = sum(sizes[1:], sizes[0])
    return df.agg(F.coalesce(F.sum(row.cast("bigint")), F.lit(0)).alias("bytes")).first()["bytes"]


def common_key(left: DataFrame, right: DataFrame, on: Sequence[str]) -> StructType:
    """Key columns in the types a join of the two compares them in."""
    return left.select(*on).limit(0).union(right.select(*on).limit(0)).schema


def byte_equal(kind: DataType) -> bool:
    """Whether values that a join takes as equal have the same bytes, hence the same hash.

    Not so for collated text, where ``HOT`` may equal ``hot``. Spark's hash treats -0.0 and 0.0 and all NaN alike.
    """
    if isinstance(kind, StringType):
        return kind == StringType()
    if isinstance(kind, ArrayType):
        return byte_equal(kind.elementType)
    if isinstance(kind, StructType):
        return all(byte_equal(field.dataType) for field in kind)
    return isinstance(kind, AtomicType)


def key_hash(key: StructType) -> Column:
    """Hash of the key columns in common types: Spark hashes an int and a bigint of one value differently."""
    return F.xxhash64(*[F.col(field.name).cast(field.dataType) for field in key])


def heavy_keys(df: DataFrame, key: Column, rows_per_piece: int = ROWS_PER_PIECE) -> list[tuple[int, int]]:
    """Hashes of keys with more than ``rows_per_piece`` rows, each with the number of pieces that restores it.

    One pass over the key columns with a mergeable sketch of fixed size: no shuffle of keys, and at most ``SPLIT_KEYS``
    results. Keys with fewer than one in ``SPLIT_KEYS`` of all rows are not sure to be among them and are left out;
    that many of their rows stay together at most. Pieces follow the rows of a key at any size of the data: all of them
    together are at most the number of rows over ``rows_per_piece``, twice over. The counts are estimates, which decide
    only how rows are spread, never which rows match.
    """
    found = (
        df.select(key.alias(_HASH))
        .agg(
            F.count("*").alias("rows"),
            F.call_function("approx_top_k", F.col(_HASH), F.lit(SPLIT_KEYS), F.lit(TRACKED_KEYS)).alias("top"),
        )
        .first()
    )
    least = max(rows_per_piece, found["rows"] / SPLIT_KEYS)
    return [(key.item, ceil(key["count"] / rows_per_piece)) for key in found["top"] or [] if key["count"] > least]


def spread_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str,
    spread_by: Sequence[str],
    rows_per_piece: int = ROWS_PER_PIECE,
) -> DataFrame:
    """Shuffle join in which no reducer gets more than about ``rows_per_piece`` facts of one heavy key (``heavy_keys``).

    Facts of a heavy key are dealt out over its pieces, and the lookup rows of that key, and only those, are repeated
    once per piece, so that every pair meets exactly once. The piece is a hash of the fact row, never a random
    number: a task that runs again after an executor was lost places its rows as before.

    Pieces go by a hash of the key, which must be the same wherever the join takes keys as equal. Keys without that
    property (collated text) take the plain join, whose skew is left to adaptive execution.
    """
    common = common_key(facts, lookup, on)
    if not byte_equal(common):
        return facts.join(lookup, list(on), how)
    key = key_hash(common)
    heavy = heavy_keys(facts, key, rows_per_piece)
    if not heavy:
        return facts.join(lookup, list(on), how)
    pieces = F.broadcast(facts.sparkSession.createDataFrame(heavy, f"{_HASH} long, {_PIECES} int"))
    count = F.coalesce(F.col(_PIECES), F.lit(1))

    def with_pieces(df: DataFrame) -> DataFrame:
        return df.withColumn(_HASH, key).join(pieces, _HASH, "left")

    dealt = with_pieces(facts).withColumn(_SALT, F.pmod(F.xxhash64(*spread_by), count).cast("int"))
    repeated = with_pieces(lookup).withColumn(_SALT, F.explode(F.sequence(F.lit(0), count - 1)))
    return (
        dealt.drop(_HASH, _PIECES).join(repeated.drop(_HASH, _PIECES), [*on, _SALT], how).drop(_SALT)
    )


def attach(
    facts: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "left",
    *,
    spread_by: Sequence[str] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    lookup_bytes: int | None = None,
    rows_per_piece: int = ROWS_PER_PIECE,
) -> DataFrame:
    """Join facts to a lookup table on shared column names, with ``how`` inner or left.

    A lookup within ``broadcast_bytes`` is broadcast, which leaves the facts where they are. Its size is
    ``lookup_bytes`` where the caller knows it, and measured by a job of its own otherwise. A larger one goes through
    ``spread_join``; ``spread_by`` names fact columns that tell rows of one key apart, by default all columns outside
    the key.
    """
    if how not in ("inner", "left"):
        raise ValueError("a lookup is an inner or a left join")
    size = measured_bytes(lookup) if lookup_bytes is None else lookup_bytes
    if size <= broadcast_bytes:
        return facts.join(F.broadcast(lookup), list(on), how)
    spread = list(spread_by or [name for name in facts.columns if name not in on])
    return spread_join(facts, lookup, on, how, spread, rows_per_piece)


def attach_dimension(
    facts: DataFrame,
    dimension: DataFrame,
    *,
    fact_key: str,
    dimension_key: str,
    attributes: Sequence[str],
    how: str = "inner",
    **options,
) -> DataFrame:
    """Add dimension attributes to facts whose key column may be named differently."""
    lookup = dimension.select(
        F.col(dimension_key).alias(fact_key), *[F.col(name).alias(name) for name in attributes]
    )
    return attach(facts, lookup, [fact_key], how, **options)
