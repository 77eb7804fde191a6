"""Small helpers for the Arrow tasks of this package: bounded slices, words, hashes, crc32 folds.

Everything here works on one slice of an Arrow batch at a time, so a task holds a few times ``SLICE_BYTES`` of text (or
one very long text) whatever the size of its partition. Where memory follows rows, slices are bounded in rows too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.session import ship_package

SLICE_BYTES = 1_000_000
BATCH_BYTES = 4_000_000

# Odd 64-bit multipliers for mixing; any odd values do.
MIX_A = np.uint64(0x9E3779B97F4A7C15)
MIX_B = np.uint64(0xC2B2AE3D27D4EB4F)
MIX_C = np.uint64(0x165667B19E3779F9)


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session hands Arrow tasks batches of at most ``BATCH_BYTES`` (or one row) from now on, and whose
    workers have this package.

    A task then holds as much whether rows are short or long; Spark's own bound is several times larger.
    """
    ship_package(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def unused(df: DataFrame, prefix: str) -> str:
    """A prefix that no column of ``df`` starts with, for columns that are put beside its own."""
    while any(name.lower().startswith(prefix.lower()) for name in df.columns):
        prefix += "_"
    return prefix


def texts_of(column: pa.Array) -> pa.Array:
    """Text column of a batch with nulls as empty texts.

    The column keeps its type: a slice that is cast to another width of offsets starts with an offset above zero, which
    Arrow's ``ascii_lower`` reads wrongly.
    """
    return pc.fill_null(column, "")


def slices(
    batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES, rows: int | None = None
) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch with about ``limit`` bytes of text each and at most ``rows`` rows, one at least."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False) + 16)
    start = 0
    while start < batch.num_rows:
        base = size[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(size, base + limit, side="right")))
        end = end if rows is None else min(end, start + rows)
        yield batch.slice(start, end - start)
        start = end
    pa.default_memory_pool().release_unused()  # a worker lives on between tasks


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words between ASCII white space: (offset of each text's first word, word index into the vocabulary, vocabulary).

    The offsets have one entry more than there are texts.
    """
    lists = pc.ascii_split_whitespace(texts)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.flatten()
    offsets = offsets - offsets[0]
    filled = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not filled.all():  # white space at the ends of a text leaves empty strings
        kept = np.concatenate(([0], np.cumsum(filled)))
        offsets, flat = kept[offsets], flat.filter(pa.array(filled))
    coded = flat.dictionary_encode()
    return offsets, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def hash_strings(strings: pa.Array, seed: int = 0) -> np.ndarray:
    """64-bit hash of each string."""
    digest = xxhash.xxh3_64_intdigest
    plain = strings.to_numpy(zero_copy_only=False).tolist()  # several times faster than to_pylist
    return np.fromiter((digest(s, seed) for s in plain), np.uint64, len(strings))


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    h = h ^ (h >> np.uint64(32))
    h = h * MIX_A
    h = h ^ (h >> np.uint64(29))
    h = h * MIX_B
    return h ^ (h >> np.uint64(32))


def rows_of(offsets: np.ndarray) -> np.ndarray:
    """Index of the text that each word belongs to."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def grouped_unique(group: np.ndarray, value: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each group, sorted: (offsets of the groups, values)."""
    order = np.lexsort((value, group))
    g, v = group[order], value[order]
    first = np.ones(len(v), bool)
    first[1:] = (g[1:] != g[:-1]) | (v[1:] != v[:-1])
    g, v = g[first], v[first]
    return np.concatenate(([0], np.cumsum(np.bincount(g, minlength=groups)))).astype(np.int64), v


def list_array(offsets: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


def id_fold(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return (F.crc32(column.cast("string").cast("binary")) % folds).cast("int")


def word_count(text: Column | str) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, 0 for null, as a long."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(column, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")
