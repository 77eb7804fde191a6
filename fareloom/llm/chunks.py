"""Substring deduplication by content-defined chunks.

Every ``MIN_WORDS`` words in a row are a passage. The first occurrence of a passage by (doc_id, text, place) stays; the
words of all later ones are cut from the text, so runs are cut to their last word. An occurrence that overlaps the first
in the same text is not a later one. Shorter matches stay.

1. A gear hash rolls over the words (four words deep) and cuts texts into chunks of eight words on average where its top
   bits are zero, so an insertion moves no later cut. A chunk is taken with the following ones up to the cut behind the last
   passage that starts in it. Chunks are counted by digest first; only those there twice (a bit map of fixed size lets them
   through) meet their first occurrence in an exact join. All passages in a later occurrence are cut.
2. What chunks can't show are passages at the ends of a repeated run and runs shorter than a chunk. The passages that no
   later chunk holds, the first occurrences among them, go by seeds: the seed of a passage is the least of the hashes
   of its ``SEED_WORDS`` words in a row, the leftmost of equals. Only passages whose seed is there twice meet in a join.

The first occurrence of a passage lies in no later chunk, so both steps together find every later one. Digests have 128
bits. Digests with more than ``HOT`` occurrences are known from the count; their occurrences are dealt over ``SALTS``
tasks, and only the first of each meet again.

Defined cases: null texts stay null and empty ones empty, with nothing cut; rows with the same id and text are one
document, each cut alike; a null id comes first; a text cut to nothing is empty; an empty table gives no rows; further
columns are kept by ``deduplicated`` whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.llm import bitfilter, textkit
from fareloom.session import materialise

SEED_WORDS = 8
MIN_WORDS = 20
GEAR_WORDS = 4
CHUNK_BITS = 3  # a cut after one word in 2**CHUNK_BITS
HOT = 10_000
SALTS = 64

# Odd multipliers of the two halves of a digest; any odd values do.
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


class Digests:
    """128-bit digests of any spans of a slice's words, from prefix sums over a polynomial."""

    def __init__(self, hashes: np.ndarray):
        self.sums, self.scale = [], []
        for base in _BASES:
            powers, inverse = (
                np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(len(hashes), x, np.uint64))))
                for x in (base, pow(base, -1, 1 << 64))
            )
            self.sums.append(np.concatenate(([np.uint64(0)], np.cumsum(textkit.mix(hashes) * powers[:-1], dtype=np.uint64))))
            self.scale.append(inverse)

    def of(self, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = (stop - start).astype(np.uint64)
        low, high = (
            textkit.mix(((sums[stop] - sums[start]) * scale[start]) ^ size).view(np.int64)
            for sums, scale in zip(self.sums, self.scale, strict=True)
        )
        return low, high


class Slice:
    """Words of a slice of texts: bounds of the texts, hashes, chunks and passages. Places count over all its texts."""

    def __init__(self, texts: pa.Array, length: int):
        self.length = length
        self.offsets, word, vocabulary = textkit.words(pc.ascii_lower(texts))
        self.hashes = textkit.hash_strings(vocabulary)[word]
        self.owner = textkit.rows_of(self.offsets)
        self.digests = Digests(self.hashes)
        self.cuts = self._cuts()

    def _cuts(self) -> np.ndarray:
        """First word of every chunk; a text begins one."""
        gear, place = self.hashes.copy(), np.arange(len(self.hashes)) - self.offsets[:-1][self.owner]
        shift = 64 // GEAR_WORDS
        for k in range(1, GEAR_WORDS):
            gear[k:] += np.where(place[k:] >= k, self.hashes[:-k] << np.uint64(shift * k), np.uint64(0))
        first = place == 0
        first[1:] |= (gear >> np.uint64(64 - CHUNK_BITS) == 0)[:-1]
        return np.flatnonzero(first)

    def chunks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(chunk, start, stop, two halves of the digest) of the chunks in which a passage starts."""
        after = np.append(self.cuts[1:], len(self.hashes))
        behind = np.searchsorted(self.cuts, after + self.length - 1)
        stop = np.append(self.cuts, len(self.hashes))[behind]
        stop = np.minimum(stop, self.offsets[1:][self.owner[self.cuts]])
        full = np.flatnonzero(stop - self.cuts >= self.length)
        return full, self.cuts[full], stop[full], *self.digests.of(self.cuts[full], stop[full])

    def passages(self) -> np.ndarray:
        """First word of every passage."""
        at = np.arange(len(self.hashes))
        return np.flatnonzero(at + self.length <= self.offsets[1:][self.owner])

    def seeds(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(seed, its place) of the passages that start at ``at``."""
        width = min(SEED_WORDS, self.length)
        starts = np.arange(max(0, len(self.hashes) - width + 1))
        short = self.digests.of(starts, starts + width)[0]
        seed, place = short[at], at
        for k in range(1, self.length - width + 1):
            other = short[at + k]
            less = other < seed
            seed, place = np.where(less, other, seed), np.where(less, at + k, place)
        return seed, place

    def in_text(self, at: np.ndarray) -> np.ndarray:
        return at - self.offsets[:-1][self.owner[at]]


def occurrences(texts: pa.Array, length: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, word after the last, low half of the digest) of each chunk."""
    own = Slice(texts, length)
    _, start, stop, low, _ = own.chunks()
    owner = own.owner[start]
    return owner, own.in_text(start), stop - own.offsets[:-1][owner], low


def place_keys(part: pa.RecordBatch, owner: np.ndarray, start: np.ndarray, digest: np.ndarray) -> np.ndarray:
    """64-bit key of an occurrence: document, place and digest."""
    doc = pc.fill_null(part.column("doc_id"), -1).to_numpy(zero_copy_only=False).view(np.uint64)
    text = pc.fill_null(part.column("text_key"), 0).to_numpy(zero_copy_only=False).view(np.uint64)
    whose = textkit.mix(doc * textkit.MIX_C + text)[owner]
    return textkit.mix(textkit.mix(whose + start.astype(np.uint64)) ^ digest.view(np.uint64)).view(np.int64)


def keyed(docs: DataFrame) -> DataFrame:
    """What a document is here: its id, a hash of its text, and the text."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


class Covered:
    """Which chunks of a slice are later occurrences: those that may repeat and are not known to stay.

    All chunks that pass the first bit map were joined exactly; the second holds those of them that are no later
    occurrence. A place that it holds by chance is looked at again, at the price of time.
    """

    def __init__(self, repeated: np.ndarray, staying: np.ndarray):
        self.repeated, self.staying = repeated, staying

    def passages(self, part: pa.RecordBatch, own: Slice) -> np.ndarray:
        """First words of the passages that no later chunk holds."""
        chunk, start, _, low, _ = own.chunks()
        key = place_keys(part, own.owner[start], own.in_text(start), low)
        later = np.zeros(len(own.cuts), bool)
        later[chunk] = bitfilter.holds(self.repeated, low) & ~bitfilter.holds(self.staying, key)
        at = own.passages()
        return at[~later[np.searchsorted(own.cuts, at, side="right") - 1]]


def counted(docs: DataFrame, length: int, covered: Covered | None = None) -> DataFrame:
    """``digest, n``: chunks by digest, or with ``covered`` seeds of the other passages by place; summed in tasks first.

    Rows of one document count again and again.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textkit.slices(batch, "text"):
                own = Slice(textkit.texts_of(part.column("text")), length)
                if covered is None:
                    key = own.chunks()[3]
                else:
                    seed, place = own.seeds(covered.passages(part, own))
                    key = seed[np.unique(place, return_index=True)[1]]
                digest, n = np.unique(key, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(digest), pa.array(n, pa.int64())], ["digest", "n"])

    return docs.mapInArrow(count, "digest long, n long").groupBy("digest").agg(F.sum("n").alias("n"))


def bit_maps(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Bit maps of the digests that are there twice, and of those with more than ``HOT`` occurrences."""
    several = materialise(counts.filter(F.col("n") > 1), "repeated")
    return bitfilter.build(several, "digest"), bitfilter.build(several.filter(F.col("n") > HOT), "digest")


def found(docs: DataFrame, length: int, maps: tuple[np.ndarray, np.ndarray], covered: Covered | None = None) -> DataFrame:
    """Rows of the chunks, or of the passages that no later chunk holds, that may be there twice.

    ``doc_id, text_key, start, stop, low, high`` (halves of the digest), ``place`` (key of the occurrence), ``salt`` of
    ``salts``.
    """
    repeated, hot = maps
    names = ["doc_id", "text_key", "start", "stop", "low", "high", "place", "salt", "salts"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textkit.slices(batch, "text"):
                own = Slice(textkit.texts_of(part.column("text")), length)
                if covered is None:
                    _, start, stop, low, high = own.chunks()
                    use, busy = bitfilter.holds(repeated, low), bitfilter.holds(hot, low)
                    start, stop, low, high, busy = (x[use] for x in (start, stop, low, high, busy))
                else:
                    start = covered.passages(part, own)
                    seed = own.seeds(start)[0]
                    use, busy = bitfilter.holds(repeated, seed), bitfilter.holds(hot, seed)
                    start, busy = start[use], busy[use]
                    stop = start + length
                    low, high = own.digests.of(start, stop)
                owner = own.owner[start]
                base = own.offsets[:-1][owner]
                key = place_keys(part, owner, start - base, low)
                salts = np.where(busy, SALTS, 1)
                rows = pa.array(owner)
                columns = [part.column("doc_id").take(rows), part.column("text_key").take(rows)]
                values = (start - base, stop - base, low, high, key, (key.view(np.uint64) >> np.uint64(32)).astype(np.int64) % salts, salts)
                yield pa.RecordBatch.from_arrays(columns + [pa.array(x, pa.int64()) for x in values], names)

    return docs.mapInArrow(find, ", ".join(f"{name} long" for name in names))


def after_first(rows: DataFrame, keys: list[str], occurrence: Column, min_words: int) -> DataFrame:
    """``rows`` with ``first``, the least ``occurrence`` of their keys, and ``later``: whether they lie in another text or
    apart from it in the same one."""
    first = F.min(occurrence).over(Window.partitionBy(*keys))
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key"))
    apart = F.col("start") >= F.col("first.start") + min_words
    return rows.withColumn("first", first).withColumn("later", ~same | apart)


def marked(rows: DataFrame, min_words: int, hot: bool) -> DataFrame:
    """``rows`` with ``later``: whether the same words occur before, in another text or apart in the same one.

    One shuffle by digest and salt finds the first occurrence. Of ``hot`` digests, an occurrence that is later than the
    first of its salt is later than the first of all, in whose text the order begins; only what is left of each salt,
    that first one and what overlaps it, is compared across salts.
    """
    rows = after_first(rows, ["low", "high", "salt"], F.struct("doc_id", "text_key", "start"), min_words)
    if hot:
        rows = materialise(rows, "firsts")
        open_still = (F.col("salts") > 1) & ~F.col("later")
        left = after_first(rows.filter(open_still), ["low", "high"], F.col("first"), min_words)
        rows = rows.filter(~open_still).unionByName(left)
    return rows.drop("first", "low", "high", "salt", "salts")


def cut_spans(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, text_key, spans``: the word ranges to cut of each document that has any, in order."""
    docs = keyed(textkit.in_small_batches(docs))
    maps = bit_maps(counted(docs, min_words))
    chunks = materialise(marked(found(docs, min_words, maps), min_words, maps[1].any()), "chunks")
    covered = Covered(maps[0], bitfilter.build(chunks.filter(~F.col("later")), "place"))
    chunks = chunks.filter("later").drop("place", "later")
    maps = bit_maps(counted(docs, min_words, covered))
    rest = marked(found(docs, min_words, maps, covered).drop("stop", "place"), min_words, maps[1].any())
    rest = rest.filter("later").select("doc_id", "text_key", "start", (F.col("start") + min_words).alias("stop"))
    later = chunks.unionByName(rest)
    # Ranges that touch or overlap form one run.
    own = Window.partitionBy("doc_id", "text_key").orderBy("start", "stop")
    reach = F.max("stop").over(own.rowsBetween(Window.unboundedPreceding, -1))
    runs = (
        later.groupBy("doc_id", "text_key", "start")
        .agg(F.max("stop").alias("stop"))
        .withColumn("opens", F.when(reach >= F.col("start"), 0).otherwise(1))
        .withColumn("run", F.sum("opens").over(own))
        .groupBy("doc_id", "text_key", "run")
        .agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
        .filter(F.col("stop") - F.col("start") >= min_words)
    )
    return runs.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans"))


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text less ranges of words, each up to the start of the next word that stays."""
    data = text.encode()
    space = _SPACE[np.frombuffer(data, np.uint8)]
    starts = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    bounds = np.append(starts, len(data))
    kept, at = [], 0
    for start, stop in spans:
        kept.append(data[at : bounds[start]])
        at = int(bounds[stop])
    kept.append(data[at:])
    return b"".join(kept).decode()


def deduplicated(docs: DataFrame, min_words: int = MIN_WORDS, report: bool = False) -> DataFrame:
    """``docs`` with repeated passages cut from ``text``, and ``n_chars`` of what is left where there is such a column.

    With ``report``, instead ``doc_id, text, cut_words, spans`` per row, spans as ``[start, stop)`` in words of the
    original text.
    """
    own = textkit.unused(docs, "chunks ")
    id_name, key_name, spans_name, own_key = (f"{own}{label}" for label in ("doc id", "text key", "spans", "own key"))
    spans = cut_spans(docs, min_words).toDF(id_name, key_name, spans_name)
    text = F.col("text").cast("string")
    joined = docs.withColumn(own_key, F.xxhash64(text)).join(
        spans,
        F.col("doc_id").cast("long").eqNullSafe(F.col(f"`{id_name}`")) & (F.col(f"`{own_key}`") == F.col(f"`{key_name}`")),
        "left",
    )

    @F.pandas_udf("string")
    def cut(texts: pd.Series, ranges: pd.Series) -> pd.Series:
        pairs = zip(texts, ranges, strict=True)
        return pd.Series([t and without_spans(t, [(s["start"], s["stop"]) for s in r]) for t, r in pairs], dtype=object)

    found = F.col(f"`{spans_name}`")
    # Texts with nothing to cut stay in the JVM: the function gets a null for them.
    cut_text = F.when(found.isNull(), text).otherwise(cut(F.when(found.isNotNull(), text), found))
    if report:
        words = F.aggregate(found, F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"])
        return joined.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            cut_text.alias("text"),
            F.coalesce(words, F.lit(0)).alias("cut_words"),
            F.coalesce(found, F.array().cast("array<struct<start:bigint,stop:bigint>>")).alias("spans"),
        )
    changed = joined.withColumn("text", cut_text)
    if "n_chars" in docs.columns:
        left = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        changed = changed.withColumn("n_chars", F.when(found.isNull(), F.col("n_chars")).otherwise(left))
    return changed.select(*[F.col(f"`{c}`") for c in docs.columns])
