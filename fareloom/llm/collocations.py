"""Phrase collocations: frequent phrases of a few words, scored by their weakest cut.

Level by level: ``LEAST`` occurrences make a phrase a candidate, and only a phrase whose first and last words form
candidates themselves can be one (Apriori). The candidates of a level are broadcast as double-array tries of at most
``TRIE_PHRASES`` phrases each. Every task advances the trie states of all positions of its texts together, word by
word; a bincount of the accepting states, summed over tasks, is the exact frequency of each candidate, and positions
where a candidate is followed by another one support the candidates of the next level. More candidates than one trie
holds make more tries and passes, never a larger broadcast.

Words are 64-bit hashes of language and word within tasks. That no two words share a hash is checked over all words;
otherwise the next seed is taken, so results are exact. Rows of one language, word or phrase are combined in tasks before
any shuffle.

Defined cases: null and empty texts have no words; a null language is ``und``; repeated rows count again; a language
without candidates has no rows; an empty table gives none; other columns are not read. Ties of cuts go to the smallest
first part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.llm import doublearray, textkit
from fareloom.session import materialise

LEAST = 30
LONGEST = 4
COVERED_PERCENT = 80
SCALE = 2_000_000
TRIE_PHRASES = 1 << 18
SEEDS = 16

MERGE_ROWS = 1_000_000

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_ENDS_PIECE = b".,;:!?\n\x0b\x0c\r"
_GAP = _ENDS_PIECE + b" \t"
_CLASS = bytes(2 if b in _ENDS_PIECE else 1 if b in _GAP else 0 for b in range(256))
_MASK = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


def split_pieces(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, piece) of each word, where each starts among the bytes of all words (one more for the end), and those
    bytes in lower case. Pieces are numbered over all texts."""
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, width)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = bytes(memoryview(data)[ends[0] : ends[-1]]) if data is not None else b""
    ends = ends - ends[0]
    kind = np.frombuffer(raw.translate(_CLASS), np.uint8)
    inside, mark = np.zeros(len(raw) + 2, bool), kind == 2
    inside[1:-1] = kind == 0
    starts, stops = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
    first = ends[:-1][ends[:-1] < len(raw)]  # a text ends the word and the piece before it
    starts[first], stops[first], mark[first] = inside[first + 1], inside[first], True
    at = np.flatnonzero(starts)
    bounds = np.concatenate(([0], np.cumsum(np.flatnonzero(stops) - at)))
    piece = np.cumsum(mark, dtype=np.int32)[at]
    owner = np.searchsorted(ends, at, side="right") - 1
    return owner, piece, bounds, np.frombuffer(raw.translate(_LOWER, _GAP), np.uint8)


def hash_spans(data: np.ndarray, bounds: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hash of each span of bytes, eight bytes at a time."""
    eight = np.ndarray((len(data) + 1,), "<u8", np.concatenate((data, np.zeros(8, np.uint8))), strides=(1,))
    at, left = bounds[:-1], np.diff(bounds)
    out = textkit.mix(left.astype(np.uint64) + np.uint64(seed) * textkit.MIX_C)
    rows = np.arange(len(out))
    while len(rows):
        out[rows] = textkit.mix(out[rows] ^ (eight[at] & _MASK[np.minimum(left, 8)]))
        longer = left > 8
        rows, at, left = rows[longer], at[longer] + 8, left[longer] - 8
    return out


def identified(part: pa.RecordBatch, seed: int) -> tuple[np.ndarray, ...]:
    """(language, piece, id) of each word of a slice, the languages, and the bounds and bytes of the words."""
    owner, piece, bounds, data = split_pieces(textkit.texts_of(part.column("text")))
    coded = part.column("lang").dictionary_encode()
    lang = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)[owner]
    salt = np.array([xxhash.xxh3_64_intdigest(x, seed) for x in coded.dictionary.to_pylist()], np.uint64)
    ids = textkit.mix(hash_spans(data, bounds, seed) ^ textkit.mix(salt)[lang]).view(np.int64)
    return lang, piece, ids, coded.dictionary, bounds, data


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their counts."""
    key, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(inverse, np.concatenate(counts), len(key)).astype(np.int64)


def word_counts(docs: DataFrame, seed: int) -> DataFrame:
    """``id, lang, word, n`` of every word of every language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textkit.slices(batch, "text"):
                lang, _, ids, langs, bounds, data = identified(part, seed)
                spans = pa.StringArray.from_buffers(
                    len(ids), pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)
                ).dictionary_encode()
                word = spans.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                size = max(1, len(spans.dictionary))
                key, first, n = np.unique(lang * size + word, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[first]),
                        langs.take(pa.array(key // size)),
                        spans.dictionary.take(pa.array(key % size)),
                        pa.array(n, pa.int64()),
                    ],
                    ["id", "lang", "word", "n"],
                )

    rows = docs.mapInArrow(count, "id long, lang string, word string, n long")
    return rows.groupBy("id", "lang", "word").agg(F.sum("n").alias("n"))


def all_words(docs: DataFrame) -> tuple[DataFrame, int]:
    """Written word counts whose ids are unique, and their seed."""
    for seed in range(SEEDS):
        words = materialise(word_counts(docs, seed), "words")
        if words.groupBy("id").count().filter("count > 1").isEmpty():
            return words, seed
    raise RuntimeError(f"{SEEDS} seeds gave words with equal hashes")


def pass_over(docs: DataFrame, seed: int, phrases: DataFrame, length: int, follow: bool, whole: bool) -> DataFrame:
    """Partial rows ``key, next, n`` of one trie of phrases of ``length`` words.

    ``next`` is null for the frequency of the phrase itself, else the word after it. With ``whole``, the trie has all
    candidates of the level, and a phrase is followed only where the next position starts a candidate too.
    """
    table = phrases.select("key", *[F.col("ids")[k].alias(f"w{k}") for k in range(length)]).toArrow()
    keys = table.column("key").to_numpy()
    ids = np.stack([table.column(f"w{k}").to_numpy() for k in range(length)], axis=1)
    shared = docs.sparkSession.sparkContext.broadcast((keys, doublearray.build(ids)))

    def rows(key: np.ndarray, after: np.ndarray | None, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(key), 100_000):
            own = slice(k, k + 100_000)
            follows = pa.nulls(len(key[own]), pa.int64()) if after is None else pa.array(after[own])
            yield pa.RecordBatch.from_arrays([pa.array(key[own]), follows, pa.array(n[own])], ["key", "next", "n"])

    def advance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, trie = shared.value
        total = np.zeros(len(keys), np.int64)
        words = trie.ids()
        pairs, counts, held = [], [], 0
        for batch in batches:
            for part in textkit.slices(batch, "text"):
                _, piece, ids, _, _, _ = identified(part, seed)
                code = trie.codes(ids)
                at, state = trie.walk(code, piece, length)
                leaf = trie.leaf[state].astype(np.int64)
                total += np.bincount(leaf, minlength=len(keys))
                if not follow:
                    continue
                goes_on = at + length < len(ids)
                goes_on[goes_on] = piece[at[goes_on] + length] == piece[at[goes_on]]
                if whole:
                    starts = np.zeros(len(ids) + 1, bool)
                    starts[at] = True
                    goes_on &= starts[at + 1]
                    at, leaf = at[goes_on], leaf[goes_on]
                    key, n = np.unique(leaf * len(words) + code[at + length], return_counts=True)
                    pairs.append(key)
                    counts.append(n)
                    held += len(key)
                    if held > MERGE_ROWS:
                        key, n = summed(pairs, counts)
                        pairs, counts, held = [key], [n], len(key)
                        if held > MERGE_ROWS // 2:
                            yield from rows(keys[key // len(words)], words[key % len(words)], n)
                            pairs, counts, held = [], [], 0
                else:
                    at, leaf = at[goes_on], leaf[goes_on]
                    known, local = np.unique(ids[at + length], return_inverse=True)
                    key, n = np.unique(leaf * max(1, len(known)) + local, return_counts=True)
                    yield from rows(keys[key // max(1, len(known))], known[key % max(1, len(known))], n)
        if pairs:
            key, n = summed(pairs, counts)
            yield from rows(keys[key // len(words)], words[key % len(words)], n)
        seen = np.flatnonzero(total)
        yield from rows(keys[seen], None, total[seen])

    return docs.mapInArrow(advance, "key long, next long, n long")


def counted(docs: DataFrame, seed: int, phrases: DataFrame, length: int, follow: bool, least: int) -> DataFrame:
    """Written ``key, next, n``: frequencies of all phrases of a level, and what follows them often enough."""
    shards = max(1, -(-phrases.count() // TRIE_PHRASES))
    rows = None
    for shard in range(shards):
        own = phrases.filter(F.pmod(F.xxhash64("key"), F.lit(shards)) == shard)
        part = pass_over(docs, seed, own, length, follow, shards == 1)
        part = part.groupBy("key", "next").agg(F.sum("n").alias("n")).filter(F.col("next").isNull() | (F.col("n") >= least))
        part = materialise(part, f"phrases-{length}")
        rows = part if rows is None else rows.unionByName(part)
    return rows


def frequent_phrases(docs: DataFrame, least: int, longest: int) -> tuple[DataFrame, DataFrame]:
    """``lang, size, phrase, f`` of all phrases of up to ``longest`` words, and ``lang, n``, both written."""
    narrow = textkit.in_small_batches(docs).select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    words, seed = all_words(narrow)
    totals = materialise(words.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    often = words.filter(F.col("n") >= least).select("lang", "id", F.col("word").alias("phrase"))
    often = often.select(F.monotonically_increasing_id().alias("key"), F.array("id").alias("ids"), "lang", "phrase")
    level = materialise(often, "level")
    single = level.select(F.col("ids")[0].alias("next"), F.col("phrase").alias("word"))
    found = None
    for length in range(1, longest + 1):
        if level.isEmpty():
            break
        counts = counted(narrow, seed, level, length, length < longest, least)
        sizes = counts.filter(F.col("next").isNull()).join(level, "key")
        sizes = sizes.select("lang", F.lit(length).alias("size"), "phrase", F.col("n").alias("f"))
        found = sizes if found is None else found.unionByName(sizes)
        if length < longest:
            longer = counts.filter(F.col("next").isNotNull()).join(level, "key").join(single, "next")
            level = materialise(
                longer.select(
                    F.monotonically_increasing_id().alias("key"),
                    F.concat("ids", F.array("next")).alias("ids"),
                    "lang",
                    F.concat_ws(" ", "phrase", "word").alias("phrase"),
                ),
                "level",
            )
    if found is None:
        found = narrow.sparkSession.createDataFrame([], "lang string, size int, phrase string, f long")
    return materialise(found, "found"), totals


def part_of(phrase: Column, start: Column, size: Column) -> Column:
    """Words ``start`` (from 1) to ``start + size - 1`` of a phrase."""
    return F.array_join(F.slice(F.split(phrase, " "), start, size), " ")


def mine(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, covered_percent: int = COVERED_PERCENT
) -> DataFrame:
    """``lang, phrase, size, a, l, r, n, cut, score`` of every candidate that no longer one covers.

    ``cut`` is the number of words of the first part of the lowest-scoring cut. Products are decimals of 38 digits.
    """
    found, totals = frequent_phrases(docs, least, longest)
    phrases = found.filter("size > 1")
    cuts = phrases.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "*",
        part_of(F.col("phrase"), F.lit(1), F.col("cut")).alias("head"),
        part_of(F.col("phrase"), F.col("cut") + 1, F.col("size") - F.col("cut")).alias("tail"),
    )
    heads = found.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = found.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    wide = F.col("f").cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(7,0)")
    both = F.col("l").cast("decimal(20,0)") + F.col("r").cast("decimal(20,0)")
    scored = (
        cuts.join(heads, ["lang", "head"])
        .join(tails, ["lang", "tail"])
        .withColumns({"wide": wide, "both": both})
        .withColumn("score", F.expr("wide div both"))
        .groupBy("lang", "phrase", "size", F.col("f").alias("a"))
        .agg(F.min(F.struct("score", "cut", "l", "r")).alias("weakest"))
    )
    starts = F.transform(
        F.sequence(F.lit(1), F.col("size") - F.col("part") + 1), lambda s: part_of(F.col("phrase"), s, F.col("part"))
    )
    inner = (
        phrases.filter("size > 2")
        .withColumn("part", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
        .select("lang", "f", F.explode(starts).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("longer"))
    )
    hundred = F.lit(100).cast("decimal(3,0)") * F.col("longer").cast("decimal(20,0)")
    share = F.lit(covered_percent).cast("decimal(3,0)") * F.col("a").cast("decimal(20,0)")
    return (
        scored.join(inner, ["lang", "phrase"], "left")
        .filter(F.col("longer").isNull() | (hundred < share))
        .join(totals, "lang")
        .select("lang", "phrase", "size", "a", "weakest.l", "weakest.r", "n", "weakest.cut", "weakest.score")
    )


def strongest(mined: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` phrases of each language, with their ``rank``."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return mined.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= limit)
