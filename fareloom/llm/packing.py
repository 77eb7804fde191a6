"""Packing documents into windows by best-fit decreasing.

A document becomes its token ids and an end id. Documents longer than a window are first cut into full windows; what
remains is placed, longest first, into the open window with the least room that still holds it. A segment tree over
room (1 to the window length) finds that window in a logarithmic number of steps.

Spark deals pieces into bins of about ``windows_per_bin`` windows by a hash; each bin is packed by one task on its own,
so memory is bounded by a bin whatever the corpus, and a document of any length is spread over bins by its pieces. Only
piece descriptions travel, never ids. A bin leaves about one window partly filled.

Defined cases: a null or empty text has the end id alone; repeated rows are packed once each; an empty table gives no
rows; further columns are ignored. Null ids are kept as null.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm import textkit, tokens
from fareloom.session import materialise

WINDOW = 4096
END_ID = 2
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED = PIECES + ", sequence_id long, offset long"


def pieces(
    docs: DataFrame, window: int = WINDOW, end_id: int = END_ID, vocabulary_path: str | None = None
) -> DataFrame:
    """Pieces of each document: full windows, then the rest. One row per piece, with the crc32 of its ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokens.coder(vocabulary_path)
        for batch in batches:
            for part in textkit.slices(batch, "text"):
                ends, ids = coder.encode(textkit.texts_of(part.column("text")))
                size = np.diff(ends) + 1
                count = -(-size // window)
                row = np.repeat(np.arange(len(size)), count)
                number = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                start = number * window
                length = np.minimum(window, size[row] - start)
                tail = np.uint32(end_id).tobytes()
                crc = [
                    zlib.crc32(ids[ends[r] + s : min(ends[r] + s + n, ends[r + 1])].tobytes() + tail * int(s + n == size[r]))
                    for r, s, n in zip(row.tolist(), start.tolist(), length.tolist(), strict=True)
                ]
                columns = [
                    part.column("doc_id").take(pa.array(row)),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                    pa.array(size[row], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    narrow = textkit.in_small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(cut, PIECES)


class OpenWindows:
    """Open windows by room: a segment tree whose leaves count the windows with each room."""

    def __init__(self, window: int):
        self.leaves = 1 << (window + 1).bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.by_room: dict[int, list[int]] = {}

    def add(self, room: int, number: int) -> None:
        self.by_room.setdefault(room, []).append(number)
        node = room + self.leaves
        while node:
            self.tree[node] += 1
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """(room, window) of the tightest window with at least that room, removed from the tree."""
        tree, node = self.tree, least + self.leaves
        if not tree[node]:
            while node > 1 and (node & 1 or not tree[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if tree[2 * node] else 2 * node + 1
        room = node - self.leaves
        while node:
            tree[node] -= 1
            node >>= 1
        return room, self.by_room[room].pop()


def best_fit(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """Window and offset of each piece, for lengths in falling order."""
    opened, numbers, offsets, count = OpenWindows(window), [], [], 0
    for length in lengths:
        found = opened.take(length)
        if found is None:
            found = (window, count)
            count += 1
        room, number = found
        numbers.append(number)
        offsets.append(window - room)
        if room > length:
            opened.add(room - length, number)
    return numbers, offsets


def pack(cut: DataFrame, window: int = WINDOW, windows_per_bin: int = 256) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces. ``cut`` is read twice and should be a written table."""
    total = cut.agg(F.sum("length")).first()[0] or 0
    bins = max(1, round(total / (window * windows_per_bin)))

    def place(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "start"], ascending=[False, True, True], kind="stable")
        numbers, offsets = best_fit(group["length"].tolist(), window)
        base = int(group["bin"].iloc[0]) << 32
        return group.drop(columns="bin").assign(sequence_id=base + np.array(numbers), offset=offsets)

    salted = cut.withColumn(
        "bin", F.pmod(F.xxhash64("doc_id", "start", F.monotonically_increasing_id()), F.lit(bins))
    )
    return salted.groupBy("bin").applyInPandas(place, PACKED)


def packed(
    docs: DataFrame,
    window: int = WINDOW,
    end_id: int = END_ID,
    windows_per_bin: int = 256,
    vocabulary_path: str | None = None,
) -> DataFrame:
    """Pieces of all documents with their places: ``sequence_id`` and a gapless ``offset`` in it."""
    cut = materialise(pieces(docs, window, end_id, vocabulary_path), "pieces")
    return pack(cut, window, windows_per_bin)
