"""Periodic runs of words within a text, found in an enhanced suffix array without tree nodes.

A run is a stretch of consecutive words with smallest period ``q`` that no neighbouring word extends keeping that period,
here with at least ``MIN_WORDS`` words and ``MIN_PERIODS`` periods.

For a slice of texts at a time: prefix doubling sorts the suffixes of all its texts together (words of different texts
differ, and each text ends with a symbol of its own, so no text meets another). Its ranks give the LCP of neighbours. Each
LCP interval of depth ``d`` holds suffixes with a common prefix of ``d`` words; a branching tandem repeat is a suffix
``i`` whose partner ``i + d`` or ``i - d`` lies in the same interval and another child of it. It is enough to look from
all children but the largest, by the inverse suffix array: ``n log n`` looks in all. The branching square of a run is its
last one; rotating it to the left word by word, in growing blocks, ends at the run's start. Of the squares with one end,
the shortest comes first, and those that its run contains have a multiple of its period.

Defined cases: null and empty texts have no words, no runs and an empty collapsed text; repeated rows are looked at once
each; null ids stay null; a text longer than a slice is one slice, its memory in proportion to its words; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.llm import textkit

MIN_WORDS = 6
MIN_PERIODS = 4
JUMPS = 64
STEPS = 32
SCHEMA = (
    "doc_id long, n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, dropped_words long, "
    "collapsed string"
)


def prefix_ranks(symbols: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... symbols; equal prefixes share the place of the first of them.

    The last entry is the inverse suffix array. Every suffix must end in a symbol that occurs once.
    """
    order = np.argsort(symbols, kind="stable")
    rank, left = _regrouped(order, [symbols[order]], np.zeros(len(order), np.int64))
    ranks, h = [np.empty(len(symbols), np.int32)], 1
    ranks[0][order] = rank
    while len(left):
        last = ranks[-1]
        own, behind = last[left].astype(np.int64), last[left + h].astype(np.int64)
        order = np.argsort(own * len(symbols) + behind, kind="stable")
        left, own, behind = left[order], own[order], behind[order]
        heads = np.concatenate(([True], own[1:] != own[:-1]))
        base = own - np.maximum.accumulate(np.where(heads, np.arange(len(own)), 0))
        rank, still = _regrouped(left, [own, behind], base)
        new = last.copy()
        new[left] = rank
        ranks.append(new)
        left, h = still, 2 * h
    return ranks


def _regrouped(positions: np.ndarray, keys: list[np.ndarray], base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rank of each sorted position: the place of its group's first one; positions that share their group)."""
    heads = np.ones(len(positions), bool)
    if len(positions):
        heads[1:] = np.logical_or.reduce([key[1:] != key[:-1] for key in keys])
    place = np.maximum.accumulate(np.where(heads, np.arange(len(positions)), 0))
    alone = heads & np.append(heads[1:], True)
    return base + place, positions[~alone]


def neighbour_lcp(ranks: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    """Common symbols of each suffix in order with the one before it; the first has 0, and a last 0 follows."""
    lcp = np.zeros(len(order) + 1, np.int64)
    alike, k = [], np.arange(1, len(order))
    for rank in ranks:
        k = k[rank[order[k - 1]] == rank[order[k]]]
        alike.append(k)
    for level in range(len(ranks) - 1, -1, -1):
        k = alike[level]
        if len(k):
            rank, done = ranks[level], lcp[k]
            lcp[k] = done + (rank[order[k - 1] + done] == rank[order[k] + done]) * (1 << level)
    return lcp


def smaller_sides(value: np.ndarray, inner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``inner``, the nearest places before and after it with a smaller value. Both ends hold 0."""
    found = []
    for step in (-1, 1):
        near = np.arange(len(value)) + step
        active = inner
        for _ in range(JUMPS):
            active = active[value[near[active]] >= value[active]]
            if not len(active):
                break
            near[active] = near[near[active]]
        found.append(None if len(active) else near[inner])
    if found[0] is None or found[1] is None:  # long chains: one walk with a stack
        heights = value.tolist()
        before, after, stack = np.zeros(len(value), np.int64), np.full(len(value), len(value) - 1), [0]
        for k in range(1, len(heights)):
            while heights[stack[-1]] > heights[k]:
                after[stack.pop()] = k
            equal = heights[stack[-1]] == heights[k]
            before[k] = before[stack[-1]] if equal else stack[-1]
            stack.append(k)
        return before[inner], after[inner]
    return found[0], found[1]


def branching_squares(ranks: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of every square that is not followed by its first symbol again."""
    inverse = ranks[-1]
    order = np.empty(len(inverse), np.int64)
    order[inverse] = np.arange(len(inverse))
    lcp = neighbour_lcp(ranks, order)
    cut = np.flatnonzero(lcp)
    if not len(cut):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low, high = smaller_sides(lcp, cut)
    depth = lcp[cut]
    by_interval = np.argsort(low * (depth.max() + 1) + depth, kind="stable")
    cut, low, high, depth = cut[by_interval], low[by_interval], high[by_interval], depth[by_interval]
    opens = np.concatenate(([True], (low[1:] != low[:-1]) | (depth[1:] != depth[:-1])))
    closes = np.append(opens[1:], True)
    # Children: up to each cut, and from the last cut to the interval's end.
    begin = np.where(opens, low, np.concatenate(([0], cut[:-1])))
    child_low, child_high = np.append(begin, cut[closes]), np.append(cut, high[closes])
    interval = np.append(np.cumsum(opens) - 1, np.arange(int(opens.sum())))
    low, high, depth = low[opens], high[opens], depth[opens]
    size = child_high - child_low
    ranked = np.lexsort((-size, interval))
    largest = np.concatenate(([True], interval[ranked][1:] != interval[ranked][:-1]))
    smaller = ranked[~largest]
    size = size[smaller]
    child = np.repeat(smaller, size)
    place = child_low[child] + np.arange(len(child)) - np.repeat(np.cumsum(size) - size, size)
    at, own = order[place], interval[child]
    starts, periods = [], []
    for step in (1, -1):
        partner = at + step * depth[own]
        known = np.flatnonzero(partner >= 0)
        rank = inverse[partner[known]]
        inside = (rank >= low[own[known]]) & (rank < high[own[known]])
        inside &= (rank < child_low[child[known]]) | (rank >= child_high[child[known]])
        known = known[inside]
        starts.append(np.minimum(at[known], partner[known]))
        periods.append(depth[own[known]])
    start, period = np.concatenate(starts), np.concatenate(periods)
    _, first = np.unique(start * (len(inverse) + 1) + period, return_index=True)
    return start[first], period[first]


def rotated(symbols: np.ndarray, start: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Leftmost starts that squares reach by rotation: every word before the start equals the one a period later."""
    start = start.copy()
    active = np.arange(len(start))
    for _ in range(STEPS):
        active = active[start[active] > 0]
        before = start[active] - 1
        active = active[symbols[before] == symbols[before + period[active]]]
        start[active] -= 1
        if not len(active):
            return start
    for k in active.tolist():
        at, q, block = int(start[k]), int(period[k]), STEPS
        while at:
            low = max(0, at - block)
            differs = np.flatnonzero(symbols[low:at] != symbols[low + q : at + q])
            if len(differs):
                at = low + int(differs[-1]) + 1
                break
            at, block = low, 2 * block
        start[k] = at
    return start


def all_runs(
    symbols: np.ndarray, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of the runs with so many words and periods (two at least), by start and period."""
    start, period = branching_squares(prefix_ranks(symbols))
    end = start + 2 * period
    order = np.lexsort((period, end))
    start, period, end = start[order], period[order], end[order]
    found = [(np.zeros(0, np.int64),) * 3]
    while len(start):
        head = np.concatenate(([True], end[1:] != end[:-1]))
        own = np.cumsum(head) - 1
        begin = rotated(symbols, start[head], period[head])
        found.append((begin, end[head] - begin, period[head]))
        left = start < begin[own]
        start, period, end = start[left], period[left], end[left]
    begin, length, period = (np.concatenate(x) for x in zip(*found, strict=True))
    enough = (length >= min_words) & (length >= max(2, min_periods) * period)
    begin, length, period = begin[enough], length[enough], period[enough]
    order = np.lexsort((period, begin))
    return begin[order], length[order], period[order]


def runs_of_texts(
    offsets: np.ndarray, word: np.ndarray, min_words: int, min_periods: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of the runs of all texts of a slice; starts count within a text."""
    owner = textkit.rows_of(offsets)
    texts = len(offsets) - 1
    # One symbol per text and word; after each text, one of its own.
    symbols = np.empty(len(word) + texts, np.int64)
    size = int(word.max(initial=0)) + 2
    symbols[np.arange(len(word)) + owner] = owner * size + word
    symbols[offsets[1:] + np.arange(texts)] = np.arange(texts) * size + size - 1
    start, length, period = all_runs(symbols, min_words, min_periods)
    text = np.searchsorted(offsets[1:] + np.arange(texts), start, side="left")
    return text, start - offsets[text] - text, length, period


def detect(docs: DataFrame, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> DataFrame:
    """``doc_id, n_words, runs, dropped_words, collapsed`` of every row.

    ``runs`` come by start and period. ``collapsed`` is the text's words joined by one space, less those that some run
    contains after its first period.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textkit.slices(batch, "text"):
                texts = textkit.texts_of(part.column("text"))
                offsets, word, _ = textkit.words(texts)
                text, start, length, period = runs_of_texts(offsets, word, min_words, min_periods)
                count = np.bincount(text, minlength=len(texts))
                dropped = np.zeros(len(texts), np.int64)
                collapsed = []
                for k, raw in enumerate(texts.to_pylist()):
                    words = raw.encode().split()  # at ASCII white space
                    if count[k]:
                        keep = np.ones(len(words), bool)
                        for r in np.flatnonzero(text == k).tolist():
                            keep[start[r] + period[r] : start[r] + length[r]] = False
                        dropped[k] = len(words) - int(keep.sum())
                        words = [w for w, stays in zip(words, keep.tolist(), strict=True) if stays]
                    collapsed.append(b" ".join(words).decode())
                runs = pa.StructArray.from_arrays(
                    [pa.array(x, pa.int64()) for x in (start, length, period)], ["start", "length", "period"]
                )
                columns = [
                    part.column("doc_id"),
                    pa.array(np.diff(offsets)),
                    textkit.list_array(np.concatenate(([0], np.cumsum(count))), runs),
                    pa.array(dropped),
                    pa.array(collapsed, pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "dropped_words", "collapsed"])

    narrow = textkit.in_small_batches(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return narrow.mapInArrow(find, SCHEMA)


def strongest(runs: Column) -> Column:
    """The run with most periods, compared exactly; ties go to the smaller start, then the smaller period."""

    def earlier(x: Column, y: Column) -> Column:
        mine, other = x["length"] * y["period"], y["length"] * x["period"]
        return (
            F.when(mine != other, F.when(mine > other, -1).otherwise(1))
            .when(x["start"] != y["start"], F.when(x["start"] < y["start"], -1).otherwise(1))
            .otherwise(F.when(x["period"] < y["period"], -1).when(x["period"] > y["period"], 1).otherwise(0))
        )

    return F.get(F.array_sort(runs, earlier), 0)


def with_planted_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, text``, where one id in ten (by crc32) repeats its own words from some place on.

    With ``h`` the hash of the decimal id, ``g = floor(h / 10)`` and ``n`` words, word ``i >= a`` becomes word
    ``a + (i - a) % p`` for ``a = g % n`` and ``p = 1 + floor((n - a) / (3 + g % 8))``. Rows without an id stay.
    """
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    text = F.col("text").cast("string")
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), h.alias("h"))
        .withColumns({"words": F.when(F.col("h") % 10 == 0, words), "g": F.expr("h div 10")})
        .withColumn("n", F.size("words"))
        .withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int")))
        .withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) AS int)"))
        .withColumn("times", F.expr("cast(1 + (n - a) div p AS int)"))
        .withColumn(
            "planted",
            F.expr("array_join(slice(concat(slice(words, 1, a), flatten(array_repeat(slice(words, a + 1, p), times))), 1, n), ' ')"),
        )
        .select("doc_id", F.when(F.col("n") > 0, F.col("planted")).otherwise(F.col("text")).alias("text"))
    )
