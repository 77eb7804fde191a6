"""Exact Jaccard self-join of word n-gram sets with set-relation skipping; one class per document.

Documents with equal sets are one node. Two nodes can only reach the threshold if they share one of their first tokens in
a global order (rare tokens before frequent ones), so an index holds those first tokens with their positions.

Relations between sets spare most work:

* Index lists skip by position. What stands behind a token in two sets bounds what they share from it on; entries too far
  back for the sizes at hand are skipped.
* Answers are derived from a similar set. In long lists, every set is first compared with one hub, the set of the list
  whose tokens are most frequent, i.e. the one closest to what the list has in common. Sets that link to it form one
  component, and pairs within a component are never formed one by one: only what lies between components is.
* Links within such a component come from its centre. What two sets share is the centre's size less what either lacks of
  it plus what their differences from it share; where the differences are small enough together the pair links whatever
  they share, so such links are counted by sums over sizes of differences. Only differences of the others meet, in blocks.

All pairs left are verified on their full sets. No candidate is dropped otherwise; token frequencies only shape the
order, never the result. Only the heaviest tokens (at most ``HEAVY``) are broadcast, and a bit map of fixed size.

Defined cases: null and empty texts have an empty set and are linked with nothing; texts of fewer words than a shingle
have one shingle, all their words; rows with equal ids are separate rows; a null id does not name a class unless all ids
of the class are null; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.llm import bitfilter, textkit
from fareloom.llm.components import components
from fareloom.session import materialise

HEAVY = 1 << 18
HEAVY_LEAST = 8
LONG_LIST = 8
# Most sets, and about the most tokens in which they differ from their centre, of a block of undecided sets.
BLOCK_NODES = 512
BLOCK_TOKENS = 1 << 17
# A token in as many sets of two blocks goes into a matrix product instead of being listed by pairs.
DENSE = 16
# The part of all tokens, by hash, whose documents are counted. Somewhat more than the part of a set that its prefix
# takes, so that most prefixes consist of tokens known to be in one document only.
COUNTED = 0.28

_TOP, _CLASS = np.uint64(1 << 63), np.uint64(1 << 61)


def shingles(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text: (offsets, hashes)."""
    offsets, word, vocabulary = textkit.words(pc.ascii_lower(texts))
    h = textkit.hash_strings(vocabulary)[word]
    n, row = np.diff(offsets), textkit.rows_of(offsets)
    full = np.flatnonzero(np.arange(len(h)) + width <= offsets[1:][row])
    value = h[full]
    for k in range(1, width):
        value = textkit.mix(value * textkit.MIX_A + h[full + k])
    short = np.flatnonzero((n > 0) & (n < width))
    whole = h[offsets[short]]
    for k in range(1, width - 1):
        more = n[short] > k
        whole[more] = textkit.mix(whole[more] * textkit.MIX_A + h[offsets[short][more] + k])
    whole = textkit.mix(whole ^ (n[short].astype(np.uint64) * textkit.MIX_C))
    return textkit.grouped_unique(np.concatenate((row[full], short)), np.concatenate((value, whole)), len(n))


def set_marks(offsets: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each set, independent of order."""
    marks = []
    for salt in (textkit.MIX_B, textkit.MIX_C):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(textkit.mix(values ^ salt))))
        marks.append((sums[offsets[1:]] - sums[offsets[:-1]]).view(np.int64))
    return marks[0], marks[1]


def token_counts(docs: DataFrame, width: int) -> DataFrame:
    """``token, exact, often`` of tokens in two documents or more.

    ``exact`` is the number of documents of a counted token. ``often`` adds up what repeats within the slices of tasks, a
    cheap estimate that finds frequent tokens among the others too.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textkit.slices(batch, "text"):
                offsets, values = shingles(textkit.texts_of(part.column("text")), width)
                token, n = np.unique(values[is_counted(values)], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(token.view(np.int64)), pa.array(n, pa.int64()), pa.array(np.zeros(len(n), np.int64))], names
                )
                token, n = np.unique(values, return_counts=True)
                token, n = token[n > 1], n[n > 1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(token.view(np.int64)), pa.array(np.zeros(len(n), np.int64)), pa.array(n, pa.int64())], names
                )

    names = ["token", "exact", "often"]
    partial = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(
        count, "token long, exact long, often long"
    )
    sums = partial.groupBy("token").agg(F.sum("exact").alias("exact"), F.sum("often").alias("often"))
    return sums.filter((F.col("exact") > 1) | (F.col("often") > 1))


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return np.where(n > 0, n - -(-percent * n // 100) + 1, 0)


def is_counted(values: np.ndarray) -> np.ndarray:
    """Whether a token is among those whose documents are counted: a property of the token alone."""
    return values < np.uint64(int(COUNTED * 2**64))


class TokenOrder:
    """The global order: tokens of one document, tokens not counted, tokens that repeat, frequent ones by count; by hash
    within each of the first three.

    Ranks are signed longs. Whether a token repeats is read from a bit map; a wrong yes places it later, which is as
    good an order.
    """

    def __init__(self, tokens: np.ndarray, counts: np.ndarray, repeated: np.ndarray):
        by_token = np.argsort(tokens)
        self.tokens = tokens[by_token]
        self.rank = by_token.astype(np.uint64)
        self.weight = np.log2(1.0 + counts[by_token])
        self.repeated = repeated

    @classmethod
    def learned(cls, counts: DataFrame, limit: int, least: int) -> TokenOrder:
        """From a written table of ``token_counts``."""
        found = (
            counts.filter(F.col("often") >= least)
            .orderBy(F.desc("often"), "token")
            .limit(limit)  # bounds what is broadcast; tokens beyond stand with those that repeat
            .toArrow()
        )
        token, often = found["token"].to_numpy(), found["often"].to_numpy()
        order = np.lexsort((token, often))
        return cls(token.view(np.uint64)[order], often[order], bitfilter.build(counts, "token"))

    def place(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rank of each token, its weight (0 unless frequent), and whether two documents may have it."""
        repeats = bitfilter.holds(self.repeated, values)
        shared = repeats | ~is_counted(values)
        rank, weight = values >> np.uint64(3), np.zeros(len(values))
        rank |= np.where(repeats, _CLASS * np.uint64(2), np.where(shared, _CLASS, np.uint64(0)))
        if len(self.tokens):
            at = np.minimum(np.searchsorted(self.tokens, values), len(self.tokens) - 1)
            heavy = self.tokens[at] == values
            rank = np.where(heavy, _TOP | self.rank[at], rank)
            weight = np.where(heavy, self.weight[at], 0.0)
        return (rank ^ _TOP).view(np.int64), weight, shared


def described(docs: DataFrame, width: int, percent: int, order: TokenOrder) -> DataFrame:
    """One row per document: set size, set hashes, mean weight, and the index tokens with their places.

    Index tokens are those of the prefix that another document may have.
    """
    names = ["doc_id", "n", "mark_a", "mark_b", "centre", "tokens", "places"]

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textkit.slices(batch, "text"):
                offsets, values = shingles(textkit.texts_of(part.column("text")), width)
                n = np.diff(offsets)
                a, b = set_marks(offsets, values)
                rank, weight, shared = order.place(values)
                row = textkit.rows_of(offsets)
                sums = np.concatenate(([0.0], np.cumsum(weight)))
                centre = (sums[offsets[1:]] - sums[offsets[:-1]]) / np.maximum(n, 1)
                sequence = np.lexsort((rank, row))
                rank, shared = rank[sequence], shared[sequence]
                place, length = np.arange(len(rank)) - offsets[:-1][row], prefix_length(n, percent)
                use = np.flatnonzero(shared & (place < length[row]))
                ends = np.concatenate(([0], np.cumsum(np.bincount(row[use], minlength=len(n)))))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        *(pa.array(x, pa.int64()) for x in (n, a, b)),
                        pa.array(np.round(centre, 6)),
                        textkit.list_array(ends, pa.array(rank[use])),
                        textkit.list_array(ends, pa.array(place[use], pa.int64())),
                    ],
                    names,
                )

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kinds = "doc_id long, n long, mark_a long, mark_b long, centre double"
    return narrow.mapInArrow(describe, kinds + ", tokens array<long>, places array<long>")


def index_entries(nodes: DataFrame) -> DataFrame:
    """``token, node, n, place, centre``: one row per node and index token."""
    each = nodes.select("node", "n", "centre", F.explode(F.arrays_zip("tokens", "places")).alias("entry"))
    return each.select(F.col("entry.tokens").alias("token"), "node", "n", F.col("entry.places").alias("place"), "centre")


def least_overlap(m: Column, n: Column, percent: int) -> Column:
    """Smallest intersection of sets of these sizes that reaches the threshold."""
    return F.ceil(F.lit(percent) * (m + n) / F.lit(100 + percent))


def sizes_fit(m: Column, n: Column, percent: int) -> Column:
    return F.lit(100) * F.least(m, n) >= F.lit(percent) * F.greatest(m, n)


def hub_pairs(entries: DataFrame, percent: int, long_list: int = LONG_LIST) -> DataFrame:
    """``a, b``: each node of a long list with the most central hub among its lists' hubs."""
    hub = F.struct("centre", F.col("node").alias("hub"), F.col("n").alias("hub_n"))
    hubs = entries.groupBy("token").agg(F.count("*").alias("size"), F.max(hub).alias("h"))
    hubs = hubs.filter(F.col("size") >= long_list).select("token", "h")
    met = entries.join(hubs, "token").filter(
        (F.col("node") != F.col("h.hub")) & sizes_fit(F.col("n"), F.col("h.hub_n"), percent)
    )
    best = met.groupBy("node").agg(F.max("h").alias("h"))
    return best.select(F.col("node").alias("a"), F.col("h.hub").alias("b"))


def remaining_pairs(entries: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """``a, b``: pairs of different components whose first shared token leaves the threshold in reach.

    A token at places i and j bounds what two sets share, from it on, by what stands behind it in either; the first token
    that they share must leave enough, so list entries beyond are skipped.
    """
    own = entries.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    # Of each list: components in it, and the largest of them.
    parts = own.groupBy("token", "component").agg(F.count("*").alias("size"))
    lists = parts.groupBy("token").agg(F.count("*").alias("parts"), F.max(F.struct("size", "component")).alias("top"))
    mixed = lists.filter(F.col("parts") > 1).select("token", F.col("top.component").alias("top"))
    live = materialise(own.join(mixed, "token").select("token", "node", "n", "place", "component", "top"), "lists")
    left, right = live.filter(F.col("component") != F.col("top")).alias("l"), live.alias("r")
    need = least_overlap(F.col("l.n"), F.col("r.n"), percent)
    met = left.join(
        right,
        (F.col("l.token") == F.col("r.token"))
        & (F.col("l.component") != F.col("r.component"))
        # A pair outside the largest component would come up from both sides.
        & ((F.col("r.component") == F.col("r.top")) | (F.col("l.node") < F.col("r.node")))
        & sizes_fit(F.col("l.n"), F.col("r.n"), percent)
        & (F.col("l.n") - F.col("l.place") >= need)
        & (F.col("r.n") - F.col("r.place") >= need),
    )
    return met.select(
        F.least("l.node", "r.node").alias("a"), F.greatest("l.node", "r.node").alias("b")
    ).distinct()


def full_sets(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """``node, tokens`` of the nodes in ``pairs(a, b)``, read again from their texts; repeated rows repeat a node."""
    used = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = materialise(nodes.select("node", "doc_id", "mark_a", "mark_b").join(used, "node"), "wanted")
    bitmap = bitfilter.build(wanted.select(F.xxhash64("doc_id").alias("key")), "key")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Texts of no node concerned are dropped before they are cut into words.
            named = bitfilter.holds(bitmap, batch.column("key").to_numpy(zero_copy_only=False))
            for part in textkit.slices(batch.filter(pa.array(named)), "text"):
                offsets, values = shingles(textkit.texts_of(part.column("text")), width)
                a, b = set_marks(offsets, values)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(a),
                        pa.array(b),
                        textkit.list_array(offsets, pa.array(values.view(np.int64))),
                    ],
                    ["own_id", "own_a", "own_b", "tokens"],
                )

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    narrow = narrow.withColumn("key", F.xxhash64("doc_id"))
    sets = narrow.mapInArrow(read, "own_id long, own_a long, own_b long, tokens array<long>")
    sets = sets.join(
        wanted,
        F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_a") == F.col("mark_a")) & (F.col("own_b") == F.col("mark_b")),
    ).select("node", "tokens")
    return materialise(sets, "sets")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that reach the threshold on their full sets."""
    met = (
        pairs.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("x")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("y")), "b")
    )
    common = F.size(F.array_intersect("x", "y"))
    united = F.size("x") + F.size("y") - common
    return met.filter(F.lit(100) * common >= F.lit(percent) * united).select("a", "b")


def centre_differences(labels: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``component, node, copies, slack, far, size, tokens`` of every node of ``labels``: the tokens in which it differs
    from the centre of its component and their number.

    With r tokens of the centre missing and a others added, ``far`` is 100 r + percent a, and ``slack`` is (100 - percent)
    times the centre's size. Two sets link if and only if their ``far`` add up to at most ``slack`` plus
    (100 + percent) times what their differences share.
    """
    placed = labels.join(nodes.select("node", "copies", "centre"), "node")
    centre = F.max(F.struct("centre", "node")).getField("node").alias("hub")
    hubs = placed.groupBy("component").agg(centre)
    hub_sets = hubs.join(sets.select(F.col("node").alias("hub"), F.col("tokens").alias("h")), "hub")
    hub_sets = hub_sets.dropDuplicates(["hub"])
    met = placed.select("component", "node", "copies").join(sets, "node").join(hub_sets, "component")
    missing, added = F.array_except("h", "tokens"), F.array_except("tokens", "h")
    found = met.select(
        "component",
        "node",
        "copies",
        (F.lit(100 - percent) * F.size("h")).cast("long").alias("slack"),
        missing.alias("missing"),
        added.alias("added"),
    )
    far = F.lit(100) * F.size("missing") + F.lit(percent) * F.size("added")
    differ = F.concat("missing", "added")
    found = found.select(
        "component", "node", "copies", "slack", far.cast("long").alias("far"), F.size(differ).alias("size"), differ.alias("tokens")
    )
    return found.dropDuplicates(["node"])


def counts_of_near(members: DataFrame) -> DataFrame:
    """``node, links``: rows in other nodes of the component that link however little the differences share."""
    each = members.groupBy("component", "slack", "far").agg(F.sum("copies").alias("copies"))
    # What lies up to slack - far is a running sum; a question comes after the values that are equal to it.
    values = each.select("component", F.col("far").alias("at"), F.lit(0).alias("asks"), "copies", F.lit(None).cast("long").alias("far"))
    asked = each.select("component", (F.col("slack") - F.col("far")).alias("at"), F.lit(1).alias("asks"), F.lit(0).cast("long").alias("copies"), "far")
    upto = Window.partitionBy("component").orderBy("at", "asks").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    answers = values.unionByName(asked).withColumn("links", F.sum("copies").over(upto)).filter("asks = 1")
    own = F.when(F.col("far") * 2 <= F.col("slack"), F.col("copies")).otherwise(F.lit(0))
    joined = members.select("component", "node", "copies", "slack", "far").join(answers.select("component", "far", "links"), ["component", "far"])
    return joined.select("node", (F.col("links") - own).alias("links"))


def shared_counts(left: np.ndarray, lefts: np.ndarray, right: np.ndarray, rights: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """How many tokens each row of one block shares with each of the other: ``left`` are rows, ``lefts`` their tokens."""
    tokens, codes = np.unique(np.concatenate((lefts, rights)), return_inverse=True)
    a, b = codes[: len(lefts)], codes[len(lefts) :]
    in_a, in_b = np.bincount(a, minlength=len(tokens)), np.bincount(b, minlength=len(tokens))
    dense = (in_a > 0) & (in_b > 0) & (in_a + in_b >= DENSE)
    sparse = (in_a > 0) & (in_b > 0) & ~dense
    by_code = np.argsort(b, kind="stable")
    first = np.concatenate(([0], np.cumsum(in_b)))
    use = np.flatnonzero(sparse[a])
    n = in_b[a[use]]
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    met = right[by_code[np.repeat(first[a[use]], n) + step]]
    shared = np.bincount(np.repeat(left[use], n) * shape[1] + met, minlength=shape[0] * shape[1]).reshape(shape)
    place = np.cumsum(dense) - 1
    for start in range(0, int(dense.sum()), 2048):
        x, y = np.zeros((shape[0], 2048), np.float32), np.zeros((shape[1], 2048), np.float32)
        for matrix, row, code in ((x, left, a), (y, right, b)):
            own = np.flatnonzero(dense[code] & (place[code] >= start) & (place[code] < start + 2048))
            matrix[row[own], place[code[own]] - start] = 1
        shared += (x @ y.T).astype(np.int64)
    return shared


def counts_of_far(members: DataFrame, percent: int) -> DataFrame:
    """``node, links``: rows in other nodes of the component that link only by what the differences share.

    Nodes that are near enough to link with all the rest in any case are left out; the others are dealt into blocks by
    hash, every two blocks of a component meet in one task, and only counts come out.
    """
    most = members.groupBy("component").agg(F.max("far").alias("most"))
    live = members.join(most, "component").filter(F.col("far") + F.col("most") > F.col("slack")).drop("most")
    total = live.groupBy("component").agg(F.count("*").alias("nodes"), F.sum("size").alias("tokens_in_all"))
    wanted = F.greatest(F.ceil(F.col("nodes") / BLOCK_NODES), F.ceil(F.col("tokens_in_all") / BLOCK_TOKENS))
    blocks = total.filter("nodes > 1").select("component", F.least("nodes", wanted).cast("int").alias("blocks"))
    dealt = live.join(blocks, "component").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))

    def count(both: pa.Table) -> pa.Table:
        both = both.combine_chunks()
        own, far, copies = (both.column(c).to_numpy() for c in ("own", "far", "copies"))
        i, j, slack = (both.column(c)[0].as_py() for c in ("i", "j", "slack"))
        lists = both.column("tokens").combine_chunks()
        size, tokens = pc.list_value_length(lists).to_numpy(zero_copy_only=False), lists.flatten().to_numpy()
        sides = []
        for block in (i, j):
            rows = np.flatnonzero(own == block)
            place = np.full(len(own), -1)
            place[rows] = np.arange(len(rows))
            entry = np.repeat(place, size)
            sides.append((rows, entry[entry >= 0], tokens[entry >= 0]))
        (rows, left, lefts), (others, right, rights) = sides
        need = far[rows][:, None] + far[others][None, :] - slack
        links = (need > 0) & ((100 + percent) * shared_counts(left, lefts, right, rights, need.shape) >= need)
        n = np.zeros(len(own), np.int64)
        if i == j:
            np.fill_diagonal(links, False)
        else:
            n[others] = copies[rows] @ links
        n[rows] = links @ copies[others]
        return pa.table({"node": both.column("node"), "links": pa.array(n)}).filter(pa.array(n > 0))

    kept = dealt.select("component", "i", "j", "own", "node", "copies", "slack", "far", "tokens")
    counted = kept.groupBy("component", "i", "j").applyInArrow(count, "node long, links long")
    return counted


def counts_between(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, links``: rows in nodes that ``links(a, b)``, each pair once, names."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    met = both.join(nodes.select(F.col("node").alias("b"), "copies"), "b")
    return met.select(F.col("a").alias("node"), F.col("copies").alias("links"))


def classes(docs: DataFrame, width: int = 4, percent: int = 85, links: bool = False) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row of ``docs``; the component is named by its smallest id.

    With ``links`` also ``n_links``, the number of other rows whose set reaches the threshold with the row's own.
    """
    docs = textkit.in_small_batches(docs)
    order = TokenOrder.learned(materialise(token_counts(docs, width), "tokens"), HEAVY, HEAVY_LEAST)
    rows = materialise(described(docs, width, percent, order), "rows")
    # Equal sets, equal prefixes: any of them will do. One row per set and task goes into the shuffle.
    nodes = (
        rows.filter(F.col("n") > 0)
        .groupBy("mark_a", "mark_b", "n")
        .agg(F.min("doc_id").alias("doc_id"), *[F.any_value(c).alias(c) for c in ("centre", "tokens", "places")], F.count("*").alias("copies"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    nodes = materialise(nodes, "nodes")
    entries = materialise(index_entries(nodes), "entries")
    with_hubs = materialise(hub_pairs(entries, percent), "pairs")
    hub_sets = full_sets(with_hubs, nodes, docs, width)
    hub_links = materialise(verified(with_hubs, hub_sets, percent), "links")
    labels = materialise(components(hub_links), "labels")
    between = materialise(remaining_pairs(entries, labels, percent), "pairs")
    more_links = verified(between, full_sets(between, nodes, docs, width), percent)
    counts = None
    if links:
        # Rows that repeat an id and a text repeat a node's set, and so a link.
        more_links = materialise(more_links.distinct(), "links")
        members = materialise(centre_differences(labels, nodes, hub_sets, percent), "differences")
        counts = counts_of_near(members).unionByName(counts_of_far(members, percent))
        counts = counts.unionByName(counts_between(more_links, nodes))
        counts = counts.groupBy("node").agg(F.sum("links").alias("links"))
    labels = components(hub_links.unionByName(more_links))
    named = (
        nodes.select("mark_a", "mark_b", "n", "doc_id", "node", "copies")
        .join(labels, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    # One row per node; a class gets its smallest id without gathering its members.
    names = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    marked = named.join(names, "component")
    if counts is not None:
        marked = marked.join(counts, "node", "left")
        marked = marked.withColumn("n_links", F.col("copies") - 1 + F.coalesce("links", F.lit(0)))
    extra = ["n_links"] if links else []
    marks = materialise(marked.select("mark_a", "mark_b", "component_id", *extra), "named")
    found = rows.select("doc_id", "n", "mark_a", "mark_b")
    joined = found.join(marks, ["mark_a", "mark_b"], "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    counted = [F.coalesce("n_links", F.lit(0)).alias("n_links")] if links else []
    return joined.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"), *counted)
