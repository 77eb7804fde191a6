"""Near-duplicate vectors by NN-descent: links of cosine ``THRESHOLD`` and more, and what they connect.

1. Equal vectors become one node that knows its copies.
2. Dense places become balls: within blocks of neighbouring vectors (cells of random hyperplanes, dealt by a hash where a
   cell is large), a leader takes all within half the threshold's angle. Members of a ball are linked by the triangle
   inequality, so links within it are counted and never listed.
3. The leaders' neighbour graph starts with the best of a few sets of small blocks and is refined by joins: everyone
   in the list of a node, or with that node in its list, meets the others around it. Nodes with very many such neighbours
   have them dealt into pieces. Lists hold ``NEIGHBOURS`` entries; a list that consists of possible links only is
   saturated and doubles, as often as it takes. Eight-bit codes of the vectors travel here.
4. Possible links between leaders are decided exactly, in double precision, member by member: chunks of the two balls meet
   in a task, which returns counts.
5. An audit compares a bounded sample of nodes with all vectors by brute force; below ``RECALL``, the graph is built
   again with longer lists and other blocks.

No pair is reported below the threshold; NN-descent may miss pairs, the audit's recall is logged.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing and are their own
component; shorter vectors count as padded with zeros; rows without an id have a null component, count as copies of equal
vectors and are kept; rows that share an id are rows of their own; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.llm.components import components
from fareloom.session import materialise, ship_package

logger = logging.getLogger(__name__)

THRESHOLD = 0.95
NEIGHBOURS = 8
TREES = 4
LEAF = 64
BALL_BLOCK = 512
AROUND = 64
MAX_ROUNDS = 6
SETTLED = 0.01
AUDIT = 1024
RECALL = 0.95
ATTEMPTS = 3
BUCKET_ROWS = 8192
CHUNK_BYTES = 131_072
CODE_ERROR = 0.03  # radians that codes may be off, far beyond their rounding

LISTS = "node long, nbr long, cos double, near boolean, k int"


def usable(vector: Column) -> Column:
    """Whether all components are finite numbers and one of them is not zero."""
    x = vector.cast("array<double>")
    finite = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < math.inf), F.lit(False)))
    return F.coalesce(finite & F.exists(x, lambda c: c != 0), F.lit(False))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def units(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaling by the largest component first keeps squares finite."""
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def coded(column: pa.Array, dims: int) -> np.ndarray:
    """Unit rows of binary codes in single precision."""
    raw = np.frombuffer(b"".join(column.to_pylist()), np.int8).reshape(-1, dims).astype(np.float32)
    return raw / np.sqrt((raw * raw).sum(axis=1, keepdims=True))


def in_cells(points: DataFrame, vector: str, dims: int, count: int, trees: int, leaf: int, seed: int) -> DataFrame:
    """``points`` once per tree with ``block``: a cell of random hyperplanes, or a piece of about ``leaf`` rows of it."""
    bits = max(0, math.ceil(math.log2(max(1, count) / leaf)))
    planes = np.random.default_rng(seed).standard_normal((trees, bits, dims))
    names = points.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            column = batch.column(vector)
            rows = coded(column, dims) if pa.types.is_binary(column.type) else matrix(column, dims)
            for tree in range(trees):
                cell = ((rows @ planes[tree].T > 0) @ weights) * trees + tree
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int64())], [*names, "cell"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in points.schema)
    cells = points.mapInArrow(place, f"{schema}, cell long")
    sizes = cells.groupBy("cell").agg(F.count("*").alias("size")).filter(F.col("size") > 2 * leaf)
    pieces = F.ceil(F.coalesce(F.col("size"), F.lit(1)) / leaf)
    piece = F.pmod(F.xxhash64("node", F.lit(seed)), pieces)
    return cells.join(sizes, "cell", "left").withColumn("block", F.xxhash64("cell", piece)).drop("cell", "size")


def block_ranges(block: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of equal values of a sorted array."""
    cuts = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1], [True])))
    return list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))


def bucketed(rows: DataFrame, count: int) -> DataFrame:
    """Whole blocks dealt into buckets of about ``BUCKET_ROWS`` rows, one group each."""
    return rows.withColumn("bucket", F.pmod(F.xxhash64("block"), F.lit(max(1, count // BUCKET_ROWS))))


def leaders(nodes: DataFrame, dims: int, count: int, half: float, seed: int) -> DataFrame:
    """``node, leader`` after one round in blocks. Nodes that are ``fixed`` stay leaders of themselves."""

    def lead(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([("block", "ascending"), ("fixed", "descending"), ("node", "ascending")])
        node, fixed = table.column("node").to_numpy(), table.column("fixed").to_numpy(zero_copy_only=False)
        unit = units(matrix(table.column("v").combine_chunks(), dims))
        own = node.copy()
        for start, end in block_ranges(table.column("block").to_numpy()):
            near = unit[start:end] @ unit[start:end].T >= half
            free = ~fixed[start:end]
            for k in np.flatnonzero(near.sum(axis=1) > 1).tolist():
                if own[start + k] == node[start + k]:
                    free[k] = False
                    taken = np.flatnonzero(near[k] & free)
                    own[start + taken] = node[start + k]
                    free[taken] = False
        return pa.table({"node": node, "leader": own})

    blocks = bucketed(in_cells(nodes, "v", dims, count, 1, BALL_BLOCK, seed), count)
    return blocks.groupBy("bucket").applyInArrow(lead, "node long, leader long")


def balls(nodes: DataFrame, dims: int, half: float) -> DataFrame:
    """Written ``node, leader``: balls whose members are within half the threshold's angle of their leader."""
    free = nodes.select("node", "v", F.lit(False).alias("fixed"))
    first = materialise(leaders(free, dims, nodes.count(), half, 1), "leaders")
    sizes = first.groupBy("leader").agg(F.count("*").alias("size"))
    again = nodes.join(sizes, F.col("node") == F.col("leader")).select("node", "v", (F.col("size") > 1).alias("fixed"))
    second = leaders(again, dims, sizes.count(), half, 2).select(F.col("node").alias("leader"), F.col("leader").alias("last"))
    return materialise(first.join(second, "leader").select("node", F.col("last").alias("leader")), "balls")


def with_radius(nodes: DataFrame, ball: DataFrame, dims: int) -> DataFrame:
    """Written ``node, code, radius`` of the leaders: eight-bit codes and the angle to the farthest member."""
    whose = ball.join(nodes.select("node", "v"), "node")
    centre = nodes.select(F.col("node").alias("leader"), F.col("v").alias("centre"))

    def angles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cos = (units(matrix(batch.column("v"), dims)) * units(matrix(batch.column("centre"), dims))).sum(axis=1)
            angle = np.arccos(np.clip(cos, -1, 1))
            yield pa.RecordBatch.from_arrays([batch.column("leader"), pa.array(angle)], ["leader", "angle"])

    members = whose.filter("node <> leader").join(centre, "leader").select("leader", "v", "centre")
    radius = members.mapInArrow(angles, "leader long, angle double").groupBy("leader").agg(F.max("angle").alias("radius"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = matrix(batch.column("v"), dims)
            codes = np.rint(127 * (rows / np.abs(rows).max(axis=1, keepdims=True))).astype(np.int8)
            columns = [batch.column("node"), pa.array([c.tobytes() for c in codes], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["node", "code"])

    own = ball.filter("node = leader").select("node")
    code = nodes.join(own, "node").select("node", "v").mapInArrow(encode, "node long, code binary")
    joined = code.join(radius, F.col("node") == F.col("leader"), "left")
    return materialise(joined.select("node", "code", F.coalesce("radius", F.lit(0.0)).alias("radius")), "points")


def near_pairs(rows: DataFrame, dims: int, count: int, angle: float) -> DataFrame:
    """``node, nbr, cos, near``: the pairs within blocks that may enter a list, at most so many per node and bucket.

    ``rows`` has ``block, node, code, radius, bar, k``: a pair counts for a node if its cosine is above the node's bar.
    """

    def meet(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([("block", "ascending"), ("node", "ascending")])
        block, node = table.column("block").to_numpy(), table.column("node").to_numpy()
        single = np.concatenate(([True], (block[1:] != block[:-1]) | (node[1:] != node[:-1])))
        block, node = block[single], node[single]
        unit = coded(table.column("code").combine_chunks(), dims)[single]
        radius, bar = (table.column(c).to_numpy()[single] for c in ("radius", "bar"))
        k = table.column("k").to_numpy()[single]
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32))]
        for start, end in block_ranges(block):
            cos = unit[start:end] @ unit[start:end].T
            np.fill_diagonal(cos, -2)
            least = bar[start:end].astype(np.float32)
            most = int(k[start:end].max())
            if end - start > most + 1:
                least = np.maximum(least, np.partition(cos, -most, axis=1)[:, -most] - np.float32(1e-6))
            i, j = np.nonzero(cos > least[:, None])
            found.append((start + i, start + j, cos[i, j]))
        i, j, cos = (np.concatenate(x) for x in zip(*found, strict=True))
        _, first = np.unique(np.stack((node[i], node[j])), axis=1, return_index=True) if len(i) else (None, i)
        i, j, cos = i[first], j[first], cos[first]
        order = np.lexsort((-cos, node[i]))
        i, j, cos = i[order], j[order], cos[order]
        heads = np.flatnonzero(np.concatenate(([True], node[i][1:] != node[i][:-1]))) if len(i) else i
        place = np.arange(len(i)) - np.repeat(heads, np.diff(np.append(heads, len(i))))
        best = place < k[i]
        i, j, cos = i[best], j[best], cos[best]
        near = np.arccos(np.clip(cos, -1, 1)) <= angle + radius[i] + radius[j] + CODE_ERROR
        return pa.table({"node": node[i], "nbr": node[j], "cos": cos.astype(float), "near": near})

    return bucketed(rows, count).groupBy("bucket").applyInArrow(meet, "node long, nbr long, cos double, near boolean")


def merged(lists: DataFrame | None, found: DataFrame, size: int) -> DataFrame:
    """Best entries of every node; a list full of possible links doubles for the next round."""
    found = found.withColumn("k", F.lit(None).cast("int"))
    rows = found if lists is None else lists.unionByName(found)
    one = rows.groupBy("node", "nbr").agg(F.max("cos").alias("cos"), F.max("near").alias("near"), F.max("k").alias("k"))
    own = Window.partitionBy("node")
    place = F.row_number().over(own.orderBy(F.desc("cos"), "nbr"))
    kept = one.withColumn("k", F.coalesce(F.max("k").over(own), F.lit(size))).withColumn("place", place)
    kept = kept.filter(F.col("place") <= F.col("k"))
    full = F.count_if("near").over(own) >= F.col("k")
    return kept.select("node", "nbr", "cos", "near", F.when(full, 2 * F.col("k")).otherwise(F.col("k")).alias("k"))


def descended(points: DataFrame, dims: int, count: int, angle: float, size: int, seed: int) -> DataFrame:
    """Written neighbour lists ``node, nbr, cos, near, k`` of all points."""
    begin = in_cells(points, "code", dims, count, TREES, LEAF, seed)
    begin = begin.withColumns({"bar": F.lit(-1.0), "k": F.lit(size)})
    lists = materialise(merged(None, near_pairs(begin, dims, count * TREES, angle), size), "lists")
    for turn in range(MAX_ROUNDS):
        before = lists.select("node", "nbr", F.col("k").alias("old"))
        state = lists.groupBy("node").agg(F.min("cos").alias("bar"), F.max("k").alias("k"), F.count("*").alias("held"))
        state = state.select("node", "k", F.when(F.col("held") < F.col("k"), -1.0).otherwise(F.col("bar")).alias("bar"))
        around = (
            lists.select(F.col("node").alias("centre"), F.col("nbr").alias("node"))
            .unionByName(lists.select(F.col("nbr").alias("centre"), "node"))
            .unionByName(points.select(F.col("node").alias("centre"), "node"))
            .distinct()
        )
        crowds = around.groupBy("centre").agg(F.count("*").alias("size")).filter(F.col("size") > 2 * AROUND)
        piece = F.pmod(
            F.xxhash64("node", "centre", F.lit(seed + turn)), F.ceil(F.coalesce(F.col("size"), F.lit(1)) / AROUND)
        )
        blocks = around.join(crowds, "centre", "left").select("node", F.xxhash64("centre", piece).alias("block"))
        known = points.join(state, "node", "left").select(
            "node", "code", "radius", F.coalesce("bar", F.lit(-1.0)).alias("bar"), F.coalesce("k", F.lit(size)).alias("k")
        )
        found = near_pairs(blocks.join(known, "node"), dims, count * (2 * size + 1), angle)
        lists = materialise(merged(lists, found, size), "lists")
        new = lists.join(before, ["node", "nbr"], "left")
        changed, saturated = new.agg(F.count_if(F.col("old").isNull()), F.count_if(F.col("old") < F.col("k"))).first()
        logger.info("round %d: %d new entries", turn + 1, changed)
        if changed <= SETTLED * size * count and not saturated:
            break
    return lists


def exact_links(
    nodes: DataFrame, ball: DataFrame, lists: DataFrame, dims: int, threshold: float
) -> tuple[DataFrame, DataFrame]:
    """(written ``node, links`` to members of other balls, ``a, b`` of the balls that have a link)."""
    chunk = max(1, CHUNK_BYTES // (8 * dims))
    sizes = ball.groupBy("leader").agg(F.count("*").alias("size")).filter(F.col("size") > 2 * chunk)
    piece = F.pmod(F.xxhash64("node"), F.ceil(F.coalesce(F.col("size"), F.lit(1)) / chunk))
    pairs = lists.filter("near").select(F.least("node", "nbr").alias("a"), F.greatest("node", "nbr").alias("b")).distinct()
    pairs = materialise(pairs, "pairs")
    used = pairs.select(F.col("a").alias("leader")).union(pairs.select(F.col("b").alias("leader"))).distinct()
    chunks = (
        ball.join(used, "leader", "left_semi")
        .join(sizes, "leader", "left")
        .join(nodes, "node")
        .groupBy("leader", piece.alias("piece"))
        .agg(F.collect_list(F.struct("node", "copies", "v")).alias("members"))
        .drop("piece")
    )
    chunks = materialise(chunks, "chunks")
    one, other = chunks.toDF("a", "one"), chunks.toDF("b", "other")

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for name in ("one", "other"):
                lists, flat = batch.column(name), batch.column(name).flatten()
                offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
                v = units(matrix(flat.field("v"), dims))
                sides.append((offsets, flat.field("node").to_numpy(), flat.field("copies").to_numpy(), v))
            (at, node, copies, v), (to, others, more, w) = sides
            a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
            out = []
            for k in range(batch.num_rows):
                x, y = slice(at[k], at[k + 1]), slice(to[k], to[k + 1])
                linked = v[x] @ w[y].T >= threshold
                for who, n in ((node[x], linked @ more[y]), (others[y], copies[x] @ linked)):
                    hit = np.flatnonzero(n)
                    if len(hit):
                        out.append((who[hit], n[hit], np.full(len(hit), a[k]), np.full(len(hit), b[k])))
            if out:
                columns = [pa.array(np.concatenate(x), pa.int64()) for x in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["node", "links", "a", "b"])

    met = pairs.join(one, "a").join(other, "b").select("a", "b", "one", "other")
    spark = nodes.sparkSession
    rows = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "256")
    try:
        linked = materialise(met.mapInArrow(decide, "node long, links long, a long, b long"), "linked")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return linked.groupBy("node").agg(F.sum("links").alias("links")), linked.select("a", "b").distinct()


def audited(nodes: DataFrame, counts: DataFrame, dims: int, threshold: float, sample: int) -> float:
    """Share of the links of a bounded sample of nodes that was found, by brute force over all nodes."""
    picked = nodes.orderBy(F.xxhash64("node", F.lit(11)), "node").limit(sample).select("node", "v").toArrow()
    ids, probes = picked.column("node").to_numpy(), matrix(picked.column("v").combine_chunks(), dims)
    if not len(ids):
        return 1.0
    probes = units(probes)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = units(matrix(batch.column("v"), dims)) @ probes.T >= threshold
            n = batch.column("copies").to_numpy() @ linked
            hit = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(ids[hit]), pa.array(n[hit], pa.int64())], ["node", "n"])

    there = nodes.select("v", "copies").mapInArrow(compare, "node long, n long").groupBy("node").agg(F.sum("n").alias("n"))
    there = there.join(counts, "node").agg(F.sum(F.col("n") - 1), F.sum("n_links")).first()
    return 1.0 if not there[0] else there[1] / there[0]


def near_duplicates(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    threshold: float = THRESHOLD,
    size: int = NEIGHBOURS,
    sample: int = AUDIT,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vectors``."""
    ship_package(vectors.sparkSession)
    angle = math.acos(threshold)
    half = math.cos(angle / 2 - 1e-6)
    wide = F.col(embedding).cast("array<double>")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.when(usable(F.col(embedding)), wide).alias("v"))
    dims = rows.agg(F.max(F.size("v"))).first()[0] or 0
    alone = rows.filter("v IS NULL").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
    )
    if dims <= 0:
        return alone
    padded = F.concat("v", F.array_repeat(F.lit(0.0), F.lit(dims) - F.size("v")))
    rows = rows.filter("v IS NOT NULL").withColumn("v", padded)
    grouped = rows.groupBy("v").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    nodes = materialise(grouped.select(F.monotonically_increasing_id().alias("node"), "v", "copies", "least"), "nodes")
    ball = balls(nodes, dims, half)
    points = with_radius(nodes, ball, dims)
    count = points.count()
    in_ball = ball.join(nodes.select("node", "copies"), "node").groupBy("leader").agg(F.sum("copies").alias("all"))
    for attempt in range(ATTEMPTS):
        lists = descended(points, dims, count, angle, size << attempt, 100 * (attempt + 1))
        across, edges = exact_links(nodes.select("node", "copies", "v"), ball, lists, dims, threshold)
        n_links = F.col("all") - 1 + F.coalesce("links", F.lit(0))
        counts = ball.join(in_ball, "leader").join(across, "node", "left").select("node", "leader", n_links.alias("n_links"))
        counts = materialise(counts, "counts")
        recall = audited(nodes.select("node", "v", "copies"), counts, dims, threshold, sample)
        logger.info("recall of the audit: %.4f", recall)
        if recall >= RECALL:
            break
    of_leader = components(edges).toDF("leader", "component")
    placed = counts.join(of_leader, "leader", "left").withColumn("component", F.coalesce("component", "leader"))
    placed = placed.join(nodes.select("node", "v", "least"), "node")
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    known = placed.join(least, "component").select("v", "n_links", "component_id")
    linked = rows.join(known, "v").select(
        "vec_id",
        "n_links",
        F.when(F.col("vec_id").isNotNull(), F.col("component_id")).alias("component_id"),
        F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )
    return linked.unionByName(alone)
