"""Exact top-k by inner product: tiles of pairs by matrix product, and pivot-table elimination of whole tiles.

Vectors are integers. Every vector's distance to a fixed number of pivots is computed once. For a query q, a vector x and
any pivot p, ``|d(q, p) - d(x, p)|`` is a lower bound of their distance, so with both lengths known it bounds the inner
product from above; the best bound is the one of the pivot that separates them most. A tile of neighbouring vectors shares
one bound a query, by the range of its distances to each pivot; queries whose k-th best score is above it skip the tile.
The others meet it in one matrix product, and only pairs that reach the k-th best score so far are ranked: exact, ties
included. The product is taken in single or double precision where the lengths show that every partial sum is exact; with
larger integers it is an estimate of known error, and the pairs it leaves are computed with Python's integers.

Cost: all pairs of queries and vectors, less the tiles skipped, so with the product of both counts at the worst. Vectors
without clusters skip no tile.

Layout: vectors are packed into chunks by nearest pivot and a hash slice, ordered by their distance to that pivot and cut
into tiles; queries go into blocks by hash, and each chunk meets each block once. A popular pivot is cut into as many slices
as its size asks for. Chunks are dealt into groups of about ``GROUP_CHUNKS``, and a block is sent to each group: the key of
the join is (block, group), so no key holds more than a group of chunks, however few the blocks are. Scores of a fixed, small
set of seed vectors give each query a first threshold, so that a chunk returns only what can still be in the answer.

Defined cases: vectors that are null or hold a null or non-finite component, and rows without id, take no part;
shorter vectors count as padded with zeros; a query's own rows are those with its id; a query given twice is answered
once, with its smallest vector; repeated candidates count each; fewer than k candidates give fewer rows; further columns
are ignored; an empty table gives no rows. Scores beyond 64 bits are clipped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.session import materialise, ship_package

PIVOTS = 16
SEEDS = 256
CHUNK_ROWS = 2048
BLOCK_QUERIES = 512
GROUP_CHUNKS = 32
BATCH = 64  # pairs computed with Python's integers at a time
TILE_ROWS = 512
HELD_QUERIES = 1 << 16  # queries whose best a task holds before it returns them
EXACT_PRODUCTS = ((np.float32, 2.0**23), (np.float64, 2.0**52))  # exact integers, with room for rounding
EXACT_COMPONENT = 1 << 20  # products of smaller components stay exact in doubles for up to 8192 dimensions
PACK = "ids binary, vectors binary, dims int, distances binary"


def scaled(vector: Column, factor: float = 256.0) -> Column:
    """floor(factor * x) of every component, as longs."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * factor))


def usable(vector: Column) -> Column:
    """No null and no non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~bad


def padded(vectors: list[np.ndarray], dims: int | None = None) -> np.ndarray:
    """Rows of one width, filled with zeros."""
    width = max([1, *map(len, vectors)]) if dims is None else dims
    out = np.zeros((len(vectors), width), np.int64)
    for k, v in enumerate(vectors):
        out[k, : len(v)] = v
    return out


def widened(m: np.ndarray, dims: int) -> np.ndarray:
    return m if m.shape[1] == dims else np.pad(m, ((0, 0), (0, dims - m.shape[1])))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of one width from a column of lists, filled with zeros."""
    if column.null_count:
        raise ValueError("null vectors take no part: filter them first")
    counts = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(counts), max(1, int(counts.max(initial=0)))), np.int64)
    out[np.arange(out.shape[1]) < counts[:, None]] = column.flatten().to_numpy(zero_copy_only=True)
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two matrices."""
    dims = max(a.shape[1], b.shape[1])
    a, b = widened(a, dims), widened(b, dims)
    largest = max(max(int(m.max(initial=0)), -int(m.min(initial=0))) for m in (a, b))
    if largest < EXACT_COMPONENT and dims <= 8192:
        return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def pair_products(a: np.ndarray, b: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Exact inner products of listed pairs of rows."""
    out = np.zeros(len(rows), np.int64)
    for start in range(0, len(rows), BATCH):
        part = slice(start, start + BATCH)
        exact = (a[rows[part]].astype(object) * b[cols[part]].astype(object)).sum(axis=1)
        out[part] = np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)
    return out


def squares(m: np.ndarray) -> np.ndarray:
    """Squared lengths of rows."""
    m = m.astype(np.float64)
    return np.einsum("ij,ij->i", m, m)


def distances(m: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Euclidean distances of rows to pivots, from below and from above."""
    dims = max(m.shape[1], pivots.shape[1])
    a, b = widened(m, dims).astype(np.float64), widened(pivots, dims).astype(np.float64)
    both = squares(a)[:, None] + squares(b)[None, :]
    squared, error = both - 2 * a @ b.T, (dims + 8) * 2.0**-51 * both
    return np.sqrt(np.maximum(squared - error, 0)), np.sqrt(np.maximum(squared + error, 0))


def pack(rows: pa.Table, pivots: np.ndarray, step: int, cell: int | None = None) -> dict[str, list]:
    """One packed row; least and greatest distances to pivots of every ``step`` vectors, ordered by that to ``cell``."""
    m, ids = matrix(rows["v"].combine_chunks()), rows["vec_id"].combine_chunks().to_numpy(zero_copy_only=True)
    low, high = distances(m, pivots)
    if cell is not None:
        order = np.argsort(low[:, cell], kind="stable")
        m, ids, low, high = m[order], ids[order], low[order], high[order]
    starts = np.arange(0, len(ids), step)
    ranges = np.stack([np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)], axis=1)
    fits = (t for t in (np.int16, np.int32, np.int64) if np.iinfo(t).min <= m.min() and m.max() <= np.iinfo(t).max)
    return {
        "ids": [ids.tobytes()],
        "vectors": [m.astype(next(fits)).tobytes()],
        "dims": np.array([m.shape[1]], np.int32),
        "distances": [ranges.tobytes()],
    }


def unpack(batch: pa.RecordBatch, row: int, side: str, n_pivots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, vectors, ranges of distances) of a packed chunk or block."""
    ids, vectors, ranges = (batch.column(f"{side}_{c}")[row].as_buffer() for c in ("ids", "vectors", "distances"))
    ids, dims = np.frombuffer(ids, np.int64), batch.column(f"{side}_dims")[row].as_py()
    kind = f"i{vectors.size // (len(ids) * dims)}"
    return (
        ids,
        np.frombuffer(vectors, kind).reshape(len(ids), dims),
        np.frombuffer(ranges, np.float64).reshape(-1, 2, n_pivots),
    )


class Best:
    """The k best of every query of a block: highest score, then smallest id.

    ``least`` and ``last`` are score and id of a query's k-th best known; what comes after them is not in the answer.
    """

    def __init__(self, queries: np.ndarray, k: int):
        self.queries, self.k = queries, k
        self.least = np.full(len(queries), -(2**63))
        self.last = np.full(len(queries), np.iinfo(np.int64).max)
        self.forget()

    def forget(self) -> None:
        """Drop what is held, but not what is known of the k-th best."""
        self.rows = self.ids = self.scores = np.zeros(0, np.int64)

    def add(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Scores of candidates for the queries at ``rows``."""
        least = self.least[rows]
        open_ = (scores > least) | ((scores == least) & (ids <= self.last[rows]))
        open_ &= ids != self.queries[rows]
        if not open_.any():
            return
        touched = np.zeros(len(self.queries), bool)
        touched[rows[open_]] = True
        again = touched[self.rows]
        rows = np.concatenate((rows[open_], self.rows[again]))
        ids = np.concatenate((ids[open_], self.ids[again]))
        scores = np.concatenate((scores[open_], self.scores[again]))
        order = np.lexsort((ids, ~scores, rows))  # ~ reverses the order of all 64-bit integers
        place = np.arange(len(order)) - np.searchsorted(rows[order], rows[order])
        order, place = order[place < self.k], place[place < self.k]
        rows, ids, scores = rows[order], ids[order], scores[order]
        self.rows = np.concatenate((self.rows[~again], rows))
        self.ids = np.concatenate((self.ids[~again], ids))
        self.scores = np.concatenate((self.scores[~again], scores))
        full = place == self.k - 1
        row, score, id_ = rows[full], scores[full], ids[full]
        better = (score > self.least[row]) | ((score == self.least[row]) & (id_ < self.last[row]))
        self.least[row[better]], self.last[row[better]] = score[better], id_[better]


def reaching(q: np.ndarray, x: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of q, row of x, exact score) of all pairs whose score is at least that of the row of q."""
    dims = max(q.shape[1], x.shape[1])
    q, x = widened(q, dims), widened(x, dims)
    q_length, x_length = np.sqrt(squares(q)), np.sqrt(squares(x))
    largest = q_length.max() * x_length.max()  # no partial sum of a product is larger
    for kind, exact in EXACT_PRODUCTS:
        if largest < exact:
            scores = q.astype(kind) @ x.astype(kind).T
            rows, cols = np.divmod(np.flatnonzero(scores >= least.astype(kind)[:, None]), len(x))
            return rows, cols, scores[rows, cols].astype(np.int64)
    error = (dims + 8) * 2.0**-51 * q_length[:, None] * x_length
    most = np.clip(q.astype(np.float64) @ x.astype(np.float64).T + error, -(2.0**63), 2.0**63)
    rows, cols = np.divmod(np.flatnonzero(most >= least[:, None]), len(x))
    scores = pair_products(q, x, rows, cols)
    good = scores >= least[rows]
    return rows[good], cols[good], scores[good]


def search(query: tuple, chunk: tuple, best: Best, tile_rows: int) -> None:
    """Bring ``best`` up to date with one chunk."""
    _, q, q_ranges = query
    ids, x, x_ranges = chunk
    q_norm, x_norm = squares(q), squares(x)
    for tile, (nearest, farthest) in enumerate(x_ranges):
        part = slice(tile * tile_rows, (tile + 1) * tile_rows)
        longest = x_norm[part].max()
        apart = np.maximum(nearest - q_ranges[:, 1], q_ranges[:, 0] - farthest).max(axis=1).clip(0)
        bound = np.minimum((q_norm + longest - apart * apart) / 2, np.sqrt(q_norm * longest))
        bound = np.maximum(bound, -(2.0**63)) + 1e-9 * (q_norm + longest) + 1e-6
        open_ = np.flatnonzero(bound >= best.least)
        if len(open_):
            rows, cols, scores = reaching(q[open_], x[part], best.least[open_])
            best.add(open_[rows], ids[part][cols], scores)


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score`` for tables of ``vec_id long, v array<long>``."""
    spark = candidates.sparkSession
    ship_package(spark)
    keyed = [F.xxhash64("vec_id", "v"), "vec_id"]
    sample = candidates.select("vec_id", "v").orderBy(*keyed).limit(SEEDS).collect()
    sample_ids = np.array([r.vec_id for r in sample], np.int64)
    seeds = padded([np.array(r.v, np.int64) for r in sample])
    pivots = seeds[: min(PIVOTS, len(seeds))] if len(seeds) else np.zeros((1, 1), np.int64)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = distances(matrix(batch.column("v")), pivots)[1].argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell, pa.int32())], ["vec_id", "v", "cell"]
            )

    placed = materialise(
        candidates.select("vec_id", "v").mapInArrow(place, "vec_id long, v array<long>, cell int"), "placed"
    )
    sizes = placed.groupBy("cell").agg(F.ceil(F.count("*") / CHUNK_ROWS).cast("int").alias("slices"))
    per_cell = {r.cell: r.slices for r in sizes.collect()}  # one row per pivot
    slices = F.lit(1)
    for cell, n in per_cell.items():
        slices = F.when(F.col("cell") == cell, F.lit(n)).otherwise(slices)

    tile_rows = TILE_ROWS

    def chunk_of(key: tuple, rows: pa.Table) -> pa.Table:
        return pa.table({**pack(rows, pivots, tile_rows, key[0].as_py()), "group": [key[2].as_py()]})

    def block_of(key: tuple, rows: pa.Table) -> pa.Table:
        return pa.table({**pack(rows, pivots, 1), "number": [key[0].as_py()]})

    groups = max(1, -(-sum(per_cell.values()) // GROUP_CHUNKS))
    chunks = (
        placed.withColumn("slice", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), slices))
        .withColumn("group", F.pmod(F.xxhash64("cell", "slice"), F.lit(groups)))
        .groupBy("cell", "slice", "group")
        .applyInArrow(chunk_of, PACK + ", group long")
    )
    once = materialise(queries.groupBy("vec_id").agg(F.min("v").alias("v")), "queries")
    n_blocks = max(1, -(-once.count() // BLOCK_QUERIES))
    blocks = (
        once.withColumn("number", F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)))
        .groupBy("number")
        .applyInArrow(block_of, PACK + ", number long")
        .withColumn("group", F.explode(F.expr(f"sequence(0L, {groups - 1}L)")))
    )
    # Each chunk meets each block: the stated query set against all rows, block by block.
    meetings = (
        chunks.withColumn("number", F.explode(F.expr(f"sequence(0L, {n_blocks - 1}L)")))
        .alias("c")
        .join(blocks.alias("b"), ["number", "group"])
        .select(
            "number",
            *[F.col(f"c.{c}").alias(f"c_{c}") for c in ("ids", "vectors", "dims", "distances")],
            *[F.col(f"b.{c}").alias(f"b_{c}") for c in ("ids", "vectors", "dims", "distances")],
        )
    )

    def begun(ids: np.ndarray, vectors: np.ndarray) -> Best:
        """Nothing held yet, and the k-th best of the seeds known."""
        best, known = Best(ids, k), products(vectors, seeds)
        least = np.partition(known, -k - 1, axis=1)[:, -k - 1] if len(seeds) > k else np.full(len(ids), -(2**63))
        rows, cols = np.nonzero(known >= least[:, None])
        best.add(rows, sample_ids[cols], known[rows, cols])
        best.forget()
        return best

    def results(held: dict[int, Best]) -> pa.RecordBatch:
        columns = [(b.queries[b.rows], b.ids, b.scores) for b in held.values()] or [[np.zeros(0, np.int64)] * 3]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c)) for c in zip(*columns)], ["query_id", "vec_id", "score"]
        )

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Best] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                query, chunk = (unpack(batch, row, side, len(pivots)) for side in "bc")
                number = batch.column("number")[row].as_py()
                if number not in held:
                    if sum(len(b.queries) for b in held.values()) >= HELD_QUERIES:
                        yield results(held)
                        held.clear()
                    held[number] = begun(query[0], query[1])
                search(query, chunk, held[number], tile_rows)
        yield results(held)

    if not len(seeds):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    found = meetings.mapInArrow(answer, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
