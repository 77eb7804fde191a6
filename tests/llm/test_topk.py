import re
import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fareloom.llm import topk


def brute_force(rows, k):
    """rows: (id, integer vector). Queries are ids divisible by 5."""
    queries = {}
    for i, v in rows:
        if i % 5 == 0:
            queries[i] = min(v, queries.get(i, v))
    out = []
    for q, v in queries.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q)
        out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def found(spark, rows, k=5):
    vectors = spark.createDataFrame(rows, "vec_id long, v array<long>").repartition(3)
    return sorted(map(tuple, topk.top_k(vectors.filter("vec_id % 5 = 0"), vectors, k).collect()))


@pytest.mark.parametrize("spread", [3, 100])
def test_equals_brute_force_with_ties(spark, spread, monkeypatch):
    """A small spread makes many ties; a third of all vectors are one and the same."""
    for name, value in (("PIVOTS", 4), ("SEEDS", 12), ("CHUNK_ROWS", 64), ("BLOCK_QUERIES", 16), ("BATCH", 8)):
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(spread)
    rows = [(i, rng.integers(-spread, spread + 1, 6).tolist() if i % 3 else [1] * 6) for i in range(300)]
    assert found(spark, rows) == brute_force(rows, 5)


def test_awkward_vectors(spark):
    rows = [(0, [1, 2]), (5, [1]), (5, [0, 9]), (6, []), (7, [2, 1, 4]), (7, [2, 1, 4]), (8, [-(2**40), 2**40])]
    assert found(spark, rows) == brute_force(rows, 5)
    assert found(spark, []) == [] and found(spark, [(0, [1])]) == [] and found(spark, [(1, [1])]) == []


def test_scaling_and_usable(spark):
    data = [(1, [0.5, -0.001]), (2, None), (3, [None]), (4, [float("nan")]), (5, [float("-inf")]), (6, [])]
    df = spark.createDataFrame(data, "i int, e array<float>")
    kept = df.filter(topk.usable(F.col("e"))).select("i", topk.scaled(F.col("e"))).collect()
    assert [(r[0], r[1]) for r in kept] == [(1, [128, -1]), (6, [])]


def test_no_key_of_the_join_holds_all_chunks(spark, monkeypatch):
    """One block of queries, nothing broadcast: chunks are joined by (block, group), over several tasks."""
    for name, value in (("SEEDS", 8), ("CHUNK_ROWS", 16), ("GROUP_CHUNKS", 4), ("PIVOTS", 4)):
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(2)
    rows = [(i, rng.integers(-9, 10, 5).tolist()) for i in range(1000)]
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        vectors = spark.createDataFrame(rows, "vec_id long, v array<long>")
        answer = topk.top_k(vectors.filter("vec_id % 5 = 0 AND vec_id < 100"), vectors, 5)
        plan = answer._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"SortMergeJoin \[number#\d+L?, group#\d+L?\]", plan)
        assert sorted(map(tuple, answer.collect())) == brute_force_of(rows, range(0, 100, 5))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def brute_force_of(rows, queries, k=5):
    return [row for row in brute_force(rows, k) if row[0] in queries]


def packed(ids, vectors, pivots, step, cell=None):
    """A block (step 1) or chunk as tasks see it."""
    rows = pa.table({"vec_id": pa.array(ids, pa.int64()), "v": pa.array(vectors.tolist(), pa.list_(pa.int64()))})
    batch = pa.RecordBatch.from_pydict({f"x_{c}": v for c, v in topk.pack(rows, pivots, step, cell).items()})
    return topk.unpack(batch, 0, "x", len(pivots))


def calls_in(run):
    """Functions called from Python while ``run`` runs."""
    calls = []
    sys.setprofile(lambda frame, event, arg: calls.append(event) if event in ("call", "c_call") else None)
    try:
        run()
    finally:
        sys.setprofile(None)
    return len(calls)


def test_steps_follow_tiles_not_pairs():
    """A chunk meets a block in a few matrix products, whether the block holds 8 queries or 512."""
    rng = np.random.default_rng(5)
    v = rng.integers(-99, 100, (2048, 16))
    chunk = packed(range(2048), v, v[:4], 512, 0)
    calls = []
    for n in (8, 512):
        block, best = packed(range(n), v[:n], v[:4], 1), topk.Best(np.arange(n), 5)
        calls.append(calls_in(lambda: topk.search(block, chunk, best, 512)))
        exact = v[:n] @ v.T
        for q in range(n):
            order = [i for i in np.lexsort((np.arange(2048), -exact[q])) if i != q][:5]
            assert best.ids[best.rows == q].tolist() == order
            assert best.scores[best.rows == q].tolist() == exact[q, order].tolist()
    assert calls[1] < 1.5 * calls[0] < 1500


def test_tiles_far_from_all_queries_are_skipped(monkeypatch):
    """Queries of one cluster don't meet the tiles of the other."""
    rng = np.random.default_rng(6)
    centres = np.repeat([[900] * 4 + [0] * 4, [0] * 4 + [900] * 4], 512, axis=0)
    v = centres + rng.integers(-9, 10, (1024, 8))
    block, best = packed(range(64), v[:64], v[[0, 600]], 1), topk.Best(np.arange(64), 5)
    met, reaching = [], topk.reaching
    monkeypatch.setattr(topk, "reaching", lambda q, x, least: met.append(len(q) * len(x)) or reaching(q, x, least))
    topk.search(block, packed(range(1024), v, v[[0, 600]], 128, 0), best, 128)
    exact = v[:64] @ v.T
    np.fill_diagonal(exact, -(10**9))
    assert best.scores.tolist() == (-np.sort(-exact, axis=1)[:, :5]).ravel().tolist()
    assert sum(met) <= 64 * 512


@pytest.mark.parametrize("base", [2**8, 2**13, 2**20, 2**28])
def test_exact_where_floats_round(spark, base, monkeypatch):
    """Scores that differ by a few units, up to 2**58: beyond single, then double precision."""
    for name, value in (("SEEDS", 12), ("PIVOTS", 4), ("TILE_ROWS", 16), ("BLOCK_QUERIES", 8), ("HELD_QUERIES", 1)):
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(base)
    rows = [(i, (rng.choice([-1, 1]) * (base + rng.integers(0, 3, 6))).tolist()) for i in range(150)]
    assert found(spark, rows) == brute_force(rows, 5)


def test_clipped_scores_tie(spark):
    most, least = 2**63 - 1, -(2**63)
    rows = [(0, [2**40]), (1, [2**40]), (2, [2**41]), (3, [-(2**41)]), (4, [-(2**42)]), (6, [2**40 - 1])]
    assert found(spark, rows, 3) == [(0, 1, 1, most), (0, 2, 2, most), (0, 3, 6, most)]
    assert found(spark, rows, 5)[3:] == [(0, 4, 3, least), (0, 5, 4, least)]
