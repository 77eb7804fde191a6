"""Near-duplicate vectors against brute force."""

import numpy as np
import pytest

from fareloom.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, node long, v double, leader string, cell int, label int"


@pytest.fixture
def make_vectors(spark):
    def build(rows, parts=3):
        full = [(k, None if v is None else [None if x is None else float(x) for x in v], 1, 2.0, "x", 3, 4) for k, v in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(parts)

    return build


def by_brute_force(rows, threshold=0.95):
    """{row number: (links, component)} with rows compared in double precision."""
    width = max(len(v) for _, v in rows)
    v = np.array([np.pad(np.asarray(v, np.float32), (0, width - len(v))) for _, v in rows], float)
    v /= np.linalg.norm(v, axis=1)[:, None]
    linked = v @ v.T >= threshold
    component = np.array([k for k, _ in rows])
    while True:
        new = np.array([component[row].min() for row in linked])
        if (new == component).all():
            return linked.sum(axis=1) - 1, component
        component = new


def clusters(seed, dims=16):
    rng = np.random.default_rng(seed)
    out = [rng.standard_normal(dims) for _ in range(300)]
    for size, noise in ((2, 0.02), (40, 0.02), (90, 0.05), (30, 0.08), (5, 0.3)):
        centre = rng.standard_normal(dims)
        out += [centre + noise * rng.standard_normal(dims) for _ in range(size)]
    out += [out[3]] * 60 + [3 * out[4]] * 5
    return [(k, v) for k, v in enumerate(out)]


@pytest.mark.parametrize("blocks", ["production", "small"])
def test_links_and_components_equal_brute_force(make_vectors, monkeypatch, blocks):
    if blocks == "small":  # more blocks, balls, pieces and chunks than so few rows would make
        for name, value in (("LEAF", 16), ("BALL_BLOCK", 16), ("AROUND", 12), ("BUCKET_ROWS", 100), ("CHUNK_BYTES", 512)):
            monkeypatch.setattr(neighbours, name, value)
    rows = clusters(5)
    found = {r.vec_id: r for r in neighbours.near_duplicates(make_vectors(rows)).collect()}
    links, component = by_brute_force(rows)
    assert len(found) == len(rows)
    assert all(found[k].n_links <= links[k] for k, _ in rows)
    assert sum(r.n_links for r in found.values()) >= 0.97 * links.sum()
    right = sum(found[k].component_id == component[k] for k, _ in rows)
    assert right >= 0.97 * len(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())


def test_awkward_rows(make_vectors):
    nan, inf = float("nan"), float("inf")
    one = [1.0, 0.0, 0.0]
    rows = [(1, None), (2, []), (3, [0, 0, 0]), (4, [1, None, 0]), (5, [nan, 1, 0]), (6, [inf, 0, 0])]
    rows += [(10, one), (9, [2.0, 0.0]), (11, [0, 1, 0]), (11, [0, 0, 1]), (12, one), (12, one), (None, one), (13, [1e-30, 0, 0])]
    found = neighbours.near_duplicates(make_vectors(rows))
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    got = sorted(map(tuple, found.collect()), key=str)
    wanted = [(k, 0, k, True) for k in (1, 2, 3, 4, 5, 6, 11, 11)]
    wanted += [(k, 5, 9, k == 9) for k in (9, 10, 12, 12, 13)] + [(None, 5, None, True)]
    assert got == sorted(wanted, key=str)


def test_empty_table(make_vectors):
    assert neighbours.near_duplicates(make_vectors([(1, [1.0])]).limit(0)).collect() == []
