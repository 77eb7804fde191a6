import random
import re

import pytest

from fareloom.llm import jaccard
from fareloom.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingle_set(text, width):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def brute_force(rows, width, percent):
    """(doc_id, set size, class) per row, by comparing all pairs."""
    sets = [shingle_set(row[1], width) for row in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    named = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            named[root(i)] = min(named.get(root(i), row[0]), row[0])
    wanted = [(row[0], len(s), named.get(root(i)) if s else row[0]) for i, (row, s) in enumerate(zip(rows, sets))]
    return sorted(wanted, key=str)


def found(docs, width, percent):
    return sorted(map(tuple, jaccard.classes(docs, width, percent).collect()), key=str)


def near_copies(prose, seed=3):
    """Groups of copies with one to nine changed words, a passage that half of all texts share, exact copies."""
    rng, rows = random.Random(seed), []
    passage = prose(1, 40)
    for group in range(12):
        base = prose(100 + group, 60 + 20 * group).split()
        for _ in range(30 if group == 5 else rng.randrange(1, 7)):
            words = list(base)
            for _ in range(rng.randrange(0, 9)):
                words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
            text = " ".join(words)
            rows.append((len(rows), text if group % 2 else passage + "\n" + text))
            if rng.random() < 0.2:
                rows.append((len(rows), rows[-1][1].upper()))
    return rows


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (5, 80)])
def test_classes_equal_all_pairs(make_docs, prose, width, percent):
    rows = near_copies(prose)
    assert found(make_docs(rows), width, percent) == brute_force(rows, width, percent)


def test_awkward_rows(make_docs, awkward):
    assert found(make_docs(awkward), 4, 85) == brute_force(awkward, 4, 85)
    assert found(make_docs([]), 4, 85) == []


def links_by_brute_force(rows, width, percent):
    """(doc_id, number of linked rows) per row, by comparing all pairs."""
    sets = [shingle_set(row[1], width) for row in rows]
    n = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                n[i] += 1
                n[j] += 1
    return sorted(((row[0], k) for row, k in zip(rows, n)), key=str)


def links_found(docs, width, percent):
    got = jaccard.classes(docs, width, percent, links=True)
    return sorted(((r.doc_id, r.n_links) for r in got.collect()), key=str)


@pytest.mark.parametrize(("width", "percent", "block", "dense"), [(4, 85, 512, 16), (5, 80, 4, 10**9), (4, 70, 4, 2)])
def test_links_equal_all_pairs(make_docs, prose, monkeypatch, width, percent, block, dense):
    """Also a chain of copies of copies, whose ends don't link, and rows that repeat an id and a text."""
    monkeypatch.setattr(jaccard, "BLOCK_NODES", block)
    monkeypatch.setattr(jaccard, "DENSE", dense)
    rows, rng, words = near_copies(prose, 8), random.Random(8), prose(900, 160).split()
    for _ in range(25):
        words[rng.randrange(len(words))] = f"c{rng.randrange(10**6)}"
        rows.append((len(rows), " ".join(words)))
    rows += [rows[-1], rows[-1], rows[3]]
    wanted = links_by_brute_force(rows, width, percent)
    assert len({n for _, n in wanted}) > 5
    assert links_found(make_docs(rows), width, percent) == wanted


def test_links_of_awkward_rows(make_docs, awkward):
    assert links_found(make_docs(awkward), 4, 85) == links_by_brute_force(awkward, 4, 85)


def test_thresholds_are_exact(make_docs):
    """85 of 100 shingles shared link, 84 of 99 do not."""
    words = [f"a{i}" for i in range(103)]
    linked, apart = words[:88], words[:87]
    rows = [(1, " ".join(words)), (2, " ".join(linked))]
    assert found(make_docs(rows), 4, 85) == [(1, 100, 1), (2, 85, 1)]
    rows = [(1, " ".join(words)), (2, " ".join(apart))]
    assert found(make_docs(rows), 4, 85) == [(1, 100, 1), (2, 84, 2)]


def test_the_order_of_tokens_changes_no_class(make_docs, prose, monkeypatch):
    rows = near_copies(prose, 4)
    wanted = brute_force(rows, 4, 85)
    for heavy_least, long_list in ((1, 2), (10**9, 10**9)):
        monkeypatch.setattr(jaccard, "HEAVY_LEAST", heavy_least)
        monkeypatch.setattr(jaccard.hub_pairs, "__defaults__", (long_list,))
        assert found(make_docs(rows), 4, 85) == wanted


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5000, 4999), (4999, 5000)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**dict.fromkeys(range(201), 0), **dict.fromkeys(range(1000, 1050), 1000), 4999: 4999, 5000: 4999}
