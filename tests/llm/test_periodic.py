"""Runs of repeated words against their definition."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from fareloom.llm import periodic, queries


def by_definition(words, min_words=6, min_periods=4):
    """(start, length, period) of every run."""
    stretches = []
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            stretches.append((i, j + q - i, q))
            i = j
    runs = {}
    for start, length, q in stretches:  # periods rise: the first of a stretch is its smallest
        if length >= 2 * q:
            runs.setdefault((start, length), q)
    return sorted((s, n, q) for (s, n), q in runs.items() if n >= max(min_words, min_periods * q))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def planted(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def answer(doc_id, text):
    words = planted(doc_id, text)
    runs = by_definition(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None, None, None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (
        doc_id,
        len(runs),
        *best,
        1000 * best[1] // best[2] if runs else None,
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(collapsed(words, runs).encode()).hexdigest(),
    )


@pytest.mark.parametrize("min_periods", [2, 3, 4])
def test_runs_of_random_words_equal_the_definition(min_periods):
    rng = random.Random(min_periods)
    for _ in range(300):
        texts = []
        for _ in range(rng.randrange(1, 5)):
            text = [rng.randrange(rng.choice([1, 2, 3, 9])) for _ in range(rng.randrange(0, 40))]
            if text and rng.random() < 0.5:
                text = (text[: rng.randrange(1, 7)] * rng.randrange(2, 9) + text)[:70]
            texts.append(text)
        offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        flat = np.array([w for t in texts for w in t], np.int64)
        found = list(zip(*(x.tolist() for x in periodic.runs_of_texts(offsets, flat, 4, min_periods)), strict=True))
        wanted = [(k, *run) for k, t in enumerate(texts) for run in by_definition(t, 4, min_periods)]
        assert found == wanted


def test_long_chains_take_the_walk_with_a_stack():
    words = [1, 2, 1] * 3000 + list(range(5, 100)) + [7] * 5000
    found = periodic.runs_of_texts(np.array([0, len(words)]), np.array(words), 6, 4)
    assert [x.tolist() for x in found] == [[0, 0], [0, 9095], [9000, 5000], [3, 1]]


def test_million_equal_words_end_soon():
    found = periodic.runs_of_texts(np.array([0, 300_000]), np.zeros(300_000, np.int64), 6, 4)
    assert [x.tolist() for x in found] == [[0], [0], [300_000], [1]]


def test_detect(make_docs, awkward, prose):
    echo = "so be it " * 5
    rows = [*awkward, (20, echo), (21, "a b\x0bc d " + "go " * 7 + "x"), (22, "É " * 9), (22, "É " * 9)]
    found = periodic.detect(make_docs(rows)).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    for doc_id, text, *_ in rows:
        words = [w.decode() for w in (text or "").encode().split()]
        runs = [tuple(r) for r in by_id[doc_id].runs]
        assert runs == (by_definition(words) if len(words) < 1000 else [])
        assert by_id[doc_id].n_words == len(words)
        assert by_id[doc_id].collapsed == collapsed(words, runs)
        assert by_id[doc_id].dropped_words == len(words) - len(by_id[doc_id].collapsed.split(" ")) * bool(words)
    assert by_id[20].collapsed == "so be it" and by_id[22].collapsed == "É"


def test_empty_table(make_docs):
    assert periodic.detect(make_docs([(1, "a")]).limit(0)).collect() == []


def test_query_equals_the_definition(spark, tmp_path, make_docs, prose):
    rng = random.Random(5)
    rows = [(k, prose(k, rng.randrange(0, 60), 6) if k % 7 else "la la land " * (k % 11)) for k in range(150)]
    rows += [(None, "no id " * 9), (151, None), (151, None), (152, "\t\x0b "), (153, "x" + " ü" * 40)]
    make_docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op13_periodic_runs(spark, str(tmp_path))
    assert found.columns == "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    wanted = [answer(doc_id, text) for doc_id, text in rows]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, wanted))
    assert sum(zlib.crc32(str(k).encode()) % 10 == 0 for k, _ in rows) > 5
