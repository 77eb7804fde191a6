"""Collocations against plain counting, and the trie against a set of sequences."""

import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from fareloom.llm import collocations, doublearray

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_counting(rows, least, longest=4, covered=80):
    f = {}
    for text, lang in rows:
        count = f.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(ASCII_LOWER)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            for size in range(1, longest + 1):
                count.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, count in f.items():
        n = sum(c for p, c in count.items() if len(p) == 1)
        often = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        for p, a in often.items():
            cuts = [(2_000_000 * a // (count[p[:k]] + count[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            covers = [
                b for q, b in often.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))
            ]
            if not any(100 * b >= covered * a for b in covers):
                out.append((lang, " ".join(p), len(p), a, count[p[:k]], count[p[k:]], n, k, score))
    return sorted(out)


def texts(prose):
    rows = [(prose(k, 120, 12), "en" if k % 3 else "fr") for k in range(40)]
    rows += [("New York, New York! new\x0byork new\tyork  city", None)] * 9
    rows += [(None, "en"), ("", "en"), (" .,;: ", "de"), ("É ñ 中文 \x85 É ñ 中文 x y", "de"), ("É Ñ" * 30, "de")]
    return rows + [(prose(7, 3000, 12), "en"), ("same words again and again " * 20, "und"), ("word" * 500 + " a b", "xx")]


@pytest.mark.parametrize("shard", [1 << 18, 7])
def test_phrases_equal_plain_counting(make_docs, prose, monkeypatch, shard):
    monkeypatch.setattr(collocations, "TRIE_PHRASES", shard)
    monkeypatch.setattr(collocations, "MERGE_ROWS", 50)
    rows = texts(prose)
    least = 5 if shard > 7 else 25
    docs = make_docs([(k, text, "s", lang) for k, (text, lang) in enumerate(rows)])
    found = collocations.mine(docs, least)
    got = found.select("lang", "phrase", "size", "a", "l", "r", "n", "cut", "score").collect()
    assert sorted(map(tuple, got)) == by_counting(rows, least)


def test_ranks(make_docs, prose):
    rows = texts(prose)
    docs = make_docs([(k, text, "s", lang) for k, (text, lang) in enumerate(rows)])
    got = collocations.strongest(collocations.mine(docs, 8), 10).collect()
    wanted = {}
    for row in by_counting(rows, 8):
        wanted.setdefault(row[0], []).append((-row[8], -row[3], row[1].encode()))
    for lang, ranked in wanted.items():
        own = sorted((r.rank, r.phrase.encode()) for r in got if r.lang == lang)
        assert own == [(k + 1, x[2]) for k, x in enumerate(sorted(ranked)[:10])]


def test_scores_stay_exact_beyond_64_bits(spark):
    a, l, r = 9_100_000_000_000_000, 9_200_000_000_000_001, 9_300_000_000_000_003
    wide = spark.sql(f"SELECT (CAST({a} AS decimal(20,0)) * CAST(2000000 AS decimal(7,0))) div "
                     f"(CAST({l} AS decimal(20,0)) + CAST({r} AS decimal(20,0))) AS s").first().s
    assert wide == Fraction(2_000_000 * a, l + r).__floor__()


def test_equal_hashes_take_the_next_seed(make_docs, prose, monkeypatch):
    true_hash, seen = collocations.hash_spans, []

    def poor(data, bounds, seed):
        seen.append(seed)
        return true_hash(data, bounds, seed) & np.uint64(3 if seed == 0 else 2**64 - 1)

    # Tasks hash in workers of their own: the counts are made here.
    rows = [(k, prose(k, 50, 20)) for k in range(5)]

    def counted(docs, seed):
        words = Counter(w for _, text in rows for w in text.split())
        made = []
        for w, n in words.items():
            data = np.frombuffer(w.encode(), np.uint8)
            made.append((int(poor(data, np.array([0, len(data)]), seed).view(np.int64)[0]), "en", w, n))
        return docs.sparkSession.createDataFrame(made, "id long, lang string, word string, n long")

    monkeypatch.setattr(collocations, "word_counts", counted)
    _, seed = collocations.all_words(make_docs(rows))
    assert seed == 1 and set(seen) == {0, 1}


def test_empty_table(make_docs):
    assert collocations.mine(make_docs([(1, "a")]).limit(0)).collect() == []


@pytest.mark.parametrize("length", [1, 2, 3])
def test_trie_finds_its_sequences_only(length):
    rng = np.random.default_rng(length)
    ids = rng.integers(-(2**63), 2**63, 400)
    text = ids[np.minimum(rng.geometric(0.02, 5000) - 1, 399)]
    rows = np.unique(np.stack([text[k : k + length] for k in range(0, 3000, 2)]), axis=0)
    trie = doublearray.build(rows)
    piece = np.cumsum(rng.random(len(text)) < 0.1)
    at, state = trie.walk(trie.codes(text), piece, length)
    known = {tuple(r): k for k, r in enumerate(rows.tolist())}
    wanted = {
        k: known[tuple(text[k : k + length].tolist())]
        for k in range(len(text) - length + 1)
        if tuple(text[k : k + length].tolist()) in known and piece[k] == piece[k + length - 1]
    }
    assert dict(zip(at.tolist(), trie.leaf[state].tolist(), strict=True)) == wanted
    assert (trie.codes(np.array([5, 6, 7])) == -1).all()
