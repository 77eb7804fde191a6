"""Exact token ids of whole texts, encoding each distinct word once per Python worker.

``word_bpe_49k`` drops white space, and none of its steps (special tokens, NFC, lower case, the split pattern, BPE) reads
across it: ids of a text are the ids of its white-space separated words in a row. Invented or natural, words repeat, so
a worker keeps the ids of the words it has met, up to ``CACHE_WORDS``; then it starts anew, which costs time only.

Words of Latin letters, with ASCII signs behind them at most, are two steps of the split pattern that no normalisation
touches but for the case of letters: their parts go to the merge step directly. All other words take every step.
"""

from __future__ import annotations

import json
import os
import re
from pathlib import Path

import numpy as np
import pyarrow as pa

from fareloom.llm import textkit

CACHE_WORDS = 1_000_000
SEPARATOR = "<|startoftext|>"  # a special token: splits its neighbours before any other step

# Letters of Basic Latin, Latin-1 and Latin Extended-A (without the dotted capital I, whose lower case is two characters),
# then signs other than the apostrophe, which may begin a step of its own.
_PLAIN = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+)([!-&(-/:-@\[-`{-~]*)")
# Bytes that the vocabulary writes as other characters, in their order.
_BYTES = {b: chr(256 + k) for k, b in enumerate([*range(33), *range(127, 161), 173])}

_coders: dict[str, WordCoder] = {}


def require_word_vocabulary(path: str) -> None:
    """Raise unless a tokenizer file has the steps that this module relies on."""
    steps = json.loads(Path(path).read_text())
    normal = [step["type"] for step in (steps["normalizer"] or {}).get("normalizers", [])]
    split = [step["type"] for step in (steps["pre_tokenizer"] or {}).get("pretokenizers", [])]
    known = any(token["content"] == SEPARATOR and token["special"] for token in steps["added_tokens"])
    if normal != ["NFC", "Replace", "Lowercase"] or split != ["Split", "ByteLevel"] or not known:
        raise ValueError(f"{path} is no vocabulary of lower-case words without white space")


class WordCoder:
    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        require_word_vocabulary(path)
        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.separator_id = self.tokenizer.token_to_id(SEPARATOR)
        self.cache_words = cache_words
        self._reset()

    def _reset(self) -> None:
        self.index: dict[str, int] = {}
        self.signs: dict[str, list[int]] = {}
        self.offsets = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids per word and all ids in a row."""
        plain = [w for w in words if SEPARATOR not in w]
        if len(plain) != len(words):
            each = [self.tokenizer.encode(w, add_special_tokens=False).ids for w in words]
            return np.array([len(x) for x in each], np.int64), np.array([i for x in each for i in x], np.uint32)
        text = SEPARATOR.join(words)
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        cuts = np.flatnonzero(ids == self.separator_id)
        ends = np.append(cuts - np.arange(len(cuts)), len(ids) - len(cuts))
        return np.diff(ends, prepend=0), ids[ids != self.separator_id]

    def _parts(self, letters: str, signs: str) -> list[int]:
        """Ids of a plain word."""
        letters = letters.lower()
        if not letters.isascii():
            letters = letters.encode().decode("latin-1").translate(_BYTES)
        ids = [token.id for token in self.merge(letters)]
        if signs:
            if signs not in self.signs:
                self.signs[signs] = [token.id for token in self.merge(signs)]
            ids += self.signs[signs]
        return ids

    def _grow(self, words: list[str]) -> None:
        other, counts, flat = [], [], []
        for word in words:
            plain = _PLAIN.fullmatch(word)
            if plain:
                own = self._parts(*plain.groups())
                self.index[word] = len(self.index)
                counts.append(len(own))
                flat.extend(own)
            else:
                other.append(word)
        lengths, ids = [np.array(counts, np.int64)], [np.array(flat, np.uint32)]
        for k in range(0, len(other), 5_000):
            n, x = self._encode(other[k : k + 5_000])
            lengths.append(n)
            ids.append(x)
        base = len(self.index)
        self.index.update(zip(other, range(base, base + len(other)), strict=True))
        self.offsets = np.concatenate((self.offsets, self.offsets[-1] + np.cumsum(np.concatenate(lengths))))
        self.ids = np.concatenate((self.ids, *ids))

    def entries(self, vocabulary: pa.Array) -> np.ndarray:
        """Cache entry of each distinct word."""
        if len(self.index) > self.cache_words:
            self._reset()
        words = vocabulary.to_numpy(zero_copy_only=False).tolist()
        get = self.index.get
        found = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        missing = np.flatnonzero(found < 0).tolist()
        if missing:
            new = [words[k] for k in missing]
            self._grow(new)
            found[missing] = [get(w) for w in new]
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(offset of each text's first id, ids of all texts in a row)."""
        offsets, word, vocabulary = textkit.words(texts)
        entry = self.entries(vocabulary)[word]
        length = self.offsets[entry + 1] - self.offsets[entry]
        ends = np.concatenate(([0], np.cumsum(length)))
        source = np.repeat(self.offsets[entry] - ends[:-1], length) + np.arange(ends[-1])
        return ends[offsets], self.ids[source]

    def count(self, texts: pa.Array) -> np.ndarray:
        """Ids per text."""
        offsets, word, vocabulary = textkit.words(texts)
        entry = self.entries(vocabulary)[word]
        ends = np.concatenate(([0], np.cumsum(self.offsets[entry + 1] - self.offsets[entry])))
        return np.diff(ends[offsets])


def coder(path: str | None) -> WordCoder:
    """The worker's coder for a vocabulary file; ``None`` is the installed ``word_bpe_49k``."""
    if path is None:
        import public_tokenizers

        path = str(public_tokenizers.path("word_bpe_49k.json"))
    if path not in _coders:
        _coders[path] = WordCoder(path)
    return _coders[path]
