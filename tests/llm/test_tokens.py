"""Word-wise ids against the tokenizer itself."""

import json
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from fareloom.llm import tokens

PATH = str(public_tokenizers.path("word_bpe_49k.json"))


def by_tokenizer(texts):
    whole = Tokenizer.from_file(PATH)
    return [whole.encode(text, add_special_tokens=False).ids for text in texts]


def test_ids_equal_the_tokenizers():
    rng = random.Random(4)
    letters = "abcXYZ éÉŸſİıŁßÀ×÷ÿŒ 'sS.,;-_!?<|>&`^~ 019ª²½ 中文ñ́İ \x85 Σς\U0001f600"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 40))) for _ in range(4000)]
    texts += [" ".join(rng.choice(["Élan,", "don't", "word.", "A", "<|endoftext|>", "x<|startoftext|>y", "<|ENDOFTEXT|>", "it's...", "Œuvre!?", "é", "İx"]) for _ in range(9)) for _ in range(500)]
    texts += ["".join(chr(rng.randrange(0xC0, 0x180)) for _ in range(5)) + rng.choice(["", ".", "!?", "'", "'s"]) for _ in range(1000)]
    texts += ["", " ", "\n\t"]
    ends, ids = tokens.WordCoder(PATH, 50).encode(pa.array(texts))
    found = [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)]
    assert found == by_tokenizer(texts)
    assert np.array_equal(tokens.WordCoder(PATH).count(pa.array(texts)), np.diff(ends))


def test_other_vocabularies_are_refused(tmp_path):
    with pytest.raises(ValueError, match="no vocabulary"):
        tokens.WordCoder(str(public_tokenizers.path("byte_bpe_50k.json")))
    steps = json.loads(open(PATH).read())
    steps["normalizer"] = None
    (tmp_path / "x.json").write_text(json.dumps(steps))
    with pytest.raises(ValueError, match="no vocabulary"):
        tokens.WordCoder(str(tmp_path / "x.json"))
