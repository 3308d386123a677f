import random

import numpy as np
import pytest
from samples import ROWS

from tokenizers import Tokenizer

from seriesloom.llm import encoding, words
from seriesloom.llm.encoding import WHITE, WordEncoder, tokenizer_path

TEXTS = [t for _, t in ROWS]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_those_of_the_library(name):
    encoder = WordEncoder(tokenizer_path(name))
    r = random.Random(1)
    letters = [*"ab'sSt1 2.!\n\t ", *WHITE, "́", "é", "Σ", "σ", "日", "\x1c", "\x00", "​", "<|endoftext|>", "  "]
    odd = ["".join(r.choices(letters, k=r.randint(0, 14))) for _ in range(5000)] + TEXTS
    # The library as the contract calls it, special tokens in texts included.
    plain = Tokenizer.from_file(tokenizer_path(name)).encode_batch([t or "" for t in odd], add_special_tokens=False)
    assert [list(i) for i in encoder.encode(odd, 1)] == [[*e.ids, 1] for e in plain]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_long_texts_in_parts_and_words_forgotten(name, monkeypatch):
    monkeypatch.setattr(encoding, "RUN", 40)
    monkeypatch.setattr(encoding, "REMEMBERED", 30)
    encoder = WordEncoder(tokenizer_path(name))
    r = random.Random(2)
    texts = ["".join(r.choices(["ab", "c,", "é!", " ", " ", "\n", "x" * 60, "don't"], k=r.randint(0, 120))) for _ in range(300)]
    plain = Tokenizer.from_file(tokenizer_path(name)).encode_batch(texts, add_special_tokens=False)
    assert [list(i) for i in encoder.encode(texts, 1)] == [[*e.ids, 1] for e in plain]


def test_words_of_one_hash(monkeypatch):
    """Where two words share the first hash, the texts go to the library."""
    monkeypatch.setattr(encoding, "_BYTES", (np.ones(256, np.uint64), encoding._BYTES[1]))
    name = tokenizer_path("byte_bpe_50k.json")
    texts = ["one two six", "ten two", "abc abd", "six", "one"]
    plain = Tokenizer.from_file(name).encode_batch(texts, add_special_tokens=False)
    assert [list(i) for i in WordEncoder(name).encode(texts, 1)] == [[*e.ids, 1] for e in plain]


def test_word_hashes(monkeypatch):
    data = [words.encoded(t) for t in TEXTS]
    got = {}
    for size in (words.SLICE, 500):
        monkeypatch.setattr(words, "SLICE", size)
        seen = []
        for first, hashes, ends in words.hashed_words(data):
            for i, (a, z) in enumerate(zip([0, *ends[:-1]], ends, strict=True)):
                own = data[first + i].split()
                assert len(own) == z - a
                for w, h in zip(own, hashes[a:z], strict=True):
                    assert got.setdefault(w, h) == h
            seen += list(range(first, first + len(ends)))
        assert seen == list(range(len(data)))
    assert len(set(got.values())) == len(got)


def test_windows_tell_orders_apart():
    a, b = np.uint64(3), np.uint64(5)
    rows = {tuple(words.windows(np.array(x, np.uint64), 5)) for x in ([a, a, b, b, b], [b, a, b, a, b], [a, b, b, b, a], [b, b, b, a, a])}
    assert len(rows) == 4
