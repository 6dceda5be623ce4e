"""Cutting texts into cached parts never changes what the libraries give."""

import itertools
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from fleetlens.llm import bpe, encoding
from fleetlens.llm.common import vocabulary_path

PARTS = ["a", "Ab", " ", "  ", "\n", "\n\n", "\t", "\r", "é", "́", "'s", "'", "1", "12", ".", "!!",
         "<|endoftext|>", "\xa0", " ", "\x1c", "\x85", "日本", "The", "🙂", "_", "-"]


def odd_texts():
    r = random.Random(1)
    return ["".join(r.choice(PARTS) for _ in range(r.randrange(0, 14))) for _ in range(3000)]


@pytest.mark.parametrize("scheme, name", [(encoding.ByteLevel, "byte_bpe_50k.json"),
                                          (encoding.Words, "word_bpe_49k.json")])
def test_ids(scheme, name):
    path = vocabulary_path(name)
    texts = odd_texts()
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoding.Encoder(scheme(), path).encode(texts)] == want


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("form", ["{}", "ab{}cd", "ab{}", "{}ab", "ab{}."])
def test_every_character_in_and_at_the_ends_of_words(name, form):
    path = vocabulary_path(name)
    scheme = encoding.Words if "word" in name else encoding.ByteLevel
    lib = Tokenizer.from_file(path)
    words = [form.format(chr(c)) for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    texts = [" ".join(words[i:i + 50]) for i in range(0, len(words), 50)]
    want = [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
    got = [np.frombuffer(x, "<u4").tolist() for x in encoding.Encoder(scheme(), path).encode(texts)]
    assert [t for t, a, b in zip(texts, got, want, strict=True) if a != b] == []


def test_words_around_a_line_end_are_looked_up_apart(monkeypatch):
    """Not every pair of words goes to the library as a text."""
    path = vocabulary_path("byte_bpe_50k.json")
    words = ["".join(x) for x in itertools.product("abcdefgh", repeat=2)]
    texts = [f"to {a}.\n{b}, and" for a in words for b in words]
    encoder, sent = encoding.Encoder(encoding.ByteLevel(), path), []
    for name in ("_whole", "_lines"):
        monkeypatch.setattr(encoder, name, lambda x, f=getattr(encoder, name): sent.extend(x) or f(x))
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == want
    assert len(sent) < 4 * len(words)


def test_counts():
    path = vocabulary_path(bpe.VOCABULARY)
    texts = odd_texts()
    want = [len(e.ids) for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert bpe.Merges(path).count(texts) == want
