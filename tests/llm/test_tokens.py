"""Token ids by pieces against the library on whole texts."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from tallyloom.llm import pieces
from tallyloom.llm.bpe import WordEncoder

#: With characters whose lower case is two characters or depends on neighbours, marks, blanks of all kinds and special tokens.
ALPHABET = "abAB ..,,\n\n''-_12éÉßẞİıΣσςΩ<|>stÀ́̇  \t\r!?()ǅǄ中文🙂क़  "


@pytest.fixture(scope="module")
def encoder():
    return WordEncoder(public_tokenizers.path("word_bpe_49k.json"))


def _differing(encoder, texts):
    whole = encoder.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    return [t for t, ids, e in zip(texts, encoder(pa.array(texts, pa.string())), whole) if ids != np.array(e.ids, "<u4").tobytes()]


def test_ids_of_random_texts(encoder):
    rng = random.Random(3)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 24))) for _ in range(50_000)]
    assert _differing(encoder, texts) == []
    assert _differing(encoder, ["İ. x", "Aİ, b", "Izmir'de TÜİ. son", "", "a" * 5_000]) == []


@pytest.mark.parametrize("form", ["{}", "A{}. {}x", "{}.,\n{}'s"])
def test_ids_of_every_letter(encoder, form):
    assert _differing(encoder, [form.format(chr(c), chr(c)) for c in [*range(0x3000), *range(0xA000, 0xB000), *range(0xF800, 0x10400)]]) == []


def test_store_that_starts_anew(monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_PIECES", 3)
    small = WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    for texts in (["one two", "three four five"], [None, "", "one six"], []):
        whole = [np.array(e.ids, "<u4").tobytes() for e in small.tokenizer.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]
        assert small(pa.array(texts, pa.string())) == whole
    assert len(small.codes.known) < 5
