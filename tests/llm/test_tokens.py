"""Cached encoding and rANS blocks: exact against the libraries themselves."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from eventloom.llm import rans, tokens
from eventloom.llm.tokens import encoder, tokenizer_file

NAME = "byte_bpe_50k.json"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_file(NAME))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("ab .,'\n\t\r é漢 \u0085\x1c-9!")) | st.characters(exclude_categories=["Cs"]), max_size=12), max_size=4))
def test_cached_ids_equal_the_library(texts):
    library = Tokenizer.from_file(tokenizer_file(NAME)) if not hasattr(test_cached_ids_equal_the_library, "t") else test_cached_ids_equal_the_library.t
    test_cached_ids_equal_the_library.t = library
    for text, raw in zip(texts, encoder(NAME).encode(texts), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize(("n", "vocabulary"), [(0, 5), (1, 1), (700, 3), (5000, 200), (700_000, 50_000)])
def test_rans_round_trip_and_checkpoints(n, vocabulary):
    ids = (np.random.default_rng(n).zipf(1.3, n) % vocabulary).astype(np.uint32)
    coder = rans.Coder(rans.scaled_frequencies(np.bincount(ids, minlength=vocabulary)))
    assert n == 0 or coder.freq.sum() == 1 << rans.SCALE
    states, words, check_states, check_words = coder.encode(ids)
    assert (coder.decode(n, states, words) == ids).all()
    for i, at in enumerate(check_words):
        first = (i + 1) * rans.CHECK_STEPS
        state = check_states[i * rans.LANES * 8 : (i + 1) * rans.LANES * 8]
        assert (coder.decode(n, state, words[4 * at :], first) == ids[first * rans.LANES :]).all()


@pytest.mark.parametrize("n", [1, 2047, 2048, 2049, 128 * 2048 - 1, 128 * 2048, 128 * 2048 + 1, 3 * 128 * 2048 + 5000, 4 * 128 * 2048])
def test_stretches_decode_side_by_side(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n), 40_000).astype(np.uint32)
    coder = rans.Coder(rans.scaled_frequencies(np.bincount(ids, minlength=40_001)))
    states, words, check_states, check_words = coder.encode(ids)
    assert len(check_words) == (n - 1) // (rans.CHECK_STEPS * rans.LANES)
    assert (coder.decode_stretches(n, states, words, check_states, check_words) == ids).all()


def test_a_full_cache_forgets_the_newest_cuts_and_keeps_the_ids(monkeypatch):
    monkeypatch.setattr(tokens, "_CACHE_ENTRIES", 40)
    monkeypatch.setattr(tokens, "_KEPT_ENTRIES", 30)
    enc = tokens.Encoder("byte_bpe_50k.json")
    texts = [" ".join(f"word{chr(97 + i % 26)}{chr(97 + (i * j) % 26)}," for i in range(30)) for j in range(20)]
    whole = enc._whole(texts)
    assert [enc.encode([t])[0] for t in texts] == whole
    assert len(enc.after) <= 40 + 30 and len(enc.first) <= 40 + 30
