"""Token ids by the tokenizers library, at the speed of a dictionary.

The byte-level pre-tokenizer always starts a new piece at a single space
between two characters that are not white space, so a text may be cut there
and each cut encoded on its own, with the same ids. Cuts repeat, so a worker
keeps the ids of those it has seen. Texts with other white space next to a
space are encoded whole.
"""

from __future__ import annotations

import os
import string
import struct
from array import array
from functools import lru_cache
from itertools import islice

import numpy as np

END = struct.pack("<I", 0)
_CACHE_ENTRIES = 500_000
_KEPT_ENTRIES = 400_000
#: The byte-level alphabet: printable bytes stand for themselves, the others, in
#: order, for the characters from 256 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_ALPHABET = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
_SPACE = chr(_ALPHABET[32])


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    """Place of a vocabulary file: by the installed package of public
    tokenizers, in a folder named by TOKENIZER_DIR, or the given path."""
    if "/" in name:
        return name
    if folder := os.environ.get("TOKENIZER_DIR"):
        return f"{folder}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


class _SpacedError(Exception):
    """A cut with white space at an end: its text is encoded whole."""


class _Cuts(dict):
    """Ids of cuts, found when first asked for."""

    def __init__(self, encoder: Encoder, lead: str):
        super().__init__()
        self._encoder, self._lead = encoder, lead

    def __missing__(self, cut: str) -> bytes:
        encoder, lead = self._encoder, self._lead
        if cut.isalpha():
            ids = encoder.word(cut, lead)
        elif (word := cut.rstrip(string.punctuation)).isalpha():
            ids = (self.get(word) or encoder.word(word, lead)) + encoder.first[cut[len(word) :]]
        else:
            ids = encoder.cut(cut, lead)
        self[cut] = ids
        return ids

    def forget(self) -> None:
        """Drop the newest cuts; the frequent ones were seen early and stay."""
        for cut in list(islice(self, _KEPT_ENTRIES, None)):
            del self[cut]


class Encoder:
    """``encode(texts)``: ids of each text as little-endian unsigned 32-bit
    bytes, equal to ``Tokenizer.encode(text, add_special_tokens=False).ids``."""

    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(tokenizer_file(name))
        self._pieces = self._tokenizer.model.tokenize
        self._line = self._whole(["\n"])[0]
        self.after, self.first = _Cuts(self, " "), _Cuts(self, "")

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def word(self, word: str, lead: str) -> bytes:
        """Ids of a word of letters, one piece for the model."""
        piece = word if word.isascii() else word.encode().decode("latin-1").translate(_ALPHABET)
        return array("I", [t.id for t in self._pieces(_SPACE + piece if lead else piece)]).tobytes()

    def cut(self, cut: str, lead: str) -> bytes:
        if cut.strip() != cut or not cut:
            raise _SpacedError
        left, line, right = cut.partition("\n")
        if line and left[-1:].strip() and right[:1].strip():  # a line break between words is a piece
            return (self.after if lead else self.first)[left] + self._line + self.first[right]
        return self._whole([lead + cut])[0]

    def encode(self, texts: list[str]) -> list[bytes]:
        for known in (self.after, self.first):
            if len(known) > _CACHE_ENTRIES:
                known.forget()
        after, out = self.after.__getitem__, []
        for text in texts:
            cuts = text.split(" ")
            try:
                first = self.first[cuts[0]]
                out.append(first + b"".join(map(after, cuts[1:])))
            except _SpacedError:
                out.append(None)
        rest = iter(self._whole([t for t, x in zip(texts, out, strict=True) if x is None]))
        return [next(rest) if x is None else x for x in out]


@lru_cache(maxsize=2)
def encoder(name: str) -> Encoder:
    return Encoder(name)
