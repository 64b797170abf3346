"""Token ids of whole texts by a public vocabulary, word by word.

The vocabulary drops white space and never merges across it, so a text's ids are those of
its words in order. Where the normaliser and the splitting rule are plain, a text's pieces
go straight to the library's BPE model, and each Python worker remembers the pieces it has
met, up to a fixed number. Any other text is taken word by word in the same way, and an odd
word, or a text with odd white space, takes the library's whole path.
"""

from __future__ import annotations

import re
from array import array
from functools import cache

import numpy as np

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
REMEMBERED = 150_000  # words; twice as many pieces

# White space that Python and the tokenizer's rule may not agree on.
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0 ᠎ -​    　﻿]")
# Printable ASCII and Latin-1 letters: composed already, with one lower-case form each.
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+").fullmatch
_PLAIN_TEXT = re.compile("[!-~À-ÖØ-öø-ÿ \t-\r]*").fullmatch
# The vocabulary's splitting rule on such words, or texts of them, in lower case.
_PIECES = re.compile("'(?:[stmd]|re|ve|ll)|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9 \t-\r]+").findall


_ODD_ASCII = re.compile("[\x1c-\x1f]").search


class _Remembered(dict):
    """A bounded dict that works out what it lacks. When it is full it becomes the older
    half, from which what is asked for again comes back."""

    def __init__(self, compute, most: int):
        super().__init__()
        self._compute, self._most, self._older = compute, most, {}

    def __missing__(self, key: str) -> bytes:
        value = self._older.get(key)
        if value is None:
            value = self._compute(key)
        if len(self) >= self._most:
            self._older = dict(self)
            self.clear()
        if len(key) <= 64:
            self[key] = value
        return value


class WordEncoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self._whole = Tokenizer.from_file(path)
        self._model = self._whole.model
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(c) for c in range(0xC0, 0x100)]
        self._bytes = str.maketrans({c: level.pre_tokenize_str(c)[0][0] for c in letters})
        self._pieces = _Remembered(self._piece, 2 * REMEMBERED)
        self._words = _Remembered(self._word, REMEMBERED)

    def _piece(self, piece: str) -> bytes:
        plain = piece if piece.isascii() else piece.translate(self._bytes)
        return array("H", [t.id for t in self._model.tokenize(plain)]).tobytes()

    def _in_full(self, text: str) -> bytes:
        return array("H", self._whole.encode(text, add_special_tokens=False).ids).tobytes()

    def _word(self, word: str) -> bytes:
        if not _PLAIN(word) or "<|" in word:
            return self._in_full(word)
        lower = word.lower()
        if lower.isalpha():
            return self._pieces[lower]
        return b"".join(map(self._pieces.__getitem__, _PIECES(lower)))

    def ids(self, text: str) -> np.ndarray:
        """The ids of a text, without an end id."""
        if _PLAIN_TEXT(text) and "<|" not in text:
            return np.frombuffer(b"".join(map(self._pieces.__getitem__, _PIECES(text.lower()))), np.uint16)
        odd = _ODD_ASCII(text) if text.isascii() else _OTHER_SPACE.search(text)
        if odd:
            return np.frombuffer(self._in_full(text), np.uint16)
        return np.frombuffer(b"".join(map(self._words.__getitem__, text.split())), np.uint16)


@cache
def encoder(path: str) -> WordEncoder:
    """One per Python worker, kept between tasks."""
    return WordEncoder(path)


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def with_end(ids: np.ndarray) -> np.ndarray:
    return np.append(ids, np.uint16(END_ID))
