"""Token ids of whole texts by a public tokenizer file, through a cache of words.

The tokenizer's own rules never join characters across white space, so a text's ids are the ids of its parts between
spaces, one after the other. A part is looked up before the tokenizer is asked; the cache is emptied when it is full.
"""

from __future__ import annotations

import ctypes
import os
import unicodedata
from array import array

import pyarrow as pa

CACHED_WORDS = 600_000
LONGEST_CACHED = 48

# The tokenizer shows its model each byte as one printable character: itself, or the next free one from U+0100.
SHOWN = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
HIDDEN = {b: chr(256 + at) for at, b in enumerate(b for b in range(256) if b not in set(SHOWN))}

_tokenizers: dict[str, WordTokens] = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordTokens(dict):
    """Part of a text between spaces -> its ids as little-endian 32-bit bytes."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model

    def direct(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def letters(self, text: str) -> bytes:
        """Ids of lower-case Latin letters: one word to the model, with nothing to normalise or split."""
        shown = text if text.isascii() else text.encode().decode("latin-1").translate(HIDDEN)
        return array("I", [token.id for token in self.model.tokenize(shown)]).tobytes()

    def __missing__(self, part: str) -> bytes:
        if len(part) > LONGEST_CACHED:
            return self.direct(part)
        # Case does not count, and a stop or comma after a letter is a word of its own to the tokenizer.
        latin = max(part, default="") < "\u0100" and unicodedata.is_normalized("NFC", part)
        if latin and (small := part.lower()) != part:
            ids = self[small]
        elif latin and part.isalpha():
            ids = self.letters(part)
        elif latin and len(part) > 1 and part[-1] in ".," and part[-2].isalpha():
            ids = self[part[:-1]] + self[part[-1]]
        else:
            ids = self.direct(part)
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[part] = ids
        return ids

    def ids(self, text: str | None) -> bytes:
        """All ids of a text; none for null."""
        if not text:
            return b""
        return b"".join([self[part] for part in text.replace("\n", " ").split(" ")])


def tokens(path: str) -> WordTokens:
    """The tokenizer of a file, read once per worker."""
    if path not in _tokenizers:
        _tokenizers[path] = WordTokens(path)
    return _tokenizers[path]


def forget() -> None:
    """Drop the cached words of this worker: for tasks of other kinds, which run in the same workers and need the memory."""
    for words in _tokenizers.values():
        words.clear()
    release()


def release() -> None:
    """Give memory that is free in this worker back to the system; allocators keep it otherwise, for the worker's life."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # only the C library of Linux has it
        pass
