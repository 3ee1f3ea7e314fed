"""Token ids of whole texts, exactly as the tokenizers library gives them.

The tokenizer drops white space and no token spans it, so a text's ids are
the ids of its white-space-free chunks in order. Every distinct chunk is
encoded once per worker by the library and then looked up. A Latin word is
handed to the library's BPE model directly; a word followed by ASCII
punctuation is looked up as these two parts, between which this tokenizer
always cuts; any other chunk goes through the whole library encoder.
"""

from __future__ import annotations

import os
import re
from array import array

#: White space of ``str.split`` that the tokenizer takes for text.
CONTROL = "\x1c\x1d\x1e\x1f"
CHUNK = re.compile(r"[^ \t-\r]+")
WORD = "[A-Za-zÀ-ÖØ-öø-ÿ]+"
WORD_PUNCT = re.compile(f"({WORD})" + r"([!-&(-/:-@\[-`{-~]+)")
WORD_ONLY = re.compile(WORD)
#: Distinct words kept per worker and generation (two generations, each
#: about 70 MB); the older generation goes when the newer one is full.
CACHE_ENTRIES = 260_000

_ENCODERS: dict = {}


def chunks_of(text: str) -> list[str]:
    """The white-space-free chunks of a text."""
    if any(c in text for c in CONTROL):
        return CHUNK.findall(text)
    return text.split()


def byte_symbols() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: a
    printable Latin-1 character stands for itself, the other bytes for the
    characters from U+0100 on, in order."""
    plain = {b for lo, hi in ((33, 126), (161, 172), (174, 255)) for b in range(lo, hi + 1)}
    rest = iter(range(256, 512))
    return {b: chr(b if b in plain else next(rest)) for b in range(256)}


BYTE_SYMBOL = byte_symbols()


def symbols(text: str) -> str:
    if text.isascii() and text.isprintable() and " " not in text:
        return text
    return "".join([BYTE_SYMBOL[b] for b in text.encode()])


class _Known(dict):
    """chunk -> ids; what is missing is put together from its two parts, taken
    from the older generation or learned."""

    def __init__(self, learn, older):
        super().__init__()
        self.learn, self.older = learn, older

    def __missing__(self, chunk: str):
        out = self.older.get(chunk)
        if out is None:
            parts = None if chunk.isalpha() else WORD_PUNCT.fullmatch(chunk)
            out = self[parts[1]] + self[parts[2]] if parts else self.learn(chunk)
            if parts and len(chunk) > 8:
                return out
        if len(chunk) <= 64:
            self[chunk] = out
        return out


class ChunkEncoder:
    """``encode(text)``: the text's ids as little-endian 32-bit integers."""

    def __init__(self, path: str, cache_entries: int = CACHE_ENTRIES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.id_bytes = [i.to_bytes(4, "little") for i in range(max(self.tokenizer.get_vocab(with_added_tokens=True).values(), default=-1) + 1)]
        self.cache_entries = cache_entries
        self.known = _Known(self._learn, {})

    def _learn(self, chunk: str) -> bytes:
        if chunk.isalpha() and chunk.isascii():  # most new words: no test and no stand-ins
            return b"".join([self.id_bytes[t.id] for t in self.model.tokenize(chunk.lower())])
        if WORD_ONLY.fullmatch(chunk):
            return array("I", [t.id for t in self.model.tokenize(symbols(chunk.lower()))]).tobytes()
        return array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str) -> bytes:
        if len(self.known) > self.cache_entries:
            self.known = _Known(self._learn, dict(self.known))
        return b"".join(map(self.known.__getitem__, chunks_of(text)))


def encoder(path: str) -> ChunkEncoder:
    """One encoder per worker and tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]
