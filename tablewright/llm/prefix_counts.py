"""Exact token counts at every prefix of a text.

For one pre-token (a run of letters, a digit, a run of other signs) a prefix
dynamic programme fills, per byte position, the last token of that prefix and
its number of tokens: the last token is the one suffix in the vocabulary that
byte-pair merging leaves whole next to the last token of the shorter prefix.
A prefix that ends there takes a token with the end-of-word mark instead.
Counts of a text add up over its pre-tokens, so the table of a text is the
concatenation of its words' tables; each distinct word is solved once per
worker. Stored per document: the count's change from each code point to the
next (16-bit integers, zstandard), from which truncation and budget questions
are answered without encoding again.

Characters that combine with a neighbour under normalisation, contractions
and special tokens are handed to the library, prefix by prefix; such runs are
short in any text with white space (their cost is quadratic in their length).

Nulls and edges: a null text counts as empty (0 tokens, empty table); repeated
rows are each returned; other columns are not read.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache
from operator import sub
from os.path import commonprefix

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import python_ready, texts
from .word_tokens import chunks_of, symbols

#: The tokenizer's end-of-word mark and its contractions (fixed values).
END = "</w>"
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
#: How the tokenizer cuts normalised text (fixed value).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

SPACE_OR_CHUNK = re.compile(r"[ \t-\r]+|[^ \t-\r]+")
LATIN_WORD = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
WORD_SIGNS = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]+)")
#: Distinct pieces kept per worker and generation.
CACHE_ENTRIES = 300_000

#: Token pairs whose standing is remembered per worker.
MOST_PAIRS = 400_000
#: A token's last symbols that index its possible sizes; shorter tokens are
#: always tried.
TAIL = 4
SHORT = (3, 2, 1)

_COUNTERS: dict = {}


def steps(counts: list[int]) -> bytes:
    """Counts as 16-bit changes from each to the next."""
    return array("h", map(sub, counts, [0, *counts])).tobytes()


@lru_cache(maxsize=1)
def combining_seconds() -> frozenset[str]:
    """Characters that may join the one before them in composed form."""
    out = set()
    for code in range(0x110000):
        parts = unicodedata.decomposition(chr(code))
        if parts and not parts.startswith("<") and " " in parts:
            out.update(chr(int(p, 16)) for p in parts.split()[1:])
    out.update(chr(c) for lo, hi in ((0x1161, 0x1176), (0x11A8, 0x11C3)) for c in range(lo, hi))
    return frozenset(out)


class _Tables(dict):
    """chunk -> its table (changes as bytes); missing ones are put together
    from word and signs, taken from the older generation or made."""

    def __init__(self, make, older):
        super().__init__()
        self.make, self.older = make, older

    def __missing__(self, chunk: str) -> bytes:
        out = self.older.get(chunk)
        if out is None:
            both = WORD_SIGNS.fullmatch(chunk)
            out = self[both[1]] + self[both[2]] if both else self.make(chunk)
            if both and len(chunk) > 8:
                return out
        if len(chunk) <= 64:
            self[chunk] = out
        return out


class PrefixCounter:
    """``changes(text)``: how the token count changes with each code point."""

    def __init__(self, path: str, cache_entries: int = CACHE_ENTRIES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.rank = {tuple(m) if isinstance(m, list) else tuple(m.split(" ")): i for i, m in enumerate(model["merges"])}
        # token -> which tokens may stand before it ("": none), as learned
        self.inner = {t: {"": True} for t in model["vocab"] if not t.endswith(END)}
        self.final = {t[: -len(END)]: {"": True} for t in model["vocab"] if t.endswith(END)}
        self.inner_sizes, self.final_sizes = self._sizes(self.inner), self._sizes(self.final)
        self.solved: tuple = ("", [""], [0], [0])
        self.pairs = 0
        self.special = re.compile("|".join(re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()) or r"(?!)")
        self.pieces = regex.compile(PIECES)
        self.letter, self.number = regex.compile(r"\p{L}"), regex.compile(r"\p{N}")
        self.plain: dict[str, str | None] = {}
        self.cache_entries = cache_entries
        self.tables = _Tables(self._table, {})

    @staticmethod
    def _sizes(tokens) -> dict[str, tuple[int, ...]]:
        """Last symbols -> sizes of the tokens that can end in them, longest
        first."""
        by: dict[str, set[int]] = {}
        for t in tokens:
            if len(t) >= TAIL:
                by.setdefault(t[-TAIL:], set()).add(len(t))
        return {tail: (*sorted(sizes, reverse=True), *SHORT) for tail, sizes in by.items()}

    # --- the dynamic programme -------------------------------------------
    def _merged(self, parts: list[str]) -> list[str]:
        """Byte-pair merging of a short symbol list."""
        while len(parts) > 1:
            at = min(range(len(parts) - 1), key=lambda i: self.rank.get((parts[i], parts[i + 1]), 1 << 60))
            if (parts[at], parts[at + 1]) not in self.rank:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _stays(self, left: str, right: str, last: bool) -> bool:
        """Do these two tokens stand side by side after merging?"""
        parts = list(left + right)
        if last:
            parts[-1] += END
        self.pairs += 1
        return self._merged(parts) == [left, right + END * last]

    def pretoken_counts(self, piece: str) -> list[int]:
        """Token counts of every prefix of one normalised pre-token. What the
        word before shares with this one is not solved again, so words come
        in sorted order where many are solved."""
        word = symbols(piece)
        n = len(word)
        before, last, count, whole = self.solved
        same = len(commonprefix((word, before)))
        del last[same + 1 :], count[same + 1 :], whole[same + 1 :]
        inner, final, inner_sizes, final_sizes = self.inner, self.final, self.inner_sizes, self.final_sizes
        for i in range(same + 1, n + 1):
            tail = word[i - TAIL : i] if i >= TAIL else ""
            for size in inner_sizes.get(tail, SHORT):
                j = i - size
                if j < 0:
                    continue
                t = word[j:i]
                after = inner.get(t)
                if after is not None:
                    known = after.get(last[j])
                    if known is None:
                        known = after[last[j]] = self._stays(last[j], t, False)
                    if known:
                        last.append(t)
                        count.append(count[j] + 1)
                        break
            for size in final_sizes.get(tail, SHORT):
                j = i - size
                if j < 0:
                    continue
                t = word[j:i]
                after = final.get(t)
                if after is not None:
                    known = after.get(last[j])
                    if known is None:
                        known = after[last[j]] = self._stays(last[j], t, True)
                    if known:
                        whole.append(count[j] + 1)
                        break
            else:
                whole.append(0)  # inside a character: no text ends here
        self.solved = (word, last, count, whole)
        if n == len(piece):
            return whole[1:]
        ends, out = 0, []
        for c in piece:
            ends += len(c.encode())
            out.append(whole[ends])
        return out

    def solve_words(self, words) -> None:
        """Tables of many Latin words, in sorted order."""
        made: dict[str, list[str]] = {}
        for w in words:
            made.setdefault(w.lower(), []).append(w)
        for low in sorted(made):
            table = steps(self.pretoken_counts(low))
            for w in made[low]:
                self.tables[w] = table

    # --- from pre-tokens to chunks ---------------------------------------
    def library_counts(self, text: str) -> list[int]:
        """The definition: encode every prefix."""
        return [len(self.tokenizer.encode(text[:i], add_special_tokens=False).ids) for i in range(1, len(text) + 1)]

    def _plain_form(self, c: str) -> str | None:
        """The normalised character, if it is one that never joins a
        neighbour and is read alike here and by the library; else None."""
        if c not in self.plain:
            n = self.tokenizer.normalizer.normalize_str(c)
            ok = len(n) == 1 and not unicodedata.combining(c) and not unicodedata.combining(n)
            ok = ok and c not in combining_seconds() and n not in combining_seconds() and unicodedata.normalize("NFC", c) == c
            if ok:
                cut = self.tokenizer.pre_tokenizer.pre_tokenize_str
                kind = "space" if not cut(n) else "letter" if len(cut("a" + n)) == 1 else "other" if len(cut("!" + n)) == 1 else "number"
                ours = "space" if n.isspace() and n not in "\x1c\x1d\x1e\x1f" else "letter" if self.letter.match(n) else "number" if self.number.match(n) else "other"
                ok = kind == ours
            self.plain[c] = n if ok else None
        return self.plain[c]

    def _kind(self, n: str) -> int:
        return 0 if self.letter.match(n) else 1 if self.number.match(n) else 2

    def _ordinary(self, chunk: str) -> list[int]:
        """Counts of a chunk in which no special token is whole."""
        forms = [self._plain_form(c) for c in chunk]
        if all(forms):
            out: list[int] = []
            done = 0
            low = "".join(forms)
            at = 0
            for m in self.pieces.finditer(low):
                out += [done] * (m.start() - at)
                piece = m[0]
                counts = self.library_counts(piece) if piece in CONTRACTIONS else self.pretoken_counts(piece)
                out += [done + c for c in counts]
                done += counts[-1]
                at = m.end()
            return out + [done] * (len(low) - at)
        # cut where two plain characters of different kinds meet away from an
        # apostrophe: no pre-token and no composition spans that place
        cuts = [0]
        for i in range(1, len(chunk)):
            a, b = forms[i - 1], forms[i]
            if a and b and "'" not in (a, b) and self._kind(a) != self._kind(b):
                cuts.append(i)
        if len(cuts) == 1:
            return self.library_counts(chunk)
        out = []
        done = 0
        for a, b in zip(cuts, [*cuts[1:], len(chunk)]):
            counts = self._ordinary(chunk[a:b])
            out += [done + c for c in counts]
            done += counts[-1]
        return out

    def chunk_counts(self, chunk: str) -> list[int]:
        """Counts of a chunk's prefixes; a special token is one token."""
        if LATIN_WORD.fullmatch(chunk):
            return self.pretoken_counts(chunk.lower())
        out: list[int] = []
        done = at = 0
        for m in self.special.finditer(chunk):
            counts = self._ordinary(chunk[at : m.end() - 1])
            out += [done + c for c in counts]
            done += (counts[m.start() - at - 1] if m.start() > at else 0) + 1
            out.append(done)
            at = m.end()
        return out + [done + c for c in self._ordinary(chunk[at:])] if at < len(chunk) else out

    def _table(self, piece: str) -> bytes:
        if piece[0] in " \t\n\r\v\f":
            return bytes(2 * len(piece))
        return steps(self.chunk_counts(piece))

    def changes(self, text: str) -> bytes:
        """One 16-bit change per code point."""
        out = b"\0\0".join(map(self.tables.__getitem__, chunks_of(text)))
        if len(out) == 2 * len(text):  # single spaces between chunks
            return out
        return b"".join(map(self.tables.__getitem__, SPACE_OR_CHUNK.findall(text)))

    def prepare(self, texts: list[str]) -> None:
        """Solve the words that a batch of texts brings."""
        if len(self.tables) > self.cache_entries:
            self.tables = _Tables(self._table, dict(self.tables))
        if self.pairs > MOST_PAIRS:
            self.pairs = 0
            for after in (*self.inner.values(), *self.final.values()):
                after.clear()
                after[""] = True
        have, older, new = self.tables, self.tables.older, set()
        for text in texts:
            for chunk in set(chunks_of(text)):
                if chunk in have:
                    continue
                both = WORD_SIGNS.fullmatch(chunk)
                word = both[1] if both else chunk
                if word not in have and word not in older and LATIN_WORD.fullmatch(word):
                    new.add(word)
        self.solve_words(new)


def counter(path: str) -> PrefixCounter:
    """One counter per worker and tokenizer file."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def prefix_counts(table: bytes):
    """A stored table as counts: entry i is the token count of the text's
    first i code points."""
    import numpy as np
    import zstandard

    changes = np.frombuffer(zstandard.ZstdDecompressor().decompress(table), "<i2")
    return np.concatenate([[0], np.cumsum(changes, dtype=np.int64)])


def longest_within(table: bytes, budget: int) -> int:
    """Code points of the longest prefix of at most ``budget`` tokens."""
    import numpy as np

    return int(np.flatnonzero(prefix_counts(table) <= budget)[-1])


def prefix_tables(docs: DataFrame, tokenizer_path: str, budget: int = 2048, level: int = 1) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, fits_chars (code points of the
    longest prefix within ``budget`` tokens) and prefix_table, row by row."""
    python_ready(docs.sparkSession)

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import zstandard

        count, press = counter(tokenizer_path), zstandard.ZstdCompressor(level=level, write_checksum=False)
        for b in batches:
            n_tokens, fits, tables = [], [], []
            batch = b.column(2).to_pylist()
            count.prepare(batch)
            for text in batch:
                raw = count.changes(text)
                counts = np.frombuffer(raw, "<i2").cumsum(dtype=np.int64)
                total = int(counts[-1]) if len(counts) else 0
                n_tokens.append(total)
                fits.append(len(text) if total <= budget else int(np.flatnonzero(counts <= budget)[-1]) + 1 if (counts <= budget).any() else 0)
                tables.append(press.compress(raw))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n_tokens, pa.int64()), pa.array(fits, pa.int64()), pa.array(tables, pa.binary())], ["doc_id", "n_bytes", "n_tokens", "fits_chars", "prefix_table"])

    rows = texts(docs, F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes")).select("doc_id", "n_bytes", "text")
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, fits_chars long, prefix_table binary")
