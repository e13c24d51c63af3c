"""Byte-level BPE encoding by chunk cache, shared by the token writers and packers."""

from __future__ import annotations

import os
import re
import sys
from array import array

import numpy as np

from .common import give_back

#: A space that a later white-space character or the end follows: the text is then encoded whole.
_ODD = re.compile(r" (?=\s)| $")
#: Distinct chunks, and distinct words inside of chunks, that a worker keeps, and the longest ones that it keeps; others
#: are worked out whenever they come. Bounds memory (about 80 MB), never results.
CACHE_ENTRIES, CACHE_WORDS, CACHE_CHARS = 500_000, 150_000, 64
_OPEN: dict = {}


class _Kept(dict):
    """What was worked out, kept while there is room for it."""

    def __init__(self, work, most: int):
        self.work, self.most = work, most

    def __missing__(self, key: str) -> bytes:
        got = self.work(key)
        if len(self) < self.most and len(key) <= CACHE_CHARS:
            self[key] = got
        return got


class ByteBpe:
    """Ids of whole texts as little-endian bytes, equal to tokenizers' encode(text, add_special_tokens=False).

    The pre-tokenizer always cuts before a space that a non-space follows, so texts are cut there first and
    each distinct chunk is kept. A new chunk is cut into the pre-tokenizer's words, and only words that are
    new as well go to the library's BPE model, in its byte alphabet, as its pre-tokenizer would hand them on.
    """

    def __init__(self, path: str, dtype: str = "<u4"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        if sys.byteorder != "little" or array("H").itemsize != 2 or array("I").itemsize != 4:
            raise RuntimeError("ids are written as little-endian arrays of two or four bytes")
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.model = self.tok.model
        self.dtype = dtype
        self.words_of = regex.compile(public_tokenizers.PATTERN).findall
        # the byte alphabet, by its rule: printable Latin-1 bytes stand for themselves, the others follow from 256 on
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in plain]
        self.letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
        if set(self.letters.values()) != set(pre_tokenizers.ByteLevel.alphabet()):
            raise ValueError("unexpected byte alphabet")
        self.special = re.compile("|".join(re.escape(t.content) for t in self.tok.get_added_tokens_decoder().values()) or r"(?!)").search
        self.code = {"<u2": "H", "<u4": "I"}[dtype]
        # a space and ASCII letters make one word, and are spelled as themselves behind the space's letter
        self.plain = self.words_of(" azAZ") == [" azAZ"]
        self.space = self.letters[0x20]
        self.chunks = _Kept(self._chunk, CACHE_ENTRIES)
        self.words = _Kept(self._word, CACHE_WORDS)

    @classmethod
    def shared(cls, path: str, dtype: str = "<u4") -> ByteBpe:
        """One per worker process and file, so that tasks that follow one another share what is known."""
        if (path, dtype) not in _OPEN:
            _OPEN[path, dtype] = cls(path, dtype)
        return _OPEN[path, dtype]

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def _ids(self, spelled: str) -> bytes:
        return array(self.code, [t.id for t in self.model.tokenize(spelled)]).tobytes()

    def _word(self, word: str) -> bytes:
        return self._ids("".join(map(self.letters.__getitem__, word.encode("utf-8"))))

    def _chunk(self, c: str) -> bytes:
        """A chunk that stands after a space."""
        if self.special(c):
            return self._library([" " + c])[0]
        if self.plain and c.isascii() and c.isalpha():
            return self._ids(self.space + c)
        parts = self.words_of(" " + c)
        # one word alone is kept as a chunk
        return self._word(parts[0]) if len(parts) == 1 else b"".join(map(self.words.__getitem__, parts))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        # the first chunk, which no space precedes, is encoded apart
        cut = [t if _ODD.search(t) else t.split(" ") for t in (t or "" for t in texts)]
        apart = self._library([c if isinstance(c, str) else c[0] for c in cut])
        known = self.chunks.__getitem__
        return [a if isinstance(c, str) else a + b"".join(map(known, c[1:])) for a, c in zip(apart, cut)]


def forget() -> None:
    """Give up what this worker keeps, when it turns to work that has no use for it."""
    if _OPEN:
        _OPEN.clear()
        give_back()


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def groups_by_size(texts: list[str | None], most: int = 4_000_000) -> list[tuple[int, int]]:
    """Slices of a batch that hold at most so many characters each (a longer text stands alone)."""
    out, start, size = [], 0, 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if size and size + n > most:
            out.append((start, i))
            start, size = i, 0
        size += n
    if start < len(texts):
        out.append((start, len(texts)))
    return out
