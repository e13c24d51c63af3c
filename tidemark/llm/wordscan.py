"""Words of whole Arrow string columns: found, hashed, windowed and rejoined on the bytes, without a Python object for each.

A word is a maximal run of bytes outside [\\x20\\x09-\\x0D]; none of these bytes is part of a longer UTF-8
character. A word's hash is a sum over its bytes of random table values times powers of an odd base,
modulo 2**64 and then scrambled, so one running sum over a buffer gives all of them. Texts are taken in
slices of bounded bytes; only a single longer text exceeds one, and its hashes still come in pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of text that a slice holds, and that one running sum covers.
SLICE_BYTES = 2_000_000
_SUM_BYTES = 1 << 18
#: Longer words are hashed by themselves.
_LONG = 4096

_U = np.uint64
_MULT, _MIX, _S32 = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93), _U(32)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _S32)) * _MIX
        x = (x ^ (x >> _S32)) * _MIX
        return x ^ (x >> _S32)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


_BASE = 0x9DDFEA08EB382D69
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * _MULT)
_UP = _powers(_BASE, _SUM_BYTES + _LONG)
_DOWN = _powers(pow(_BASE, -1, 1 << 64), _SUM_BYTES + _LONG)
_IS_WHITE = np.zeros(256, bool)
_IS_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


@dataclass
class Words:
    """The words of some texts, one after another.

    data: the texts' bytes; text_at: where each text begins in data, and the end; start, end: where each word
    stands in data; word_at: the number of the first word of each text, and that of all words.
    """

    data: np.ndarray
    text_at: np.ndarray
    start: np.ndarray
    end: np.ndarray
    word_at: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.word_at)

    def hashes(self) -> np.ndarray:
        out = np.empty(len(self.start), np.uint64)
        size = self.end - self.start
        short = np.flatnonzero(size <= _LONG)
        for i in np.flatnonzero(size > _LONG).tolist():
            out[i] = xxhash.xxh3_64_intdigest(self.data[self.start[i] : self.end[i]].tobytes())
        first = self.start[short]
        at = 0
        while at < len(short):
            to = int(np.searchsorted(first, first[at] + _SUM_BYTES))
            own = short[at:to]
            lo, hi = int(first[at]), int(self.end[own[-1]])
            with np.errstate(over="ignore"):
                total = np.zeros(hi - lo + 1, np.uint64)
                np.cumsum(_BYTE[self.data[lo:hi]] * _UP[: hi - lo], out=total[1:])
                s = self.start[own] - lo
                out[own] = mix64((total[self.end[own] - lo] - total[s]) * _DOWN[s] + size[own].astype(np.uint64) * _MULT)
            at = to
        return out

    def joined(self, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets): each text's words, or those kept, joined by one space."""
        n_texts = len(self.text_at) - 1
        chosen = np.flatnonzero(keep) if keep is not None else np.arange(len(self.start))
        text = np.searchsorted(self.word_at, chosen, side="right") - 1
        # a word that is not the last chosen one of its text takes the white space behind it along
        more = np.zeros(len(chosen), bool)
        more[:-1] = text[1:] == text[:-1]
        edge = np.zeros(len(self.data) + 2, np.int8)
        edge[self.start[chosen]] += 1
        np.subtract.at(edge, self.end[chosen] + more, 1)
        stay = np.cumsum(edge[: len(self.data)], dtype=np.int8) > 0
        data = self.data.copy()
        data[self.end[chosen[more]]] = 0x20
        sizes = np.bincount(text, self.end[chosen] - self.start[chosen] + more, n_texts).astype(np.int64)
        return data[stay], np.concatenate(([0], np.cumsum(sizes)))


def words_in(data: np.ndarray, text_at: np.ndarray, lower: bool = False) -> Words:
    """data: bytes of texts that follow one another; text_at: their starts and the end, from 0."""
    if lower:
        data = _LOWER[data]
    inside = ~_IS_WHITE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[text_at] = True
    start = inside & cut[:-1]
    start[1:] |= inside[1:] & ~inside[:-1]
    end = inside & cut[1:]
    end[:-1] |= inside[:-1] & ~inside[1:]
    at = np.flatnonzero(start)
    return Words(data, text_at, at, np.flatnonzero(end) + 1, np.searchsorted(at, text_at))


def text_slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row behind the last, bytes, text_at) of slices of a string column; nulls count as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if not n:
        return
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + most, side="right")) - 1)
        yield lo, hi, raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        lo = hi


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive word hashes, in order; empty if there are fewer."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        acc = np.zeros(n, np.uint64)
        for i in range(k):
            acc = mix64(acc * _MULT + h[i : i + n])
    return acc


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the least value of every range of that width, the first of equal ones."""
    if len(values) < width:
        return np.empty(0, np.int64)
    place = np.arange(len(values))
    have = 1
    while have < width:
        step = min(have, width - have)
        a, b = place[: len(place) - step], place[step:]
        place = np.where(values[b] < values[a], b, a)
        have += step
    return place


def binary_column(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())


def list_column(flat: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column of consecutive stretches of flat."""
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, kind))
