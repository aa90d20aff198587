"""Words of a batch of texts as positions and 64-bit hashes, without a Python object for each word."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SPACES = (9, 10, 11, 12, 13, 32)


@dataclass
class Words:
    """``hashes`` and ``begin`` (place of the first byte): one for each word; ``ends[d - 1] : ends[d]`` are those of text d."""

    hashes: np.ndarray
    ends: np.ndarray
    begin: np.ndarray

    def start(self) -> np.ndarray:
        return np.concatenate([[0], self.ends[:-1]]).astype(np.int64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (a finalizer of multiplications and shifts)."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    np.multiply.accumulate(out, out=out)
    return out


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_LETTERS = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def hashed_words(texts: pa.Array, lower: bool = True, word_bytes: np.ndarray | None = None, head: int = 0) -> Words:
    """Words of each text (a large_string array without nulls): runs of ``word_bytes``, else of all but white space.

    With ``head``, of each word only so many first bytes are hashed.

    The hash of a word is a polynomial of its bytes modulo 2^64, from differences of one running sum, then mixed.
    """
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    blob = texts.buffers()[2]
    raw = bytes(memoryview(blob)[offsets[0] : offsets[-1]]) if blob is not None else b""
    data = np.frombuffer(raw.translate(LOWER) if lower else raw, np.uint8)
    at = offsets - offsets[0]
    if word_bytes is None:
        word_bytes = np.ones(256, bool)
        word_bytes[list(SPACES)] = False
    inside = word_bytes[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts_of_texts = at[:-1][at[:-1] < len(data)]
    first[starts_of_texts] = inside[starts_of_texts]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends_of_texts = at[1:][at[1:] > 0] - 1
    last[ends_of_texts] = inside[ends_of_texts]
    begin, end = np.flatnonzero(first), np.flatnonzero(last)
    sums = np.zeros(len(data) + 1, np.uint64)
    for s in range(0, len(data), 1 << 20):  # powers start anew in each part, so they are made once
        part = _LETTERS[data[s : s + (1 << 20)]]
        np.multiply(part, _power_table()[0][: len(part)], out=part)
        sums[s + 1 : s + 1 + len(part)] = part
    hashes = np.empty(len(begin), np.uint64)
    if head:
        end = np.minimum(end, begin + head - 1)
    if len(begin):
        _hash_spans(sums, begin, end, hashes)
    return Words(hashes, np.searchsorted(begin, at[1:]), begin)


_TABLE: list[np.ndarray] = []


def _power_table() -> list[np.ndarray]:
    if not _TABLE:
        _TABLE.extend([_powers(1 << 20, _BASE), _powers(1 << 20, _INVERSE)])
    return _TABLE


def _hash_spans(sums: np.ndarray, begin: np.ndarray, end: np.ndarray, out: np.ndarray) -> None:
    """Words that cross a border of parts have terms of two scales; those are summed up part by part."""
    size = 1 << 20
    total = np.cumsum(sums, out=sums)
    down = _power_table()[1]
    whole = (begin // size) == (end // size)
    out[:] = total[end + 1] - total[begin]
    out *= down[begin % size]
    for i in np.flatnonzero(~whole):
        value, power, b = 0, 1, int(begin[i])
        while b <= end[i]:
            e = min(int(end[i]), (b // size + 1) * size - 1)
            part = (int(total[e + 1]) - int(total[b])) * int(down[b % size]) % (1 << 64)
            value = (value + part * power) % (1 << 64)
            power = power * pow(_BASE, e + 1 - b, 1 << 64) % (1 << 64)
            b = e + 1
        out[i] = value
    out += (end - begin + 1).astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
    out[:] = mixed(out)
