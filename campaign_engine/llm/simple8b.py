"""Simple-8b: integers packed into 64-bit words, with raw escapes and the place of every block of 1024 integers.

The high four bits of a word select how many integers of how many bits the other 60 hold; each word takes as many of
the next integers of its block as fit. Selector 15 stands for one integer of more than 30 bits (or one before such),
which lies among the block's escapes. Because each block's first word and escape are known, all words decode at once.
"""

from __future__ import annotations

import numpy as np

BLOCK = 1024
# Integers in a word, and bits of each, by selector.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 64])
ESCAPE = 15


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words uint64, escapes uint64, places uint32 of shape (blocks, 2): first word and first escape of each block)."""
    n = len(values)
    blocks, wide = -(-n // BLOCK), BLOCK + 256
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty((0, 2), np.uint32)
    table = np.zeros((blocks, wide), np.uint64)
    padded = np.zeros(blocks * BLOCK, np.uint64)
    padded[:n] = values
    table[:, :BLOCK] = padded.reshape(blocks, BLOCK)
    need = np.minimum(np.frexp(table.astype(np.float64))[1], 31).astype(np.uint8)
    largest = {1: need}  # of so many integers from each place on
    for k in (1, 2, 4, 8, 16, 32, 64):
        x = largest[k]
        largest[2 * k] = x.copy()
        np.maximum(x[:, :-k], x[:, k:], out=largest[2 * k][:, :-k])
    choice = np.full((blocks, BLOCK), ESCAPE, np.uint8)
    for s in range(ESCAPE - 1, -1, -1):
        count = int(COUNTS[s])
        k = 1 << (count.bit_length() - 1)
        top = np.maximum(largest[k][:, :BLOCK], largest[k][:, count - k : count - k + BLOCK])
        choice[top <= BITS[s]] = s
    size = np.full(blocks, BLOCK)
    size[-1] = n - (blocks - 1) * BLOCK
    at, live, found = np.zeros(blocks, np.int64), np.arange(blocks), []
    while len(live):
        own = choice[live, at[live]]
        found.append((live, at[live], own))
        at[live] += COUNTS[own]
        live = live[at[live] < size[live]]
    block, place, chosen = (np.concatenate([f[i] for f in found]) for i in range(3))
    order = np.argsort(block, kind="stable")
    block, place, chosen = block[order], place[order], chosen[order]
    flat, base = table.reshape(-1), block * wide + place
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s in range(2, ESCAPE):
        rows = np.flatnonzero(chosen == s)
        for i in range(int(COUNTS[s]) if len(rows) else 0):
            words[rows] |= flat[base[rows] + i] << np.uint64(i * BITS[s])
    escaped = chosen == ESCAPE
    first = np.searchsorted(block, np.arange(blocks))
    places = np.stack([first, np.concatenate([[0], np.cumsum(escaped)])[first]], axis=1)
    return words, flat[base[escaped]], places.astype(np.uint32)


def decode(words: np.ndarray, escapes: np.ndarray, places: np.ndarray, n: int) -> np.ndarray:
    """The n integers (uint64)."""
    out = np.empty(n, np.uint64)
    if not n:
        return out
    chosen = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[chosen]
    before = np.concatenate([[0], np.cumsum(counts)])[:-1]
    first = places[:, 0].astype(np.int64)
    block = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(words))))
    start = before - before[first][block] + block * BLOCK
    end = np.minimum((block + 1) * BLOCK, n)
    for s in range(ESCAPE):
        rows = np.flatnonzero(chosen == s)
        mask = np.uint64((1 << int(BITS[s])) - 1)
        for i in range(int(COUNTS[s]) if len(rows) else 0):
            to = start[rows] + i
            fits = to < end[rows]
            out[to[fits]] = (words[rows[fits]] >> np.uint64(i * BITS[s])) & mask
    out[start[chosen == ESCAPE]] = escapes
    return out
