"""Plain versions of the operators, row by row, to compare with."""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")
ITEM_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def base_spans(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 32]
    return [f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found)]


def contamination(docs, items, width=13):
    """{doc: (n_words, n_hit, n_items, items_sha256, contaminated)}"""
    windows = defaultdict(lambda: defaultdict(set))
    for item, text in items:
        words = ITEM_WORD.findall(lower(text))
        n = min(width, len(words))
        for k in range(len(words) - n + 1 if words else 0):
            windows[n][tuple(words[k : k + n])].add(item)
    out = {}
    for doc, text in docs:
        words, hit, found = ITEM_WORD.findall(lower(text)), set(), set()
        for n, known in windows.items():
            for k in range(len(words) - n + 1):
                if owners := known.get(tuple(words[k : k + n])):
                    hit.update(range(k, k + n))
                    found |= owners
        names = sorted(str(i) for i in found if i is not None)
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        out[doc] = (len(words), len(hit), len(names), digest, bool(hit) and 20 * len(hit) >= len(words))
    return out


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0d]+", lower(text))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else ({tuple(words)} if words else set())


def near_groups(docs, n, percent=80):
    """{doc: (n_shingles, component)} of (doc, text) rows with distinct ids."""
    sets = [shingles(t, n) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, own in enumerate(sets):
        common = defaultdict(int)
        for s in own:
            for j in holders[s]:
                common[j] += 1
            holders[s].append(i)
        for j, k in common.items():
            if 100 * k >= percent * (len(own) + len(sets[j]) - k):
                parent[root(i)] = root(j)
    smallest = {}
    for i, (doc, _) in enumerate(docs):
        smallest[root(i)] = min(doc, smallest.get(root(i), doc))
    return {doc: (len(sets[i]), smallest[root(i)]) for i, (doc, _) in enumerate(docs)}


def _mix(x):
    x ^= x >> 33
    x = x * 0xFF51AFD7ED558CCD % 2**64
    x ^= x >> 33
    x = x * 0xC4CEB9FE1A85EC53 % 2**64
    return x ^ x >> 33


def _word_hash(word):
    """A polynomial of the word's bytes, its length added, mixed."""
    value = sum(_mix((b + 1) * 0xD6E8FEB86659FD93 % 2**64) * pow(0x9E3779B97F4A7C15, i, 2**64) for i, b in enumerate(word))
    return _mix((value + len(word) * 0xA0761D6478BD642F) % 2**64)


def features(text, model):
    """{index: value} of a text, from its words one by one."""
    step, mark, data = 0x9FB21C651E98DF25, 0x632BE59BD9B4E019, text.encode()
    letters = rb"[0-9A-Za-z\x80-\xff]+"
    lowered = data.lower()  # of bytes: A-Z alone
    if model.symbols:
        hashes = [_word_hash(w) for w in re.findall(letters + rb"|[^0-9A-Za-z\x80-\xff\t-\r ]+", data)]
        hashes = [mark if i and h == hashes[i - 1] else h for i, h in enumerate(hashes)]
    else:
        hashes = [_word_hash(w) for w in re.findall(letters, lowered)]
    found = []
    for n in range(1, model.grams + 1):
        for i in range(len(hashes) - n + 1):
            value = n
            for h in hashes[i : i + n]:
                value = (value * step + h) % 2**64
            found.append(value)
    for skip in model.skips:
        found += [(a * step + b + 97 + skip) % 2**64 for a, b in zip(hashes, hashes[skip + 1 :])]
    if model.stem:
        found += [_word_hash(w[: model.stem]) ^ mark for w in re.findall(letters, lowered)]
    counts = defaultdict(int)
    for value in found:
        counts[_mix(value) >> 64 - model.bits] += 1
    length = max(1.0, sum(c * c for c in counts.values()) ** 0.5)
    return {i: c / length if model.scaled else 1.0 for i, c in counts.items() if i} | {0: 1.0}


def ftrl(rows, model):
    """{index: weight} after the updates, one coordinate at a time; index 0 is the bias, without L1 and L2."""
    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        l1, l2 = (model.l1, model.l2) if i else (0.0, 0.0)
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - (l1 if z[i] > 0 else -l1)) / ((model.beta + n[i] ** 0.5) / model.alpha + l2)

    for _ in range(model.epochs):
        for own, label in rows:
            w = {i: weight(i) for i in own}
            p = 1 / (1 + math.exp(-max(-35, min(35, sum(w[i] * v for i, v in own.items())))))
            for i, v in own.items():
                g = (p - label) * v
                z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / model.alpha * w[i]
                n[i] += g * g
    return {i: weight(i) for i in z if i == 0 or abs(z[i]) > model.l1}
