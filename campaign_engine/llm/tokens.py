"""Token ids of whole texts by a tokenizers file, with the work done once for each distinct chunk of a batch.

Tokenizers that drop white space encode each chunk between white space on its own, so a text's ids are those of its
chunks one after another. Chunks that were seen before, in this worker, come from a bounded table. Plain chunks
(ASCII and Latin letters, no "<", which begins special tokens) are lower-cased and split here and only merged by the library; all others go through the
whole tokenizer. Other tokenizers encode whole texts. Null texts have no ids.
"""

from __future__ import annotations

import json
import os
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
from tokenizers import Tokenizer  # noqa: E402

DROPS_SPACE = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pattern": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+",
}  # fixed values: the parts of a tokenizer for which the short way is exact
_PIECES = regex.compile(DROPS_SPACE["pattern"] + "|\n")
_PLAIN = regex.compile("[\x21-\x7e¡-¬®-įı-ňŊ-ž]+")
_WORD_END = "</w>"


def gathered(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """flat[s : s + c] for each start and count, one after another."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - counts), counts) + np.arange(total)]


class TextTokens:
    """Encoder with a table of at most ``limit`` chunks (beyond it the table starts anew)."""

    def __init__(self, path: str, limit: int = 800_000):
        self.full, self.limit = Tokenizer.from_file(path), limit
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        split = (parts.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.by_chunk = (
            parts.get("normalizer") == DROPS_SPACE["normalizer"]
            and split[0].get("pattern", {}).get("Regex") == DROPS_SPACE["pattern"]
            and split[0].get("behavior") == "Removed" and split[0].get("invert") is True
            and [s.get("type") for s in split[1:]] == ["ByteLevel"]
            and parts["model"].get("end_of_word_suffix") == _WORD_END
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in parts["added_tokens"])
            and all(t["content"].startswith("<") for t in parts["added_tokens"])
        )
        if self.by_chunk:
            at_space = {"type": "Split", "pattern": {"String": " "}, "behavior": "Removed", "invert": False}
            parts |= {"normalizer": None, "added_tokens": [], "pre_tokenizer": {"type": "Sequence", "pretokenizers": [at_space, *split[1:]]}}
            self.merges = Tokenizer.from_str(json.dumps(parts))
            vocabulary = parts["model"]["vocab"]
            self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends_word[[i for token, i in vocabulary.items() if token.endswith(_WORD_END)]] = True
        self._forget()

    def _forget(self) -> None:
        self.codes: dict[str, int] = {}
        self.flat, self.starts, self.counts = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each text has."""
        texts = texts.cast(pa.large_string()).fill_null("")
        if not self.by_chunk:
            return self._whole(texts.to_pylist())
        if not pc.any(pc.match_substring(texts, "<")).as_py():  # else lower case could make a special token
            texts = pc.ascii_lower(texts)
        chunks = pc.ascii_split_whitespace(texts)
        each = pc.list_value_length(chunks).to_numpy(zero_copy_only=False)
        seen = chunks.flatten().dictionary_encode()
        codes = self._codes(seen.dictionary.to_pylist())[seen.indices.to_numpy()] if len(seen) else np.empty(0, np.int64)
        counts = self.counts[codes]
        before = np.concatenate([[0], np.cumsum(counts)])
        ends = np.cumsum(each)
        return gathered(self.flat, self.starts[codes], counts), before[ends] - before[ends - each]

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [np.array(e.ids, np.int32) for e in self.full.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate(found or [np.empty(0, np.int32)]), np.array([len(f) for f in found], np.int64)

    def _codes(self, chunks: list[str]) -> np.ndarray:
        """Numbers of distinct chunks in the table, which gets those it lacks."""
        if len(self.codes) + len(chunks) > self.limit:
            self._forget()
        found = np.fromiter(map(self.codes.get, chunks, repeat(-1)), np.int64, len(chunks))
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new = [chunks[i] for i in missing]
            plain = np.array([(c.isascii() and c.isprintable() or _PLAIN.fullmatch(c) is not None) and "<" not in c for c in new])
            for place, encode in ((np.flatnonzero(plain), self._merged), (np.flatnonzero(~plain), self._whole)):
                names = [new[i] for i in place]
                ids, counts = encode(names)
                numbers = np.arange(len(self.codes), len(self.codes) + len(names))
                self.codes.update(zip(names, numbers.tolist()))
                found[missing[place]] = numbers
                self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(counts) - counts])
                self.counts = np.concatenate([self.counts, counts])
                self.flat = np.concatenate([self.flat, ids])
        return found

    def _merged(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts = _PIECES.findall("".join(c.lower() + "\n" for c in chunks))
        number = {p: i for i, p in enumerate(dict.fromkeys(parts)) if p != "\n"}
        number = {p: i for i, p in enumerate(number)}
        words, group = list(number), 1000
        joined = [" ".join(words[i : i + group]) for i in range(0, len(words), group)]
        ids = [np.array(e.ids, np.int32) for e in self.merges.encode_batch_fast(joined, add_special_tokens=False)]
        flat = np.concatenate(ids or [np.empty(0, np.int32)])
        stop = np.flatnonzero(self.ends_word[flat]) + 1
        assert len(stop) == len(words), "each word has one last token"
        start = np.concatenate([[0], stop[:-1]]).astype(np.int64) if len(stop) else stop
        number["\n"] = -1
        order = np.fromiter(map(number.__getitem__, parts), np.int64, len(parts))
        line = order == -1
        size = np.where(line, 0, (stop - start)[order] if len(stop) else 0)
        before = np.concatenate([[0], np.cumsum(size)])
        borders = np.flatnonzero(line)
        counts = np.diff(before[borders], prepend=0)
        use = order[~line]
        return gathered(flat, start[use], (stop - start)[use]), counts


_LOADED: dict[tuple[str, int], TextTokens] = {}


def loaded(path: str, limit: int = 800_000) -> TextTokens:
    """The encoder of this worker process for a file, with a table of at most ``limit`` chunks (about 150 bytes each)."""
    if (path, limit) not in _LOADED:
        _LOADED[path, limit] = TextTokens(path, limit)
    return _LOADED[path, limit]
