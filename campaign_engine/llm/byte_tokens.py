"""Token ids of whole texts by a byte-level tokenizers file, merged by tiktoken where both are known to agree.

A file qualifies if it splits by the byte-level pattern without a prefix space, normalizes nothing, and numbers its
merges in the order of their ranks. Texts that hold the string of an added token go through the tokenizers library, as
do those of all other files.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from tokenizers import Tokenizer

from campaign_engine.llm.tokens import TextTokens, loaded

# The pattern by which byte-level files split, and settings that change nothing there.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NEUTRAL = {"dropout": (None,), "unk_token": (None,), "continuing_subword_prefix": (None, ""), "end_of_word_suffix": (None, ""),
           "fuse_unk": (None, False), "byte_fallback": (None, False), "ignore_merges": (None, False)}


def letters_of_bytes() -> dict[str, int]:
    """The letters that stand for bytes in byte-level files: printable ones for themselves, others from 256 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    others = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


def ranks_of(parts: dict) -> dict[bytes, int] | None:
    """Ranks of all tokens of a byte-level file by their bytes; None if the file doesn't qualify."""
    model, split = parts["model"], parts.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or parts.get("normalizer") is not None or split.get("type") != "ByteLevel":
        return None
    if split.get("add_prefix_space") or not split.get("use_regex", True) or any(model.get(k) not in v for k, v in NEUTRAL.items()):
        return None
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in parts["added_tokens"]):
        return None
    letters, vocabulary = letters_of_bytes(), dict(model["vocab"])
    for token in parts["added_tokens"]:
        vocabulary.pop(token["content"], None)
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [vocabulary.get(a + b) for a, b in pairs]
    in_order = None not in made and all(a < b for a, b in zip(made, made[1:]))
    if not in_order or len(vocabulary) != 256 + len(made) or any(c not in letters for t in vocabulary for c in t):
        return None
    return {bytes(letters[c] for c in token): number for token, number in vocabulary.items()}


class ByteTokens:
    """Encoder of one byte-level file."""

    def __init__(self, path: str, parts: dict, ranks: dict[bytes, int]):
        self.full = Tokenizer.from_file(path)
        self.added = [t["content"] for t in parts["added_tokens"]]
        self.merges = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null: empty) one after another, and how many each text has."""
        texts = texts.cast(pa.large_string()).fill_null("")
        special = np.zeros(len(texts), bool)
        for content in self.added:
            special |= pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
        found = [self._library(t) if s else self._one(t) for t, s in zip(texts.to_pylist(), special.tolist())]
        return np.concatenate(found or [np.empty(0, np.int32)]), np.array([len(f) for f in found], np.int64)

    def _one(self, text: str) -> np.ndarray:
        try:
            return self.merges.encode_to_numpy(text, disallowed_special=()).astype(np.int32)
        except (ValueError, RuntimeError):  # its pattern gives up on very long runs of white space
            return self._library(text)

    def _library(self, text: str) -> np.ndarray:
        return np.array(self.full.encode(text, add_special_tokens=False).ids, np.int32)


_ENCODERS: dict[str, ByteTokens | TextTokens] = {}


def encoder(path: str) -> ByteTokens | TextTokens:
    """The encoder of this worker process for a file."""
    if path not in _ENCODERS:
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        ranks = ranks_of(parts)
        _ENCODERS[path] = loaded(path) if ranks is None else ByteTokens(path, parts, ranks)
    return _ENCODERS[path]
