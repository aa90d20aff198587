"""Token counts of texts under a unigram model, by dynamic programming over a trie of their pre-tokens.

The pieces of a sentencepiece file are the vocabulary; a piece's log probability comes from its rank by the fixed rule
-log(rank + 2). A text is split at ASCII white space and each word gets the mark of a word's begin. The best
segmentation of a word, the one of largest total score, is found from left to right; what it has at a place depends on
the word up to there alone. So the distinct words of a batch are walked in sorted order, which is the depth-first
order of their trie: scores of a shared prefix are computed once, and a word's end holds its count and score. A
character without a piece is one unknown token, scored below all pieces.

Counts of words that were seen before, in this worker, come from a bounded table. Null and empty texts have no tokens
and the score 0. Of equal scores, the segmentation whose last piece is longer counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campaign_engine.llm.shared import ship, slices

BEGIN = "▁"  # fixed value: mark of a word's begin in sentencepiece files
UNKNOWN_BELOW = 10.0  # fixed value: an unknown character scores so much less than the worst piece


def unigram_scores(path: str) -> dict[str, float]:
    """Log probability of every ordinary piece of a sentencepiece file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ordinary = [i for i in range(model.get_piece_size()) if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))]
    return {model.id_to_piece(i): -float(np.log(rank + 2.0)) for rank, i in enumerate(ordinary)}


class Trie:
    """Best scores and token counts of words, with a table of at most ``limit`` words."""

    def __init__(self, scores: dict[str, float], limit: int = 400_000):
        self.scores, self.limit = scores, limit
        self.longest = max(map(len, scores), default=1)
        self.unknown = min(scores.values(), default=0.0) - UNKNOWN_BELOW
        self.known: dict[str, tuple[int, float]] = {}

    def insert(self, words: list[str]) -> None:
        """Compute the terminals of new words, each distinct prefix once."""
        new = sorted(w for w in words if w not in self.known)
        if len(self.known) + len(new) > self.limit:
            self.known = {}
            new = sorted(words)
        get, longest, unknown = self.scores.get, self.longest, self.unknown
        score, count, path = [0.0, 0.0], [0, 0], ""
        first = get(BEGIN)
        score[1], count[1] = (unknown if first is None else first), 1
        for word in new:
            shared = 0
            for a, b in zip(word, path):
                if a != b:
                    break
                shared += 1
            del score[shared + 2 :], count[shared + 2 :]
            text = BEGIN + word
            for end in range(shared + 2, len(text) + 1):
                best, tokens = score[end - 1] + unknown, count[end - 1] + 1
                for start in range(end - 1, max(-1, end - longest - 1), -1):
                    own = get(text[start:end])
                    if own is not None and score[start] + own >= best:
                        best, tokens = score[start] + own, count[start] + 1
                score.append(best)
                count.append(tokens)
            path = word
            self.known[word] = (count[-1], score[-1])

    def totals(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and score of each text (large_string without nulls)."""
        chunks = pc.ascii_split_whitespace(texts)
        each = pc.list_value_length(chunks).to_numpy(zero_copy_only=False)
        seen = chunks.flatten().dictionary_encode()
        words = seen.dictionary.to_pylist()
        self.insert([w for w in words if w])
        known = self.known
        ends = [known[w] if w else (0, 0.0) for w in words]
        at = seen.indices.to_numpy() if len(seen) else np.empty(0, np.int64)
        stops = np.cumsum(each)
        out, some = [], each > 0
        for values in (np.array([c for c, _ in ends], np.int64), np.array([s for _, s in ends], np.float64)):
            sums = np.zeros(len(each), values.dtype)
            if some.any():  # each text is summed on its own, so its score doesn't depend on its neighbours
                sums[some] = np.add.reduceat(values[at], (stops - each)[some])
            out.append(sums)
        return out[0], out[1]


_TRIES: dict[str, Trie] = {}


def counted(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_tokens, score) of each row; ``path``: a sentencepiece file, present wherever tasks run."""
    ship(docs.sparkSession)

    def totals(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if path not in _TRIES:
            _TRIES[path] = Trie(unigram_scores(path))
        for batch in batches:
            parts = [_TRIES[path].totals(s) for s in slices(batch, 1 << 23)]
            yield pa.StructArray.from_arrays(
                [pa.array(np.concatenate([p[0] for p in parts] or [np.empty(0)]).astype(np.int64)),
                 pa.array(np.concatenate([p[1] for p in parts] or [np.empty(0)]).astype(np.float64))],
                ["n_tokens", "score"],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.arrow_udf(totals, "n_tokens long, score double")(F.col(text_col)).alias("t"))
    return rows.select(F.col("id").alias(id_col), "t.n_tokens", "t.score")
