"""Benchmark items found in documents by Wu-Manber search over words.

Words are runs of digits, letters and all characters beyond ASCII, after lower-casing A-Z. A window is ``width``
consecutive words of an item; an item of fewer words, but not none, is one window. All windows of one length are one
search: the block of the last two words looks up how far the search may move on (a shift table over hashed blocks);
where it is zero, the hash of the window's last words selects the test strings of a bucket, and those are compared
word by word. Words are numbered by the vocabulary of the items, so equal numbers are equal words.

Many stretches of the documents are searched side by side in numpy. The items are broadcast in blocks of at most about
``block_bytes`` of text. More than one block are searched one after another, each in a job of its own that leaves the
hits of the rows that have some; so the driver and every worker hold one block at a time, however many items there
are. The hits of all blocks are then united per row and joined to the rows by their place in a stored copy. Null texts and items have no words. Items without an id hit words, but aren't listed.
Rows that repeat an id are separate documents; an item id that repeats is one item with all the windows of its rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campaign_engine.llm.shared import ship, slices, stored

BLOCK_BYTES = 1 << 24
STRETCH = 512  # places that one cursor searches
SUFFIX = 4  # words of a window's end that select its bucket
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_RESULT = "n_words long, hits array<struct<first:long,last:long>>, items array<string>"


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts (large_string without nulls), and how many each has."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    blob = texts.buffers()[2]
    data = bytes(memoryview(blob)[offsets[0] : offsets[-1]]).translate(_TABLE) if blob is not None else b""
    plain = pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(offsets - offsets[0]), pa.py_buffer(data)])
    split = pc.ascii_split_whitespace(plain)
    each = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = split.flatten()
    some = pc.greater(pc.binary_length(flat), 0)
    kept = np.concatenate([[0], np.cumsum(some.to_numpy(zero_copy_only=False))])
    ends = np.cumsum(each)
    return flat.filter(some), kept[ends] - kept[ends - each]


class Search:
    """Windows of one length: shift table, buckets by suffix hash, and the windows themselves."""

    def __init__(self, windows: np.ndarray, owners: list[list]):
        self.windows, self.owners, self.length = windows, owners, windows.shape[1]
        self.block = min(2, self.length)
        self.bits = min(22, max(10, int(np.ceil(np.log2(windows.size + 1))) + 4))
        self.shift = np.full(1 << self.bits, self.length - self.block + 1, np.int16)
        for end in range(self.block - 1, self.length):
            hashed = self._hash(windows, np.full(len(windows), end), self.block, by_row=True)
            np.minimum.at(self.shift, hashed & ((1 << self.bits) - 1), self.length - 1 - end)
        suffix = self._hash(windows, np.full(len(windows), self.length - 1), min(SUFFIX, self.length), by_row=True)
        self.order = np.argsort(suffix, kind="stable")
        self.suffix = suffix[self.order]

    def _hash(self, words: np.ndarray, ends: np.ndarray, count: int, by_row: bool = False) -> np.ndarray:
        """Hash of the ``count`` words that end at each place (of each row)."""
        rows = (np.arange(len(words)),) if by_row else ()
        value = np.zeros(len(ends), np.int64)
        for k in range(count):
            value = (value * 1000003 + words[(*rows, ends - (count - 1 - k))]) & 0xFFFFFFFFFFF
            value ^= value >> 15
        return value

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(last place, window) of each occurrence in a sequence of word numbers."""
        last, mask = len(words) - 1, (1 << self.bits) - 1
        at = np.arange(self.length - 1, last + 1, STRETCH)
        stop = np.minimum(at + STRETCH, last + 1)
        candidates = []
        while len(at):
            move = self.shift[self._hash(words, at, self.block) & mask]
            candidates.append(at[move == 0])
            at = at + np.maximum(move, 1)
            live = at < stop
            at, stop = at[live], stop[live]
        ends = np.concatenate(candidates) if candidates else np.empty(0, np.int64)
        hashed = self._hash(words, ends, min(SUFFIX, self.length))
        low, high = np.searchsorted(self.suffix, hashed, "left"), np.searchsorted(self.suffix, hashed, "right")
        chosen = high > low
        ends, low, size = ends[chosen], low[chosen], (high - low)[chosen]
        out_end, out_window, part, steps = [], [], 0, np.cumsum(size)
        while part < len(ends):  # a bounded number of comparisons at once
            stop_part = max(part + 1, int(np.searchsorted(steps, (steps[part - 1] if part else 0) + (1 << 18))))
            n = size[part:stop_part]
            place = np.repeat(ends[part:stop_part], n)
            test = self.order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[part:stop_part], n)]
            same = (words[place[:, None] + np.arange(1 - self.length, 1)] == self.windows[test]).all(axis=1)
            out_end.append(place[same])
            out_window.append(test[same])
            part = stop_part
        empty = np.empty(0, np.int64)
        return np.concatenate(out_end or [empty]), np.concatenate(out_window or [empty])


class Items:
    """All windows of a block of items, ready to search."""

    def __init__(self, items: list[tuple], width: int):
        words, counts = words_of(pa.array([t or "" for _, t in items], pa.large_string()))
        self.vocabulary = words.unique()
        numbers = pc.index_in(words, self.vocabulary).to_numpy(zero_copy_only=False).astype(np.int32) + 1 if len(words) else np.empty(0, np.int32)
        found: dict[int, dict[bytes, set]] = {}
        for (item, _), end, count in zip(items, np.cumsum(counts).tolist(), counts.tolist()):
            length = min(width, count)
            for start in range(end - count, end - length + 1) if count else ():
                found.setdefault(length, {}).setdefault(numbers[start : start + length].tobytes(), set()).add(item)
        self.searches = [
            Search(np.array([np.frombuffer(k, np.int32) for k in keys]), [sorted(str(i) for i in owners if i is not None) for owners in keys.values()])
            for length, keys in sorted(found.items())
        ]

    def scan(self, texts: pa.Array) -> pa.Array:
        """For each text: its words, the hit ranges of words, and the items found."""
        words, counts = words_of(texts)
        n = len(counts)
        numbers = pc.index_in(words, self.vocabulary).fill_null(-1).to_numpy(zero_copy_only=False) + 1 if len(words) else np.empty(0, np.int32)
        ends = np.cumsum(counts)
        gaps = np.insert(numbers.astype(np.int32), ends, 0)  # a number of no word after each document
        doc_end = ends + np.arange(n)  # where those are
        cover = np.zeros(len(gaps) + 1, np.int32)
        items: dict[int, set] = {}
        for search in self.searches:
            last, window = search.find(gaps)
            np.add.at(cover, last - search.length + 1, 1)
            np.add.at(cover, last + 1, -1)
            doc = np.searchsorted(doc_end, last)
            for pair in np.unique(doc * len(search.owners) + window).tolist():
                items.setdefault(pair // len(search.owners), set()).update(search.owners[pair % len(search.owners)])
        hit = np.cumsum(cover[:-1]) > 0
        step = np.diff(hit.astype(np.int8), prepend=0, append=0)
        first, last = np.flatnonzero(step == 1), np.flatnonzero(step == -1) - 1
        doc = np.searchsorted(doc_end, first)
        base = (doc_end - counts)[doc] if len(doc) else doc
        ranges = pa.StructArray.from_arrays([pa.array(first - base), pa.array(last - base)], ["first", "last"])
        places = np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)
        names = pa.array([sorted(items.get(d, ())) for d in range(n)], pa.list_(pa.string()))
        return pa.StructArray.from_arrays(
            [pa.array(counts), pa.ListArray.from_arrays(pa.array(places), ranges), names], ["n_words", "hits", "items"]
        )


def _blocks(items: DataFrame, item_col: str, text_col: str, block_bytes: int) -> list[DataFrame]:
    """The items in parts of about ``block_bytes`` of text or less; repeated rows count once."""
    rows = items.select(F.col(item_col).alias("item"), F.col(text_col).alias("text")).filter("text is not null").distinct()
    size = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    parts = max(1, -(-2 * size // block_bytes)) if size > block_bytes else 1
    return [rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == p) for p in range(parts)]


def scanned(texts: Column, block: DataFrame, width: int) -> tuple[Column, Broadcast]:
    """What ``Items.scan`` finds of a block of items (collected here, of bounded size) in a text column."""
    search = block.sparkSession.sparkContext.broadcast([(r["item"], r["text"]) for r in block.collect()])

    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        items = Items(search.value, width)
        for batch in batches:
            parts = [items.scan(s) for s in slices(batch, 1 << 23)]
            yield pa.concat_arrays(parts) if parts else items.scan(batch.cast(pa.large_string()))

    return F.arrow_udf(scan, _RESULT)(texts), search


def _united(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Lists of results of one document, from all blocks, as one result."""
    for batch in batches:
        out = []
        for results in batch.to_pylist():
            spans = sorted((h["first"], h["last"]) for r in results for h in r["hits"])
            merged: list[list[int]] = []
            for first, last in spans:
                if merged and first <= merged[-1][1] + 1:
                    merged[-1][1] = max(merged[-1][1], last)
                else:
                    merged.append([first, last])
            names = sorted({i for r in results for i in r["items"]})
            out.append({"n_words": results[0]["n_words"], "hits": [{"first": f, "last": e} for f, e in merged], "items": names})
        yield pa.array(out, batch.type.value_type)


def found(
    docs: DataFrame, items: DataFrame, result: str = "found", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", width: int = 13, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with a column ``result``: struct of n_words, hits (ranges of hit words) and items (their ids, sorted)."""
    ship(docs.sparkSession)
    blocks = _blocks(items, item_col, item_text_col, block_bytes)
    if len(blocks) == 1:
        return docs.withColumn(result, scanned(F.col(text_col), blocks[0], width)[0])
    key = "own_row"
    while key in docs.columns:
        key += "_"
    rows = stored(docs.withColumn(key, F.monotonically_increasing_id()))
    each = []
    for i, block in enumerate(blocks):
        scan, sent = scanned(F.col(text_col), block, width)
        hits = rows.select(F.col(key).alias("own_key"), scan.alias("hit"))
        each.append(stored(hits if i == 0 else hits.filter(F.size("hit.hits") > 0)))  # the first one has every row's words
        sent.destroy()
    lists = reduce(DataFrame.unionByName, each).groupBy("own_key").agg(F.collect_list("hit").alias("hits"))
    united = lists.select("own_key", F.arrow_udf(_united, _RESULT)("hits").alias(result))
    return rows.join(united, F.col(key) == F.col("own_key")).select(*docs.columns, result)


def n_hit(result: str) -> Column:
    """Number of hit words."""
    return F.aggregate(f"{result}.hits", F.lit(0).cast("long"), lambda total, h: total + h["last"] - h["first"] + 1)


def contaminated(result: str) -> Column:
    """At least one word in twenty is hit."""
    return (n_hit(result) > 0) & (20 * n_hit(result) >= F.col(f"{result}.n_words"))


def report(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """(id_col, n_words, n_hit, n_items, items_sha256, contaminated) of each row."""
    rows = found(docs.select(F.col(id_col).alias("id"), F.col(options.get("text_col", "text")).alias("text")), items,
                 **{k: v for k, v in options.items() if k != "text_col"})
    return rows.select(
        F.col("id").alias(id_col), "found.n_words", n_hit("found").alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"), contaminated("found").alias("contaminated"),
    )


def digest(item_ids: list) -> str:
    """The items_sha256 of a list of ids."""
    return hashlib.sha256(",".join(sorted(map(str, item_ids))).encode()).hexdigest()


def clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated."""
    name = "_found"
    while name in docs.columns:
        name += "_"
    return found(docs, items, name, **options).filter(~contaminated(name)).drop(name)
