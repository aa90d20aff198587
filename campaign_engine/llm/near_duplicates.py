"""Near-duplicate groups of documents by circulant MinHash, banding and exact Jaccard similarity.

Texts are lower-cased (A-Z) and split at ASCII white space; a document's set holds its distinct shingles of
``shingle`` words (a shorter, not empty document: its whole sequence). Documents are linked if
100 * intersection >= percent * union; groups are the connected components of the links.

* Two permutations make all signature coordinates: the first scatters the shingles, the second is read at places
  shifted by 0, 1, 2, ... around the circle. Both are bijections of the 32-bit numbers.
* Exact copies are one class from the start. Classes that share a bucket of a band are candidates. Each is compared
  with one representative of the bucket; then those that a bucket still holds in several components are compared
  across components in bounded blocks, by signature, then by sets; one link of a row with each other component is
  enough there. All links are confirmed on the full sets of shingles.
* Two documents at the threshold itself share no bucket with probability (1 - 0.8^rows)^bands (6e-5 by default).

Null and empty texts have no shingles and no links. Rows without an id link like others, but their id never names a
component; a component without any id has the null id. Rows that repeat id and text get the same result.
``deduplicated`` keeps one row of each component: the one of the smallest id (rows without an id come last), and of the
smallest text hash where that id has several texts of the component. An id may so keep several texts that aren't linked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campaign_engine.llm.shared import components, lookup, ship, slices, stored
from campaign_engine.llm.words import LOWER, hashed_words

BANDS, ROWS = 32, 6
BLOCK = 512  # rows that are compared with as many others at once
FAN = 500  # pairs with one representative in a task
_FEATURES = "shingles long, bands array<long>, signature binary"


def scattered(x: np.ndarray) -> np.ndarray:
    """First permutation of the 32-bit numbers."""
    x = x ^ (x >> np.uint32(16))
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def circulant(x: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Signatures (sets x size) of scattered 32-bit numbers; ``starts``: where each set, none empty, begins in x."""
    out = np.empty((size, len(starts)), np.uint32)
    part = 1 << 15
    cuts = [0]
    while cuts[-1] < len(starts):  # whole sets of about so many numbers, which stay in the processor's cache
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(starts, starts[cuts[-1]] + part))))
    for a, b in zip(cuts, cuts[1:]):
        low, high = starts[a], starts[b] if b < len(starts) else len(x)
        own, begin = x[low:high], starts[a:b] - low
        y, t = np.empty_like(own), np.empty_like(own)
        for k in range(size):
            np.add(own, np.uint32(k), out=y)  # the second permutation, read k places further around
            np.right_shift(y, np.uint32(16), out=t)
            np.bitwise_xor(y, t, out=y)
            np.multiply(y, np.uint32(0x7FEB352D), out=y)
            np.right_shift(y, np.uint32(15), out=t)
            np.bitwise_xor(y, t, out=y)
            np.multiply(y, np.uint32(0x846CA68B), out=y)
            out[k, a:b] = np.minimum.reduceat(y, begin)
    return out.T


def distinct_shingles(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each text, and their number in each text."""
    found = hashed_words(texts)
    begin, count = found.start(), np.diff(found.ends, prepend=0)
    n = np.where(count >= words, count - words + 1, np.minimum(count, 1))
    doc = np.repeat(np.arange(len(count)), n)
    place = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n) + begin[doc]
    left = np.minimum(count[doc], words)
    hashes = np.zeros(len(doc), np.uint64)
    for i in range(words):
        part = left > i
        hashes[part] = hashes[part] * np.uint64(0x9FB21C651E98DF25) + found.hashes[place[part] + i]
    hashes ^= hashes >> np.uint64(32)
    hashes *= np.uint64(0xD6E8FEB86659FD93)
    ends = np.cumsum(n)
    sets = [np.unique(hashes[e - k : e]) for e, k in zip(ends, n)]
    return (np.concatenate(sets) if sets else hashes), np.array([len(s) for s in sets], np.int64)


def _features(words: int, bands: int, rows: int) -> Callable[[Column], Column]:
    def features(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [_of_slice(s) for s in slices(batch, 1 << 20)]
            yield pa.concat_arrays(parts) if parts else _of_slice(batch.cast(pa.large_string()))

    def _of_slice(texts: pa.Array) -> pa.Array:
        hashes, n = distinct_shingles(texts, words)
        some = n > 0
        starts = (np.cumsum(n) - n)[some]
        x = scattered((hashes ^ (hashes >> np.uint64(32))).astype(np.uint32))
        signs = circulant(x, starts, bands * rows) if len(starts) else np.empty((0, bands * rows), np.uint32)
        keys = np.zeros((len(signs), bands), np.uint64)
        for r in range(rows):
            keys = keys * np.uint64(0x9E3779B97F4A7C15) + signs[:, r::rows]
            keys ^= keys >> np.uint64(29)
            keys *= np.uint64(0xBF58476D1CE4E5B9)
        keys += np.arange(bands, dtype=np.uint64) * np.uint64(0x94D049BB133111EB)
        keys ^= keys >> np.uint64(31)
        low = np.ascontiguousarray((signs ^ (signs >> np.uint32(16))).astype(np.uint8))
        each = np.where(some, bands, 0)
        offsets = np.concatenate([[0], np.cumsum(each)]).astype(np.int32)
        where = np.full(len(n), -1)
        where[some] = np.arange(len(signs))
        return pa.StructArray.from_arrays(
            [
                pa.array(n),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.reshape(-1).view(np.int64))),
                pa.array([low[i].tobytes() if i >= 0 else b"" for i in where], pa.binary()),
            ],
            ["shingles", "bands", "signature"],
        )

    return F.arrow_udf(features, _FEATURES)


def shingle_set(text: str, words: int) -> set:
    parts = text.encode().translate(LOWER).split()
    return set(zip(*(parts[i:] for i in range(words)))) if len(parts) >= words else ({tuple(parts)} if parts else set())


def _linked(words: int, percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b_id, b_set = None, set()
        for batch in batches:
            keep = []
            for i, (a_text, b, b_text) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("a_text", "b", "b_text")))):
                if b != b_id:
                    b_id, b_set = b, shingle_set(b_text, words)
                a_set = shingle_set(a_text, words)
                same = len(a_set & b_set)
                if 100 * same >= percent * (len(a_set) + len(b_set) - same):
                    keep.append(i)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return confirm


def _confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b, n) that are links. Pairs of a frequent b, of which up to n are expected, are dealt over tasks."""
    pairs = pairs.withColumn("salt", F.expr(f"pmod(xxhash64(a), int(ceil(n / {FAN})))"))
    sides = pairs.select("b", "salt").distinct().join(texts.select(F.col("node").alias("b"), F.col("text").alias("b_text")), "b")
    left = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("a_text")), "a")
    both = left.join(sides, ["b", "salt"]).select("a", "b", "a_text", "b_text")
    return both.mapInArrow(_linked(words, percent), "a long, b long")


def _facing(table: pa.Table, size: int, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, other rows) of a block: rows of other components whose signatures agree about as often as linked ones do,
    where no earlier band already holds both."""
    share = percent / 100
    least = size * share - 4.5 * np.sqrt(size * share * (1 - share))
    label, side = (table.column(c).to_numpy() for c in ("label", "side"))
    signs = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint8).reshape(len(label), size)
    keys = table.column("bands").combine_chunks().flatten().to_numpy().reshape(len(label), -1)
    band = int(np.argmax(keys[0] == table.column("key")[0].as_py()))
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    for i in left:
        others = right if len(right) else left[left > i]
        others = others[label[others] != label[i]]
        others = others[np.count_nonzero(signs[others] == signs[i], axis=1) >= least]
        yield i, others[~(keys[others, :band] == keys[i, :band]).any(axis=1)]


def _worth(size: int, percent: int):
    """The rows of a block that face any other."""

    def select(table: pa.Table) -> pa.Table:
        keep = np.zeros(table.num_rows, bool)
        for i, others in _facing(table, size, percent):
            keep[others] = True
            keep[i] |= len(others) > 0
        return table.filter(pa.array(keep))

    return select


def _across(size: int, words: int, percent: int):
    """Links of a block across components: of each row and each other component, the closest by hashed shingles."""

    def compare(table: pa.Table) -> pa.Table:
        node, label = table.column("node").to_numpy(), table.column("label").to_numpy()
        texts, sets = table.column("text"), {}

        def of(row: int) -> np.ndarray:  # sorted hashes: a tenth of the memory of a set of numbers
            if row not in sets:
                sets[row] = distinct_shingles(pa.array([texts[row].as_py()], pa.large_string()), words)[0]
            return sets[row]

        out = []
        for i, others in _facing(table, size, percent):
            best: dict[int, tuple[float, int]] = {}
            for j in others.tolist():
                same = len(np.intersect1d(of(i), of(j), assume_unique=True))
                union = len(of(i)) + len(of(j)) - same
                if 100 * same >= percent * union:
                    best[label[j]] = max(best.get(label[j], (-1.0, -1)), (same / union, int(node[j])))
            out.extend((int(node[i]), other) for _, other in best.values())
        a, b = (np.array([p[k] for p in out], np.int64) for k in (0, 1))
        return pa.table({"a": a, "b": b, "n": np.full(len(a), table.num_rows, np.int64)})

    return compare


def _print(text_col: str) -> Column:
    return F.md5(F.coalesce(F.col(text_col), F.lit("")))


def _grouped(
    docs: DataFrame, id_col: str, text_col: str, shingle: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """(id, print, shingles, component_id, chosen) for each row; chosen: the row's text is the one its component keeps."""
    ship(docs.sparkSession)
    read = docs.select(F.col(id_col).alias("id"), _print(text_col).alias("print"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    made = read.select("id", "print", _features(shingle, bands, rows)("text").alias("f")).select("id", "print", "f.*")
    classes = stored(
        made.groupBy("print").agg(
            F.min("id").alias("first_id"), F.count("*").alias("copies"), F.first("shingles").alias("shingles"),
            F.first("bands").alias("bands"), F.first("signature").alias("signature"),
        ).withColumn("node", F.monotonically_increasing_id())
    )
    members = classes.select("node", F.explode("bands").alias("key"))
    buckets = stored(members.groupBy("key").agg(F.min("node").alias("rep"), F.count("*").alias("n")).filter("n > 1"))
    shared = stored(lookup(members, buckets, "key", "n"))
    needed = shared.select("node").distinct().join(classes.select("node", "first_id", "print"), "node")
    same = needed["first_id"].eqNullSafe(read["id"]) & (needed["print"] == read["print"])
    texts = stored(needed.join(read, same).select("node", "text").dropDuplicates(["node"]))

    stars = shared.filter("node <> rep").groupBy(F.col("node").alias("a"), F.col("rep").alias("b")).agg(F.max("n").alias("n"))
    links = stored(_confirmed(stars, texts, shingle, percent))
    first = stored(components(links))

    labelled = stored(
        shared.filter("n > 2").join(first, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
    )
    sizes = labelled.groupBy("key", "label").agg(F.count("*").alias("c")).groupBy("key").agg(
        F.max_by("label", F.struct("c", "label")).alias("main"), F.max("c").alias("mains"), F.sum("c").alias("many")
    ).filter("mains < many")
    split = lookup(labelled, stored(sizes), "key", "many").withColumns(
        {"stray": F.col("label") != F.col("main"), "c": F.expr(f"int(ceil(mains / {BLOCK}))"), "s": F.expr(f"int(ceil((many - mains) / {BLOCK}))")}
    ).withColumn("own", F.expr("pmod(xxhash64(node), if(stray, s, c))"))
    # blocks: strays i with strays j (kind 1, i <= j), or main rows i with strays j (kind 0)
    with_main = split.select(
        "*", F.explode(F.expr("if(stray, sequence(0, c - 1), sequence(0, s - 1))")).alias("o"), F.lit(0).alias("kind")
    ).withColumns({"i": F.expr("if(stray, o, own)"), "j": F.expr("if(stray, own, o)"), "side": F.expr("int(stray)")})
    with_strays = split.filter("stray").select("*", F.explode(F.expr("sequence(0, s - 1)")).alias("o"), F.lit(1).alias("kind")).withColumns(
        {"i": F.least("o", "own"), "j": F.greatest("o", "own"), "side": F.expr("int(own > o)")}
    )
    blocks = with_main.unionByName(with_strays).join(classes.select("node", "signature", "bands"), "node")
    parts = ["key", "kind", "i", "j"]
    blocks = blocks.select(*parts, "node", "label", "side", "signature", "bands")
    facing = blocks.groupBy(*parts).applyInArrow(_worth(bands * rows, percent), blocks.schema)
    cross = facing.join(texts, "node").groupBy(*parts).applyInArrow(
        _across(bands * rows, shingle, percent), "a long, b long, n long"
    )
    pairs = stored(cross.groupBy(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).agg(F.max("n").alias("n")))
    more = stored(_confirmed(pairs, texts, shingle, percent))
    stars_of_first = first.select(F.col("node").alias("a"), F.col("label").alias("b"))
    labels = first if more.isEmpty() else stored(components(stars_of_first.unionByName(more)))

    named = classes.select("node", "print", "first_id", "copies", "shingles").join(labels, "node", "left").withColumn(
        "label", F.coalesce("label", "node")
    )
    named = stored(named)
    best = F.min(F.struct(F.col("first_id").isNull(), F.col("first_id").alias("id"), F.col("print").alias("text")))
    smallest = stored(named.groupBy("label").agg(best.alias("best"), F.count("*").alias("n")))
    result = stored(lookup(named, smallest, "label", "n").select(
        "print", "copies", "shingles", F.col("best.id").alias("component_id"), (F.col("print") == F.col("best.text")).alias("chosen")
    ))
    joined = lookup(read.select("id", "print"), result, "print", "copies")
    own = F.when(F.col("shingles") > 0, F.col("component_id")).otherwise(F.col("id"))
    return joined.select("id", "print", "shingles", own.alias("component_id"), (F.col("chosen") | (F.col("shingles") == 0)).alias("chosen"))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id_col, n_shingles, component_id, kept) for each row; kept: the row has its component's id."""
    return _grouped(docs, id_col, text_col, **options).select(
        F.col("id").alias(id_col), F.col("shingles").alias("n_shingles"), "component_id",
        F.col("component_id").eqNullSafe(F.col("id")).alias("kept"),
    )


def _row_key(row_id: Column, text_print: Column) -> Column:
    """Id and text hash as one text, which is never null; rows with the same one are the same document."""
    return F.concat_ws("|", row_id.cast("string"), text_print)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of ``docs`` for each component (see above); of rows that repeat id and text, the one with the smallest
    hash. Texts without shingles have no component: each stays, once for its id."""
    kept = F.col("chosen") & F.col("component_id").eqNullSafe(F.col("id"))
    gone = _grouped(docs, id_col, text_col, **options).filter(~kept).select(_row_key(F.col("id"), F.col("print")).alias("document_key"))
    hashed = [c for c, kind in docs.dtypes if "map<" not in kind]  # maps have no hash
    one = F.min_by(F.struct(*docs.columns), F.xxhash64(*hashed)).alias("row")
    rows = docs.groupBy(_row_key(F.col(id_col), _print(text_col)).alias("document_key")).agg(one)  # repeats end before the shuffle
    return rows.join(gone.distinct(), "document_key", "left_anti").select("row.*")
