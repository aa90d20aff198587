"""Documents as token ids packed into sequences with next to no padding: cutting stock by column generation.

A document is its ids and an end id. Sequences hold at most ``size`` tokens; one of a power of two tokens needs no
padding, others are padded to ``size``. Documents longer than that are cut into pieces of full length and a rest.

* What is planned is the histogram of the pieces' lengths: at most ``size`` counts, however many documents there are.
* A pattern says how many pieces of each length a sequence holds. A linear program over patterns takes every length as
  often as it occurs with the least padding. Its columns are generated: for the dual prices of a solution, a knapsack's
  dynamic program over the fills gives, for each length, the pattern worth most above its padding that holds it.
* The counts of patterns are rounded down. What is left of each length is put into whole patterns again, exactly filled
  ones found by subset sums, as far as that goes.
* What no pattern without padding takes runs on from sequence to sequence and is cut where a sequence ends; the last of
  these is cut into powers of two. So nothing is padded, and cuts beyond the full pieces are as many as such sequences.
* Pieces are ranked within their length, by counts of their block and of the blocks before, never gathered. A rank is
  a place by arithmetic on the plan, whose size depends on ``size`` alone.

Null and empty texts are an end id alone. Rows that repeat an id are packed as separate documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from campaign_engine.llm.byte_tokens import encoder
from campaign_engine.llm.shared import ship, slices, stored
from campaign_engine.llm.token_files import with_end

TOLERANCE = 1e-3  # a plan's padding, as a share of all tokens, below which no better one is sought
PIVOTS = 400


def padding(fill: np.ndarray | int, size: int) -> np.ndarray:
    """Padding of sequences with so many tokens."""
    fill = np.asarray(fill)
    return np.where((fill & (fill - 1)) == 0, 0, size - fill)


def knapsack(prices: np.ndarray, lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each fill up to ``size``, the largest total price of pieces that fill it exactly, and one of them (-1: none)."""
    best, last = np.full(size + 1, -np.inf), np.full(size + 1, -1)
    best[0] = 0
    for fill in range(1, size + 1):
        usable = np.searchsorted(lengths, fill, "right")
        if usable:
            total = best[fill - lengths[:usable]] + prices[:usable]
            at = int(total.argmax())
            best[fill], last[fill] = total[at], at
    return best, last


def _priced(prices: np.ndarray, lengths: np.ndarray, size: int) -> np.ndarray:
    """Patterns that the prices find worth more than their padding: for each length the best that has it."""
    best, last = knapsack(prices, lengths, size)
    cost, found = padding(np.arange(size + 1), size), []
    for row, length in enumerate(lengths.tolist()):
        total = best[: size + 1 - length] - cost[length:]
        rest = int(total.argmax())
        worth = prices[row] + total[rest]
        if worth > 1e-6:
            pattern = np.zeros(len(lengths))
            pattern[row] = 1
            while rest:
                pattern[last[rest]] += 1
                rest -= int(lengths[last[rest]])
            found.append((worth, pattern))
    return np.array([p for _, p in sorted(found, key=lambda f: -f[0])]).reshape(-1, len(lengths))


def first_basis(lengths: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(columns of a triangular basis, how often each): patterns that fill a sequence, the longest lengths first, each
    used until one of its lengths is exhausted; a length that none exhausts is packed on its own."""
    m, left = len(lengths), counts.astype(float)
    basis, amount = np.diag(size // lengths).astype(float), np.zeros(m)
    open_ = np.ones(m, bool)
    while open_.any():
        rows = np.flatnonzero(open_)
        own = lengths[rows]
        best, last = knapsack(own * (1.0 + own / size), own, size)
        before = open_.sum()
        for row in rows[::-1].tolist():
            rest = size - int(lengths[row])
            if not open_[row] or not np.isfinite(best[rest]):
                continue
            pattern = np.zeros(m)
            pattern[row] = 1
            while rest:
                at = rows[last[rest]]
                pattern[at] += 1
                rest -= int(lengths[at])
            used = np.flatnonzero(pattern)
            if open_[used].all():
                ratio = left[used] / pattern[used]
                gone = used[int(ratio.argmin())]
                basis[:, gone], amount[gone] = pattern, ratio.min()
                left[used] -= ratio.min() * pattern[used]
                left[gone] = 0
                open_[gone] = False
        if open_.sum() == before:
            break
    rows = np.flatnonzero(open_)
    amount[rows] = left[rows] / basis[rows, rows]
    return basis, amount


def plan_patterns(lengths: np.ndarray, counts: np.ndarray, size: int, tolerance: float = TOLERANCE) -> tuple[np.ndarray, np.ndarray]:
    """(patterns, how often each) that together hold each length as often as it occurs: a basic solution of the linear
    program for least padding, by the revised simplex method with generated columns. Any pivot's solution holds all
    pieces; the method ends when no pattern improves it, when its padding is below ``tolerance`` of all tokens, or
    after ``PIVOTS`` pivots.
    """
    if not len(lengths):
        return np.empty((0, 0), np.int64), np.empty(0)
    basis, amount = first_basis(lengths, counts, size)
    cost = padding((lengths @ basis).astype(np.int64), size).astype(float)
    inverse, kept = np.linalg.inv(basis), (basis.copy(), amount)
    enough = tolerance * float((lengths * counts).sum())
    pool, pool_cost = np.empty((0, len(lengths))), np.empty(0)
    for pivot in range(PIVOTS):
        if cost @ amount <= enough:
            break
        prices = cost @ inverse
        gain = pool @ prices - pool_cost
        if not len(pool) or gain.max() < 1e-6:
            pool = _priced(prices, lengths, size)
            pool_cost = padding((pool @ lengths).astype(np.int64), size)
            if not len(pool):
                break
            gain = pool @ prices - pool_cost
        enter = int(gain.argmax())
        column, column_cost = pool[enter], pool_cost[enter]
        pool, pool_cost = np.delete(pool, enter, axis=0), np.delete(pool_cost, enter)
        change = inverse @ column
        rows = np.flatnonzero(change > 1e-7)
        if not len(rows):
            continue
        ratio = amount[rows] / change[rows]
        ties = rows[ratio <= ratio.min() + 1e-9]
        leave = int(ties[change[ties].argmax()])
        step = amount[leave] / change[leave]
        amount = np.maximum(amount - step * change, 0)
        amount[leave] = step
        basis[:, leave], cost[leave] = column, column_cost
        row = inverse[leave] / change[leave]
        others = np.flatnonzero(change)
        inverse[others] -= np.outer(change[others], row)
        inverse[leave] = row
        if pivot % 200 == 199:  # rounding errors end here
            try:
                inverse = np.linalg.inv(basis)
            except np.linalg.LinAlgError:
                return kept[0].T.astype(np.int64), kept[1]
            amount = np.maximum(inverse @ counts, 0)
            kept = basis.copy(), amount
    return basis.T.astype(np.int64), amount


def exact_fill(lengths: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray | None:
    """How many pieces of each length, no more than there are, fill ``size`` exactly with the longest among them."""
    top = int(np.flatnonzero(counts)[-1])
    goal, mask = size - int(lengths[top]), (1 << (size + 1)) - 1
    reach, steps = 1, []  # bits: fills that the lengths so far can give
    for row in range(top, -1, -1):
        left = int(counts[row]) - (row == top)
        steps.append((row, reach))
        part = 1
        while left > 0:
            use = min(part, left)
            reach |= (reach << (use * int(lengths[row]))) & mask
            left, part = left - use, part * 2
        if reach >> goal & 1:
            break
    if not reach >> goal & 1:
        return None
    used = np.zeros(len(lengths), np.int64)
    used[top] = 1
    for row, before in reversed(steps):
        while not before >> goal & 1:
            used[row] += 1
            goal -= int(lengths[row])
    return used


@dataclass
class Plan:
    """Where the pieces of each length and rank go: runs of ranks, sorted by ``key`` = length and first rank.

    The piece of rank r in a run is number ``(r - rank) % per`` of those of its length in the sequence
    ``sequence + (r - rank) // per``, at ``offset`` and so many lengths. Of each length, the ranks from ``tail`` on run on
    through the sequences after ``tail_sequence``: the first of them begins ``tail_place`` tokens in; ``ends`` are the
    places where those sequences end.
    """

    size: int
    key: np.ndarray
    sequence: np.ndarray
    per: np.ndarray
    offset: np.ndarray
    tail: np.ndarray
    tail_place: np.ndarray
    tail_tokens: int
    tail_sequence: int

    def whole(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of pieces before the tail of their length."""
        at = np.searchsorted(self.key, (length << 44) + rank, "right") - 1
        place = rank - (self.key[at] & ((1 << 44) - 1))
        return self.sequence[at] + place // self.per[at], self.offset[at] + place % self.per[at] * length

    def last_ends(self) -> np.ndarray:
        """Places where the sequences of the tail's last, not full stretch end: at powers of two, the largest first."""
        full, rest = divmod(self.tail_tokens, self.size)
        parts = [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]
        return full * self.size + np.cumsum(np.array(parts, np.int64)) if parts else np.empty(0, np.int64)

    def parts(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(start, length, sequence, offset) of the parts of a piece of the tail."""
        place, out, start = int(self.tail_place[length]) + (rank - int(self.tail[length])) * length, [], 0
        full, ends = self.tail_tokens // self.size, self.last_ends()
        while start < length:
            number, offset = divmod(place, self.size)
            end = (number + 1) * self.size
            if number == full:
                at = int(np.searchsorted(ends, place, "right"))
                number, offset, end = full + at, place - (int(ends[at - 1]) if at else full * self.size), int(ends[at])
            own = min(length - start, end - place)
            out.append((start, own, self.tail_sequence + number, offset))
            start, place = start + own, place + own
        return out


def planned(histogram: dict[int, int], size: int, tolerance: float = TOLERANCE) -> Plan:
    """A plan for so many pieces of each length (1 to ``size``)."""
    lengths = np.array(sorted(k for k in histogram if k < size), np.int64)
    counts = np.array([histogram[k] for k in lengths.tolist()], np.int64)
    patterns, amounts = plan_patterns(lengths, counts.astype(float), size, tolerance)
    uses = np.floor(amounts + 1e-6).astype(np.int64)
    uses[padding(patterns @ lengths if len(lengths) else uses, size) > 0] = 0
    for row in np.flatnonzero(patterns.T @ uses > counts) if len(lengths) else []:  # rounding errors of the amounts
        while (patterns[:, row] @ uses) > counts[row]:
            uses[int(np.argmax((patterns[:, row] > 0) * uses))] -= 1
    chosen = [(p, int(u)) for p, u in zip(patterns, uses) if u]
    left = counts - (patterns.T @ uses if len(lengths) else 0)
    tail = np.zeros(size + 1, np.int64)
    for _ in range(4 * size):
        if not left.any():
            break
        own = exact_fill(lengths, left, size)
        if own is None:
            top = int(np.flatnonzero(left)[-1])
            tail[lengths[top]], left[top] = left[top], 0
            continue
        used = np.flatnonzero(own)
        times = int((left[used] // own[used]).min())
        chosen.append((own, times))
        left -= times * own
    tail[lengths] += left
    runs, sequence, placed = [], 0, np.zeros(size + 1, np.int64)
    for pattern, times in chosen:
        offset = 0
        for row in np.flatnonzero(pattern)[::-1].tolist():
            length, per = int(lengths[row]), int(pattern[row])
            runs.append((length << 44 | int(placed[length]), sequence, per, offset))
            placed[length] += times * per
            offset += per * length
        sequence += times
    runs.append((size << 44, sequence, 1, 0))
    placed[size] = histogram.get(size, 0)
    sequence += histogram.get(size, 0)
    order = np.arange(size, -1, -1)
    tokens = (tail * np.arange(size + 1))[order]
    place = np.zeros(size + 1, np.int64)
    place[order] = np.cumsum(tokens) - tokens
    key, first, per, offset = (np.array(c, np.int64) for c in zip(*sorted(runs)))
    return Plan(size, key, first, per, offset, placed, place, int(tokens.sum()), sequence)


_PIECE = [("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType()), ("doc_tokens", T.LongType())]


def pieces(docs: DataFrame, tokenizer: str, size: int, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, start, length, ids_crc32, doc_tokens, ids, block, nth): pieces of at most ``size`` ids; ``nth`` counts
    those of a length in a task's block, and ``ids`` are little-endian unsigned 32-bit integers."""
    ship(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, block, seen = encoder(tokenizer).encode, TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        for batch in batches:
            done = 0
            for texts in slices(batch.column("text"), 1 << 22):
                ids, counts = with_end(*encode(texts), end_id)
                data, ends = memoryview(ids.astype("<u4").tobytes()), np.cumsum(counts)
                n = -(-counts // size)
                doc = np.repeat(np.arange(len(counts)), n)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)) * size
                length = np.minimum(size, counts[doc] - start)
                first = (ends - counts)[doc] + start
                own = [data[4 * f : 4 * (f + c)] for f, c in zip(first.tolist(), length.tolist())]
                order = np.argsort(length, kind="stable")
                group = length[order]
                nth = np.empty(len(doc), np.int64)
                nth[order] = seen[group] + np.arange(len(doc)) - np.searchsorted(group, group, "left")
                seen += np.bincount(length, minlength=size + 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(done, len(texts)).take(pa.array(doc)), pa.array(start), pa.array(length),
                     pa.array([zlib.crc32(p) for p in own], pa.int64()), pa.array(counts[doc]), pa.array([bytes(p) for p in own], pa.binary()),
                     pa.array(np.full(len(doc), block)), pa.array(nth)],
                    names=[id_col, *(c for c, _ in _PIECE), "ids", "block", "nth"],
                )
                done += len(texts)

    fields = [(id_col, docs.schema[id_col].dataType), *_PIECE, ("ids", T.BinaryType()), ("block", T.LongType()), ("nth", T.LongType())]
    schema = T.StructType([T.StructField(n, t) for n, t in fields])
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(cut, schema)


def pack(
    docs: DataFrame, tokenizer: str, size: int = 1024, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
    with_ids: bool = False, few: int = 200_000,
) -> DataFrame:
    """(id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset) of each piece, and its ids if asked for.

    ``few``: up to so many counts of blocks whose pieces run on are broadcast; more are joined by a shuffle.
    """
    rows = stored(pieces(docs, tokenizer, size, end_id, id_col, text_col))
    counts = stored(rows.groupBy("block", "length").agg((F.max("nth") + 1).alias("n")))
    histogram = {r["length"]: r["total"] for r in counts.groupBy("length").agg(F.sum("n").alias("total")).collect()}  # at most ``size`` rows
    plan = planned(histogram, size)
    earlier = F.sum("n").over(Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    before = stored(counts.withColumn("before", F.coalesce(earlier, F.lit(0))))

    out = [id_col, *(c for c, _ in _PIECE), "sequence_id", "offset"] + ["ids"] * with_ids
    fields = [(id_col, docs.schema[id_col].dataType), *_PIECE, ("sequence_id", T.LongType()), ("offset", T.LongType())]
    schema = T.StructType([T.StructField(n, t) for n, t in fields + [("ids", T.BinaryType())] * with_ids])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            keep = rank < plan.tail[length]
            batch, length, rank = batch.filter(pa.array(keep)), length[keep], rank[keep]
            sequence, offset = plan.whole(length, rank)
            columns = {"sequence_id": pa.array(sequence), "offset": pa.array(offset)}
            yield pa.RecordBatch.from_arrays([columns[c] if c in columns else batch.column(c) for c in out], names=out)

    def tail(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: list[dict] = []
            for row in batch.to_pylist():
                for start, length, sequence, offset in plan.parts(row["length"], row["rank"]):
                    ids = row["ids"][4 * start : 4 * (start + length)]
                    made.append({**row, "start": row["start"] + start, "length": length, "ids_crc32": zlib.crc32(ids), "sequence_id": sequence,
                                 "offset": offset, "ids": ids})
            yield pa.RecordBatch.from_pylist([{c: r[c] for c in out} for r in made], arrow)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    rank = (F.col("before") + F.col("nth")).alias("rank")
    light = rows if with_ids else rows.drop("ids")
    uncut = light.join(before, ["block", "length"]).select(*light.columns, rank).mapInArrow(whole, schema)
    limits = F.create_map(*(F.lit(v) for k in sorted(histogram) for v in (k, int(plan.tail[k])))) if histogram else F.create_map().cast("map<bigint,bigint>")
    last = stored(before.withColumn("limit", F.element_at(limits, F.col("length"))).filter(F.col("before") + F.col("n") > F.col("limit")))
    blocks = F.broadcast(last) if last.count() <= few else last
    run_on = rows.join(blocks, ["block", "length"]).filter(F.col("before") + F.col("nth") >= F.col("limit"))
    return uncut.unionByName(run_on.select(*rows.columns, rank).mapInArrow(tail, schema))
