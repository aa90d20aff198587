"""Many forests over one binned table: all candidates, folds and feature sets of a search grow in shared passes.

* Features are binned once, to at most 255 edges a column (all values, where a column has few).
* What decides how a tree grows is kept apart from what only cuts it (depth, split size, pruning, size of the forest):
  candidates that differ in the latter use the same trees. A set of columns is a mask over the shared matrix.
* A node with more than ``local_rows`` rows is split by Spark: each task adds up the class sums of its rows for every
  open node, tried feature and bin, the sums of a node are added up and its best split is chosen in one task of its own.
  A node with fewer rows meets them in one task, which finishes the whole subtree. Trees are the same either way.
* Tables of up to ``local_rows`` rows go once to each of a few tasks a core (fewer, the more rows), not to each tree: a
  task grows its share of all trees, a few at a time, scores the held-out rows with them and returns sums over its
  trees, a number for each row.
* In larger tables blocks of rows meet groups of trees to be scored. No forest passes through the driver, which holds
  only the splits of nodes above ``local_rows``.
* A growth is followed no further than the deepest and finest of its cuts uses; nodes that pruning is sure to take
  aren't split.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from campaign_engine.operators import metrics
from campaign_engine.operators.tree_growth import BINS, Cut, Growth, Trees, best_split, children, cut_values, grow, leaves, sample_weights
from campaign_engine.schemas import SEED

LOCAL_ROWS = 6_000_000  # a task holds some 50 + 2 x columns bytes of each, and some 120 bytes of each sampled row of a tree
ROWS_AT_ONCE = 300_000  # sampled rows of the trees that a task grows together
TASKS = 4  # tasks a core that trees are dealt to
COPIED_ROWS = 2_000_000  # rows that are dealt for each core, where more than one task a core needs them
BLOCK = 1 << 17  # held-out rows whose sums are put together in one task
OPEN_NODES = 1000  # nodes that one pass splits: their sums take some 12 kB a tried feature in each task
CHUNK = 4096
FEW_VALUES = 200
_CHUNK = "n int, hash binary, y binary, fold binary, x binary"


@dataclass(frozen=True)
class Job:
    """A forest to score: ``trees`` trees of a growth, cut alike, for each of ``folds`` (those held out)."""

    growth: Growth
    cut: Cut
    trees: int
    folds: tuple[int, ...]


def bin_edges(df: DataFrame, cols: Sequence[str]) -> list[np.ndarray]:
    """Sorted edges of each column: a value's bin is the number of edges below it. Two aggregations over all columns."""
    number = {c: F.col(c).cast("double") for c in cols}
    few = df.agg(*[F.approx_count_distinct(number[c]).alias(c) for c in cols]).first()
    fractions = F.array(*[F.lit(i / (BINS - 1)) for i in range(1, BINS - 1)])
    found = df.agg(*[
        (F.collect_set(number[c]) if few[c] <= FEW_VALUES else F.percentile_approx(number[c], fractions, 10 * BINS)).alias(c) for c in cols
    ]).first()
    out = []
    for c in cols:
        values = np.unique(np.array([v for v in found[c] or [] if v == v], float))
        if few[c] <= FEW_VALUES and len(values) < BINS:
            values = (values[1:] + values[:-1]) / 2  # between the values, all of which are known
        out.append(values)
    return out


def numbers(cols: Sequence[str]) -> Column:
    """The columns as one array, null as NaN."""
    return F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in cols])


def binned(x: pa.Array, rows: int, edges: Sequence[np.ndarray]) -> np.ndarray:
    """One byte for each value of ``numbers`` (rows x columns)."""
    values = x.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)
    out = np.empty(values.shape, np.uint8)
    for j, own in enumerate(edges):
        out[:, j] = np.searchsorted(own, np.nan_to_num(values[:, j], nan=-np.inf), "left")
    return out


class Binned:
    """Chunks of binned rows: hash of the key, label, fold (held out there), and one byte for each column.

    Null and NaN values are in the first bin. Rows without a label take no part. Keep it until results are computed.
    """

    def __init__(self, df: DataFrame, cols: Sequence[str], key: str, label: str, fold: str, local_rows: int = LOCAL_ROWS):
        self.cols, self.local_rows = list(cols), local_rows
        self.edges = edges = bin_edges(df, cols)
        rows = df.filter(F.col(label).isNotNull()).select(
            F.xxhash64(F.col(key)).alias("hash"), F.col(label).cast("double").alias("y"), F.col(fold).cast("int").alias("fold"),
            numbers(cols).alias("x"),
        )

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, batch.num_rows, CHUNK):
                    part = batch.slice(start, CHUNK)
                    x = binned(part.column("x"), part.num_rows, edges)
                    blobs = [part.column("hash").to_numpy(), part.column("y").to_numpy(), part.column("fold").to_numpy().astype(np.int8), x]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part.num_rows], pa.int32()), *(pa.array([b.tobytes()], pa.binary()) for b in blobs)],
                        names=["n", "hash", "y", "fold", "x"],
                    )

        self.chunks = rows.mapInArrow(pack, _CHUNK).persist(StorageLevel.MEMORY_AND_DISK)
        self.rows = self.chunks.agg(F.sum("n")).first()[0] or 0

    def unpersist(self) -> None:
        self.chunks.unpersist()


def _opened(chunk, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return (np.frombuffer(chunk["hash"], np.int64), np.frombuffer(chunk["y"], np.float64), np.frombuffer(chunk["fold"], np.int8),
            np.frombuffer(chunk["x"], np.uint8).reshape(-1, width))


@dataclass(frozen=True)
class Unit:
    """Trees ``first`` to ``last`` - 1 of a growth without a fold."""

    growth: int
    fold: int
    first: int
    last: int


def _cuts_of(jobs: Sequence[Job], growths: Sequence[Growth]) -> list[list[Cut]]:
    """The different cuts of each growth."""
    return [list(dict.fromkeys(j.cut for j in jobs if j.growth == g)) for g in growths]


def _reach(cuts: Sequence[Cut]) -> dict[str, float]:
    """How far trees have to grow for all of their cuts."""
    depths = [64 if c.max_depth is None else c.max_depth for c in cuts]
    return {"max_depth": min(64, max(depths)), "min_split": min(c.min_split for c in cuts), "alpha": min(c.alpha for c in cuts)}


@dataclass(frozen=True)
class _Wanted:
    """What a growth without a fold is for: (job, cut, trees) of each job, and the most trees of them."""

    growth: int
    fold: int
    trees: int
    uses: tuple[tuple[int, int, int], ...]


def _wanted(jobs: Sequence[Job], growths: Sequence[Growth], cuts: list[list[Cut]]) -> list[_Wanted]:
    firsts = {job: i for i, job in reversed(list(enumerate(jobs)))}
    out = []
    for g, growth in enumerate(growths):
        for fold in sorted({f for j in jobs if j.growth == growth for f in j.folds}):
            uses = tuple((i, cuts[g].index(j.cut), j.trees) for j, i in firsts.items() if j.growth == growth and fold in j.folds)
            out.append(_Wanted(g, fold, max(trees for _, _, trees in uses), uses))
    return out


def _levels(growth: Growth, cuts: Sequence[Cut], rows: int) -> float:
    """About how many levels a row goes down a tree of its own growth, from the size of the nodes that aren't split."""
    reach = _reach(cuts)
    least = max(2, 2 * growth.min_leaf, reach["min_split"], 2 * reach["alpha"] * rows)
    return min(reach["max_depth"], 1 + 1.3 * math.log2(max(rows / least, 1)))


def _shares(
    wanted: Sequence[_Wanted], growths: Sequence[Growth], groups: int, levels: Sequence[float] | None = None
) -> list[list[tuple[int, int, int]]]:
    """(place in ``wanted``, first tree, end) of the trees of each group: neighbours, and about as much work in each.

    ``levels``: about how many each growth's trees have.
    """
    costs = [growths[w.growth].rate * (growths[w.growth].tried + 1) * (levels[w.growth] if levels else 1.0) for w in wanted]
    size = sum(c * w.trees for c, w in zip(costs, wanted)) / groups
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(groups)]
    done = 0.0
    for i, (cost, w) in enumerate(zip(costs, wanted)):
        group = np.minimum(((done + cost * (np.arange(w.trees) + 0.5)) / size).astype(int), groups - 1)
        done += cost * w.trees
        ends = np.append(np.flatnonzero(np.diff(group)) + 1, w.trees)
        for first, end in zip(np.append(0, ends[:-1]).tolist(), ends.tolist()):
            out[group[first]].append((i, first, end))
    return [g for g in out if g]


def _unit_row(unit: int, trees: Trees, cuts: Sequence[Cut], criterion: str) -> dict:
    values = np.array([cut_values(trees, c, criterion) for c in cuts], np.float32)
    return {"unit": unit, "feature": trees.feature.astype(np.int32).tobytes(), "bin": trees.bin.astype(np.int16).tobytes(),
            "left": trees.left.astype(np.int32).tobytes(), "values": values.tobytes()}


_NO_FOLD = -1  # of trees that learn all rows
_UNIT = "unit int, feature binary, bin binary, left binary, values binary"
_UNIT_ARROW = pa.schema([("unit", pa.int32()), *((c, pa.binary()) for c in ("feature", "bin", "left", "values"))])


_PIECE = "job int, fold int, block int, trees long, hash binary, y binary, total binary"
_PIECE_ARROW = pa.schema([("job", pa.int32()), ("fold", pa.int32()), ("block", pa.int32()), ("trees", pa.int64()),
                          *((c, pa.binary()) for c in ("hash", "y", "total"))])


def _tasks(data: Binned, parallel: int) -> int:
    """Tasks that get all rows."""
    return parallel * max(1, min(TASKS, COPIED_ROWS // max(data.rows, 1)))


def _dealt(data: Binned, shares: Sequence[Sequence], work: Callable[..., Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``work`` on (hash, label, fold, columns) of all rows and each item of a share; each share has a task of its own.

    Rows are in the order of their folds, hashes and labels.
    """
    width = len(data.cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks: dict[int, list] = {}
        for batch in batches:
            for chunk in batch.to_pylist():
                chunks.setdefault(chunk["share"], []).append(_opened(chunk, width))
        for number in list(chunks):
            h, y, fold, x = (np.concatenate(p) for p in zip(*chunks.pop(number)))
            order = np.lexsort((y, h, fold))
            h, y, fold, x = h[order], y[order], fold[order], x[order]
            for item in shares[number]:
                yield from work(h, y, fold, x, item)

    dealt = data.chunks.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(len(shares) - 1))))
    return dealt.repartitionById(len(shares), "share").mapInArrow(run, schema)


def _local_pieces(data: Binned, jobs: Sequence[Job], seed: int, block: int, parallel: int) -> DataFrame:
    """Sums over trees of the scores of held-out rows, where all rows meet in a task (no more than ``local_rows``).

    A piece is a block of a job's held-out rows, in the order of their hashes, and the trees of one task. The piece with
    tree 0 has the rows' hashes and labels.
    """
    growths = list(dict.fromkeys(j.growth for j in jobs))
    cuts = _cuts_of(jobs, growths)
    wanted = _wanted(jobs, growths, cuts)
    levels = [1 + _levels(g, c, data.rows) for g, c in zip(growths, cuts)]
    shares = _shares(wanted, growths, min(sum(w.trees for w in wanted), _tasks(data, parallel)), levels)

    def summed(h, y, fold, x, share: tuple[int, int, int]) -> Iterator[pa.RecordBatch]:
        want, first, end = wanted[share[0]], *share[1:]
        growth, own = growths[want.growth], cuts[want.growth]
        begin, end_held = np.searchsorted(fold, np.array([want.fold, want.fold + 1], np.int8))
        if begin == end_held:
            return
        held = slice(begin, end_held)  # what is learnt isn't copied, where it is in one place too
        learnt = slice(end_held, None) if begin == 0 else slice(0, begin) if end_held == len(fold) else np.flatnonzero(fold != want.fold)
        fit_h, fit_y, fit_x, asked = h[learnt], y[learnt], x[learnt], x[held]
        totals = {job: np.zeros(len(asked)) for job, _, trees in want.uses if trees > first}
        step = max(1, ROWS_AT_ONCE // max(len(fit_h), 1))
        for start in range(first, end, step):
            trees = np.arange(start, min(start + step, end))
            weights = growth.weights(fit_h, trees, seed)
            grown = grow(fit_x, fit_y, weights, growth.roots(trees, seed), growth, sample_weights(growth, fit_y, weights), **_reach(own))
            at = leaves(grown.feature, grown.bin, grown.left, np.arange(len(trees)), asked)
            for number, cut in enumerate(own):
                counts = {job: min(most - start, len(trees)) for job, used, most in want.uses if used == number and most > start}
                if not counts:
                    continue
                values = cut_values(grown, cut, growth.criterion).astype(np.float32)
                sums = {n: sum(values[line].astype(float) for line in at[:n]) for n in set(counts.values())}
                for job, n in counts.items():
                    totals[job] += sums[n]
        h, y = h[held], y[held]
        begin = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (y[1:] != y[:-1])))  # rows of a key and label share a score
        times = np.diff(np.append(begin, len(h)))
        for job, total in totals.items():
            trees = min(next(most for other, _, most in want.uses if other == job), end) - first
            total = np.add.reduceat(total, begin) / times
            for at in range(0, len(begin), block):
                part = begin[at : at + block]
                known = [a[part].tobytes() if first == 0 else b"" for a in (h, y)]
                yield pa.RecordBatch.from_pylist([{"job": job, "fold": want.fold, "block": at // block, "trees": trees, "hash": known[0],
                                                   "y": known[1], "total": total[at : at + block].tobytes()}], _PIECE_ARROW)

    return _dealt(data, shares, summed, _PIECE)


def _put_together(table: pa.Table) -> tuple[bytes, np.ndarray, np.ndarray]:
    """(hashes, labels, scores) of the pieces of a block."""
    hashes, y, total, trees = b"", np.empty(0), 0.0, 0
    for blob, labels, part, count in zip(*(table.column(c) for c in ("hash", "y", "total", "trees"))):
        total, trees = total + np.frombuffer(part.as_buffer()), trees + count.as_py()
        if len(labels.as_buffer()):
            hashes, y = blob.as_py(), np.frombuffer(labels.as_py())
    return hashes, y, total / trees


class _Top:
    """The upper parts of the units' trees; ``paths``, ``sums`` (rows, w, s, q) and places of all their nodes."""

    def __init__(self, units: list[Unit], growths: list[Growth], seed: int):
        self.unit = np.concatenate([np.full(u.last - u.first, i) for i, u in enumerate(units)])
        trees = np.concatenate([np.arange(u.first, u.last) for u in units])
        self.tree = trees - np.array([u.first for u in units])[self.unit]
        self.roots = [np.flatnonzero(self.unit == i) for i in range(len(units))]
        self.root = np.arange(len(self.unit))
        self.paths = np.concatenate([growths[u.growth].roots(np.arange(u.first, u.last), seed) for u in units])
        n = len(self.unit)
        self.feature, self.bin, self.left = np.full(n, -1), np.zeros(n, np.int64), np.full(n, -1)
        self.parent, self.depth, self.sums = np.full(n, -1), np.zeros(n, np.int64), np.zeros((n, 4))

    def split(self, node: int, feature: int, cut: int) -> None:
        self.feature[node], self.bin[node], self.left[node] = feature, cut, len(self.feature)
        own = self.paths[node : node + 1]
        more = {"unit": [self.unit[node]] * 2, "tree": [self.tree[node]] * 2, "root": [self.root[node]] * 2, "feature": [-1, -1], "bin": [0, 0],
                "left": [-1, -1], "parent": [node] * 2, "depth": [self.depth[node] + 1] * 2}
        for name, values in more.items():
            setattr(self, name, np.append(getattr(self, name), values))
        self.paths = np.concatenate([self.paths, children(own, 0), children(own, 1)])
        self.sums = np.vstack([self.sums, np.zeros((2, 4))])


def _split_units(data: Binned, units: list[Unit], growths: list[Growth], cuts: list[list[Cut]], seed: int) -> DataFrame:
    """The units' trees, where nodes of more than ``local_rows`` rows are split level by level."""
    width, limit, top = len(data.cols), data.local_rows, _Top(units, growths, seed)

    def sampled(unit: Unit, h: np.ndarray, fold: np.ndarray) -> np.ndarray:
        return growths[unit.growth].weights(h, np.arange(unit.first, unit.last), seed) * (fold != unit.fold)

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(top.unit), 4), np.int64)
        for batch in batches:
            for chunk in batch.to_pylist():
                h, y, fold, _ = _opened(chunk, width)
                one = y > 0.5
                for number, unit in enumerate(units):
                    weights, roots = sampled(unit, h, fold), top.roots[number]
                    total[roots, 0] += weights[:, ~one].sum(axis=1)
                    total[roots, 1] += weights[:, one].sum(axis=1)
                    total[roots, 2:] += [(~one & (fold != unit.fold)).sum(), (one & (fold != unit.fold)).sum()]
        columns = [pa.array(np.arange(len(total)))] + [pa.array(total[:, i]) for i in range(4)]
        yield pa.RecordBatch.from_arrays(columns, names=["root", "a", "b", "c", "d"])

    counted = data.chunks.mapInArrow(classes, "root long, a long, b long, c long, d long").groupBy("root").agg(*[F.sum(c).alias(c) for c in "abcd"])
    by_class = np.zeros((len(top.unit), 4))
    for r in counted.collect():  # one row for each tree
        by_class[r["root"]] = [r["a"], r["b"], r["c"], r["d"]]
    class_weights = np.ones((len(top.unit), 2))
    for number, unit in enumerate(units):
        kind = growths[unit.growth].class_weight
        if kind is not None:
            n = by_class[top.roots[number]][:, (slice(2, 4) if kind == "balanced" else slice(0, 2))]
            class_weights[top.roots[number]] = n.sum(axis=1, keepdims=True) / (np.maximum((n > 0).sum(axis=1, keepdims=True), 1) * np.maximum(n, 1))

    def of_unit(number: int, chunk: dict) -> tuple[np.ndarray, ...]:
        """(node, row, sample weight, weight, label, columns) of the sampled rows of a unit's trees."""
        h, y, fold, x = _opened(chunk, width)
        weights = sampled(units[number], h, fold)
        tree, row = np.nonzero(weights)
        node = leaves(top.feature, top.bin, top.left, top.roots[number], x)[tree, row]
        times = weights[tree, row]
        weight = times * class_weights[top.roots[number][tree], (y[row] > 0.5).astype(int)]
        return node, row, times, weight, y[row], x

    def sums_of(nodes: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(len(top.feature), -1)
        place[nodes] = np.arange(len(nodes))
        busy, held = sorted(set(top.unit[nodes].tolist())), {}
        for batch in batches:
            for chunk in batch.to_pylist():
                for number in busy:
                    growth = growths[units[number].growth]
                    node, row, _, w, y, x = of_unit(number, chunk)
                    mine = place[node] >= 0
                    node, row, w, y = node[mine], row[mine], w[mine], y[mine]
                    open_ = np.unique(node)
                    if not len(open_):
                        continue
                    at = np.searchsorted(open_, node)
                    tried = growth.features(top.paths[open_])
                    size = growth.tried * BINS
                    total = np.zeros((3, len(open_) * size))
                    for k in range(growth.tried):
                        key = at * size + k * BINS + x[row, tried[at, k]]
                        total += [np.bincount(key, v, total.shape[1]) for v in (np.ones(len(key)), w, w * y)]
                    squares = np.bincount(at, w * y * y, len(open_))
                    for i, n in enumerate(open_.tolist()):
                        own = np.append(total[:, i * size : (i + 1) * size].ravel(), squares[i])
                        held[n] = held[n] + own if n in held else own
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.int64()), pa.array([v.tobytes() for v in held.values()], pa.binary())], names=["node", "sums"]
        )

    def choose(table: pa.Table) -> pa.Table:
        node = table.column("node")[0].as_py()
        total = sum(np.frombuffer(b) for b in table.column("sums").to_pylist())
        growth = growths[units[top.unit[node]].growth]
        counts, *sums = total[:-1].reshape(3, growth.tried, BINS)
        feature, cut = best_split(growth, growth.features(top.paths[node : node + 1])[0], counts, np.array(sums), total[-1])
        out = {"node": node, "feature": feature, "bin": cut, "rows": counts[0].sum(), "w": sums[0][0].sum(), "s": sums[1][0].sum(), "q": total[-1]}
        return pa.Table.from_pylist([out], _CHOICE_ARROW)

    open_, local = list(range(len(top.unit))), []
    while open_:
        found = []
        for start in range(0, len(open_), OPEN_NODES):
            nodes = np.array(open_[start : start + OPEN_NODES])
            parts = data.chunks.mapInArrow(lambda batches, nodes=nodes: sums_of(nodes, batches), "node long, sums binary")
            found += parts.groupBy("node").applyInArrow(choose, _CHOICE).collect()  # one row for each open node
        later = []
        for r in sorted(found, key=lambda r: r["node"]):
            node = r["node"]
            top.sums[node] = r["rows"], r["w"], r["s"], r["q"]
            if r["rows"] <= limit:
                local.append(node)
            elif r["feature"] >= 0:
                top.split(node, r["feature"], r["bin"])
                later += [len(top.feature) - 2, len(top.feature) - 1]
        open_ = later
    is_local = np.zeros(len(top.feature), bool)
    is_local[local] = True

    def to_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in batch.to_pylist():
                for number in range(len(units)):
                    node, row, times, _, y, x = of_unit(number, chunk)
                    mine = np.flatnonzero(is_local[node])
                    mine = mine[np.argsort(node[mine], kind="stable")]
                    names, begin = np.unique(node[mine], return_index=True)
                    parts = np.split(mine, begin[1:])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names), pa.array([times[p].astype(np.uint8).tobytes() for p in parts][: len(names)], pa.binary()),
                         pa.array([y[p].tobytes() for p in parts][: len(names)], pa.binary()),
                         pa.array([x[row[p]].tobytes() for p in parts][: len(names)], pa.binary())],
                        names=["node", "times", "y", "x"],
                    )

    def finish(table: pa.Table) -> pa.Table:
        node = table.column("node")[0].as_py()
        times, y, x = (np.frombuffer(b"".join(table.column(c).to_pylist()), t) for c, t in (("times", np.uint8), ("y", np.float64), ("x", np.uint8)))
        number, root = units[top.unit[node]].growth, top.root[node]
        reach = _reach(cuts[number])
        reach["max_depth"] = max(0, reach["max_depth"] - int(top.depth[node]))
        weights = times[None, :].astype(np.int64)
        own = grow(x.reshape(-1, width), y, weights, top.paths[node : node + 1], growths[number], class_weights[root : root + 1],
                   whole=top.sums[root : root + 1, 1], **reach)
        out = {"unit": int(top.unit[node]), "node": node} | {c: getattr(own, c).astype(t).tobytes() for c, t in _TREE.items()}
        return pa.Table.from_pylist([out], _PART_ARROW)

    def merge(table: pa.Table) -> pa.Table:
        number = table.column("unit")[0].as_py()
        names = np.flatnonzero(top.unit == number)
        upper = {"parent": top.parent[names], "depth": top.depth[names], "feature": top.feature[names], "bin": top.bin[names], "left": top.left[names],
                 "tree": top.tree[names], **{c: top.sums[names, i] for i, c in enumerate(("rows", "w", "s", "q"))}}
        places = np.full(len(top.feature), -1)
        places[names] = np.arange(len(names))
        for c in ("parent", "left"):
            upper[c] = np.where(upper[c] >= 0, places[upper[c]], -1)
        columns = {c: [upper[c].astype(float)] for c in _TREE}
        size = len(names)
        for row in table.to_pylist():
            if row["node"] < 0:
                continue
            own, at = {c: np.frombuffer(row[c], t).astype(float) for c, t in _TREE.items()}, places[row["node"]]
            own["tree"][:] = upper["tree"][at]
            own["depth"] += upper["depth"][at]
            shift = size - 1  # the subtree's root is the upper node itself
            own["left"] = np.where(own["left"] >= 0, own["left"] + shift, -1)
            own["parent"] = np.where(own["parent"] > 0, own["parent"] + shift, np.where(own["parent"] == 0, at, -1))
            for c in ("feature", "bin", "left", "rows", "w", "s", "q"):
                columns[c][0][at] = own[c][0]
            for c in _TREE:
                columns[c].append(own[c][1:])
            size += len(own["feature"]) - 1
        flat = {c: np.concatenate(v) for c, v in columns.items()}
        order = np.argsort(flat["depth"], kind="stable")
        where = np.argsort(order)
        for c in ("parent", "left"):
            known = flat[c] >= 0
            flat[c][known] = where[flat[c][known].astype(int)]
        ints = {c: flat[c][order].astype(np.int64) for c in ("tree", "parent", "depth", "rows", "feature", "bin", "left")}
        trees = Trees(**ints, **{c: flat[c][order] for c in ("w", "s", "q")})
        unit = units[number]
        return pa.Table.from_pylist([_unit_row(number, trees, cuts[unit.growth], growths[unit.growth].criterion)], _UNIT_ARROW)

    tasks = 4 * data.chunks.sparkSession.sparkContext.defaultParallelism
    rows = data.chunks.mapInArrow(to_nodes, "node long, times binary, y binary, x binary").repartition(tasks, "node")
    finished = rows.groupBy("node").applyInArrow(finish, _PART)
    every = data.chunks.sparkSession.createDataFrame([(i, -1, *[b""] * len(_TREE)) for i in range(len(units))], _PART)
    return finished.unionByName(every).repartition(min(len(units), tasks), "unit").groupBy("unit").applyInArrow(merge, _UNIT)


_TREE = {"tree": np.int32, "parent": np.int32, "depth": np.uint8, "rows": np.int32, "w": np.float64, "s": np.float64, "q": np.float64,
         "feature": np.int16, "bin": np.uint8, "left": np.int32}
_PART = "unit int, node long, " + ", ".join(f"{c} binary" for c in _TREE)
_PART_ARROW = pa.schema([("unit", pa.int32()), ("node", pa.int64()), *((c, pa.binary()) for c in _TREE)])
_CHOICE = "node long, feature int, bin int, rows double, w double, s double, q double"
_CHOICE_ARROW = pa.schema([("node", pa.int64()), ("feature", pa.int32()), ("bin", pa.int32()), *((c, pa.float64()) for c in ("rows", "w", "s", "q"))])


def _split_scores(data: Binned, jobs: Sequence[Job], seed: int, parallel: int) -> DataFrame:
    """(job, fold, hash, y, score) where nodes were split by Spark: groups of trees meet blocks of rows."""
    growths = list(dict.fromkeys(j.growth for j in jobs))
    cuts, width = _cuts_of(jobs, growths), len(data.cols)
    wanted = _wanted(jobs, growths, cuts)
    units = [Unit(w.growth, w.fold, t, t + 1) for w in wanted for t in range(w.trees)]
    uses = [[(job, cut, 1) for job, cut, trees in w.uses if trees > t] for w in wanted for t in range(w.trees)]
    blocks = -(-data.rows // data.local_rows)
    groups = max(1, min(len(units), TASKS * parallel // blocks))
    grown = _split_units(data, units, growths, cuts, seed)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks: dict[int, list] = {}
        rows: dict[tuple[int, int], tuple] = {}
        totals: dict[tuple[int, int, int], list] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                if row["unit"] < 0:
                    chunks.setdefault(row["place"], []).append(_opened(row, width))
                    continue
                unit, place = units[row["unit"]], row["place"]
                if place not in chunks:
                    continue
                if (place, unit.fold) not in rows:
                    rows[place, unit.fold] = tuple(np.concatenate(p) for p in zip(*(
                        [a[c[2] == unit.fold] for a in (c[0], c[1], c[3])] for c in chunks[place]
                    )))
                h, _, x = rows[place, unit.fold]
                if not len(h):
                    continue
                feature, bins, left = (np.frombuffer(row[c], t) for c, t in (("feature", np.int32), ("bin", np.int16), ("left", np.int32)))
                at = leaves(feature, bins, left, np.arange(1), x)[0]
                values = np.frombuffer(row["values"], np.float32).reshape(-1, len(feature))
                for job, cut, count in uses[row["unit"]]:
                    own = totals.setdefault((place, job, unit.fold), [np.zeros(len(h)), 0])
                    own[0] += values[cut][at]
                    own[1] += count
        for (place, job, fold), (total, trees) in totals.items():
            h, y, _ = rows[place, fold]
            for begin in range(0, len(h), BLOCK):
                part, n = slice(begin, begin + BLOCK), len(h[begin : begin + BLOCK])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, job, np.int32)), pa.array(np.full(n, fold, np.int32)), pa.array(h[part]), pa.array(y[part]),
                     pa.array(total[part]), pa.array(np.full(n, trees))],
                    names=["job", "fold", "hash", "y", "total", "trees"],
                )

    every = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    dealt = data.chunks.withColumn("block", F.pmod(F.xxhash64("hash"), F.lit(blocks))).withColumn("group", every).select(
        (F.col("group") * blocks + F.col("block")).cast("int").alias("place"), F.lit(-1).alias("unit"), "hash", "y", "fold", "x",
        *[F.lit(None).cast("binary").alias(c) for c in ("feature", "bin", "left", "values")],
    )
    group = F.floor(F.col("unit") * groups / len(units))
    trees = grown.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select(
        (group * blocks + F.col("block")).cast("int").alias("place"), "unit",
        *[F.lit(None).cast("binary").alias(c) for c in ("hash", "y", "fold", "x")], "feature", "bin", "left", "values",
    )
    met = dealt.unionByName(trees).repartitionById(groups * blocks, "place").sortWithinPartitions("place", "unit")
    parts = met.mapInArrow(score, "job int, fold int, hash long, y double, total double, trees long")
    return parts.groupBy("job", "fold", "hash", "y").agg((F.sum("total") / F.sum("trees")).alias("score"))


def _parallel(data: Binned) -> int:
    return data.chunks.sparkSession.sparkContext.defaultParallelism


_SCORES = "job int, fold int, hash long, y double, score double"


def grown_trees(data: Binned, growth: Growth, cut: Cut, trees: int, seed: int = SEED) -> DataFrame:
    """(unit, feature, bin, left, values): the trees of a forest that learns all rows, one in each row."""
    if data.rows > data.local_rows:
        return _split_units(data, [Unit(0, _NO_FOLD, t, t + 1) for t in range(trees)], [growth], [[cut]], seed)

    def whole(h, y, fold, x, tree: int) -> Iterator[pa.RecordBatch]:
        number = np.array([tree])
        weights = growth.weights(h, number, seed)
        grown = grow(x, y, weights, growth.roots(number, seed), growth, sample_weights(growth, y, weights), **_reach([cut]))
        yield pa.RecordBatch.from_pylist([_unit_row(tree, grown, [cut], growth.criterion)], _UNIT_ARROW)

    shares = [list(s) for s in np.array_split(range(trees), min(trees, _tasks(data, _parallel(data))))]
    return _dealt(data, shares, whole, _UNIT)


def held_out_scores(data: Binned, jobs: Sequence[Job], seed: int = SEED) -> DataFrame:
    """(job, fold, hash, y, score): the mean over each job's trees for every row of its held-out folds.

    ``job`` is the place in ``jobs``; equal jobs are computed once, under the first of them. Rows that repeat a key
    within a fold and label share a score.
    """
    if data.rows > data.local_rows:
        return _split_scores(data, jobs, seed, _parallel(data))

    def rows(table: pa.Table) -> pa.Table:
        hashes, y, score = _put_together(table)
        job, fold = (np.full(len(y), table.column(c)[0].as_py(), np.int32) for c in ("job", "fold"))
        return pa.table({"job": job, "fold": fold, "hash": np.frombuffer(hashes, np.int64), "y": y, "score": score})

    return _local_pieces(data, jobs, seed, BLOCK, _parallel(data)).groupBy("job", "fold", "block").applyInArrow(rows, _SCORES)


_METRICS = "job int, fold int, roc_auc double, avg_precision double"
_METRICS_ARROW = pa.schema([("job", pa.int32()), ("fold", pa.int32()), ("roc_auc", pa.float64()), ("avg_precision", pa.float64())])


def ranking(y: np.ndarray, score: np.ndarray) -> tuple[float | None, float | None]:
    """(roc_auc, avg_precision) of labels and scores that meet in one task; as ``metrics.ranking_metrics``."""
    order = np.argsort(-score)
    score, hit = score[order], y[order] == 1
    ends = np.flatnonzero(np.append(score[1:] != score[:-1], True))
    cum_pos = np.cumsum(hit)[ends].astype(float)
    cum_neg = ends + 1 - cum_pos
    pos, neg, all_pos, all_neg = np.diff(cum_pos, prepend=0), np.diff(cum_neg, prepend=0), cum_pos[-1], cum_neg[-1]
    auc = float((pos * (all_neg - cum_neg + neg / 2)).sum() / (all_pos * all_neg)) if all_pos and all_neg else None
    return auc, float((pos / all_pos * (cum_pos / (cum_pos + cum_neg))).sum()) if all_pos else None


def held_out_ranking(data: Binned, jobs: Sequence[Job], seed: int = SEED) -> DataFrame:
    """(job, fold, roc_auc, avg_precision) of the scores of ``held_out_scores``.

    A fold of a table of up to ``local_rows`` rows is ranked in a task, larger ones by keyed running totals.
    """
    if data.rows > data.local_rows:
        scores = held_out_scores(data, jobs, seed).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            found = metrics.ranking_metrics_by(scores, ["job", "fold"], "y", "score").collect()  # a row for each job and fold
        finally:
            scores.unpersist()
        return data.chunks.sparkSession.createDataFrame([tuple(r) for r in found], _METRICS)

    def measured(table: pa.Table) -> pa.Table:
        auc, precision = ranking(*_put_together(table)[1:])
        out = {"job": table.column("job")[0].as_py(), "fold": table.column("fold")[0].as_py(), "roc_auc": auc, "avg_precision": precision}
        return pa.Table.from_pylist([out], _METRICS_ARROW)

    whole = _local_pieces(data, jobs, seed, data.local_rows, _parallel(data))
    return whole.drop("hash").withColumn("hash", F.lit(b"")).groupBy("job", "fold").applyInArrow(measured, _METRICS)
