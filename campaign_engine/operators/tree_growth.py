"""Growing, pruning and reading decision trees on binned rows: the part of a forest that runs inside a task.

Many trees grow together, level by level. A tree's rows come from a hash of row and tree (a Poisson bootstrap), the
features tried at a node from a hash of tree and path, so a tree is the same wherever it grows, and trees that differ
only in depth, split size, pruning or the size of their forest are cuts of one tree.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

BINS = 256
_DRAWN = 1 << 15  # rows whose counts are drawn together


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of the 64-bit numbers that scatters them."""
    x = np.asarray(x, np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class Growth:
    """What decides how a tree grows; trees of equal growth and number are the same tree."""

    cols: tuple[int, ...]
    tried: int  # features tried at a node
    min_leaf: int = 1
    criterion: str = "gini"  # gini, entropy, or squares for numbers
    class_weight: str | None = None
    rate: float = 1.0
    bootstrap: bool = True

    def weights(self, hashes: np.ndarray, trees: np.ndarray, seed: int) -> np.ndarray:
        """How often each row is in the sample of each tree (trees x rows)."""
        if not self.bootstrap:
            return np.ones((len(trees), len(hashes)), np.int8)
        own = mixed(trees.astype(np.uint64) + np.uint64(seed << 20))
        terms = np.cumsum([math.exp(-self.rate) * self.rate**k / math.factorial(k) for k in range(12)])
        out = np.empty((len(trees), len(hashes)), np.int8)
        for start in range(0, len(hashes), _DRAWN):
            part = hashes[start : start + _DRAWN].view(np.uint64)
            u = (mixed(part[None, :] ^ own[:, None]) >> np.uint64(11)) * 2.0**-53
            out[:, start : start + _DRAWN] = np.searchsorted(terms, u.ravel(), "right").reshape(u.shape)
        return out

    def roots(self, trees: np.ndarray, seed: int) -> np.ndarray:
        return mixed(trees.astype(np.uint64) * np.uint64(2) + np.uint64(1) + np.uint64(seed << 24))

    def features(self, paths: np.ndarray) -> np.ndarray:
        """The features that each node tries (nodes x ``tried``), in the order in which they are tried."""
        cols = np.array(self.cols)
        rank = mixed(paths[:, None] ^ mixed(cols.astype(np.uint64))[None, :])
        return cols[np.argsort(rank, axis=1)[:, : self.tried]]


def children(paths: np.ndarray, side: int) -> np.ndarray:
    return mixed(paths * np.uint64(2) + np.uint64(side))


def impurity(criterion: str, w: np.ndarray, s: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Impurity of nodes of weight w, sum s and sum of squares q, times their weight."""
    with np.errstate(divide="ignore", invalid="ignore"):
        if criterion == "squares":
            return np.where(w > 0, q - s * s / w, 0.0)
        p = np.clip(np.where(w > 0, s / w, 0.0), 0, 1)
        if criterion == "gini":
            return w * 2 * p * (1 - p)
        return w * -(np.where(p > 0, p * np.log2(p), 0.0) + np.where(p < 1, (1 - p) * np.log2(1 - p), 0.0))


def _entropy(w: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Entropy of nodes of weight w and sum s, times their weight, by x log x."""
    terms = (v * np.log2(np.maximum(v, 1e-300)) for v in (w, s, w - s))
    return next(terms) - next(terms) - next(terms)


def gains(criterion: str, left: Sequence[np.ndarray], whole: Sequence[np.ndarray]) -> np.ndarray:
    """Impurity that splits take away, for each 1e-10 units of weight; sums (w, s) of their left sides and of their nodes.

    For squares it is a share of the nodes' impurity, the third part of ``whole``; for entropy that part may be given. It
    is a whole number, so that equal splits stay equal in whatever order their sums were added; the first of them
    counts. Callers leave out splits with an empty side.
    """
    (w, s), (all_w, all_s, *known) = left, whole
    with np.errstate(divide="ignore", invalid="ignore"):
        if criterion == "entropy":
            value = (known[0] if known else _entropy(all_w, all_s)) - _entropy(w, s) - _entropy(all_w - w, all_s - s)
        else:  # squares and, up to a factor, gini
            value = s * s
            value /= w
            rest = all_s - s
            rest *= rest
            rest /= all_w - w
            value += rest
            value -= all_s * all_s / all_w
        value /= known[0] if criterion == "squares" else all_w
        value *= 1e10
        return np.rint(value, out=value)


@dataclass
class Trees:
    """Nodes of trees grown together, level by level; the right child follows the left one."""

    tree: np.ndarray
    parent: np.ndarray
    depth: np.ndarray
    rows: np.ndarray
    w: np.ndarray
    s: np.ndarray
    q: np.ndarray
    feature: np.ndarray  # -1: leaf
    bin: np.ndarray
    left: np.ndarray

    def levels(self) -> list[slice]:
        ends = np.cumsum(np.bincount(self.depth))
        return [slice(int(a), int(b)) for a, b in zip(np.append(0, ends), ends)]

    def values(self) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.w > 0, self.s / self.w, 0.0)


_ONE = 26  # a row's weight and, so many bits up, its weight if it is of class 1: sums of both in one number
_MASK = (1 << _ONE) - 1
_AMOUNTS = np.array([(c & 31) + ((c & 31) * (c >> 5) << _ONE) for c in range(64)])
_FIELD = 17  # bits of each sum where rows, weights and weights of class 1 are one exact float
_FIELD_MASK = (1 << _FIELD) - 1
_FIELDS = np.array([1.0 + ((c & 31) << _FIELD) + ((c & 31) * (c >> 5) << 2 * _FIELD) for c in range(64)])
_FEW_ROWS = 128  # rows a node from which a level counts bins instead of sorting rows


class _Classes:
    """Sums over rows of whole weights and labels 0 and 1: both sums of a place are one whole number.

    A row is its ``cell``, the label above the weight, so that rows sorted by it are in the order of their labels.
    """

    def __init__(self, times: np.ndarray, y: np.ndarray, class_weights: np.ndarray | None):
        self.cell, self.class_weights = (times | (y > 0.5) << 5).astype(np.uint8), class_weights

    def opened(self, sums: np.ndarray, tree: np.ndarray, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(w, s) of sums in trees, or in places of ``tree``."""
        ones, times = sums >> _ONE, (sums & _MASK).astype(float)
        if self.class_weights is None:
            return times, ones.astype(float)
        own = self.class_weights.take(tree, axis=0)
        zero_w, one_w = (v if at is None else v.take(at) for v in np.ascontiguousarray(own.T))
        ones_w = ones * one_w
        times -= ones
        times *= zero_w
        times += ones_w
        return times, ones_w

    def grow(
        self, x: np.ndarray, tree: np.ndarray, row: np.ndarray, paths: np.ndarray, growth: Growth, max_depth: int, min_split: int,
        alpha: float, whole: np.ndarray | None,
    ) -> Trees:
        """As ``grow``, of rows and the trees they are in. The sums of children are those of their parent's best cut."""
        flat, width = np.ascontiguousarray(x).ravel(), x.shape[1]
        least = max(2, 2 * growth.min_leaf, min_split)
        owner, parent, begin, depth = np.arange(len(paths)), np.full(len(paths), -1), 0, 0
        count, total = np.bincount(tree, minlength=len(paths)), np.bincount(tree, _AMOUNTS[self.cell], len(paths)).astype(np.int64)
        node, row, to = tree, row * width, None
        out: dict[str, list[np.ndarray]] = {n: [] for n in ("tree", "parent", "depth", "rows", "w", "s", "q", "feature", "bin", "left")}
        while len(owner):
            n = len(owner)
            w, s = self.opened(total, owner)
            feature, cut, first_child = np.full(n, -1), np.zeros(n, np.int64), np.full(n, -1)
            impure = (s > 0) & (s < w) & (count >= least)
            if alpha > 0:
                whole = w if whole is None else whole
                risk = impurity(growth.criterion, w, s, s) / whole[owner]
                impure &= risk > alpha
            open_ = np.flatnonzero(impure) if depth < max_depth else np.empty(0, np.int64)
            inner = open_[:0]
            if len(open_):
                place = np.full(n + 1, -1)  # the last one is for rows of nodes that weren't split
                place[open_] = np.arange(len(open_))
                if to is None:
                    node = place.take(node)
                else:  # what was split last goes to its children
                    node <<= 1
                    node += side
                    node = place[to].take(node)
                keep = np.flatnonzero(node >= 0)
                if len(keep) < len(node):  # go on with the rows of open nodes alone
                    node, row, self.cell = node.take(keep), row.take(keep), self.cell.take(keep)
                tried = growth.features(paths[open_])
                found, at_bin, left, size = self.best_cuts(flat, node, row, tried, growth, count[open_], total[open_], owner[open_], w[open_], s[open_])
                if alpha > 0:
                    below = [np.minimum(impurity(growth.criterion, *v, v[1]) / whole[owner[open_]], alpha)
                             for v in (self.opened(part, owner[open_]) for part in (left, total[open_] - left))]
                    found[risk[open_] <= alpha + below[0] + below[1]] = -1
                feature[open_], cut[open_] = found, np.where(found >= 0, at_bin, 0)
                split = np.flatnonzero(found >= 0)
                inner = open_[split]
                first_child[inner] = begin + n + 2 * np.arange(len(inner))
            for name, values in zip(out, (owner, parent, np.full(n, depth), count, w, s, s, feature, cut, first_child)):
                out[name].append(values)
            if not len(inner):
                break
            own = (found << 8 | at_bin).take(node)  # of nodes that aren't split, any place in the table
            place = own >> 8
            place += row
            side = flat.take(place) > (own & (BINS - 1)).astype(np.uint8)
            to = np.full(2 * len(open_), -1)
            to[2 * split], to[2 * split + 1] = 2 * np.arange(len(inner)), 2 * np.arange(len(inner)) + 1
            size, left = size[split], left[split]
            count = np.column_stack([size, count[inner] - size]).ravel()
            total = np.column_stack([left, total[inner] - left]).ravel()
            owner, parent = np.repeat(owner[inner], 2), np.repeat(inner + begin, 2)
            paths = np.column_stack([children(paths[inner], 0), children(paths[inner], 1)]).ravel()
            begin, depth = begin + n, depth + 1
        return Trees(*(np.concatenate(v) if v else np.empty(0, np.int64) for v in out.values()))

    def best_cuts(
        self, flat: np.ndarray, node: np.ndarray, row: np.ndarray, tried: np.ndarray, growth: Growth, count: np.ndarray,
        total: np.ndarray, owner: np.ndarray, w: np.ndarray, s: np.ndarray,
    ) -> tuple[np.ndarray, ...]:
        """(feature or -1, bin, sums of the left side, rows there) of each open node's best split.

        A cut between two bins that hold one and the same class is no best one, as what is gained along them is convex.
        """
        n, least = len(tried), growth.min_leaf
        starts = np.cumsum(count) - count
        wholes = [w, s, _entropy(w, s)] if growth.criterion == "entropy" else [w, s]
        best, feature, cut, lefts, sizes = np.full(n, -np.inf), np.full(n, -1), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        many = len(node) > _FEW_ROWS * n
        kind = np.uint32 if n < 1 << 18 else np.uint64
        if many:
            base, small = node << 8, int((total & _MASK).max()) < 1 << _FIELD
            amounts = (_FIELDS if small else _AMOUNTS.astype(float)).take(self.cell)
        else:
            base = node.astype(kind)
            base <<= kind(14)
            base |= self.cell
        for k in range(tried.shape[1]):
            own = np.ascontiguousarray(tried[:, k])
            place = own.take(node)
            place += row
            if many:
                place = flat.take(place) + base
                sums = np.bincount(place, amounts, n * BINS)
                if small:  # rows, weights and weights of class 1 in one number
                    ends = np.flatnonzero(sums)
                    sums = sums.take(ends).astype(np.int64)
                    each, sums = sums & _FIELD_MASK, sums >> _FIELD
                    sums = (sums & _FIELD_MASK) + (sums >> _FIELD << _ONE)
                else:
                    each = np.bincount(place, minlength=n * BINS)
                    ends = np.flatnonzero(each)
                    each, sums = each.take(ends), sums.take(ends).astype(np.int64)
                at, bins = ends >> 8, ends & (BINS - 1)
                inside = np.append(at[1:] == at[:-1], False)
                last = np.flatnonzero(~inside)
                inside = np.flatnonzero(inside)
                size, running = np.cumsum(each), np.cumsum(sums)
                before = np.append(0, running[last[:-1]])
                at, bins = at.take(inside), bins.take(inside)
                size, left = size.take(inside) - starts.take(at), running.take(inside) - before.take(at)
                if least > 1:
                    fits = np.flatnonzero((size >= least) & (count.take(at) - size >= least))
                    at, bins, left, size = at.take(fits), bins.take(fits), left.take(fits), size.take(fits)
            else:
                key = flat.take(place).astype(kind)
                key <<= kind(6)
                key |= base
                key.sort()
                running = np.cumsum(_AMOUNTS.take(key & kind(63)))
                names = key >> kind(6)
                ends = np.append(np.flatnonzero(names[1:] != names[:-1]), len(key) - 1)
                bins = key.take(ends)
                label = (bins & kind(32)) + (key.take(np.append(0, ends[:-1] + 1)) & kind(32))  # the labels at both ends of each bin
                at = bins >> kind(14)
                inside = at[1:] == at[:-1]
                alike = (label[1:] == label[:-1]) & (label[1:] != 32)
                if least > 1:
                    size = ends[:-1] + 1
                    size -= starts.take(at[:-1])
                    inside &= (size >= least) & (count.take(at[:-1]) - size >= least)
                    alike[1:] &= inside[:-1]  # what is gained is highest where no more rows fit a side, too
                    alike[:-1] &= inside[1:]
                inside = np.flatnonzero(inside & ~alike)
                ends, at, bins = ends.take(inside), at.take(inside).astype(np.int64), bins.take(inside)
                before = running[starts - 1]
                before[0] = 0
                left, size = running.take(ends) - before.take(at), ends + 1 - starts.take(at)
                bins = (bins >> kind(6) & kind(BINS - 1)).astype(np.int64)
            if not len(at):
                continue
            gain = gains(growth.criterion, self.opened(left, owner, at), [v.take(at) for v in wholes])
            first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            nodes, top = at[first], np.maximum.reduceat(gain, first)
            better = top > best[nodes]
            highest = np.full(n, np.nan)
            highest[nodes[better]] = top[better]
            where = np.flatnonzero(gain == highest.take(at))[::-1]  # of equal gains the first one is written last
            best[nodes[better]] = top[better]
            at = at[where]
            feature[at], cut[at], lefts[at], sizes[at] = own[at], bins[where], left[where], size[where]
        return feature, cut, lefts, sizes


class _Numbers:
    """Sums over rows of weights, of labels and of their squares; columns of an array."""

    def __init__(self, w: np.ndarray, y: np.ndarray):
        self.parts = [w, w * y, w * y * y]

    def keep(self, which: np.ndarray) -> None:
        self.parts = [p[which] for p in self.parts]

    def by(self, key: np.ndarray, n: int) -> np.ndarray:
        return np.stack([np.bincount(key, p, n) for p in self.parts], axis=-1)

    def sorted(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.sort(key << 32 | np.arange(len(key)))
        key = order >> 32
        order &= (1 << 32) - 1
        return key, np.cumsum(np.stack([p[order] for p in self.parts[:2]], axis=-1), axis=0)

    def centred(self, node: np.ndarray, means: np.ndarray) -> _Numbers:
        """Labels less their nodes' means: sums stay small, so that equal splits are equal whatever rows were added before."""
        out = _Numbers.__new__(_Numbers)
        own = self.parts[1] - self.parts[0] * means[node]
        out.parts = [self.parts[0], own, own * own / self.parts[0]]
        return out

    def slim(self, sums: np.ndarray) -> np.ndarray:
        """Without the squares, which no split needs."""
        return sums[..., :2]

    def opened(self, sums: np.ndarray, tree: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return tuple(sums[..., i] for i in range(sums.shape[-1]))


def grow(
    x: np.ndarray, y: np.ndarray, weights: np.ndarray, paths: np.ndarray, growth: Growth, class_weights: np.ndarray | None = None,
    max_depth: int = 64, min_split: int = 2, alpha: float = 0.0, whole: np.ndarray | None = None,
) -> Trees:
    """One tree for each row of ``weights``, from its path on. ``class_weights``: (trees x 2), by label.

    Nodes of ``max_depth``, or of fewer rows than ``min_split``, are leaves, and so are those that pruning by ``alpha``
    takes in any case: two leaves cost ``alpha`` each, and a child costs no less than ``alpha`` and the lesser of its
    impurity and ``alpha`` (shares of the trees' weights, ``whole`` if only a part of a tree is grown). Levels of large
    nodes count the rows of each bin, those of small nodes sort their rows.
    """
    tree, row = np.nonzero(weights)
    times, y = weights[tree, row], y[row]
    if growth.criterion != "squares" and times.max(initial=0) < 32 and times.sum() <= _MASK and ((y == 0) | (y == 1)).all():
        return _Classes(times, y, class_weights).grow(x, tree, row, paths, growth, max_depth, min_split, alpha, whole)
    w = times.astype(float)
    if class_weights is not None:
        w *= class_weights[tree, (y > 0.5).astype(int)]
    sums = _Numbers(w, y)
    flat, node, row = np.ascontiguousarray(x).ravel(), tree, row * x.shape[1]
    del tree, times, w, y  # each is as long as the sample
    out: dict[str, list[np.ndarray]] = {n: [] for n in ("tree", "parent", "depth", "rows", "w", "s", "q", "feature", "bin", "left")}
    owner, parent, begin, depth = np.arange(len(weights)), np.full(len(weights), -1), 0, 0
    while len(owner):
        n = len(owner)
        count = np.bincount(node, minlength=n)
        total = sums.by(node, n)
        w, s, q = sums.opened(total, owner)
        risk = impurity(growth.criterion, w, s, q)
        impure = risk > 1e-9 * np.maximum(q, 1e-300)
        if alpha > 0:
            whole = w if whole is None else whole
            impure &= risk > alpha * whole[owner]
        feature, cut, first_child = np.full(n, -1), np.zeros(n, np.int64), np.full(n, -1)
        open_ = np.flatnonzero(impure & (count >= max(2, 2 * growth.min_leaf, min_split))) if depth < max_depth else np.empty(0, np.int64)
        if len(open_):
            if len(open_) < n:  # go on with the rows of open nodes alone
                place = np.full(n, -1)
                place[open_] = np.arange(len(open_))
                node = place[node]
                keep = np.flatnonzero(node >= 0)
                node, row = node[keep], row[keep]
                sums.keep(keep)
            tried = growth.features(paths[open_])
            own, found, at_bin = _best_cuts(flat, node, row, sums, tried, growth, count[open_], total[open_], owner[open_])
            feature[open_], cut[open_] = found, at_bin
            split = own >= 0
            inner = open_[split]
            first_child[inner] = begin + n + 2 * np.arange(len(inner))
        for name, values in zip(out, (owner, parent, np.full(n, depth), count, w, s, q, feature, cut, first_child)):
            out[name].append(values)
        if not len(open_) or not len(inner):
            break
        if len(inner) < len(open_):
            place = np.where(split, np.cumsum(split) - 1, -1)
            keep = np.flatnonzero(split[node])
            node, row = place[node[keep]], row[keep]
            sums.keep(keep)
        node = 2 * node + (flat[row + feature[inner][node]] > cut[inner][node])
        owner, parent = np.repeat(owner[inner], 2), np.repeat(inner + begin, 2)
        paths = np.column_stack([children(paths[inner], 0), children(paths[inner], 1)]).ravel()
        begin, depth = begin + n, depth + 1
    return Trees(*(np.concatenate(v) if v else np.empty(0, np.int64) for v in out.values()))


def _best_cuts(
    flat: np.ndarray, node: np.ndarray, row: np.ndarray, sums: _Numbers, tried: np.ndarray, growth: Growth,
    count: np.ndarray, total: np.ndarray, owner: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node or -1, feature, bin) of each open node's best split; ``row`` is where a row begins in ``flat``."""
    n, least = len(tried), growth.min_leaf
    w, s, q = sums.opened(total, owner)
    wholes, total = [w, s], sums.slim(total)
    if growth.criterion == "squares":
        sums = sums.centred(node, s / w)
        wholes = [w, np.zeros(n), np.bincount(node, sums.parts[2], n)]
        total = np.column_stack(wholes[:2])
    if growth.criterion == "entropy":
        wholes.append(_entropy(*wholes))
    starts = np.cumsum(count) - count
    best, feature, cut = np.full(n, -np.inf), np.full(n, -1), np.zeros(n, np.int64)
    for k in range(tried.shape[1]):
        own = np.ascontiguousarray(tried[:, k])
        key = node * BINS + flat[row + own[node]]
        if len(node) > _FEW_ROWS * n:
            each = np.bincount(key, minlength=n * BINS)
            ends = np.flatnonzero(each)
            at, bins = ends >> 8, ends & (BINS - 1)
            last = np.flatnonzero(np.append(at[1:] != at[:-1], True))
            size = np.cumsum(each[ends]) - starts[at]
            running = np.cumsum(sums.slim(sums.by(key, n * BINS)[ends]), axis=0)
            before = np.concatenate([np.zeros_like(running[:1]), running])[np.append(0, last[:-1] + 1)]
            left = running - before[at]  # every open node has rows
            inside = np.ones(len(ends), bool)
            inside[last] = False
            at, bins, size, left = at[inside], bins[inside], size[inside], left[inside]
        else:
            ordered, running = sums.sorted(key)
            ends = np.flatnonzero(ordered[1:] != ordered[:-1])
            last = ordered[ends]
            at = last >> 8
            inside = np.flatnonzero(at == ordered[ends + 1] >> 8)
            ends, at, bins = ends[inside], at[inside], last[inside] & (BINS - 1)
            before = np.concatenate([np.zeros_like(running[:1]), running])[starts]
            left, size = running[ends] - before[at], ends + 1 - starts[at]
        if least > 1:
            fits = np.flatnonzero((size >= least) & (count[at] - size >= least))
            at, bins, left = at[fits], bins[fits], left[fits]
        if not len(at):
            continue
        gain = gains(growth.criterion, sums.opened(left, owner[at])[:2], [v[at] for v in wholes])
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        nodes, top = at[first], np.maximum.reduceat(gain, first)
        better = top > best[nodes]
        highest = np.full(n, np.nan)
        highest[nodes[better]] = top[better]
        where = np.flatnonzero(gain == highest[at])[::-1]  # of equal gains the first one is written last
        best[nodes[better]] = top[better]
        feature[at[where]], cut[at[where]] = own[at[where]], bins[where]
    return np.where(feature >= 0, np.arange(n), -1), feature, cut


@dataclass(frozen=True)
class Cut:
    """How much of a grown tree a candidate uses."""

    max_depth: int | None = None
    min_split: int = 2
    alpha: float = 0.0


def cut_values(trees: Trees, cut: Cut, criterion: str) -> np.ndarray:
    """For each node, the value of the node at which rows that pass it stop, once the trees are cut.

    Pruning is minimal cost-complexity pruning: a subtree goes if its leaves' impurity and ``alpha`` for each leaf
    are no less than the impurity of its root as a leaf and ``alpha`` (shares of the tree's weight).
    """
    stop = (trees.feature < 0) | (trees.rows < cut.min_split)
    if cut.max_depth is not None:
        stop |= trees.depth >= cut.max_depth
    levels = trees.levels()
    if cut.alpha > 0:
        whole = trees.w[levels[0]][trees.tree] if levels else trees.w
        risk = impurity(criterion, trees.w, trees.s, trees.q) / np.maximum(whole, 1e-300) + cut.alpha
        cost = risk.copy()
        for level in reversed(levels):
            inner = np.flatnonzero(~stop[level]) + level.start
            below = cost[trees.left[inner]] + cost[trees.left[inner] + 1]
            stop[inner] = risk[inner] <= below + 1e-12
            cost[inner] = np.minimum(risk[inner], below)
    value = trees.values()
    if not (stop & (trees.feature >= 0)).any():  # nothing is cut
        return value
    for level in levels[1:]:
        above = trees.parent[level]
        value[level] = np.where(stop[above], value[above], value[level])
        stop[level] |= stop[above]
    return value


_STEPS = 4  # steps down a tree until rows that reached a leaf are left out


def leaves(feature: np.ndarray, bins: np.ndarray, left: np.ndarray, roots: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The leaf that each row reaches from each root (roots x rows)."""
    inner, own = feature >= 0, np.arange(len(feature))  # a leaf leads to itself
    step = np.where(inner, left.astype(np.int64) << 24 | feature.astype(np.int64) << 8 | bins.astype(np.int64), own << 24 | 0xFF)
    flat, out = np.ascontiguousarray(x).ravel(), np.repeat(roots, len(x))
    row, at, place = np.tile(np.arange(len(x)) * x.shape[1], len(roots)), out.copy(), np.arange(len(out))
    while len(at):
        going = np.flatnonzero(inner.take(at))
        if len(going) < len(at):
            out[place] = at
            at, row, place = at.take(going), row.take(going), place.take(going)
        for _ in range(_STEPS):
            own = step.take(at)
            at = (own >> 24) + (flat.take(row + (own >> 8 & 0xFFFF)) > (own & 0xFF))
    return out.reshape(len(roots), len(x))


def sample_weights(growth: Growth, y: np.ndarray, weights: np.ndarray) -> np.ndarray | None:
    """Class weights (trees x 2): n / (classes x rows of the class), of all rows or of each tree's own sample."""
    if growth.class_weight is None:
        return None
    one = y > 0.5
    counts = np.ones_like(weights) if growth.class_weight == "balanced" else weights
    n = np.column_stack([counts[:, ~one].sum(axis=1), counts[:, one].sum(axis=1)]).astype(float)
    present = np.maximum((n > 0).sum(axis=1, keepdims=True), 1)
    return n.sum(axis=1, keepdims=True) / (present * np.maximum(n, 1))


def best_split(growth: Growth, tried: np.ndarray, counts: np.ndarray, sums: np.ndarray, squares: float) -> tuple[int, int]:
    """(feature, bin) of a node's best split, or (-1, 0), by the sums of its bins: ``counts`` (tried x bins) and
    ``sums`` (2 x tried x bins); the same rule as that of ``grow``."""
    whole = sums[:, 0].sum(axis=1)
    n = int(counts[0].sum())
    if n < max(2, 2 * growth.min_leaf) or impurity(growth.criterion, *whole, np.float64(squares)) <= 1e-9 * max(squares, 1e-300):
        return -1, 0
    whole = [np.repeat(v, BINS) for v in whole] + [np.repeat(impurity(growth.criterion, *whole, np.float64(squares)), BINS)]
    best, found = -np.inf, (-1, 0)
    for k, feature in enumerate(tried.tolist()):
        left, size = np.cumsum(sums[:, k], axis=1), np.cumsum(counts[k])
        gain = gains(growth.criterion, left, whole)
        gain[(counts[k] == 0) | (size < max(1, growth.min_leaf)) | (n - size < max(1, growth.min_leaf))] = -np.inf
        at = int(gain.argmax())  # an empty side was left out above
        if gain[at] > best:
            best, found = gain[at], (feature, at)
    return found


def tried_features(share, n: int) -> int:
    """Features tried at a node: ``sqrt``, ``log2``, a share, a number, or all."""
    if share is None:
        return n
    number = math.sqrt(n) if share == "sqrt" else math.log2(n) if share == "log2" else share * n if isinstance(share, float) else share
    return min(n, max(1, int(number)))


def growth_of(params: dict, cols: Sequence[int], criterion: str | None = None) -> tuple[Growth, Cut, int]:
    """(how its trees grow, how they are cut, how many there are) of forest parameters."""
    criterion = criterion or {"log_loss": "entropy"}.get(params.get("criterion", "gini"), params.get("criterion", "gini"))
    growth = Growth(
        tuple(cols), tried_features(params.get("max_features", "sqrt"), len(cols)), int(params.get("min_samples_leaf", 1)), criterion,
        params.get("class_weight"), float(params.get("max_samples") or 1.0), bool(params.get("bootstrap", True)),
    )
    depth = params.get("max_depth")
    cut = Cut(None if depth is None else int(depth), int(params.get("min_samples_split", 2)), float(params.get("ccp_alpha", 0.0)))
    return growth, cut, int(params.get("n_estimators", 100))
