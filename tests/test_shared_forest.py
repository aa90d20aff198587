"""Shared growing of forests: splits, pruning and weights against plain versions, and one way of growing against the other."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from campaign_engine.operators import metrics, shared_forest
from campaign_engine.operators.tree_growth import BINS, Cut, Growth, best_split, cut_values, grow, growth_of, impurity, leaves, sample_weights


def table(n=300, d=4, seed=0, values=12):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, values, (n, d)).astype(np.uint8)
    y = (rng.random(n) < 1 / (1 + np.exp(-(x[:, 0] - values / 2.0 + (x[:, 1] > 3))))).astype(float)
    return x, y, rng.integers(-(2**62), 2**62, n)


def one_tree(x, y, h, growth, seed=3, number=5):
    weights = growth.weights(h, np.array([number]), seed)
    return grow(x, y, weights, growth.roots(np.array([number]), seed), growth, sample_weights(growth, y, weights)), weights[0]


@pytest.mark.parametrize("criterion", ["gini", "entropy", "squares"])
@pytest.mark.parametrize("weight", [None, "balanced", "balanced_subsample"])
def test_each_split_is_the_best_of_all(criterion, weight):
    x, y, h = table()
    if criterion == "squares":
        y, weight = y + x[:, 2] / 7, None
    growth = Growth((0, 1, 2, 3), 4, 3, criterion, weight)
    trees, times = one_tree(x, y, h, growth)
    own = times.astype(float)
    if weight:
        n = np.array([(times if weight == "balanced_subsample" else np.ones(len(y)))[y == c].sum() for c in (0, 1)])
        own = times * (n.sum() / (2 * n))[y.astype(int)]
    inside = {0: np.flatnonzero(times)}
    part = lambda rows: impurity(criterion, own[rows].sum(), (own * y)[rows].sum(), (own * y * y)[rows].sum())
    for node in range(len(trees.feature)):
        rows = inside[node]
        assert trees.rows[node] == len(rows) and trees.values()[node] == pytest.approx((own * y)[rows].sum() / own[rows].sum())
        options = {}
        for f in range(4):
            for cut in np.unique(x[rows, f])[:-1]:
                low, high = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                if min(len(low), len(high)) >= 3:
                    options[f, int(cut)] = part(rows) - part(low) - part(high)
        if trees.feature[node] < 0:
            assert not options or part(rows) < 1e-6
            continue
        f, cut = trees.feature[node], trees.bin[node]
        assert options[f, cut] == pytest.approx(max(options.values()), abs=1e-9)
        inside[trees.left[node]], inside[trees.left[node] + 1] = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]


def test_binned_sums_choose_the_same_split():
    x, y, h = table(500, 5, 1)
    for criterion in ("gini", "entropy"):
        growth = Growth((0, 2, 3, 4), 3, 4, criterion)
        trees, times = one_tree(x, y, h, growth)
        tried = growth.features(growth.roots(np.array([5]), 3))[0]
        kept = times > 0
        sums = [[np.bincount(x[kept, f], v[kept], BINS) for f in tried] for v in (np.ones(500), times * 1.0, times * y)]
        assert best_split(growth, tried, np.array(sums[0]), np.array(sums[1:]), (times * y).sum()) == (trees.feature[0], trees.bin[0])


def weakest_links(trees, criterion, alpha):
    """Plain pruning: the inner node with the smallest loss a leaf goes first, while that is no more than alpha."""
    left = {i: trees.left[i] for i in range(len(trees.left)) if trees.feature[i] >= 0}
    risk = impurity(criterion, trees.w, trees.s, trees.q) / trees.w[0]

    def under(i):
        return under(left[i]) + under(left[i] + 1) if i in left else [i]

    while left:
        loss = {i: (risk[i] - risk[under(i)].sum()) / (len(under(i)) - 1) for i in left}
        weakest = min(loss, key=lambda i: (loss[i], i))
        if loss[weakest] > alpha + 1e-12:
            break
        gone, stack = [weakest], [left[weakest], left[weakest] + 1]
        while stack:
            node = stack.pop()
            if node in left:
                gone.append(node)
                stack += [left[node], left[node] + 1]
        for node in gone:
            left.pop(node, None)
    return set(left)


@pytest.mark.parametrize("criterion", ["gini", "entropy"])
@pytest.mark.parametrize("alpha", [1e-4, 3e-3, 0.01, 0.05, 1.0])
def test_pruning_equals_the_weakest_links(criterion, alpha):
    x, y, h = table(250, 3, 4)
    trees, _ = one_tree(x, y, h, Growth((0, 1, 2), 2, 2, criterion))
    inner, values = weakest_links(trees, criterion, alpha), trees.values()
    want = []
    for row in x:
        node = 0
        while node in inner:
            node = trees.left[node] + (row[trees.feature[node]] > trees.bin[node])
        want.append(values[node])
    at = leaves(trees.feature, trees.bin, trees.left, np.array([0]), x)[0]
    assert cut_values(trees, Cut(alpha=alpha), criterion)[at] == pytest.approx(want)


def test_cuts_are_trees_that_were_grown_so():
    x, y, h = table(400, 4, 6)
    growth = Growth((0, 1, 2, 3), 2)
    trees, _ = one_tree(x, y, h, growth)
    at = leaves(trees.feature, trees.bin, trees.left, np.array([0]), x)[0]
    weights = growth.weights(h, np.array([5]), 3)
    short = grow(x, y, weights, growth.roots(np.array([5]), 3), growth, max_depth=3)
    there = leaves(short.feature, short.bin, short.left, np.array([0]), x)[0]
    assert cut_values(trees, Cut(max_depth=3), "gini")[at] == pytest.approx(short.values()[there])
    thick = cut_values(trees, Cut(min_split=40), "gini")[at]
    node = np.zeros(len(x), int)
    for _ in range(60):
        go = (trees.feature[node] >= 0) & (trees.rows[node] >= 40)
        node = np.where(go, trees.left[node] + (x[np.arange(len(x)), trees.feature[node]] > trees.bin[node]), node)
    assert thick == pytest.approx(trees.values()[node])


def test_subsample_weights_are_each_trees_own():
    _, y, h = table(300, 2, 8)
    growth = Growth((0, 1), 1, class_weight="balanced_subsample", rate=0.7)
    times = growth.weights(h, np.arange(6), 1)
    got = sample_weights(growth, y, times)
    for t in range(6):
        n = np.array([times[t][y == c].sum() for c in (0, 1)])
        assert got[t] == pytest.approx(n.sum() / (2 * n))
    assert len({tuple(g) for g in got.round(9).tolist()}) > 1 and 0.6 < times.mean() < 0.8


@pytest.fixture(scope="module")
def rows(spark):
    x, y, _ = table(700, 4, 9)
    data = [(f"C-{i}", *map(float, r), float(v), i % 3) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, "client_id string, a double, b double, c double, d double, label double, fold int").repartition(5)


COLS = ["a", "b", "c", "d"]


def jobs():
    params = [
        {"n_estimators": 7, "class_weight": "balanced_subsample"}, {"n_estimators": 4, "max_depth": 3, "class_weight": "balanced_subsample"},
        {"n_estimators": 5, "max_features": None, "criterion": "entropy", "class_weight": "balanced", "max_samples": 0.7},
        {"n_estimators": 7, "min_samples_split": 30, "ccp_alpha": 0.002, "class_weight": "balanced_subsample"},
        {"n_estimators": 3, "min_samples_leaf": 5, "bootstrap": False, "max_features": 0.5},
    ]
    out = [shared_forest.Job(*growth_of(p, range(4)), (0, 1, 2)) for p in params]
    return out + [shared_forest.Job(*growth_of(params[0], (1, 2)), (1,))]


def scores(rows, local_rows):
    data = shared_forest.Binned(rows, COLS, "client_id", "label", "fold", local_rows)
    try:
        return {(r["job"], r["hash"]): (r["fold"], r["y"], r["score"]) for r in shared_forest.held_out_scores(data, jobs()).collect()}
    finally:
        data.unpersist()


def test_split_nodes_give_the_trees_of_one_task(rows):
    local = scores(rows, 20_000)
    assert len(local) == 5 * 700 + sum(i % 3 == 1 for i in range(700))
    spread = scores(rows, 60)
    assert local.keys() == spread.keys()
    apart = [k for k in local if abs(local[k][2] - spread[k][2]) > 1e-6]
    assert len(apart) < 0.01 * len(local)  # equal gains of rounded sums may fall to another split


def test_scores_are_those_of_trees_grown_alone(rows):
    local = scores(rows, 20_000)
    job = jobs()[3]
    found = [tuple(r) for r in rows.select(F.xxhash64("client_id"), *COLS, "label", "fold").collect()]
    h, x = np.array([r[0] for r in found]), np.array([r[1:5] for r in found]).astype(np.uint8)
    y, fold = np.array([r[5] for r in found]), np.array([r[6] for r in found])
    for f in (0, 1, 2):
        learnt, total = fold != f, 0
        for t in range(7):
            weights = job.growth.weights(h[learnt], np.array([t]), shared_forest.SEED)
            tree = grow(x[learnt], y[learnt], weights, job.growth.roots(np.array([t]), shared_forest.SEED), job.growth,
                        sample_weights(job.growth, y[learnt], weights))
            total = total + cut_values(tree, job.cut, "gini")[leaves(tree.feature, tree.bin, tree.left, np.array([0]), x[~learnt])[0]]
        assert [local[3, i][2] for i in h[~learnt].tolist()] == pytest.approx(total / 7, abs=1e-6)


@pytest.mark.parametrize("limit", [10**6, 200])
def test_ranking_metrics_of_all_groups_at_once(spark, limit):
    rng = np.random.default_rng(5)
    sizes = [3000 if g == 0 else int(rng.integers(1, 60)) for g in range(50)]
    data = [(g if g else None, int(rng.random() < 0.4), float(rng.integers(0, 400)) / 400 if rng.random() < 0.98 else None) for g, n in enumerate(sizes) for _ in range(n)]
    frame = spark.createDataFrame(data, "part int, label int, score double")
    got = {r["part"]: r for r in metrics.ranking_metrics_by(frame, ["part"], "label", "score", limit).collect()}
    for g in range(50):
        own = metrics.ranking_metrics(frame.filter(F.col("part").eqNullSafe(F.lit(g if g else None))), "label", "score").first() if g < 6 else None
        assert own is None or (got[g or None]["roc_auc"], got[g or None]["avg_precision"]) == pytest.approx((own["roc_auc"], own["avg_precision"]), nan_ok=True)
    assert len(got) == 50


def test_null_values_few_values_and_no_rows(spark):
    rows = [(i, None if i % 5 == 0 else float(i % 7), float(i) if i % 3 else float("nan"), None if i % 11 == 0 else float(i % 2), i % 2) for i in range(200)]
    frame = spark.createDataFrame(rows, "k long, a double, b double, label double, fold int")
    data = shared_forest.Binned(frame, ["a", "b"], "k", "label", "fold")
    assert data.rows == 181 and len(data.edges[0]) == 6
    job = [shared_forest.Job(*growth_of({"n_estimators": 2}, range(2)), (0, 1))]
    assert shared_forest.held_out_scores(data, job).count() == 181
    empty = shared_forest.Binned(frame.limit(0), ["a", "b"], "k", "label", "fold")
    assert shared_forest.held_out_scores(empty, job).collect() == []


def test_rows_go_to_shares_of_trees_and_not_to_each_tree(rows):
    data = shared_forest.Binned(rows, COLS, "client_id", "label", "fold")
    try:
        many = [shared_forest.Job(*growth_of({"n_estimators": 200, "max_depth": d}, range(4)), (0, 1, 2)) for d in (2, 3, 4)]
        pieces = shared_forest._local_pieces(data, many, 1, shared_forest.BLOCK, 2).toPandas()
        shares = shared_forest.TASKS * 2
        assert len(pieces) <= 3 * (3 + shares)  # a row for each job and fold, and for each share that ends inside of one
        assert (pieces.groupby(["job", "fold"]).trees.sum() == 200).all()
        assert all(len(b) == 8 * n for b, n in zip(pieces.total, pieces.fold.map({f: sum(i % 3 == f for i in range(700)) for f in range(3)})))
    finally:
        data.unpersist()


def test_shares_hold_each_tree_once():
    growths = [Growth((0, 1, 2), 1), Growth((0, 1, 2), 3)]
    wanted = [shared_forest._Wanted(g, f, trees, ()) for g, trees in ((0, 100), (1, 7)) for f in range(3)]
    shares = shared_forest._shares(wanted, growths, 16)
    found = sorted((i, t) for s in shares for i, first, end in s for t in range(first, end))
    assert found == [(i, t) for i, w in enumerate(wanted) for t in range(w.trees)]
    work = [sum((end - first) * (growths[wanted[i].growth].tried + 1) for i, first, end in s) for s in shares]
    assert max(work) - min(work) <= 8


def test_growing_ends_where_no_cut_goes():
    x, y, h = table(400, 4, 6)
    growth = Growth((0, 1, 2, 3), 2)
    weights, roots = growth.weights(h, np.array([5]), 3), growth.roots(np.array([5]), 3)
    whole, cuts = grow(x, y, weights, roots, growth), [Cut(4, 10), Cut(3, 20, 0.002)]
    short = grow(x, y, weights, roots, growth, **shared_forest._reach(cuts))
    assert len(short.feature) < len(whole.feature) and short.depth.max() <= 4
    for cut in cuts:
        values = [cut_values(t, cut, "gini")[leaves(t.feature, t.bin, t.left, np.array([0]), x)[0]] for t in (whole, short)]
        assert values[0] == pytest.approx(values[1])


@pytest.mark.parametrize("criterion,weight", [("gini", "balanced"), ("entropy", None), ("squares", None)])
def test_counted_bins_and_sorted_rows_give_one_tree(monkeypatch, criterion, weight):
    from campaign_engine.operators import tree_growth

    x, y, h = table(600, 4, 2, 40)
    y = y + x[:, 2] if criterion == "squares" else y
    growth, found = Growth((0, 1, 2, 3), 3, 2, criterion, weight), []
    for rows_a_node in (0, 10**9):
        monkeypatch.setattr(tree_growth, "_FEW_ROWS", rows_a_node)
        found.append(one_tree(x, y, h, growth)[0])
    for name in ("feature", "bin", "left", "rows", "w", "s"):
        assert getattr(found[0], name) == pytest.approx(getattr(found[1], name))


def test_ranking_in_a_task_is_that_of_the_metrics(rows):
    data = shared_forest.Binned(rows, COLS, "client_id", "label", "fold")
    try:
        scores = shared_forest.held_out_scores(data, jobs()).persist()
        want = {(r["job"], r["fold"]): tuple(r)[2:] for r in metrics.ranking_metrics_by(scores, ["job", "fold"], "y", "score").collect()}
        got = {(r["job"], r["fold"]): tuple(r)[2:] for r in shared_forest.held_out_ranking(data, jobs()).collect()}
    finally:
        data.unpersist()
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    assert shared_forest.ranking(np.ones(3), np.arange(3.0)) == (None, 1.0) and shared_forest.ranking(np.zeros(2), np.zeros(2)) == (None, None)


def test_regression_trees_do_not_depend_on_the_order_of_rows_or_on_their_neighbours():
    rng = np.random.default_rng(3)
    n = 400
    x, y, h = rng.integers(0, 255, (n, 6)).astype(np.uint8), np.round(rng.lognormal(14, 0.6, n), 2), rng.integers(-(2**62), 2**62, n)
    growth, order = Growth((0, 1, 2, 3, 4, 5), 3, 1, "squares"), rng.permutation(n)

    def predicted(rows, trees):
        trees = np.array(trees)
        found = grow(x[rows], y[rows], growth.weights(h[rows], trees, 7), growth.roots(trees, 7), growth)
        return found.values()[leaves(found.feature, found.bin, found.left, np.arange(len(trees)), 255 - x)]

    together = predicted(np.arange(n), range(20))
    for other in (predicted(order, range(20)), np.vstack([predicted(order, [t]) for t in range(20)])):
        assert (abs(other / together - 1) > 1e-9).mean() < 0.001  # gains that end half way between two numbers may fall apart
