"""Growing and walking trees: every way of finding cuts gives the same trees, and large tables are dealt once a task."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from campaign_engine.operators import shared_forest, tree_growth
from campaign_engine.operators.tree_growth import grow, growth_of, leaves, sample_weights


def table(rows, seed=3):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, n, rows) for n in (3, 40, 250, 256)]).astype(np.uint8)
    y = ((x[:, 1] > 20) ^ (rng.random(rows) < 0.25)).astype(float)
    return x, y, rng.integers(-(2**62), 2**62, rows)


@pytest.mark.parametrize("params", [
    {"max_features": 2}, {"max_features": None, "min_samples_leaf": 3, "class_weight": "balanced_subsample"},
    {"criterion": "entropy", "min_samples_leaf": 2, "class_weight": "balanced"},
])
def test_cuts_are_the_same_by_one_count_two_counts_and_sorting(monkeypatch, params):
    x, y, h = table(3_000)
    growth, _, trees = growth_of({**params, "n_estimators": 4}, range(4))
    number = np.arange(trees)
    weights = growth.weights(h, number, 5)
    grown = []
    for few, field in ((0, 17), (0, 0), (10**9, 17)):  # sums in one number, sums too large for it, rows sorted
        monkeypatch.setattr(tree_growth, "_FEW_ROWS", few)
        if field != 17:
            monkeypatch.setattr(tree_growth, "_FIELD", field)
        grown.append(grow(x, y, weights, growth.roots(number, 5), growth, sample_weights(growth, y, weights)))
        monkeypatch.undo()
    for other in grown[1:]:
        for name in ("tree", "parent", "rows", "w", "s", "feature", "bin", "left"):
            assert np.array_equal(getattr(grown[0], name), getattr(other, name)), name
    for i in range(trees):  # sums of a split are those of its children
        inner = np.flatnonzero((grown[0].feature >= 0) & (grown[0].tree == i))
        left = grown[0].left[inner]
        assert (grown[0].rows[inner] == grown[0].rows[left] + grown[0].rows[left + 1]).all()


def test_rows_walk_to_their_leaves():
    x, y, h = table(700)
    growth, _, _ = growth_of({"n_estimators": 3}, range(4))
    number = np.arange(3)
    grown = grow(x, y, growth.weights(h, number, 1), growth.roots(number, 1), growth)
    at = leaves(grown.feature, grown.bin, grown.left, number, x)
    for i in range(3):
        for r in range(0, 700, 7):
            node = i
            while grown.feature[node] >= 0:
                node = grown.left[node] + (x[r, grown.feature[node]] > grown.bin[node])
            assert at[i, r] == node


def test_counts_of_rows_don_t_depend_on_those_drawn_with_them(monkeypatch):
    h = table(1_000)[2]
    growth, _, _ = growth_of({"max_samples": 0.7}, range(4))
    whole = growth.weights(h, np.arange(3), 9)
    monkeypatch.setattr(tree_growth, "_DRAWN", 64)
    assert np.array_equal(growth.weights(h, np.arange(3), 9), whole) and 0.4 < (whole > 0).mean() < 0.6


def test_millions_of_rows_are_dealt_once_a_task_not_once_a_tree(spark, monkeypatch):
    """5.4 million rows are what 6 GB of tables give."""
    frame = spark.range(600).select("id", (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 5 / 3).alias("label"),
                                    (F.col("id") % 2).cast("int").alias("fold"))
    data = shared_forest.Binned(frame, ["a"], "id", "label", "fold")
    data.rows = 5_400_000
    monkeypatch.setattr(shared_forest, "_split_units", None)
    job = shared_forest.Job(*growth_of({"n_estimators": 40}, range(1), "squares"), (0,))
    dealt = shared_forest._local_pieces(data, [job], 1, shared_forest.BLOCK, 2)
    assert dealt.count() == 2 and shared_forest.held_out_scores(data, [job]).count() == 300
