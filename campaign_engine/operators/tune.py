"""Parameter search, version comparison and feature-set screening.

All forests of a search, over all candidates, folds and feature sets, are jobs on one binned table (``shared_forest``).
"""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from itertools import product
from math import prod

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from campaign_engine.operators import metrics
from campaign_engine.operators.campaign import rank_results
from campaign_engine.operators.prep import with_fold
from campaign_engine.operators.shared_forest import Binned, Job, held_out_ranking, held_out_scores
from campaign_engine.operators.tree_growth import growth_of
from campaign_engine.schemas import ID_COL, SEED

# The named search spaces.
_WIDE = {
    "n_estimators": [200, 300, 400, 600, 800],
    "max_depth": [None, 10, 15, 20, 30],
    "min_samples_split": [2, 5, 10, 20],
    "min_samples_leaf": [1, 2, 4, 8],
    "max_features": ["sqrt", "log2", 0.5, 0.7, None],
    "class_weight": [None, "balanced", "balanced_subsample"],
    "criterion": ["gini", "entropy", "log_loss"],
    "bootstrap": [True],
    "max_samples": [None, 0.7, 0.85],
    "ccp_alpha": [0.0, 0.0001, 0.001, 0.005],
}
SPACES: dict[str, dict] = {
    "v1": {
        "n_estimators": [100, 200],
        "max_depth": [None, 5, 10, 20],
        "min_samples_split": [2, 5, 10],
        "min_samples_leaf": [1, 2, 4],
        "max_features": ["sqrt", "log2"],
        "class_weight": [None, "balanced"],
    },
    "v2": {
        "n_estimators": [100, 150],
        "max_depth": [3, 5, 8, 12],
        "min_samples_split": [5, 10, 20],
        "min_samples_leaf": [2, 4, 6],
        "max_features": ["sqrt"],
        "class_weight": ["balanced", "balanced_subsample"],
    },
    "v3": {
        "n_estimators": [500, 600],
        "max_depth": [None, 12],
        "min_samples_split": [2, 5],
        "min_samples_leaf": [1, 2],
        "max_features": ["sqrt", 0.5, 4],
        "class_weight": ["balanced", "balanced_subsample"],
    },
    "v3_fast": {
        "n_estimators": [120, 200],
        "max_depth": [10, None],
        "min_samples_split": [2, 10],
        "min_samples_leaf": [1, 2],
        "max_features": ["sqrt", 0.5],
        "class_weight": ["balanced_subsample"],
    },
    "v4": _WIDE,
    "v5": _WIDE,
    "deep": {
        "n_estimators": [200, 300, 500, 700, 900],
        "max_depth": [None, 8, 12, 16, 24, 32],
        "min_samples_split": [2, 4, 8, 12, 20],
        "min_samples_leaf": [1, 2, 4, 8],
        "max_features": ["sqrt", "log2", 0.5, 0.7, None],
        "class_weight": [None, "balanced", "balanced_subsample"],
        "criterion": ["gini", "entropy", "log_loss"],
        "bootstrap": [True],
        "max_samples": [None, 0.6, 0.8, 0.9],
        "ccp_alpha": [0.0, 1e-4, 1e-3, 5e-3],
    },
    "light": {
        "n_estimators": [80, 120, 160],
        "max_depth": [5, 10, None],
        "min_samples_split": [2, 4, 8],
        "min_samples_leaf": [1, 2, 4],
        "max_features": ["sqrt", 0.6, None],
    },
}
# How each space is searched (mode, draws, folds, metric that picks the best).
SEARCHES = {
    "v1": ("grid", None, 5, "roc_auc"),
    "v2": ("grid", None, 5, "roc_auc"),
    "v3": ("grid", None, 5, "roc_auc"),
    "v3_fast": ("grid", None, 3, "roc_auc"),
    "v4": ("random", 30, 4, "avg_precision"),
    "v5": ("random", 30, 4, "roc_auc"),
    "deep": ("random", 12, 4, "roc_auc"),
    "light": ("random", 8, 2, "roc_auc"),
}
# The forest that screens feature sets.
SCREEN_FOREST = {
    "n_estimators": 400,
    "max_depth": 14,
    "min_samples_split": 6,
    "min_samples_leaf": 2,
    "max_features": "sqrt",
    "class_weight": "balanced_subsample",
}


def grid_combinations(space: Mapping[str, Sequence]) -> list[dict]:
    return [dict(zip(space, values)) for values in product(*space.values())]


def random_combinations(space: Mapping[str, Sequence], n: int, seed: int = SEED) -> list[dict]:
    """n different combinations, without listing the whole grid."""
    total = prod(len(v) for v in space.values())
    picks = random.Random(seed).sample(range(total), min(n, total))
    out = []
    for place in picks:
        combo = {}
        for name, values in space.items():
            place, i = divmod(place, len(values))
            combo[name] = values[i]
        out.append(combo)
    return out


def _text(params: Mapping) -> str:
    return ", ".join(f"{n}={v}" for n, v in params.items())


def _job(data: Binned, cols: Sequence[str], params: Mapping, folds: Sequence[int]) -> Job:
    growth, cut, trees = growth_of(dict(params), [data.cols.index(c) for c in cols])
    return Job(growth, cut, trees, tuple(folds))


def _measured(data: Binned, jobs: Sequence[Job], seed: int) -> list[dict[int, tuple[float | None, float | None]]]:
    """(roc_auc, avg_precision) of each fold of each job."""
    first = {job: i for i, job in reversed(list(enumerate(jobs)))}
    found = held_out_ranking(data, jobs, seed).collect()  # a row for each job and fold
    by_job: dict[int, dict[int, tuple[float | None, float | None]]] = {}
    for r in found:
        by_job.setdefault(r["job"], {})[r["fold"]] = r["roc_auc"], r["avg_precision"]
    return [by_job.get(first[job], {}) for job in jobs]


def _mean(values: Sequence[float | None]) -> tuple[float | None, float | None]:
    """Mean and population deviation of the known values."""
    known = [v for v in values if v is not None]
    if not known:
        return None, None
    mean = sum(known) / len(known)
    return mean, (sum((v - mean) ** 2 for v in known) / len(known)) ** 0.5


def _candidates(combos: Sequence[Mapping], measured: Sequence[Mapping]) -> list[tuple]:
    """(candidate, params, mean and deviation of both metrics over the folds) of each combination."""
    return [
        (i, _text(combo), *_mean([auc for auc, _ in folds.values()]), *_mean([ap for _, ap in folds.values()]))
        for i, (combo, folds) in enumerate(zip(combos, measured))
    ]


_CANDIDATES = ("candidate int, params string, roc_auc double, roc_auc_std double, avg_precision double, avg_precision_std double")


def tune(
    df: DataFrame,
    cols: Sequence[str],
    combos: Sequence[Mapping],
    k: int,
    refit: str = "roc_auc",
    key: str = ID_COL,
    label: str = "label",
    seed: int = SEED,
) -> tuple[dict, DataFrame]:
    """(best parameters, one row per candidate with the mean and deviation of both metrics over the folds).

    Folds are made of all rows, each candidate learns all rows of the other folds, and every row is scored once.
    """
    data = Binned(with_fold(df, key, k, seed, label).select(key, label, "fold", *cols), cols, key, label, "fold")
    try:
        measured = _measured(data, [_job(data, cols, c, range(k)) for c in combos], seed)
    finally:
        data.unpersist()
    other = "avg_precision" if refit == "roc_auc" else "roc_auc"
    frame = df.sparkSession.createDataFrame(_candidates(combos, measured), _CANDIDATES)
    results = rank_results(frame, [refit, other], name="candidate")
    return dict(combos[results.first()["candidate"]]), results


def search(df: DataFrame, cols: Sequence[str], name: str, key: str = ID_COL, label: str = "label", seed: int = SEED) -> tuple[dict, DataFrame]:
    """A named search over its full space."""
    mode, draws, folds, refit = SEARCHES[name]
    space = SPACES[name]
    combos = grid_combinations(space) if mode == "grid" else random_combinations(space, draws, seed)
    return tune(df, cols, combos, folds, refit, key, label, seed)


def _parts(train: DataFrame, test: DataFrame, cols: Sequence[str], key: str, label: str) -> Binned:
    """Both parts in one table: fold 0 is the test part, and what is learnt is fold 1."""
    mark = lambda df, fold: df.select(key, label, *cols, F.lit(fold).alias("fold"))
    return Binned(mark(train, 1).unionByName(mark(test, 0)), cols, key, label, "fold")


def evaluate(scored: DataFrame, label: str = "y") -> dict:
    """Ranking metrics, confusion cells and report of (label, conversion_score, prediction)."""
    scored = scored.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        row = metrics.ranking_metrics(scored, label, "conversion_score").first()
        cells = metrics.confusion(scored, label, "prediction").first()
        report = metrics.class_report(scored, label, "prediction").collect()  # five rows
    finally:
        scored.unpersist()
    return {"roc_auc": row["roc_auc"], "avg_precision": row["avg_precision"], **cells.asDict(), "report": report}


def compare_versions(
    train: DataFrame,
    test: DataFrame,
    versions: Mapping[str, tuple[Sequence[str], str]],
    combos: Sequence[Mapping],
    k: int = 2,
    key: str = ID_COL,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """Tune each version (name -> columns, label) on the training part and test its best candidate.

    Returns (version, roc_auc, avg_precision, best_params, tn, fp, fn, tp) and the reports of all versions.
    """
    rows, reports = [], []
    for name, (cols, label) in versions.items():
        best = dict(combos[0]) if len(combos) == 1 else tune(train, cols, combos, k, key=key, label=label, seed=seed)[0]
        data = _parts(train, test, cols, key, label)
        try:
            scored = held_out_scores(data, [_job(data, cols, best, [0])], seed).select(
                "y", F.col("score").alias("conversion_score"), (F.col("score") > 0.5).cast("int").alias("prediction")
            )
            found = evaluate(scored)
        finally:
            data.unpersist()
        rows.append((name, found["roc_auc"], found["avg_precision"], _text(best), *[found[c] for c in metrics.CELLS]))
        reports += [(name, *r) for r in found["report"]]
    spark = train.sparkSession
    table = spark.createDataFrame(
        rows,
        "version string, roc_auc double, avg_precision double, best_params string, tn long, fp long, fn long, tp long",
    )
    detail = spark.createDataFrame(
        reports, "model string, class string, precision double, recall double, f1_score double, support long"
    )
    return table, detail


def _all_columns(sets: Mapping[str, Sequence[str]]) -> list[str]:
    return list(dict.fromkeys(c for cols in sets.values() for c in cols))


def screen(
    train: DataFrame,
    test: DataFrame,
    sets: Mapping[str, Sequence[str]],
    params: Mapping | None = None,
    key: str = ID_COL,
    label: str = "label",
    seed: int = SEED,
) -> DataFrame:
    """(feature_set, n_features, roc_auc, avg_precision) of one fixed forest per set, a mask over the columns of all."""
    data = _parts(train, test, _all_columns(sets), key, label)
    try:
        jobs = [_job(data, cols, SCREEN_FOREST if params is None else params, [0]) for cols in sets.values()]
        measured = _measured(data, jobs, seed)
    finally:
        data.unpersist()
    rows = [(name, len(cols), *found.get(0, (None, None))) for (name, cols), found in zip(sets.items(), measured)]
    return rank_results(train.sparkSession.createDataFrame(rows, "feature_set string, n_features int, roc_auc double, avg_precision double"))


def deep_tune_top(
    train: DataFrame,
    test: DataFrame,
    sets: Mapping[str, Sequence[str]],
    combos: Sequence[Mapping],
    k: int = 4,
    top: int = 5,
    screen_params: Mapping | None = None,
    key: str = ID_COL,
    label: str = "label",
    seed: int = SEED,
) -> DataFrame:
    """Screen all sets, tune the best ones together, test them: (feature_set, roc_auc, avg_precision, best_params as map)."""
    names = [r["feature_set"] for r in screen(train, test, sets, screen_params, key, label, seed).limit(top).collect()]
    cols = _all_columns({n: sets[n] for n in names})
    folded = Binned(with_fold(train, key, k, seed, label).select(key, label, "fold", *cols), cols, key, label, "fold")
    try:
        measured = _measured(folded, [_job(folded, sets[n], c, range(k)) for n in names for c in combos], seed)
    finally:
        folded.unpersist()
    best = {}
    for i, name in enumerate(names):
        own = _candidates(combos, measured[i * len(combos) : (i + 1) * len(combos)])
        best[name] = combos[max(own, key=lambda r: (r[2] if r[2] is not None else -1.0, r[4] if r[4] is not None else -1.0, -r[0]))[0]]
    data = _parts(train, test, cols, key, label)
    try:
        tested = _measured(data, [_job(data, sets[n], best[n], [0]) for n in names], seed)
    finally:
        data.unpersist()
    rows = [(n, *found.get(0, (None, None)), {p: str(v) for p, v in best[n].items()}) for n, found in zip(names, tested)]
    return rank_results(train.sparkSession.createDataFrame(
        rows, "feature_set string, roc_auc double, avg_precision double, best_params map<string,string>"
    ))
