"""Segmentation: KMeans, its diagnostics, and PCA."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from campaign_engine.functions.numeric import round_places
from campaign_engine.operators.columns import minmax_scale, with_share
from campaign_engine.operators.lloyd import Centres, cluster_all
from campaign_engine.operators.prep import assemble, fit_sample, standardize
from campaign_engine.schemas import ID_COL, SEED
from campaign_engine.session import in_parallel

ORDER_BY = "last_3_month_purchase_freq"


def scaled_vectors(df: DataFrame, cols: Sequence[str], key: str = ID_COL) -> DataFrame:
    """(key, cols..., features): rows with all columns known and their standardized vector."""
    known = df.select(key, *cols).na.drop(subset=list(cols))
    scaled = standardize(known.withColumns({f"_z_{c}": F.col(c) for c in cols}), [f"_z_{c}" for c in cols])
    return assemble(scaled, [f"_z_{c}" for c in cols]).drop(*[f"_z_{c}" for c in cols])


def best_kmeans(vectors: DataFrame, k: int, seed: int = SEED, n_init: int = 10, key: str = ID_COL) -> Centres:
    """The start with the lowest cost out of ``n_init`` seeds, all in the same passes; keep ``vectors`` persisted."""
    return cluster_all(vectors, [k], seed, n_init, key)[k]


def renumber(df: DataFrame, raw: str = "_cluster", order: str = ORDER_BY, name: str = "cluster") -> DataFrame:
    """Number clusters from 0 by the mean of a column, highest first, so that the numbers do not depend on the start."""
    means = df.groupBy(raw).agg(F.avg(order).alias("m")).collect()  # one row per cluster
    ranked = sorted(means, key=lambda r: (-(r["m"] if r["m"] is not None else float("-inf")), r[raw]))
    if not ranked:
        return df.withColumn(name, F.lit(None).cast("int")).drop(raw)
    mapping = F.create_map(*[F.lit(x) for i, r in enumerate(ranked) for x in (r[raw], i)])
    return df.withColumn(name, F.try_element_at(mapping, F.col(raw))).drop(raw)


def fit_kmeans(
    df: DataFrame, cols: Sequence[str], k: int = 3, seed: int = SEED, n_init: int = 10, key: str = ID_COL
) -> tuple[Centres, DataFrame]:
    """(model, rows with ``features`` and ``cluster``)."""
    vectors = scaled_vectors(df, cols, key).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = best_kmeans(vectors, k, seed, n_init, key)
        order = ORDER_BY if ORDER_BY in cols else cols[0]
        return model, renumber(model.transform(vectors), order=order)
    finally:
        vectors.unpersist()


def silhouette(vectors: DataFrame, label: str = "cluster") -> float:
    """Mean silhouette with squared Euclidean distances: linear in the rows, no pairs of rows."""
    known = vectors.filter(F.col(label).isNotNull())
    return ClusteringEvaluator(predictionCol=label, featuresCol="features").evaluate(known)


_ROWS_AT_ONCE = 1_000  # rows of a batch whose distances to the sample are held together


def silhouette_euclidean(
    vectors: DataFrame, label: str = "cluster", key: str = ID_COL, sample_rows: int = 1_000, seed: int = SEED
) -> DataFrame:
    """(silhouette, error, n_sampled, n): mean silhouette with plain Euclidean distances and its standard error.

    The plain form needs the distances of all pairs. Here ``sample_rows`` rows, those with the smallest hash of the key, are
    compared with every row: linear in the rows, and each task returns sample x clusters sums. The error is that of a mean
    over a sample without replacement, 0 where the sample is the whole table. Rows without a label take no part; a row alone
    in its cluster counts 0; without two clusters the result is null.
    """
    known = vectors.filter(F.col(label).isNotNull()).withColumn("x", vector_to_array("features"))
    sizes = {r[label]: r["count"] for r in known.groupBy(label).count().collect()}  # one row per cluster
    place = {c: i for i, c in enumerate(sorted(sizes))}
    drawn = fit_sample(known.select(key, label, "x"), key, sample_rows, seed).collect()  # bounded by sample_rows
    asked = np.array([r["x"] for r in drawn], dtype=float)

    def tasks(batches):
        total = np.zeros((len(asked), len(place)))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            own = np.array([place[c] for c in batch.column(1).to_pylist()])
            for at in range(0, len(x), _ROWS_AT_ONCE):
                part, mine = x[at : at + _ROWS_AT_ONCE], own[at : at + _ROWS_AT_ONCE]
                squares = np.zeros((len(asked), len(part)))
                for j in range(asked.shape[1]):
                    squares += (asked[:, j : j + 1] - part[:, j]) ** 2
                gaps = np.sqrt(squares)
                for c in range(len(place)):
                    total[:, c] += gaps[:, mine == c].sum(1)
        q, c = np.indices(total.shape)
        arrays = [pa.array(q.ravel(), pa.int32()), pa.array(c.ravel(), pa.int32()), pa.array(total.ravel())]
        yield pa.RecordBatch.from_arrays(arrays, ["query", "other", "total"])

    n = sum(sizes.values())
    spark = vectors.sparkSession
    sums = known.select("x", label).mapInArrow(tasks, "query int, other int, total double")
    sums = sums.groupBy("query", "other").agg(F.sum("total").alias("total"))
    counts = spark.createDataFrame([(place[c], m) for c, m in sizes.items()], "other int, rows long")
    mine = spark.createDataFrame([(i, place[r[label]]) for i, r in enumerate(drawn)], "query int, own int")
    joined = sums.join(F.broadcast(counts), "other").join(F.broadcast(mine), "query")  # clusters and sample: both bounded
    same = F.col("other") == F.col("own")
    each = joined.groupBy("query").agg(
        F.max(F.when(same, F.col("rows"))).alias("n_own"),
        F.max(F.when(same & (F.col("rows") > 1), F.col("total") / (F.col("rows") - 1))).alias("a"),
        F.min(F.when(~same, F.col("total") / F.col("rows"))).alias("b"),
    )
    largest = F.greatest("a", "b")
    value = F.when(F.col("b").isNull(), None).when((F.col("n_own") == 1) | (largest == 0), 0.0).otherwise((F.col("b") - F.col("a")) / largest)
    rest = float(np.sqrt(max(0.0, 1 - len(drawn) / n))) if n else 0.0
    return each.agg(
        F.avg(value).alias("silhouette"),
        (F.stddev_samp(value) / F.sqrt(F.count("*")) * rest).alias("error"),
        F.count("*").alias("n_sampled"),
        F.lit(n).cast("long").alias("n"),
    )


def elbow(df: DataFrame, cols: Sequence[str], ks: Sequence[int] = (2, 3, 4, 5, 6), seed: int = SEED,
          n_init: int = 10, key: str = ID_COL) -> DataFrame:
    """(k, inertia, silhouette) for each k; the vectors are scaled and kept once, all k share their passes."""
    vectors = scaled_vectors(df, cols, key).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        models = cluster_all(vectors, ks, seed, n_init, key)

        def one(k: int):
            def run() -> tuple[int, float, float]:
                return k, models[k].cost, float(silhouette(models[k].transform(vectors), "_cluster"))

            return run

        rows = in_parallel([one(k) for k in ks])
    finally:
        vectors.unpersist()
    return df.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")


def inertia(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """Sum of squared distances to the mean of the own cluster, for given labels."""
    within = sum((F.coalesce(F.var_pop(c) * F.count(c), F.lit(0.0)) for c in cols), F.lit(0.0))
    parts = df.groupBy(label).agg(within.alias("ss"))
    return parts.agg(F.sum("ss").alias("inertia"))


def pca(df: DataFrame, cols: Sequence[str], k: int = 2, key: str = ID_COL) -> tuple[DataFrame, DataFrame]:
    """((key, pc1...), (component, explained)) on standardized columns.

    The largest loading of each component is positive. The projection is column arithmetic.
    """
    known = df.select(key, *cols).na.drop(subset=list(cols))
    scaled = standardize(known, cols)
    model = PCA(k=k, inputCol="features", outputCol="_pc").fit(assemble(scaled, cols))
    loadings = model.pc.toArray()
    projected = []
    for j in range(k):
        column = loadings[:, j]
        sign = 1.0 if column[abs(column).argmax()] >= 0 else -1.0
        terms = (F.col(c) * float(sign * w) for c, w in zip(cols, column))
        projected.append(sum(terms, F.lit(0.0)).alias(f"pc{j + 1}"))
    explained = [(j + 1, float(v)) for j, v in enumerate(model.explainedVariance.toArray())]
    return scaled.select(key, *projected), df.sparkSession.createDataFrame(explained, "component int, explained double")


def cluster_profile(df: DataFrame, label: str, cols: Sequence[str]) -> DataFrame:
    """Mean of each column (2 places) and number of customers per cluster, in one aggregation."""
    return df.groupBy(label).agg(
        *[round_places(F.avg(c), 2).alias(c) for c in cols], F.count("*").alias("n_clientes")
    )


def cluster_radar(profile: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Profile scaled to [0, 1] across clusters."""
    return minmax_scale(profile, cols)


def cluster_sizes(df: DataFrame, label: str = "cluster") -> DataFrame:
    return with_share(df.groupBy(label).agg(F.count("*").alias("n")), "n")
