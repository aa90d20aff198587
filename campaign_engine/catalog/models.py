"""Model queries, with the settings of the plans and of the named searches.

The forests of ``rf_classifier``, ``model_metrics`` and ``model_reports`` are fitted on at most ``FIT_ROWS`` labelled rows,
picked by a hash of the key. All other models learn all rows of their training parts, and score every held-out row.
Forests, folds, draws and feature sets are whole.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campaign_engine.catalog.base import profile, query, rnd, with_tables
from campaign_engine.catalog.cleaning import cleaned, normalized
from campaign_engine.catalog.sources import scratch
from campaign_engine.functions.numeric import round_places
from campaign_engine.operators import cluster, logistic, metrics, prep, supervised, tune
from campaign_engine.operators.columns import drop_nulls, round_cols
from campaign_engine.operators.features import add_engineered_features, search_sets
from campaign_engine.plans import cleaning, training
from campaign_engine.plans.feature_search import search_features
from campaign_engine.schemas import BEHAVIOUR_COLS, ID_COL, SEED, TARGET_COL
from campaign_engine.sources.client_profile import scored, table

FIT_ROWS = 3_000  # a kept forest of 120 trees takes 12.0 s on so many (README)
_stored: dict[tuple[str, str, str], DataFrame] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, made) -> DataFrame:
    """A table that is written once per session and input, then read, as jobs would."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        path = f"{scratch(spark, 'training')}/{name}"
        made().write.parquet(path)
        _stored[key] = spark.read.parquet(path)
    return _stored[key]


def clean_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "clean", lambda: cleaned(spark, sf_dir))


def coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coded table with label."""
    clean = clean_table(spark, sf_dir)
    return _once(spark, sf_dir, "coded", lambda: training.labelled(cleaning.encoded(clean)[0], clean))


def training_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(clean table, coded table with label)."""
    return clean_table(spark, sf_dir), coded(spark, sf_dir)


def to_fit(df: DataFrame) -> DataFrame:
    return prep.kept_sample(df, ID_COL, FIT_ROWS)


def _standard_sql(cols, source: str, places: int = 9) -> str:
    parts = []
    for c in cols:
        m, s = f"(SELECT avg({c}) FROM {source})", f"(SELECT stddev_pop({c}) FROM {source})"
        parts.append(f"CASE WHEN {s} > 0 THEN {rnd(f'({c} - {m}) / {s}', places)} ELSE 0.0::DOUBLE END AS {c}")
    return ", ".join(parts)


_FLAT = "flat AS (SELECT client_id, avg_order_value, lifetime_value, total_visits, 5.0::DOUBLE AS constant FROM client_profile)"
_FLAT_COLS = ["avg_order_value", "lifetime_value", "total_visits", "constant"]


@query("standardize", with_tables(f"SELECT client_id, {_standard_sql(_FLAT_COLS, 'flat', 7)} FROM flat", _FLAT))
def _standardize(spark, sf_dir):
    df = profile(spark, sf_dir).select(ID_COL, *_FLAT_COLS[:3], F.lit(5.0).alias("constant"))
    return round_cols(prep.standardize(df, _FLAT_COLS), _FLAT_COLS, 7)


_HASH = f"substr(md5(client_id || '|{SEED}'), 1, 13)"


@query(
    "split_stratified",
    with_tables(
        f"SELECT client_id, label, row_number() OVER (PARTITION BY label ORDER BY {_HASH}) <= "
        "round_even(count(*) OVER (PARTITION BY label) * 0.2, 0) AS is_test FROM scored",
        start="scored",
    ),
)
def _split_stratified(spark, sf_dir):
    return prep.with_split(scored(spark, sf_dir).select(ID_COL, "label"), ID_COL, 0.2, stratify="label")


@query(
    "split_plain",
    with_tables(
        f"SELECT client_id, row_number() OVER (ORDER BY {_HASH}) <= ceil(count(*) OVER () * 0.2) AS is_test FROM scored",
        start="scored",
    ),
)
def _split_plain(spark, sf_dir):
    return prep.with_split(scored(spark, sf_dir).select(ID_COL), ID_COL, 0.2)


_FOLD_CUTS = " + ".join(f"CAST(rn > round_even(n * {i} / 5, 0) AS INTEGER)" for i in range(1, 5))


@query(
    "cv_folds",
    with_tables(
        f"SELECT client_id, label, {_FOLD_CUTS} AS fold FROM (SELECT client_id, label, "
        f"row_number() OVER (PARTITION BY label ORDER BY {_HASH}) AS rn, count(*) OVER (PARTITION BY label) AS n FROM scored)",
        start="scored",
    ),
)
def _cv_folds(spark, sf_dir):
    return prep.with_fold(scored(spark, sf_dir).select(ID_COL, "label"), ID_COL, 5, stratify="label")


@query(
    "feature_matrix",
    with_tables(
        "SELECT client_id, total_spent AS f0, avg_order_value AS f1, last_3_month_purchase_freq AS f2, "
        "CAST(total_visits AS DOUBLE) AS f3, pages_per_session AS f4, CAST(support_tickets AS DOUBLE) AS f5 FROM cleaned",
        start="cleaned",
    ),
)
def _feature_matrix(spark, sf_dir):
    """The assembled vector, shown element by element."""
    df = prep.assemble(cleaned(spark, sf_dir).select(ID_COL, *BEHAVIOUR_COLS), BEHAVIOUR_COLS)
    values = vector_to_array("features")
    return df.select(ID_COL, *[values[i].alias(f"f{i}") for i in range(len(BEHAVIOUR_COLS))])


@query(
    "fill_feature_defaults",
    with_tables(
        "SELECT client_id, coalesce(n.age, d.age) AS age, coalesce(n.total_spent, d.total_spent) AS total_spent, "
        "coalesce(n.satisfaction_score, d.satisfaction_score) AS satisfaction_score, d.nps_score AS nps_score FROM normalized n, "
        "(SELECT median(age) AS age, median(total_spent) AS total_spent, median(satisfaction_score) AS satisfaction_score, "
        "median(nps_score) AS nps_score FROM normalized) d",
        start="normalized",
    ),
)
def _fill_defaults(spark, sf_dir):
    """Records come with the age as text and without the NPS."""
    cols = ["age", "total_spent", "satisfaction_score", "nps_score"]
    defaults = prep.feature_defaults(normalized(spark, sf_dir).select(*cols), cols)
    records = profile(spark, sf_dir).select(ID_COL, "satisfaction_score", "total_spent", "age", "country")
    return prep.prepare_features(records, defaults, [ID_COL])


# Clustering


def _behaviour(spark, sf_dir):
    return clean_table(spark, sf_dir).select(ID_COL, *BEHAVIOUR_COLS)


@query("kmeans")
def _kmeans(spark, sf_dir):
    _, rows = cluster.fit_kmeans(_behaviour(spark, sf_dir), BEHAVIOUR_COLS, 3)
    return rows.select(ID_COL, *BEHAVIOUR_COLS, "cluster")


@query("kmeans_nearest", with_tables("SELECT client_id, TRUE AS at_nearest FROM cleaned", start="cleaned"))
def _kmeans_nearest(spark, sf_dir):
    """Whether each row's cluster is the one whose rows have the nearest mean, all worked out from the rows."""
    _, rows = cluster.fit_kmeans(_behaviour(spark, sf_dir), BEHAVIOUR_COLS, 3)
    entries = rows.select("cluster", F.posexplode(vector_to_array("features")))
    means = entries.groupBy("cluster", "pos").agg(F.avg("col").alias("mean")).orderBy("cluster", "pos").collect()  # clusters x columns
    centres = np.array([r["mean"] for r in means]).reshape(-1, len(BEHAVIOUR_COLS))
    nearest = cluster.Centres(centres, 0.0, 0).transform(rows)
    return nearest.select(ID_COL, (F.col("_cluster") == F.col("cluster")).alias("at_nearest"))


@query("elbow")
def _elbow(spark, sf_dir):
    return cluster.elbow(_behaviour(spark, sf_dir), BEHAVIOUR_COLS)


@query("pca_2d")
def _pca(spark, sf_dir):
    points, _ = cluster.pca(_behaviour(spark, sf_dir), BEHAVIOUR_COLS)
    return points


@query("pca_explained")
def _pca_explained(spark, sf_dir):
    _, explained = cluster.pca(_behaviour(spark, sf_dir), BEHAVIOUR_COLS)
    return explained


_LABELS = ["avg_order_value", "lifetime_value", "total_visits", "pages_per_session", "email_open_rate", "nps_score"]


@query(
    "inertia_given_labels",
    with_tables(
        "SELECT " + rnd("sum(ss)", 2) + " AS inertia FROM (SELECT "
        + " + ".join(f"coalesce(({c} - avg({c}) OVER g) ** 2, 0)" for c in _LABELS[3:])
        + " AS ss FROM client_profile WINDOW g AS (PARTITION BY payment_method))"
    ),
)
def _inertia(spark, sf_dir):
    return round_cols(cluster.inertia(profile(spark, sf_dir), _LABELS[3:], "payment_method"), ["inertia"], 2)


@query(
    "cluster_profile",
    with_tables(
        "SELECT payment_method, " + ", ".join(f"{rnd(f'avg({c})', 2)} AS {c}" for c in _LABELS)
        + ", count(*) AS n_clientes FROM client_profile GROUP BY payment_method"
    ),
)
def _cluster_profile(spark, sf_dir):
    return cluster.cluster_profile(profile(spark, sf_dir), "payment_method", _LABELS)


@query(
    "join_index_left",
    with_tables(
        "SELECT m.country, m.total_visits, m.nps_score, c.n_clientes FROM (SELECT country, "
        + rnd("avg(total_visits)", 2) + " AS total_visits, " + rnd("avg(nps_score)", 2)
        + " AS nps_score FROM normalized GROUP BY country) m LEFT JOIN (SELECT country, count(*) AS n_clientes FROM normalized "
        "GROUP BY country) c ON m.country IS NOT DISTINCT FROM c.country",
        start="normalized",
    ),
)
def _join_index(spark, sf_dir):
    """Means and counts of each group, which a single aggregation gives without the join."""
    return cluster.cluster_profile(normalized(spark, sf_dir), "country", ["total_visits", "nps_score"])


_RADAR = ["avg_order_value", "total_visits", "pages_per_session"]


@query(
    "cluster_radar",
    with_tables(
        "SELECT payment_method, "
        + ", ".join(
            f"CASE WHEN (SELECT max({c}) > min({c}) FROM p) THEN {rnd(f'({c} - (SELECT min({c}) FROM p)) / ((SELECT max({c}) FROM p) - (SELECT min({c}) FROM p))', 9)} ELSE {c} END AS {c}"
            for c in _RADAR
        )
        + ", n_clientes FROM p",
        "p AS (SELECT payment_method, " + ", ".join(f"{rnd(f'avg({c})', 2)} AS {c}" for c in _RADAR)
        + ", count(*) AS n_clientes FROM client_profile GROUP BY payment_method)",
    ),
)
def _cluster_radar(spark, sf_dir):
    means = cluster.cluster_profile(profile(spark, sf_dir), "payment_method", _RADAR)
    return round_cols(cluster.cluster_radar(means, _RADAR), _RADAR, 9)


@query(
    "cluster_sizes",
    with_tables(
        "SELECT payment_method, n, " + rnd("n / sum(n) OVER ()", 9)
        + " AS share FROM (SELECT payment_method, count(*) AS n FROM client_profile GROUP BY payment_method)"
    ),
)
def _cluster_sizes(spark, sf_dir):
    return round_cols(cluster.cluster_sizes(profile(spark, sf_dir), "payment_method"), ["share"], 9)


_SIL = ["email_open_rate", "email_click_rate", "nps_score"]


def _silhouette_sql() -> str:
    """Squared Euclidean silhouette from the sums of each group."""
    dot = " + ".join(f"p.{c} * g.s_{c}" for c in _SIL)
    own = " + ".join(f"{c} * {c}" for c in _SIL)
    return with_tables(
        "SELECT " + rnd("avg(CASE WHEN n_own = 1 THEN 0 ELSE (b - a) / greatest(a, b) END)", 9) + " AS silhouette FROM ("
        "SELECT client_id, max(n) FILTER (WHERE mine) AS n_own, max(d * n / (n - 1)) FILTER (WHERE mine) AS a, "
        "min(d) FILTER (WHERE NOT mine) AS b FROM ("
        f"SELECT p.client_id, p.grp = g.grp AS mine, g.n AS n, p.sq - 2 * ({dot}) / g.n + g.ssq / g.n AS d FROM p, g) GROUP BY client_id)",
        "p AS (SELECT client_id, payment_method AS grp, " + ", ".join(_SIL) + f", {own} AS sq FROM client_profile WHERE payment_method IS NOT NULL)",
        "g AS (SELECT grp, count(*) AS n, sum(sq) AS ssq, " + ", ".join(f"sum({c}) AS s_{c}" for c in _SIL) + " FROM p GROUP BY grp)",
    )


@query("silhouette", _silhouette_sql())
def _silhouette(spark, sf_dir):
    df = profile(spark, sf_dir).select(F.substring("payment_method", 1, 1).cast("int").alias("cluster"), *_SIL)
    value = cluster.silhouette(prep.assemble(df, _SIL))
    return spark.createDataFrame([(round(value * 1e9) / 1e9,)], "silhouette double")


def _euclidean_sql() -> str:
    """The same sample against all rows, pair by pair."""
    gap = "sqrt(" + " + ".join(f"(q.{c} - p.{c}) ** 2" for c in _SIL) + ")"
    value = "CASE WHEN n_own = 1 OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END"
    return with_tables(
        f"SELECT {rnd(f'avg({value})', 8)} AS silhouette, "
        + rnd(f"stddev_samp({value}) / sqrt(count(*)) * sqrt(greatest(0, 1 - count(*) / (SELECT count(*) FROM p)))", 8)
        + " AS error, count(*) AS n_sampled, (SELECT count(*) FROM p) AS n FROM (SELECT client_id, max(n) FILTER (WHERE mine) AS n_own, "
        "max(total / (n - 1)) FILTER (WHERE mine) AS a, min(total / n) FILTER (WHERE NOT mine) AS b FROM (SELECT q.client_id, "
        f"q.grp = p.grp AS mine, count(*) AS n, sum({gap}) AS total FROM q, p GROUP BY q.client_id, q.grp, p.grp) GROUP BY client_id)",
        "p AS (SELECT client_id, payment_method AS grp, " + ", ".join(_SIL) + " FROM client_profile WHERE payment_method IS NOT NULL)",
        f"q AS (SELECT * FROM p ORDER BY {_HASH}, client_id LIMIT 1000)",
    )


@query("silhouette_euclidean", _euclidean_sql())
def _silhouette_euclidean(spark, sf_dir):
    """A sample of 1,000 rows is the operator's own, with its standard error; every row is compared with it."""
    df = profile(spark, sf_dir).select(ID_COL, F.col("payment_method").alias("cluster"), *_SIL)
    return round_cols(cluster.silhouette_euclidean(prep.assemble(df, _SIL)), ["silhouette", "error"], 8)


@query("kmeans_embeddings")
def _kmeans_embeddings(spark, sf_dir):
    """Segments of the vector table."""
    vectors = table(spark, sf_dir, "embeddings").filter(F.col("embedding").isNotNull()).select(
        "vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    )
    vectors = vectors.persist()
    try:
        model = cluster.best_kmeans(vectors, 5, SEED, 10, "vec_id")
    finally:
        vectors.unpersist()
    return cluster.cluster_sizes(model.transform(vectors), "_cluster").withColumnRenamed("_cluster", "cluster")


# Supervised models


def _split(spark, sf_dir):
    data = coded(spark, sf_dir)
    return (*prep.split(data, ID_COL, 0.2, stratify="label"), prep.feature_names(data, TARGET_COL))


def _scored_by(kind: str, params: dict):
    def run(spark, sf_dir):
        train, test, cols = _split(spark, sf_dir)
        model = supervised.fit_classifier(to_fit(train) if kind == "rf" else train, kind, cols, params)
        return supervised.score(model, test).select(ID_COL, "label", "conversion_score", "prediction")

    return run


query("rf_classifier")(_scored_by(*training.CLASSIFIERS["Random Forest"]))
query("lr_classifier")(_scored_by(*training.CLASSIFIERS["Regresión Logística"]))


_STEPS = 12  # steps of the SQL form, which has no test for the end


@query(
    "lr_coefficients",
    with_tables(
        "SELECT " + rnd("b0", 6) + " AS intercept, " + rnd("b1", 6) + " AS weight, n FROM line, (SELECT count(*) AS n FROM z) "
        f"WHERE step = {_STEPS}",
        "z AS (SELECT label AS y, (score - (SELECT avg(score) FROM scored)) / (SELECT stddev_pop(score) FROM scored) AS x FROM scored)",
        "line AS (SELECT 0 AS step, 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1 UNION ALL "
        "SELECT step + 1, b0 - (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01), b1 - (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01) "
        "FROM (SELECT step, b0, b1, sum(p - y) AS g0, sum((p - y) * x) + b1 AS g1, sum(p * (1 - p)) AS h00, "
        "sum(p * (1 - p) * x) AS h01, sum(p * (1 - p) * x * x) + 1 AS h11 FROM (SELECT step, b0, b1, x, y, "
        f"1 / (1 + exp(-(b0 + b1 * x))) AS p FROM line, z WHERE step < {_STEPS}) GROUP BY step, b0, b1))",
        start="scored",
    ).replace("WITH ", "WITH RECURSIVE ", 1),
)
def _lr_coefficients(spark, sf_dir):
    """The label by the score: one feature, so that SQL can take the same steps."""
    df = scored(spark, sf_dir).select("score", "label")
    line = logistic.fit(df, ["score"], prep.moments(df, ["score"]))
    return df.agg(F.count("*").alias("n")).select(
        round_places(F.lit(line.intercept), 6).alias("intercept"), round_places(F.lit(line.weights[0]), 6).alias("weight"), "n"
    )


@query(
    "lr_gradient",
    "SELECT term, 0.0::DOUBLE AS gradient FROM (VALUES "
    + ", ".join(f"('{c}')" for c in ["intercept", *BEHAVIOUR_COLS]) + ") v(term)",
)
def _lr_gradient(spark, sf_dir):
    """The size of the loss's mean gradient at the fit to all training rows: 0 at the minimum, which is the only one."""
    train, _ = prep.split(coded(spark, sf_dir), ID_COL, 0.2, stratify="label")
    line = logistic.fit(train, BEHAVIOUR_COLS, prep.moments(train, BEHAVIOUR_COLS))
    slopes = logistic.gradient(train, line)
    return slopes.select("term", F.abs(round_places(F.col("gradient"), 7)).alias("gradient"))


@query(
    "linear_regressor",
    with_tables(
        "SELECT " + rnd("regr_slope(lifetime_value, avg_order_value)", 6) + " AS slope, "
        + rnd("regr_intercept(lifetime_value, avg_order_value)", 2) + " AS intercept, "
        + rnd("sqrt((regr_syy(lifetime_value, avg_order_value) - "
              "regr_sxy(lifetime_value, avg_order_value) * regr_sxy(lifetime_value, avg_order_value) / "
              "regr_sxx(lifetime_value, avg_order_value)) / regr_count(lifetime_value, avg_order_value))", 2)
        + " AS rmse FROM client_profile"
    ),
)
def _linear(spark, sf_dir):
    """One feature, so that the closed form can be compared."""
    df = drop_nulls(profile(spark, sf_dir).select("lifetime_value", "avg_order_value"), ["lifetime_value", "avg_order_value"])
    model = supervised.fit_regressor(df, "linear", ["avg_order_value"], "lifetime_value")
    fit = metrics.regression_metrics(supervised.predict(model, df), "lifetime_value", "prediction")
    line = model.stages[-1]
    return fit.select(
        round_places(F.lit(float(line.coefficients[0])), 6).alias("slope"),
        round_places(F.lit(float(line.intercept)), 2).alias("intercept"),
        round_places(F.col("rmse"), 2).alias("rmse"),
    )


@query("rf_regressor")
def _rf_regressor(spark, sf_dir):
    data = coded(spark, sf_dir)
    cols = prep.feature_names(data, "total_spent")
    return training.forest_regression(data, cols, "total_spent").select(ID_COL, "total_spent", "prediction")


@query("regression_compare")
def _regression_compare(spark, sf_dir):
    return training.train_regressors(coded(spark, sf_dir))


@query("cv_accuracy")
def _cv_accuracy(spark, sf_dir):
    settings = training.CLASSIFIERS["Random Forest"][1]
    return supervised.cross_val(coded(spark, sf_dir), supervised.ForestFit(BEHAVIOUR_COLS, settings), 5)


@query("cv_summary")
def _cv_summary(spark, sf_dir):
    """Mean and deviation over the folds."""
    return supervised.fold_summary(_cv_accuracy(spark, sf_dir))


def _search(name: str):
    def run(spark, sf_dir):
        return tune.search(coded(spark, sf_dir), BEHAVIOUR_COLS, name)[1]

    return run


for _name, (_mode, *_) in tune.SEARCHES.items():
    query(f"{_mode}_search_{_name}")(_search(_name))


def _versions(spark, sf_dir):
    train, test, cols = _split(spark, sf_dir)
    flip = (1 - F.col("label")).alias("label_inverted")
    _, draws, folds, _ = tune.SEARCHES["light"]
    return tune.compare_versions(
        train.select("*", flip),
        test.select("*", flip),
        {
            "v1 - Todas las features": (cols, "label"),
            "v2 - Solo comportamiento": (BEHAVIOUR_COLS, "label"),
            "v3 - Clase inversa como positivo": (BEHAVIOUR_COLS, "label_inverted"),
        },
        tune.random_combinations(tune.SPACES["light"], draws),
        folds,
    )


@query("compare_versions_table")
def _compare_versions(spark, sf_dir):
    return _versions(spark, sf_dir)[0]


@query("compare_versions_metrics")
def _compare_metrics(spark, sf_dir):
    detail = _versions(spark, sf_dir)[1]
    names = [r["model"] for r in detail.select("model").distinct().collect()]  # one row per version
    return metrics.metrics_long({n: detail.filter(F.col("model") == n).drop("model") for n in sorted(names)})


@query("screen_sets")
def _screen(spark, sf_dir):
    data = coded(spark, sf_dir)
    derived = add_engineered_features(data)
    train, test = prep.split(derived, ID_COL, 0.2, stratify="label")
    return tune.screen(train, test, search_sets(prep.feature_names(data, TARGET_COL)))


@query("deep_tune_top")
def _deep_tune_top(spark, sf_dir):
    """All sets screened, the five best tuned by the deep search and tested."""
    return search_features(coded(spark, sf_dir))


# Scoring


def _model(spark, sf_dir) -> supervised.ConversionModel:
    forest = {"Random Forest": training.CLASSIFIERS["Random Forest"]}
    return training.train_classifiers(coded(spark, sf_dir), forest)[0]


@query("score_all")
def _score_all(spark, sf_dir):
    return supervised.score(_model(spark, sf_dir).pipeline, coded(spark, sf_dir)).select(ID_COL, "conversion_score")


@query("score_batch")
def _score_batch(spark, sf_dir):
    """Raw records with some of the features, the age as dirty text."""
    records = profile(spark, sf_dir).select(ID_COL, "age", "total_spent", "avg_order_value", "total_visits", "satisfaction_score")
    return supervised.predict_conversion(_model(spark, sf_dir), records)


@query("campaign_scores")
def _campaign_scores(spark, sf_dir):
    clean, _ = training_tables(spark, sf_dir)
    return training.campaign_scores(_model(spark, sf_dir), coded(spark, sf_dir), clean)


@query("model_metrics")
def _model_metrics(spark, sf_dir):
    _, held_out = training.train_classifiers(coded(spark, sf_dir), fit_rows=FIT_ROWS)
    return training.classifier_metrics(held_out, list(training.CLASSIFIERS))


@query("model_reports")
def _model_reports(spark, sf_dir):
    _, held_out = training.train_classifiers(coded(spark, sf_dir), fit_rows=FIT_ROWS)
    return metrics.metrics_long({
        n: metrics.class_report(held_out.filter(F.col("model") == n), "label", "prediction") for n in training.CLASSIFIERS
    })


@query("training_job")
def _training_job(spark, sf_dir):
    """All steps: models of the whole training part, metrics, reports and scores of all rows are written; the metrics are
    read back."""
    clean, codes = training_tables(spark, sf_dir)
    path = scratch(spark, "training-job")
    training.train(clean, codes).write(path)
    return spark.read.parquet(f"{path}/metrics")
