"""Model metrics on the deterministic score; no model is needed to check them."""

from __future__ import annotations

from pyspark.sql import functions as F

from campaign_engine.catalog.base import profile, query, rnd, with_tables
from campaign_engine.operators import metrics as ops
from campaign_engine.operators.columns import round_cols, with_status
from campaign_engine.operators.campaign import rank_results
from campaign_engine.operators.shape import stack_tagged
from campaign_engine.sources.client_profile import scored, table

_CUM = """counts AS (
  SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg FROM scored GROUP BY score)""", """cum AS (
  SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
         sum(pos) OVER () AS n_pos, sum(neg) OVER () AS n_neg FROM counts)"""


def _cum(body: str) -> str:
    return with_tables(body, *_CUM, start="scored")


def _predicted(spark, sf_dir, threshold: float = 0.5):
    return ops.with_prediction(scored(spark, sf_dir), "score", threshold)


_CELLS = ", ".join(
    f"count(*) FILTER (WHERE label = {y} AND CAST(score >= {{t}} AS INTEGER) = {p}) AS {n}"
    for n, y, p in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))
)


@query("confusion_matrix", with_tables(f"SELECT {_CELLS.format(t=0.5)} FROM scored", start="scored"))
def _confusion(spark, sf_dir):
    return ops.confusion(_predicted(spark, sf_dir), "label", "prediction")


def report_sql(cells: str) -> str:
    """Rows of the classification report out of a statement with tn, fp, fn, tp."""

    def div(a: str, b: str) -> str:
        return f"coalesce(({a}) / nullif({b}, 0), 0.0::DOUBLE)"

    zero = (div("tn", "tn + fn"), div("tn", "tn + fp"), div("2 * tn", "2 * tn + fn + fp"), "tn + fp")
    one = (div("tp", "tp + fp"), div("tp", "tp + fn"), div("2 * tp", "2 * tp + fp + fn"), "tp + fn")
    acc = div("tp + tn", "tn + fp + fn + tp")
    rows = {
        "0": zero,
        "1": one,
        "accuracy": (acc, acc, acc, "tn + fp + fn + tp"),
        "macro avg": (*[f"({a} + {b}) / 2" for a, b in zip(zero[:3], one[:3])], "tn + fp + fn + tp"),
        "weighted avg": (
            *[div(f"{a} * ({zero[3]}) + {b} * ({one[3]})", "tn + fp + fn + tp") for a, b in zip(zero[:3], one[:3])],
            "tn + fp + fn + tp",
        ),
    }
    return " UNION ALL ".join(
        f"SELECT '{n}' AS class, {rnd(p, 9)} AS precision, {rnd(r, 9)} AS recall, {rnd(f, 9)} AS f1_score, {s} AS support "
        f"FROM ({cells})"
        for n, (p, r, f, s) in rows.items()
    )


_RATES = ["precision", "recall", "f1_score"]


@query(
    "classification_report",
    with_tables(report_sql(f"SELECT {_CELLS.format(t=0.5)} FROM scored"), start="scored"),
)
def _class_report(spark, sf_dir):
    return round_cols(ops.class_report(_predicted(spark, sf_dir), "label", "prediction"), _RATES, 9)


_BEST = (
    "SELECT score FROM (SELECT score, tp / (tp + fp) AS p, tp / n_pos AS r FROM cum) "
    "ORDER BY 2 * p * r / (p + r + 1e-10) DESC, score LIMIT 1"
)


@query(
    "report_at_threshold",
    _cum(
        f"SELECT 0.5::DOUBLE AS threshold, * FROM ({report_sql(f'SELECT {_CELLS.format(t=0.5)} FROM scored')}) UNION ALL "
        f"SELECT ({_BEST}) AS threshold, * FROM ({report_sql(f'SELECT {_CELLS.format(t=f'({_BEST})')} FROM scored')})"
    ),
)
def _report_at(spark, sf_dir):
    df = scored(spark, sf_dir)
    best = ops.best_f1(df, "label", "score").first()["threshold"]
    both = ops.report_at(df, "label", "score", 0.5).unionByName(ops.report_at(df, "label", "score", best))
    return round_cols(both, _RATES, 9)


@query(
    "roc_auc",
    with_tables(
        "SELECT " + rnd("(sum(r) FILTER (WHERE label = 1) - n1 * (n1 + 1) / 2) / (n1 * n0)", 9) + " AS roc_auc FROM "
        "(SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS r, "
        "count(*) FILTER (WHERE label = 1) OVER () AS n1, count(*) FILTER (WHERE label = 0) OVER () AS n0 FROM scored) "
        "GROUP BY n1, n0",
        start="scored",
    ),
)
def _roc_auc(spark, sf_dir):
    return round_cols(ops.roc_auc(scored(spark, sf_dir), "label", "score"), ["roc_auc"], 9)


@query(
    "roc_curve",
    _cum(
        f"SELECT {rnd('fp / n_neg', 9)} AS fpr, {rnd('tp / n_pos', 9)} AS tpr, score AS threshold FROM cum "
        "UNION ALL SELECT 0.0::DOUBLE, 0.0::DOUBLE, NULL"
    ),
)
def _roc_curve(spark, sf_dir):
    return round_cols(ops.roc_curve(scored(spark, sf_dir), "label", "score"), ["fpr", "tpr"], 9)


@query(
    "pr_curve",
    _cum(
        f"SELECT {rnd('tp / (tp + fp)', 9)} AS precision, {rnd('tp / n_pos', 9)} AS recall, score AS threshold FROM cum "
        "UNION ALL SELECT 1.0::DOUBLE, 0.0::DOUBLE, NULL"
    ),
)
def _pr_curve(spark, sf_dir):
    return round_cols(ops.pr_curve(scored(spark, sf_dir), "label", "score"), ["precision", "recall"], 9)


@query(
    "average_precision",
    _cum(f"SELECT {rnd('sum((tp / n_pos - coalesce(before, 0) / n_pos) * tp / (tp + fp))', 9)} AS avg_precision FROM "
         "(SELECT *, lag(tp) OVER (ORDER BY score DESC) AS before FROM cum)"),
)
def _average_precision(spark, sf_dir):
    return round_cols(ops.average_precision(scored(spark, sf_dir), "label", "score"), ["avg_precision"], 9)


@query(
    "best_f1_threshold",
    _cum(
        f"SELECT score AS threshold, {rnd('p', 9)} AS precision, {rnd('r', 9)} AS recall, {rnd('2 * p * r / (p + r + 1e-10)', 9)} AS f1 "
        f"FROM (SELECT score, tp / (tp + fp) AS p, tp / n_pos AS r FROM cum) WHERE score = ({_BEST})"
    ),
)
def _best_f1(spark, sf_dir):
    return round_cols(ops.best_f1(scored(spark, sf_dir), "label", "score"), ["precision", "recall", "f1"], 9)


@query(
    "accuracy",
    with_tables(
        f"SELECT {rnd('count(*) FILTER (WHERE label = CAST(score >= 0.5 AS INTEGER)) / count(*)', 9)} AS accuracy FROM scored",
        start="scored",
    ),
)
def _accuracy(spark, sf_dir):
    return round_cols(ops.accuracy(_predicted(spark, sf_dir), "label", "prediction"), ["accuracy"], 9)


@query(
    "rmse_r2",
    with_tables(
        " UNION ALL ".join(
            f"SELECT '{n}' AS model, {rnd('sqrt(avg((lifetime_value - p) * (lifetime_value - p)))', 4)} AS rmse, "
            f"{rnd('1 - sum((lifetime_value - p) * (lifetime_value - p)) / (SELECT sum((lifetime_value - m) * (lifetime_value - m)) FROM client_profile, (SELECT avg(lifetime_value) AS m FROM client_profile))', 9)} AS r2 "
            f"FROM (SELECT lifetime_value, {p} AS p FROM client_profile)"
            for n, p in (("visits", "avg_order_value * total_visits"), ("orders", "avg_order_value * 10"))
        )
    ),
)
def _rmse(spark, sf_dir):
    """Two fixed predictions of the lifetime value, sorted by RMSE."""
    df = profile(spark, sf_dir).select("lifetime_value", "avg_order_value", "total_visits")
    guesses = {"visits": F.col("avg_order_value") * F.col("total_visits"), "orders": F.col("avg_order_value") * 10}
    both = stack_tagged(
        {n: ops.regression_metrics(df.withColumn("p", p), "lifetime_value", "p") for n, p in guesses.items()}, "model"
    )
    return round_cols(round_cols(both, ["rmse"], 4), ["r2"], 9).orderBy("rmse")


_TWO = {"Corte 0.5": 0.5, "Corte 0.34": 0.34}


@query(
    "metrics_long",
    with_tables(
        "SELECT model, class, metric, value, model || ' | ' || class AS series FROM (SELECT model, 'Clase ' || class AS class, "
        f"{rnd('precision', 3)} AS precision, {rnd('recall', 3)} AS recall, {rnd('f1_score', 3)} AS f1_score FROM ("
        + " UNION ALL ".join(
            f"SELECT '{n}' AS model, * FROM ({report_sql(f'SELECT {_CELLS.format(t=t)} FROM scored')})" for n, t in _TWO.items()
        )
        + ") WHERE class IN ('0', '1')) UNPIVOT (value FOR metric IN (precision, recall, f1_score))",
        start="scored",
    ),
)
def _metrics_long(spark, sf_dir):
    df = scored(spark, sf_dir)
    reports = {n: ops.class_report(ops.with_prediction(df, "score", t), "label", "prediction") for n, t in _TWO.items()}
    return ops.metrics_long(reports)


_QUALITY = "(SELECT d.n_chars, l.{0} AS label FROM labels l JOIN documents d USING (doc_id))"


def _auc_row(name: str) -> str:
    src = _QUALITY.format(name)
    return (
        f"SELECT '{name}' AS feature_set, (sum(r) FILTER (WHERE label = 1) - n1 * (n1 + 1) / 2) / (n1 * n0) AS roc_auc FROM "
        f"(SELECT label, rank() OVER (ORDER BY n_chars) + (count(*) OVER (PARTITION BY n_chars) - 1) / 2 AS r, "
        f"count(*) FILTER (WHERE label = 1) OVER () AS n1, count(*) FILTER (WHERE label = 0) OVER () AS n0 FROM {src}) "
        "GROUP BY n1, n0"
    )


def _label_aucs(spark, sf_dir):
    """AUC of the text length against the two real labels of the documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    joined = table(spark, sf_dir, "labels").join(docs, "doc_id")
    return stack_tagged({n: ops.roc_auc(joined, n, "n_chars") for n in ("quality", "toxic")}, "feature_set")


@query(
    "model_status",
    f"SELECT feature_set, {rnd('roc_auc', 9)} AS roc_auc, CASE WHEN roc_auc >= 0.65 THEN 'scale' WHEN roc_auc >= 0.58 THEN 'monitor' "
    f"ELSE 'improve' END AS status, roc_auc >= 0.75 AS goal_reached FROM ({_auc_row('quality')} UNION ALL {_auc_row('toxic')})",
)
def _model_status(spark, sf_dir):
    return round_cols(with_status(_label_aucs(spark, sf_dir)), ["roc_auc"], 9)


@query(
    "rank_versions",
    f"SELECT feature_set, {rnd('roc_auc', 9)} AS roc_auc FROM ({_auc_row('quality')} UNION ALL {_auc_row('toxic')}) "
    "ORDER BY roc_auc DESC LIMIT 1",
)
def _rank_versions(spark, sf_dir):
    return round_cols(rank_results(_label_aucs(spark, sf_dir), ["roc_auc"], 1), ["roc_auc"], 9)


@query(
    "sort_report",
    f"SELECT feature_set, {rnd('roc_auc', 9)} AS roc_auc FROM ({_auc_row('quality')} UNION ALL {_auc_row('toxic')}) ORDER BY roc_auc DESC",
)
def _sort_report(spark, sf_dir):
    return rank_results(round_cols(_label_aucs(spark, sf_dir), ["roc_auc"], 9), ["roc_auc"])
