"""Data quality: rule checks, null and duplicate counts, raw-versus-clean comparisons.

Every check of a table is one aggregation over it; what comes out is a small DataFrame.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campaign_engine.functions.numeric import known, outside
from campaign_engine.functions.text import strip, to_double
from campaign_engine.operators.columns import numeric_names
from campaign_engine.operators.order_stats import column_quantiles
from campaign_engine.operators.outliers import fences
from campaign_engine.operators.shape import long_values, rows_from, stack_tagged
from campaign_engine.schemas import Rule

REPORT = "stage string, column string, rule string, severity string, n long"


def _failures(df: DataFrame, col: str, rule: Rule) -> dict[str, tuple[str, Column]]:
    """rule name -> (severity, condition that a row breaks it) for one present column."""
    c = F.col(col)
    checks: dict[str, tuple[str, Column]] = {}
    if not rule.nullable:
        checks["null"] = ("ERROR", c.isNull())
    if rule.kind == "numeric":
        value = known(c.cast("double")) if col in numeric_names(df) else to_double(c)
        if value is not c and col not in numeric_names(df):
            checks["not_numeric"] = ("WARNING", c.isNotNull() & value.isNull())
        if rule.low is not None and rule.high is not None:
            checks["range"] = ("WARNING", outside(value, rule.low, rule.high))
    if rule.values:
        checks["values"] = ("WARNING", c.isNotNull() & ~strip(c).isin(list(rule.values)))
    return checks


def validate_schema(df: DataFrame, rules: Mapping[str, Rule], stage: str = "ETL") -> DataFrame:
    """Rows (stage, column, rule, severity, n) for every broken rule.

    A missing column is an ERROR, an extra one a WARNING, nulls where none are allowed an ERROR, values out
    of range, unparseable or outside the allowed set a WARNING. All rules are counted in one pass.
    """
    present = set(df.columns)
    metadata = [(stage, c, "missing", "ERROR", 1) for c in sorted(set(rules) - present)]
    metadata += [(stage, c, "extra", "WARNING", 1) for c in sorted(present - set(rules))]
    checks = [
        (col, name, severity, broken)
        for col, rule in rules.items()
        if col in present
        for name, (severity, broken) in _failures(df, col, rule).items()
    ]
    report = df.sparkSession.createDataFrame(metadata, REPORT)
    if not checks:
        return report
    one_row = df.agg(*[F.count_if(broken).alias(f"n{i}") for i, (_, _, _, broken) in enumerate(checks)])
    structs = [
        F.struct(
            F.lit(stage).alias("stage"),
            F.lit(col).alias("column"),
            F.lit(name).alias("rule"),
            F.lit(severity).alias("severity"),
            F.col(f"n{i}").alias("n"),
        )
        for i, (col, name, severity, _) in enumerate(checks)
    ]
    counted = one_row.select(F.inline(F.array(*structs))).filter(F.col("n") > 0)
    return report.unionByName(counted)


def verdict(report: DataFrame) -> DataFrame:
    """One row: is_valid (no ERROR), errors, warnings."""
    errors = F.count_if(F.col("severity") == "ERROR")
    return report.agg(
        (errors == 0).alias("is_valid"), errors.alias("errors"), F.count_if(F.col("severity") == "WARNING").alias("warnings")
    )


def quarantine(df: DataFrame, rules: Mapping[str, Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with ``reasons`` as array of column:rule)."""
    marks = [
        F.when(broken, F.lit(f"{col}:{name}"))
        for col, rule in rules.items()
        if col in df.columns
        for name, (_, broken) in _failures(df, col, rule).items()
    ]
    flagged = df.withColumn("reasons", F.array_compact(F.array(*marks)))
    return flagged.filter(F.size("reasons") == 0).drop("reasons"), flagged.filter(F.size("reasons") > 0)


def _nulls(df: DataFrame) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]


def null_counts(df: DataFrame) -> DataFrame:
    """(column, nulls), most nulls first."""
    one_row = df.agg(*_nulls(df))
    return rows_from(one_row, {c: {"nulls": F.col(c)} for c in df.columns}).orderBy(F.desc("nulls"), "column")


def null_total(df: DataFrame) -> DataFrame:
    per_row = sum((F.col(c).isNull().cast("int") for c in df.columns), F.lit(0))
    return df.agg(F.coalesce(F.sum(per_row), F.lit(0)).alias("nulls"))


def null_compare(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """(column, nulls_raw, nulls_clean) over all columns of both tables."""
    a = null_counts(raw).withColumnRenamed("nulls", "nulls_raw")
    b = null_counts(clean).withColumnRenamed("nulls", "nulls_clean")
    return a.join(b, "column", "full")


def null_compare_long(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """(column, nulls, dataset) of the shared columns that have nulls."""
    shared = [c for c in clean.columns if c in raw.columns]
    both = stack_tagged({"Original": null_counts(raw.select(*shared)), "Limpio": null_counts(clean.select(*shared))})
    return both.filter(F.col("nulls") > 0)


def quality_metrics(df: DataFrame, stage: str = "ETL") -> DataFrame:
    """rows, columns, null share in % and repeated rows (second and later copies).

    Equal rows are counted together before the shuffle, so many copies of one row cost nothing extra.
    """
    n_cols = len(df.columns)
    nulls = sum((F.col(c).isNull().cast("int") for c in df.columns), F.lit(0))
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("_n")).select("_n", nulls.alias("_nulls"))
    total = F.coalesce(F.sum("_n"), F.lit(0))
    return groups.agg(
        F.lit(stage).alias("stage"),
        total.alias("total_rows"),
        F.lit(n_cols).alias("total_cols"),
        F.try_divide(F.sum(F.col("_nulls") * F.col("_n")) * 100.0, total * n_cols).alias("null_ratio"),
        (total - F.count("*")).alias("duplicate_rows"),
    )


def shape_kpis(df: DataFrame) -> DataFrame:
    """rows, columns, numeric columns, nulls."""
    per_row = sum((F.col(c).isNull().cast("int") for c in df.columns), F.lit(0))
    return df.agg(
        F.count("*").alias("total_rows"),
        F.lit(len(df.columns)).alias("total_cols"),
        F.lit(len(numeric_names(df))).alias("numeric_cols"),
        F.coalesce(F.sum(per_row), F.lit(0)).alias("nulls"),
    )


def row_consistency(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """One row: rows of both tables and whether the clean one has no more."""
    counts = raw.agg(F.count("*").alias("rows_raw"))
    both = counts.withColumn("rows_clean", clean.agg(F.count("*")).scalar())
    return both.withColumn("consistent", F.col("rows_clean") <= F.col("rows_raw"))


def _stats(df: DataFrame, cols: Sequence[str], with_median: bool) -> DataFrame:
    values = {c: known(F.col(c).cast("double")) if c in numeric_names(df) else to_double(F.col(c)) for c in cols}
    numbers = df.select(*[v.alias(c) for c, v in values.items()])
    exprs = [e for c in cols for e in (F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"), F.avg(c).alias(f"{c}_avg"))]
    middle = column_quantiles(numbers, cols, [0.5]) if with_median else {}
    items = {}
    for c in cols:
        items[c] = {"min": F.col(f"{c}_min"), "max": F.col(f"{c}_max"), "mean": F.col(f"{c}_avg")}
        if with_median:
            q = middle[c]
            items[c]["median"] = F.lit(None if q is None else q[0]).cast("double")
    return rows_from(numbers.agg(*exprs), items, key="variable")


def stats_compare(raw: DataFrame, clean: DataFrame, cols: Sequence[str], with_median: bool = True) -> DataFrame:
    """Statistics per variable with suffixes ``_raw`` and ``_clean``."""
    names = ["min", "max", "mean", *(["median"] if with_median else [])]
    a = _stats(raw, cols, with_median).withColumnsRenamed({n: f"{n}_raw" for n in names})
    b = _stats(clean, cols, with_median).withColumnsRenamed({n: f"{n}_clean" for n in names})
    return a.join(b, "variable")


def stats_compare_long(raw: DataFrame, clean: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(dataset, variable, metric, value)."""
    both = stack_tagged({"Original": _stats(raw, cols, True), "Limpio": _stats(clean, cols, True)})
    return both.unpivot(["dataset", "variable"], ["min", "max", "mean", "median"], "metric", "value")


def category_compare(raw: DataFrame, clean: DataFrame, col: str) -> DataFrame:
    """(value, n, dataset): rows per category in both tables; null shows as text."""
    def counts(df: DataFrame) -> DataFrame:
        return df.groupBy(F.coalesce(F.col(col).cast("string"), F.lit("nan")).alias("value")).agg(F.count("*").alias("n"))

    return stack_tagged({"Original": counts(raw), "Limpio": counts(clean)})


def summary_numeric(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, type, nulls, outliers) per numeric column, most outliers first."""
    cols = numeric_names(df) if cols is None else list(cols)
    found = fences(df, cols)
    kinds = dict(df.dtypes)
    exprs: list[Column] = []
    for c in cols:
        exprs.append(F.count_if(known(F.col(c).cast("double")).isNull()).alias(f"{c}_nulls"))
        f = found.get(c)
        out = F.count_if(outside(F.col(c).cast("double"), f.low, f.high)) if f else F.lit(0).cast("long")
        exprs.append(out.alias(f"{c}_out"))
    report = rows_from(df.agg(*exprs), {
        c: {"type": F.lit(kinds[c]), "nulls": F.col(f"{c}_nulls"), "outliers": F.col(f"{c}_out")} for c in cols
    })
    return report.orderBy(F.desc("outliers"), F.desc("nulls"), "column")


def summary_categorical(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, type, nulls, n_unique) per category, most nulls first; values are counted before they are compared."""
    kinds = F.create_map(*[F.lit(x) for c in cols for x in (c, dict(df.dtypes)[c])])
    counts = long_values(df, cols, "string").groupBy("variable", "value").agg(F.count("*").alias("n"))
    report = counts.groupBy(F.col("variable").alias("column")).agg(
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.count("value").alias("n_unique"),
    )
    return report.select("column", kinds[F.col("column")].alias("type"), "nulls", "n_unique").orderBy(F.desc("nulls"), "column")
