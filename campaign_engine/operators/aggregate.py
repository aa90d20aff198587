"""Group profiles, pivots, counts, histograms and descriptive statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from campaign_engine.functions.numeric import known, round_places
from campaign_engine.operators.order_stats import EXACT_ROWS, column_quantiles, running_totals
from campaign_engine.operators.shape import long_values, rows_from

BROADCAST_VALUES = 100_000


def group_profile(df: DataFrame, by: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """Named aggregates per group; rows with a null key are left out."""
    keyed = df.na.drop(subset=list(by))
    return keyed.groupBy(*by).agg(*[e.alias(name) for name, e in aggs.items()])


def pivot_metrics(
    df: DataFrame, index: str, columns: str, value: str, names: Sequence[str] | None = None, fill: float = 0
) -> DataFrame:
    """Mean and count of a value per (index, column); absent cells become ``fill``.

    All values of the column get cells. ``names`` only saves the job that looks them up; a value it lacks is an error.
    """
    keyed = df.na.drop(subset=[index, columns])
    if names is None:
        names = category_names(keyed, columns)
    else:
        listed = F.col(columns).isin(list(names))
        wrong = F.raise_error(F.concat(F.lit(f"{columns} has an unlisted value: "), F.col(columns).cast("string")))
        keyed = keyed.withColumn(columns, F.when(listed, F.col(columns)).otherwise(wrong))
    wide = keyed.groupBy(index).pivot(columns, list(names)).agg(
        F.avg(value).alias("mean"), F.count(value).alias("count")
    )
    return wide.fillna(fill)


def pivot_cells(wide: DataFrame, index: str, columns: str) -> DataFrame:
    """(index, columns, mean, count): the cells of ``pivot_metrics`` as rows."""
    names = [c.removesuffix("_mean") for c in wide.columns if c.endswith("_mean")]
    cells = [F.struct(F.lit(n).alias(columns), F.col(f"`{n}_mean`").alias("mean"), F.col(f"`{n}_count`").alias("count")) for n in names]
    found = F.array(*cells).cast(f"array<struct<`{columns}`: string, mean: double, count: bigint>>")
    return wide.select(index, F.explode(found).alias("cell")).select(index, *[F.col("cell")[i].alias(i) for i in (columns, "mean", "count")])


def category_names(df: DataFrame, col: str, limit: int = 1_000) -> list[str]:
    """The values of a category, for a pivot; refuses columns that are not categories."""
    rows = df.select(col).where(F.col(col).isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{col} has more than {limit} values")
    return sorted(r[0] for r in rows)


def value_counts(df: DataFrame, col: str, dropna: bool = True, top: int | None = None) -> DataFrame:
    """Rows per value, most frequent first; ``top`` keeps the first n."""
    rows = df.filter(F.col(col).isNotNull()) if dropna else df
    counts = rows.groupBy(col).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc_nulls_last(col))
    return counts if top is None else counts.limit(top)


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, std (n-1), min, quartiles, max per column."""
    quartiles = column_quantiles(df, cols, [0.25, 0.5, 0.75])
    exprs: list[Column] = []
    for c in cols:
        v = known(F.col(c).cast("double"))
        exprs += [
            F.count(v).alias(f"{c}_n"),
            F.avg(v).alias(f"{c}_avg"),
            F.stddev_samp(v).alias(f"{c}_std"),
            F.min(v).alias(f"{c}_min"),
            F.max(v).alias(f"{c}_max"),
        ]
    items = {}
    for c in cols:
        q = quartiles[c] or [None, None, None]
        items[c] = {
            "n": F.col(f"{c}_n"),
            "mean": F.col(f"{c}_avg"),
            "std": F.col(f"{c}_std"),
            "min": F.col(f"{c}_min"),
            "q1": F.lit(q[0]).cast("double"),
            "median": F.lit(q[1]).cast("double"),
            "q3": F.lit(q[2]).cast("double"),
            "max": F.col(f"{c}_max"),
        }
    return rows_from(df.agg(*exprs), items)


def describe_cat(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, unique, top and its frequency per category; counted per value first, so no group is held whole."""
    counts = long_values(df, cols, "string").groupBy("variable", "value").agg(F.count("*").alias("n"))
    there = F.col("value").isNotNull()
    return counts.groupBy(F.col("variable").alias("column")).agg(
        F.coalesce(F.sum(F.when(there, F.col("n"))), F.lit(0)).alias("n"),
        F.count("value").alias("n_unique"),
        F.min_by("value", F.when(there, F.struct(-F.col("n"), F.col("value")))).alias("top"),
        F.max(F.when(there, F.col("n"))).alias("freq"),
    )


def center_lines(df: DataFrame, col: str) -> DataFrame:
    """Mean and median of a column."""
    q = column_quantiles(df, [col], [0.5])[col]
    return df.agg(F.avg(F.col(col)).alias("mean")).withColumn("median", F.lit(None if q is None else q[0]).cast("double"))


def histogram(df: DataFrame, col: str, bins: int, by: str | None = None) -> DataFrame:
    """Equal-width bins over [min, max], the last one closed, with empty bins; optionally per group."""
    v = known(F.col(col).cast("double"))
    low, high = df.agg(F.min(v), F.max(v)).first()
    if low is None:
        low = high = 0.0
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    place = F.least(F.floor((v - low) / width).cast("int"), F.lit(bins - 1))
    keys = [by] if by else []
    counts = df.filter(v.isNotNull()).groupBy(*keys, place.alias("bin")).agg(F.count("*").alias("n"))
    if by:
        groups = counts.select(by).distinct()
        grid = groups.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
        full = grid.join(counts.withColumnsRenamed({by: "_by", "bin": "_bin"}),
                         F.col(by).eqNullSafe(F.col("_by")) & (F.col("bin") == F.col("_bin")), "left").drop("_by", "_bin")
    else:
        grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
        full = grid.join(counts, "bin", "left")
    return full.select(
        *keys,
        "bin",
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("bin_low"),
        (F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("bin_high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def average_ranks(df: DataFrame, rankings: Mapping[str, Column], limit: int = EXACT_ROWS) -> tuple[DataFrame, dict[str, int]]:
    """(variable, value, rank) and the number of values per ranking.

    The rank is the mean 1-based rank of all rows that share a value; nulls have none. Equal values are
    counted before they are sorted. All rankings with up to ``limit`` values share one window per ranking;
    the others are summed up in value ranges.
    """
    wide = df.select(*[v.cast("double").alias(name) for name, v in rankings.items()])
    values = wide.unpivot([], list(rankings), "variable", "value").filter(known(F.col("value")).isNotNull())
    counts = values.groupBy("variable", "value").agg(F.count("*").alias("n"))
    sizes = {r["variable"]: r["count"] for r in counts.groupBy("variable").count().collect()}  # one row per ranking
    big = [name for name, n in sizes.items() if n > limit]
    w = Window.partitionBy("variable").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = counts.filter(~F.col("variable").isin(big)) if big else counts
    totals = totals.withColumn("cum_n", F.sum("n").over(w))
    for name in big:
        one = running_totals(counts.filter(F.col("variable") == name), "value", ["n"], limit=limit)
        totals = totals.unionByName(one.select(*totals.columns))
    return totals.select("variable", "value", (F.col("cum_n") - (F.col("n") - 1) / 2).alias("rank")), sizes


def _ranked(df: DataFrame, rankings: Mapping[str, Column], limit: int) -> DataFrame:
    """One column of ranks per ranking."""
    ranks, sizes = average_ranks(df, rankings, limit)
    out = df.select(*[known(v.cast("double")).alias(name) for name, v in rankings.items()])
    for name in rankings:
        one = ranks.filter(F.col("variable") == name).select(F.col("value").alias("_v"), F.col("rank").alias("_r"))
        if sizes.get(name, 0) <= BROADCAST_VALUES:
            one = F.broadcast(one)
        out = out.join(one, F.col(name) == F.col("_v"), "left").withColumn(name, F.col("_r")).drop("_v", "_r")
    return out


def corr_spearman(df: DataFrame, cols: Sequence[str], places: int = 2, limit: int = EXACT_ROWS) -> DataFrame:
    """Average-rank correlation of every pair, over the rows where both are known: (col_a, col_b, rho).

    Columns without nulls share one ranking; a pair with nulls is ranked on its own complete rows.
    """
    values = {c: known(F.col(c).cast("double")) for c in cols}
    nulls = df.agg(*[F.count_if(v.isNull()).alias(c) for c, v in values.items()]).first()
    rankings: dict[str, Column] = {}
    pairs = []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            names = [a, b]
            if nulls[a] or nulls[b]:
                both = values[a].isNotNull() & values[b].isNotNull()
                names = [f"{c}__{a}__{b}" for c in (a, b)]
                rankings |= {n: F.when(both, values[c]) for n, c in zip(names, (a, b))}
            else:
                rankings |= {a: values[a], b: values[b]}
            pairs.append((a, b, *names))
    ranks = _ranked(df, rankings, limit)
    row = ranks.agg(*[F.corr(x, y).alias(f"r{i}") for i, (_, _, x, y) in enumerate(pairs)])
    structs = [
        F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), round_places(F.col(f"r{i}"), places).alias("rho"))
        for i, (a, b, _, _) in enumerate(pairs)
    ]
    return row.select(F.inline(F.array(*structs)))
