"""Exact order statistics and running totals that hold no unbounded group in one task.

``percentile`` keeps every distinct value of a group in one aggregation buffer. That is fine up to
``EXACT_ROWS`` rows; beyond that a rank is found by narrowing: a quantile sketch gives two values that
enclose the rank, a count tells exactly where the rank lies, and the next pass looks only between them.
Each pass is one scan with map-side aggregation and shrinks the open interval more than 1,000 times.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from campaign_engine.functions.numeric import known
from campaign_engine.session import ensure_checkpoint_dir

EXACT_ROWS = 1_000_000
CUT_ROWS = 100_000  # distinct hashes in one buffer: 900,000 took one task 7 s
SKETCH = 10_000
MAX_GROUPS = 10_000
EXPRS_PER_JOB = 40
GROUP_CUTS = 1_000



def _fractions(parts: int, first: int = 0) -> str:
    """SQL array of i / parts; one SQL text instead of very many literal columns keeps the plan quick to build."""
    return "array(" + ", ".join(f"{i / parts!r}D" for i in range(first, parts + 1 - first)) + ")"


@dataclass
class _Ask:
    """One wanted rank of the values selected by ``member``; the answer lies strictly in (low, high), None: open end.

    ``source`` names the values, so that asks about the same ones share their aggregates.
    """

    source: tuple
    value: Column
    member: Column
    rank: int
    inside: int
    low: float | None = None
    high: float | None = None
    below: int = 0
    answer: float | None = None

    @property
    def key(self) -> tuple:
        return (self.source, self.low, self.high)

    def around(self) -> tuple[float, float]:
        """Two fractions that surely enclose the rank; neighbouring ranks get the same ones."""
        at = round((self.rank - self.below) / max(self.inside - 1, 1), 5)
        return max(at - 3 / SKETCH, 0.0), min(at + 3 / SKETCH, 1.0)

    def scope(self) -> Column:
        """The values that may still be the answer, null elsewhere."""
        keep = self.member
        if self.low is not None:
            keep = keep & (self.value > self.low)
        if self.high is not None:
            keep = keep & (self.value < self.high)
        return F.when(keep, self.value)


def _run(df: DataFrame, exprs: dict[tuple, Column]) -> dict[tuple, object]:
    """Evaluate named aggregates, a bounded number per job."""
    out: dict[tuple, object] = {}
    names = list(exprs)
    for start in range(0, len(names), EXPRS_PER_JOB):
        part = names[start : start + EXPRS_PER_JOB]
        row = df.agg(*[exprs[n].alias(f"e{i}") for i, n in enumerate(part)]).first()
        out.update(zip(part, row))
    return out


def _narrow(df: DataFrame, asks: list[_Ask]) -> None:
    """One narrowing step: sketch two enclosing values, count around them, keep the part with the rank."""
    fractions: dict[tuple, set[float]] = {}
    for a in asks:
        fractions.setdefault(a.key, set()).update(a.around())
    parts = {a.key: a.scope() for a in asks}
    scopes = {k: F.col(f"s{i}") for i, k in enumerate(parts)}
    df = df.select(*[c.alias(f"s{i}") for i, c in enumerate(parts.values())])  # each worked out once a row
    sketches = _run(df, {k: F.percentile_approx(scopes[k], sorted(f), SKETCH) for k, f in fractions.items()})
    values = {k: dict(zip(sorted(fractions[k]), sketches[k])) for k in fractions}
    edges = {id(a): tuple(values[a.key][f] for f in a.around()) for a in asks}
    wanted: dict[tuple, Column] = {}
    for a in asks:
        low, high = edges[id(a)]
        v = scopes[a.key]
        part = F.struct(
            F.count_if(v < low),
            F.count_if(v == low),
            F.count_if((v > low) & (v < high)),
            F.count_if(v == high),
        )
        wanted[(a.key, low, high)] = part
    counts = _run(df, wanted)
    for a in asks:
        low, high = edges[id(a)]
        n_less, n_low, n_mid, n_high = counts[(a.key, low, high)]
        if low == high:
            n_high = 0
        at = a.rank - a.below
        if at < n_less:
            a.high, a.inside = low, n_less
        elif at < n_less + n_low:
            a.answer = low
        elif at < n_less + n_low + n_mid:
            a.low, a.high, a.below, a.inside = low, high, a.below + n_less + n_low, n_mid
        elif at < n_less + n_low + n_mid + n_high:
            a.answer = high
        else:
            gone = n_less + n_low + n_mid + n_high
            a.low, a.below, a.inside = high, a.below + gone, a.inside - gone


def _resolve(df: DataFrame, asks: list[_Ask], limit: int) -> None:
    """Fill in the answer of every ask."""
    while wide := [a for a in asks if a.answer is None and a.inside > limit]:
        _narrow(df, wide)
    rest = [a for a in asks if a.answer is None]
    for start in range(0, len(rest), EXPRS_PER_JOB):
        part = rest[start : start + EXPRS_PER_JOB]
        scopes = {a.key: a.scope() for a in part}
        names = {k: f"v{i}" for i, k in enumerate(scopes)}
        picks = [
            F.expr(
                f"percentile_disc({(a.rank - a.below + 0.5) / a.inside!r}D) WITHIN GROUP (ORDER BY {names[a.key]})"
            ).alias(f"e{i}")
            for i, a in enumerate(part)
        ]
        row = df.select(*[scopes[k].alias(n) for k, n in names.items()]).agg(*picks).first()
        for a, answer in zip(part, row):
            a.answer = answer


def _interpolated(asks: dict[int, _Ask], position: float) -> float:
    low, high = asks[math.floor(position)].answer, asks[math.ceil(position)].answer
    if low == high:  # infinite ones have no difference
        return low
    return (math.ceil(position) - position) * low + (position - math.floor(position)) * high


def column_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], limit: int = EXACT_ROWS, rows: int | None = None
) -> dict[str, list[float] | None]:
    """Exact linear-interpolated quantiles of each column; None for a column without values.

    ``rows``, if the caller knows it, is an upper bound of the number of rows and may save the counting job.
    """
    if not cols:
        return {}
    values = {c: known(F.col(c).cast("double")) for c in cols}
    if rows is not None and rows <= limit:
        row = df.agg(*[F.percentile(v, list(probs)).alias(c) for c, v in values.items()]).first()
        return {c: None if row[c] is None else list(row[c]) for c in cols}
    counts = df.agg(*[F.count(v).alias(c) for c, v in values.items()]).first()
    out: dict[str, list[float] | None] = {c: None for c in cols}
    small = [c for c in cols if 0 < counts[c] <= limit]
    while small:  # the values that one job's buffers hold are bounded for all its columns together
        part, held = [], 0
        while small and (not part or held + counts[small[0]] <= limit):
            held += counts[small[0]]
            part.append(small.pop(0))
        row = df.agg(*[F.percentile(values[c], list(probs)).alias(c) for c in part]).first()
        out.update({c: list(row[c]) for c in part})
    asks: dict[str, dict[int, _Ask]] = {}
    for c in cols:
        if counts[c] > limit:
            at = [p * (counts[c] - 1) for p in probs]
            ranks = {r for p in at for r in (math.floor(p), math.ceil(p))}
            asks[c] = {r: _Ask((c,), values[c], values[c].isNotNull(), r, counts[c]) for r in ranks}
    _resolve(df, [a for group in asks.values() for a in group.values()], limit)
    for c, group in asks.items():
        out[c] = [_interpolated(group, p * (counts[c] - 1)) for p in probs]
    return out


def approximate_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, list[float] | None]:
    """One-pass alternative with a rank error of at most 1/10,000."""
    row = df.agg(*[F.percentile_approx(known(F.col(c).cast("double")), list(probs), SKETCH).alias(c) for c in cols]).first()
    return {c: None if row[c] is None else list(row[c]) for c in cols}


_INSIDE = "(low IS NULL OR v > low) AND (high IS NULL OR v < high)"  # infinite values lie inside an open end


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= MAX_GROUPS else df


def _narrow_groups(values: DataFrame, asks: DataFrame, n_asks: int) -> DataFrame:
    """One narrowing step for all open asks (group, rank) at once: the same jobs for any number of groups."""
    open_asks = _small(asks.filter("answer IS NULL"), n_asks)
    keys = ["_g", "rank", "low", "high", "below", "inside"]
    scoped = values.join(open_asks.select(*keys), "_g").filter(_INSIDE)
    fractions = F.expr(_fractions(GROUP_CUTS))
    at = (F.col("rank") - F.col("below")) / F.greatest(F.col("inside") - 1, F.lit(1)) * GROUP_CUTS
    sketches = scoped.groupBy(*keys).agg(F.percentile_approx("v", fractions, SKETCH).alias("q")).select(
        *keys,
        F.get("q", F.greatest(F.floor(at - 0.5), F.lit(0)).cast("int")).alias("a"),
        F.get("q", F.least(F.ceil(at + 0.5), F.lit(GROUP_CUTS)).cast("int")).alias("b"),
    ).checkpoint()
    counted = values.join(_small(sketches, n_asks), "_g").filter(_INSIDE).groupBy(*keys, "a", "b").agg(
        F.count_if(F.expr("v < a")).alias("n_less"), F.count_if(F.expr("v = a")).alias("n_a"),
        F.count_if(F.expr("v > a AND v < b")).alias("n_mid"), F.count_if(F.expr("v = b AND a < b")).alias("n_b"),
    )
    steps = counted.withColumn("k", F.expr("rank - below")).select(
        "_g", "rank",
        *[F.expr(e).alias(name) for name, e in {
            "low": "CASE WHEN k < n_less THEN low WHEN k < n_less + n_a + n_mid THEN a ELSE b END",
            "high": "CASE WHEN k < n_less THEN a WHEN k < n_less + n_a + n_mid THEN b ELSE high END",
            "below": "below + CASE WHEN k < n_less THEN 0 WHEN k < n_less + n_a + n_mid THEN n_less + n_a "
                     "ELSE n_less + n_a + n_mid + n_b END",
            "inside": "CASE WHEN k < n_less THEN n_less WHEN k < n_less + n_a + n_mid THEN n_mid "
                      "ELSE inside - (n_less + n_a + n_mid + n_b) END",
            "answer": "CASE WHEN k < n_less THEN NULL WHEN k < n_less + n_a THEN a WHEN k < n_less + n_a + n_mid THEN NULL "
                      "WHEN k < n_less + n_a + n_mid + n_b THEN b END",
        }.items()],
    )
    return steps.unionByName(asks.filter("answer IS NOT NULL")).checkpoint()


def group_quantiles(
    df: DataFrame,
    col: str,
    by: Sequence[str],
    probs: Sequence[float],
    limit: int = EXACT_ROWS,
    rows: int | None = None,
) -> DataFrame:
    """Exact quantiles per group as ``q`` (array). Groups above ``limit`` values are narrowed, all in the same few
    jobs, until an aggregation buffer holds what is left of each; all others fit a buffer from the start."""
    v = known(F.col(col).cast("double"))
    if rows is not None and rows <= limit:
        return df.groupBy(*by).agg(F.percentile(v, list(probs)).alias("q"))
    sizes = df.groupBy(*by).agg(F.count(v).alias("n"))
    if (sizes.agg(F.max("n")).first()[0] or 0) <= limit:
        return df.groupBy(*by).agg(F.percentile(v, list(probs)).alias("q"))
    ensure_checkpoint_dir(df.sparkSession)
    group = F.to_json(F.struct(*by), {"ignoreNullFields": "false"})
    hot = sizes.filter(F.col("n") > limit).withColumn("_g", group).checkpoint()
    n_hot = hot.count()
    places = [F.lit(float(p)) * (F.col("n") - 1) for p in probs]
    ranks = F.array_distinct(F.array(*[f(x).cast("long") for x in places for f in (F.floor, F.ceil)]))
    asks = hot.select(
        "_g", F.explode(ranks).alias("rank"), *[F.lit(None).cast("double").alias(end) for end in ("low", "high")],
        F.lit(0).cast("long").alias("below"), F.col("n").alias("inside"), F.lit(None).cast("double").alias("answer"),
    ).checkpoint()
    n_asks = n_hot * 2 * len(probs)
    keyed = df.select(group.alias("_g"), v.alias("v")).filter("v IS NOT NULL")
    values = keyed.join(_small(hot.select("_g"), n_hot), "_g", "left_semi")
    while not asks.filter((F.col("inside") > limit) & F.col("answer").isNull()).isEmpty():
        asks = _narrow_groups(values, asks, n_asks)
    rest = values.join(_small(asks.filter("answer IS NULL"), n_asks), "_g").filter(_INSIDE)
    last = rest.groupBy("_g", "rank", "below").agg(F.sort_array(F.collect_list("v")).alias("s")).select(
        "_g", "rank", F.get("s", (F.col("rank") - F.col("below")).cast("int")).alias("answer")
    )
    answers = asks.filter("answer IS NOT NULL").select("_g", "rank", "answer").unionByName(last)
    found = answers.groupBy("_g").agg(F.map_from_entries(F.collect_list(F.struct("rank", "answer"))).alias("m"))

    def between(place: Column) -> Column:
        low, high = (F.element_at("m", f(place).cast("long")) for f in (F.floor, F.ceil))
        mixed = (F.ceil(place) - place) * low + (place - F.floor(place)) * high
        return F.when(low == high, low).otherwise(mixed)

    exact = hot.join(found, "_g").select(*by, F.array(*[between(x) for x in places]).alias("q"))
    cold = df.withColumn("_g", group).join(_small(hot.select("_g"), n_hot), "_g", "left_anti")
    return cold.groupBy(*by).agg(F.percentile(v, list(probs)).alias("q")).unionByName(exact)


def group_cuts(
    df: DataFrame,
    value: Column,
    by: str | None,
    wanted: Callable[[int], Sequence[int]],
    limit: int = CUT_ROWS,
) -> dict:
    """Values that cut each group after the wanted numbers of smallest rows.

    ``wanted(n)`` gives the sizes for a group of n rows; ``value <= cut`` then holds for exactly that many.
    Values must be distinct numbers. The number of groups must be small (classes).
    """
    # as columns of their own, so that a hash is worked out once a row, not in every aggregate
    df = df.select((F.col(by) if by else F.lit("all")).alias("g"), value.alias("v"))
    key, value = F.col("g"), F.col("v")
    groups = df.groupBy("g").agg(F.count("*").alias("n")).limit(MAX_GROUPS + 1).collect()
    if len(groups) > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} groups in {by}")
    asks: dict = {}
    for g in groups:
        member = key.eqNullSafe(F.lit(g["g"]))
        sizes = [k for k in wanted(g["n"]) if 0 < k < g["n"]]
        asks[g["g"]] = {r: _Ask((g["g"],), value, member, r, g["n"]) for k in sizes for r in (k - 1, k)}
    _resolve(df, [a for group in asks.values() for a in group.values()], limit)
    out: dict = {}
    for g in groups:
        found = asks[g["g"]]
        out[g["g"]] = [
            -math.inf if k <= 0 else math.inf if k >= g["n"] else (found[k - 1].answer + found[k].answer) / 2
            for k in wanted(g["n"])
        ]
    return out


def running_totals_by(
    df: DataFrame, keys: Sequence[str], order: str, sums: Sequence[str], descending: bool = False, limit: int = EXACT_ROWS
) -> DataFrame:
    """Running sums within each group of ``keys``, sorted by a number that is distinct there, as ``cum_<column>``, with
    the group's sum as ``total_<column>``.

    More than ``limit`` rows are cut into the same value ranges for all groups, of about ``limit`` rows together; windows
    run inside a range of a group, and windows over its ranges add the earlier ones. So no group is sorted in one task.
    """
    n = df.count()
    ranged = df.withColumn("_number", F.col(order).cast("double"))
    if n > limit:
        ranges = max(2, -(-2 * n // limit))
        sketch = f"percentile_approx(CAST(`{order}` AS DOUBLE), {_fractions(ranges, 1)}, {max(SKETCH, 10 * ranges)})"
        splits = [-math.inf, *sorted(set(df.agg(F.expr(sketch)).first()[0])), math.inf]
        ranged = Bucketizer(splits=splits, inputCol="_number", outputCol="_range").transform(ranged)
    else:
        ranged = ranged.withColumn("_range", F.lit(0.0))
    turn = F.desc if descending else F.asc
    inner = Window.partitionBy(*keys, "_range").orderBy(turn("_number")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*keys).orderBy(turn("_range")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = ranged.groupBy(*keys, "_range").agg(*[F.sum(c).alias(f"_sum_{c}") for c in sums]).select(
        *[F.col(k).alias(f"_key_{k}") for k in keys], F.col("_range").alias("_own_range"),
        *[F.coalesce(F.sum(f"_sum_{c}").over(before), F.lit(0)).alias(f"_off_{c}") for c in sums],
        *[F.sum(f"_sum_{c}").over(whole).alias(f"total_{c}") for c in sums],
    )
    match = F.col("_range") == F.col("_own_range")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    placed = ranged.withColumns({f"_in_{c}": F.sum(c).over(inner) for c in sums}).join(offsets, match)
    return placed.withColumns({f"cum_{c}": F.col(f"_off_{c}") + F.col(f"_in_{c}") for c in sums}).select(
        *df.columns, *[f"cum_{c}" for c in sums], *[f"total_{c}" for c in sums]
    )


def running_totals(
    df: DataFrame, order: str, sums: Sequence[str], descending: bool = False, limit: int = EXACT_ROWS
) -> DataFrame:
    """Running sums over rows sorted by a distinct number, as ``cum_<column>``, with the sum over all rows as
    ``total_<column>``.

    Small inputs use one window. Larger ones are cut into value ranges of about ``limit`` rows by a sketch; the
    window runs inside each range and the totals of the earlier ranges are added.
    """
    row = df.agg(
        F.count("*").alias("_rows"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums],
    ).first()
    n = row["_rows"]
    wholes = {f"total_{c}": F.lit(row[c]) for c in sums}

    def by_order(*keys: str):
        last = F.desc(order) if descending else F.asc(order)
        return Window.partitionBy(*keys).orderBy(last).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    if n <= limit:
        w = by_order()
        return df.withColumns({f"cum_{c}": F.sum(c).over(w) for c in sums} | wholes)
    ranges = max(2, -(-2 * n // limit))
    sketch = f"percentile_approx(CAST(`{order}` AS DOUBLE), {_fractions(ranges, 1)}, {max(SKETCH, 10 * ranges)})"
    cuts = df.agg(F.expr(sketch)).first()[0]
    splits = [-math.inf, *sorted(set(cuts)), math.inf]
    ranged = Bucketizer(splits=splits, inputCol="_number", outputCol="_range").transform(
        df.withColumn("_number", F.col(order).cast("double"))
    )
    w = by_order("_range")
    inner = ranged.withColumns({f"_in_{c}": F.sum(c).over(w) for c in sums})
    totals = ranged.groupBy("_range").agg(*[F.sum(c).alias(f"_sum_{c}") for c in sums])
    before = (
        Window.orderBy(F.desc("_range") if descending else F.asc("_range"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = totals.select("_range", *[F.coalesce(F.sum(f"_sum_{c}").over(before), F.lit(0)).alias(f"_off_{c}") for c in sums])
    return (
        inner.join(F.broadcast(offsets), "_range")  # one row per range of about limit / 2 rows
        .withColumns({f"cum_{c}": F.col(f"_off_{c}") + F.col(f"_in_{c}") for c in sums})
        .select(*df.columns, *[f"cum_{c}" for c in sums])
        .withColumns(wholes)
    )


def sorted_positions(df: DataFrame, *keys: str, name: str = "position") -> DataFrame:
    """Number rows from 0 in the order of the (distinct) keys.

    The global sort is range-partitioned; partition and place in it are read off the row id, frozen by a
    checkpoint, and the sizes of the earlier partitions are added.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    placed = df.sort(*keys).withColumn("_id", F.monotonically_increasing_id()).checkpoint()
    part, place = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = sorted(tuple(r) for r in placed.groupBy(part.alias("p")).count().collect())  # one row per partition
    offsets, total = [], 0
    for p, n in sizes:
        offsets.append((p, total))
        total += n
    schema = T.StructType([T.StructField("_part", T.LongType()), T.StructField("_offset", T.LongType())])
    small = spark.createDataFrame(offsets, schema)
    return (
        placed.join(F.broadcast(small), part == F.col("_part"))
        .withColumn(name, F.col("_offset") + place)
        .drop("_id", "_part", "_offset")
    )
