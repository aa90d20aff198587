"""A clean table kept up to date while raw files are added, changed or removed.

Each raw file leaves counts: how many of its rows hold each number, category or null (of the spend: for each group).
Counts of files add up, and every constant of the cleaning (medians, group medians, modes, fences) follows exactly from
their sum, so a refresh counts the new files alone. Rows of an older file are cleaned again only if a constant that
they use has moved: a median or mode if the file has such nulls, a fence if one of its values lies beyond the old or the
new one, the rate always. The table equals ``cleaning.clean`` (profile ``bootstrap``) of all files.

``root`` holds, for each run that found something to do, ``files`` (the listing), ``counts``, ``rows`` (a folder for
each raw file), ``groups``, ``constants`` and, written last, ``manifest``: the raw files with their size and time and
the runs that hold their counts and rows. Readers follow the newest finished manifest, so a run that dies leaves the
table as it was, and the next one writes the same folders anew. One run at a time; ``vacuum`` deletes what no file of
the newest manifest needs. A raw file is known by path, size and time of change. Raw files without rows are listed and have
none. Raw columns named ``own_run`` or ``own_part`` aren't supported, nor columns that only folder names hold.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campaign_engine.operators import columns, impute, outliers
from campaign_engine.operators.fx import fx_enrich, resolve_rate
from campaign_engine.operators.order_stats import EXACT_ROWS, running_totals_by
from campaign_engine.operators.shape import bounded_broadcast
from campaign_engine.plans.cleaning import MONEY_COLS, normalized
from campaign_engine.schemas import CAT_COLS, FX_FALLBACK, INT_COLS, NUMERIC_COLS, TARGET_COL, UNKNOWN, WINSOR_COLS

GROUPED = "total_spent"
_FILES = "file string, path string, length long, modified timestamp, own_part string"
_COUNTS = "own_part string, variable string, grp string, number double, text string, n long"
_MANIFEST = "file string, length long, modified timestamp, own_part string, counts_run int, rows_run int"
_GROUPS = "grp string, median double"


def _runs(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the finished runs in a folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s.getPath() for s in files.listStatus(path)] if files.exists(path) else []
    return sorted(int(p.getName()[8:]) for p in found if p.getName().startswith("own_run=") and files.exists(p.suffix("/_SUCCESS")))


def _write(df: DataFrame, root: str, kind: str, run: int, *by: str) -> None:
    df.write.mode("overwrite").partitionBy(*by).parquet(f"{root}/{kind}/own_run={run}")


def _read(spark: SparkSession, root: str, kind: str, run: int, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{root}/{kind}/own_run={run}")


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """The raw files that the table holds: (file, length, modified, own_part, counts_run, rows_run)."""
    runs = _runs(spark, f"{root}/manifest")
    if not runs:
        raise ValueError(f"no finished refresh in {root}")
    return _read(spark, root, "manifest", runs[-1], _MANIFEST)


def _constants(spark: SparkSession, root: str, run: int) -> dict:
    return json.loads(_read(spark, root, "constants", run, "value string").first()["value"])


def _of_files(spark: SparkSession, root: str, kind: str, files: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of ``kind`` that the manifest ``files`` names; folders of other runs aren't read."""
    runs = [r[0] for r in files.select(f"{kind}_run").distinct().collect()]  # one row for each refresh that changed something
    whole = T.StructType([*schema, T.StructField("own_run", T.IntegerType())])
    if "own_part" not in schema.fieldNames():
        whole = whole.add("own_part", T.StringType())
    if not runs:
        return spark.createDataFrame([], whole).drop("own_run")
    stored = spark.read.schema(whole).option("basePath", f"{root}/{kind}").parquet(*[f"{root}/{kind}/own_run={r}" for r in runs])
    return stored.join(files.select(F.col(f"{kind}_run").alias("own_run"), "own_part"), ["own_run", "own_part"], "left_semi").drop("own_run")


def current(spark: SparkSession, root: str) -> DataFrame:
    """The clean rows of all files of the newest manifest."""
    run = _runs(spark, f"{root}/manifest")[-1:] or [0]
    files = manifest(spark, root)
    schema = T.StructType.fromJson(_constants(spark, root, run[0])["schema"])
    return _of_files(spark, root, "rows", files, schema).select(*schema.fieldNames())


def listed(spark: SparkSession, raw_path: str) -> DataFrame:
    """The raw files by Spark's own listing; their content isn't read."""
    return spark.read.format("binaryFile").load(raw_path).select(
        F.col("_metadata.file_path").alias("file"), "path", "length", F.col("modificationTime").alias("modified"),
        F.concat(F.lit("f"), F.md5(F.col("_metadata.file_path").cast("binary"))).alias("own_part"),
    )


def counted(df: DataFrame) -> DataFrame:
    """Mergeable state of normalised rows: (own_part, variable, grp, number, text, n)."""
    group = F.col(TARGET_COL) if TARGET_COL in df.columns else F.lit(None)

    def one(c: str) -> Column:
        number, text = (F.col(c), F.lit(None)) if c in NUMERIC_COLS else (F.lit(None), F.col(c))
        return F.struct(
            F.lit(c).alias("variable"), (group if c == GROUPED else F.lit(None)).cast("string").alias("grp"),
            number.cast("double").alias("number"), text.cast("string").alias("text"),
        )

    present = [c for c in [*NUMERIC_COLS, *CAT_COLS] if c in df.columns]
    values = df.select("own_part", F.inline(F.array(*[one(c) for c in present])))
    return values.groupBy("own_part", "variable", "grp", "number", "text").agg(F.count("*").alias("n"))


def quantiles(counts: DataFrame, keys: list[str], probs: list[float], limit: int) -> DataFrame:
    """(keys, q): exact quantiles, interpolated between neighbours, from counts of distinct numbers."""
    sums = running_totals_by(counts.select(*keys, "number", "n"), keys, "number", ["n"], limit=limit)
    picks = []
    for i, p in enumerate(probs):
        place = (F.col("total_n") - 1) * F.lit(p)
        for side, rank in (("low", F.floor(place)), ("high", F.ceil(place))):
            picks.append(F.min(F.when(F.col("cum_n") > rank, F.col("number"))).alias(f"{side}{i}"))
    found = sums.groupBy(*keys, "total_n").agg(*picks)
    each = []
    for i, p in enumerate(probs):
        place = (F.col("total_n") - 1) * F.lit(p)
        low, high = F.col(f"low{i}"), F.col(f"high{i}")
        each.append(F.when(low == high, low).otherwise((F.ceil(place) - place) * low + (place - F.floor(place)) * high))
    return found.select(*keys, F.array(*each).alias("q"))


def _filled(counts: DataFrame, groups: DataFrame, medians: Mapping[str, float]) -> DataFrame:
    """Counts of the numbers with nulls filled as the rows are: spend by its group, then all by the column."""
    numbers = counts.filter(F.col("variable").isin(NUMERIC_COLS))
    small = bounded_broadcast(groups.select(F.col("grp").alias("own_grp"), "median"))
    known = numbers.join(small, (F.col("variable") == GROUPED) & (F.col("grp") == F.col("own_grp")), "left")
    fallback = F.lit(None).cast("double")
    for c, v in medians.items():
        fallback = F.when(F.col("variable") == c, F.lit(float(v))).otherwise(fallback)
    return known.select(
        *[c for c in counts.columns if c != "number"], F.coalesce("number", "median", fallback).alias("number"),
        F.col("number").isNull().alias("was_null"), "median",
    )


def constants(counts: DataFrame, groups: DataFrame, limit: int = EXACT_ROWS) -> dict:
    """Medians, modes and fences of summed counts; one entry for each column."""
    known = counts.filter("number is not null")
    plain = quantiles(known.filter(F.col("variable") != GROUPED), ["variable"], [0.5], limit)
    medians = {r["variable"]: r["q"][0] for r in plain.collect()}

    def distinct(rows: DataFrame) -> DataFrame:
        return rows.filter("number is not null").groupBy("variable", "number").agg(F.sum("n").alias("n"))

    spent = distinct(_filled(counts.filter(F.col("variable") == GROUPED), groups, {}))
    medians |= {r["variable"]: r["q"][0] for r in quantiles(spent, ["variable"], [0.5], limit).collect()}
    wins = distinct(_filled(counts.filter(F.col("variable").isin(WINSOR_COLS)), groups, medians))
    found = {r["variable"]: r["q"] for r in quantiles(wins, ["variable"], [0.25, 0.5, 0.75], limit).collect()}
    texts = counts.filter("text is not null").groupBy("variable", "text").agg(F.sum("n").alias("n"))
    best = texts.groupBy("variable").agg(F.min_by("text", F.struct(-F.col("n"), F.col("text"))).alias("text"))
    return {"medians": medians, "fences": found, "modes": {r["variable"]: r["text"] for r in best.collect()}}


def _bounds(values: dict) -> dict[str, tuple[float, float]]:
    """What each column is clipped to; a fence without width clips nothing."""
    found = {c: outliers.Fence(*q) for c, q in values["fences"].items()}
    return {c: (f.low, f.high) for c, f in found.items() if f.iqr != 0}


def cleaned(df: DataFrame, groups: DataFrame, values: dict) -> DataFrame:
    """Raw rows cleaned with given constants: one projection and, for the spend, a lookup of its group."""
    out = normalized(df)
    if GROUPED in out.columns and TARGET_COL in out.columns:
        small = bounded_broadcast(groups.select(F.col("grp").alias("own_grp"), F.col("median").alias("own_median")))
        out = out.join(small, F.col(TARGET_COL) == F.col("own_grp"), "left")
        out = out.withColumn(GROUPED, F.coalesce(F.col(GROUPED).cast("double"), "own_median")).drop("own_grp", "own_median")
    present = [c for c in CAT_COLS if c in out.columns]
    out = out.withColumns({c: F.coalesce(c, F.lit(values["modes"].get(c, UNKNOWN))) for c in present})
    out = impute.fill_numbers(out, {c: v for c, v in values["medians"].items() if c in out.columns})
    fences = {c: outliers.Fence(*q) for c, q in values["fences"].items()}
    out = columns.round_int(outliers.winsorize_iqr(out, WINSOR_COLS, found=fences), INT_COLS)
    return fx_enrich(out, F.lit(values["rate"]), MONEY_COLS)


def stale(counts: DataFrame, old: dict, new: dict, old_groups: DataFrame, new_groups: DataFrame) -> DataFrame:
    """(own_part) of the files whose clean rows differ under the new constants, from the counts of each file."""
    if old["rate"] != new["rate"]:
        return counts.select("own_part").distinct()
    before = bounded_broadcast(old_groups.select(F.col("grp").alias("old_grp"), F.col("median").alias("old_median")))
    texts = [c for c in CAT_COLS if old["modes"].get(c, UNKNOWN) != new["modes"].get(c, UNKNOWN)]
    rows = _filled(counts, new_groups, new["medians"])
    rows = rows.join(before, (F.col("variable") == GROUPED) & (F.col("grp") == F.col("old_grp")), "left")
    moved = [c for c in NUMERIC_COLS if old["medians"].get(c) != new["medians"].get(c)]
    nulls = F.col("was_null") & F.col("variable").isin([c for c in moved if c != GROUPED])
    spent = F.col("was_null") & (F.col("variable") == GROUPED) & (
        ~F.col("median").eqNullSafe(F.col("old_median")) | (F.col("median").isNull() & F.lit(GROUPED in moved))
    )
    tests = [nulls, spent]
    first, second, free = _bounds(old), _bounds(new), (-math.inf, math.inf)
    for c in {*first, *second}:
        (a, b), (x, y) = first.get(c, free), second.get(c, free)
        if (a, b) != (x, y):
            tests.append((F.col("variable") == c) & ((F.col("number") < max(a, x)) | (F.col("number") > min(b, y))))
    parts = rows.filter(reduce(or_, tests)).select("own_part")
    blank = counts.filter(F.col("variable").isin(texts) & F.col("text").isNull()).select("own_part")
    return parts.unionByName(blank).distinct()


def refresh(
    spark: SparkSession, raw_path: str, root: str, fmt: str = "parquet", schema: T.StructType | None = None,
    options: Mapping | None = None, rates: DataFrame | None = None, as_of: datetime | None = None, force: bool = False,
    limit: int = EXACT_ROWS,
) -> dict[str, int]:
    """Bring the table in ``root`` up to the raw files. Returns the run and how many files there are, were counted (new
    or changed), removed and cleaned. Without a difference nothing is written. ``force`` and another schema rebuild all."""
    from campaign_engine.sources.tables import read_table  # that module imports the plans

    last = (_runs(spark, f"{root}/manifest") or [0])[-1]
    run = last + 1
    shape = read_table(spark, raw_path, fmt, schema, options).schema
    rate = FX_FALLBACK if rates is None or as_of is None else resolve_rate(rates, as_of).first()["rate"]
    old = _constants(spark, root, last) if last else None
    known = manifest(spark, root) if last else spark.createDataFrame([], _MANIFEST)
    if force or (old and old["raw"] != shape.jsonValue()):
        old, known = None, known.limit(0)
    _write(listed(spark, raw_path), root, "files", run)
    files = _read(spark, root, "files", run, _FILES)
    keys = ["file", "length", "modified", "own_part"]
    placed = files.join(known, keys, "left")
    total, fresh, held = *placed.agg(F.count("*"), F.count_if(F.col("counts_run").isNull())).first(), known.count()
    gone = held - (total - fresh)
    if old and not fresh and not gone and old["rate"] == rate:
        return {"run": last, "files": total, "counted": 0, "removed": 0, "cleaned": 0}

    def raw(chosen: DataFrame, n: int) -> DataFrame:
        """Rows of the chosen files, each with its file's name."""
        paths = [raw_path] if n == total else [r["path"] for r in chosen.select("path").collect()]  # names, as Spark's own listing
        if not paths:
            return spark.createDataFrame([], shape).withColumn("own_part", F.lit(""))
        rows = read_table(spark, paths, fmt, shape, options)
        return rows.select("*", F.concat(F.lit("f"), F.md5(F.col("_metadata.file_path").cast("binary"))).alias("own_part"))

    def kept(rows: DataFrame, chosen: DataFrame) -> DataFrame:
        """Only listed files: one may have been added since."""
        return rows.join(chosen.select("own_part"), "own_part", "left_semi")

    added = placed.filter("counts_run is null")
    _write(kept(counted(normalized(raw(added, fresh))), added), root, "counts", run)
    held_files = placed.withColumn("counts_run", F.coalesce("counts_run", F.lit(run)))
    own = _of_files(spark, root, "counts", held_files, T.StructType.fromDDL(_COUNTS))
    summed = own.groupBy("variable", "grp", "number", "text").agg(F.sum("n").alias("n")).persist()
    spent = summed.filter((F.col("variable") == GROUPED) & F.col("grp").isNotNull() & F.col("number").isNotNull())
    _write(quantiles(spent, ["grp"], [0.5], limit).select("grp", F.col("q")[0].alias("median")), root, "groups", run)
    groups = _read(spark, root, "groups", run, _GROUPS)
    new = constants(summed, groups, limit) | {"rate": rate, "raw": shape.jsonValue()}
    summed.unpersist()
    if old:
        before = held_files.filter("rows_run is not null")
        moved = stale(own.join(before.select("own_part"), "own_part", "left_semi"), old, new, _read(spark, root, "groups", last, _GROUPS), groups)
        held_files = held_files.join(moved.withColumn("moved", F.lit(True)), "own_part", "left")
        held_files = held_files.withColumn("rows_run", F.when(F.col("moved").isNull(), F.col("rows_run"))).drop("moved")
    held_files = held_files.persist()
    again = held_files.filter("rows_run is null")
    n_again = again.count()
    rows = cleaned(kept(raw(again, n_again), again), groups, new)
    new["schema"] = T.StructType([f for f in rows.schema if f.name != "own_part"]).jsonValue()
    _write(rows, root, "rows", run, "own_part")
    _write(spark.createDataFrame([(json.dumps(new),)], "value string"), root, "constants", run)
    done = held_files.withColumn("rows_run", F.coalesce("rows_run", F.lit(run))).select(*T.StructType.fromDDL(_MANIFEST).fieldNames())
    _write(done, root, "manifest", run)
    held_files.unpersist()
    return {"run": run, "files": total, "counted": fresh, "removed": gone, "cleaned": n_again}


def vacuum(spark: SparkSession, root: str) -> int:
    """Delete the folders of runs that no file of the newest manifest needs; the number of folders deleted."""
    last = _runs(spark, f"{root}/manifest")[-1]
    files, jvm = manifest(spark, root), spark.sparkContext._jvm
    needed = {k: {r[0] for r in files.select(f"{k}_run").distinct().collect()} for k in ("counts", "rows")}
    deleted = 0
    for kind in ("manifest", "files", "counts", "rows", "groups", "constants"):
        for run in _runs(spark, f"{root}/{kind}"):
            if run < last and run not in needed.get(kind, ()):
                path = jvm.org.apache.hadoop.fs.Path(f"{root}/{kind}/own_run={run}")
                deleted += path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return deleted
