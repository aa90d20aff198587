"""Secrets in texts, judged by how widely their values are copied: SQL functions only, no Python in any task.

Base kinds are leftmost, not overlapping matches of their patterns: ``assign`` (a value of 8 or more characters given
to a telling name), ``access`` (key ids of 16 or more), ``hex`` (32 or more digits). A ``bare`` candidate is a run of
20 or more key characters with digits and letters that touches no base match.

The hashes of all candidate values are counted over the whole corpus, by distinct repositories and distinct owners
(pre-aggregated, so a value in a third of all rows is no large group). A value of ``shared_owners`` or more owners, or
of ``shared_repositories`` or more repositories, whoever owns them, is a widely copied example; any other is specific
to its owners and looks live. Base matches are always reported, bare ones only if they look live.

Spans count code points, end exclusive. Null and empty texts have no matches. A null owner or repository counts as one
of its own. Rows that repeat an id, or have none, are judged one by one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campaign_engine.llm.shared import lookup, stored

# Kinds in their order, patterns, the group that is the value, and its least length.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}+"
HEX = r"[0-9a-f]{32,}+"
BARE = r"(?=[A-Za-z0-9+/_-]{20})(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{20,}+"
KINDS = ("assign", "access", "hex", "bare")
_PART = 128


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once."""
    return F.transform(F.array(value), then)[0]


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, x: a + x)


def _before(numbers: Column) -> Column:
    """Sum of all earlier elements, for each element: within a part of the array, and of the parts before."""

    def parts(n: Column) -> Column:
        count = F.ceil(F.size(n) / _PART).cast("int")
        return F.transform(F.sequence(F.lit(0), count - 1), lambda p: _total(F.slice(n, p * _PART + 1, F.lit(_PART))))

    def sums(n: Column) -> Column:
        earlier = _let(parts(n), lambda t: F.transform(t, lambda _, p: _total(F.slice(t, F.lit(1), p))))
        return _let(earlier, lambda e: F.transform(n, lambda _, i: F.get(e, F.floor(i / _PART).cast("int")) + _total(
            F.slice(n, F.floor(i / _PART).cast("int") * _PART + 1, i % _PART))))

    return _let(numbers, sums)


def _matches(text: Column, pattern: str, kind: int, group: int = 0) -> Column:
    """All matches as structs (start, kind, end, value), an empty array without any."""
    found = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
        F.split(text, pattern, -1).alias("between"),
    )

    def spans(f: Column) -> Column:
        sizes = F.transform(f["whole"], lambda m, i: (F.length(m) + F.length(F.get(f["between"], i))).cast("long"))
        return _let(_before(sizes), lambda b: F.transform(f["whole"], lambda m, i: F.struct(
            (F.get(b, i) + F.length(F.get(f["between"], i))).alias("start"), F.lit(kind).alias("kind"),
            (F.get(b, i) + F.length(F.get(f["between"], i)) + F.length(m)).alias("end"), F.get(f["value"], i).alias("value"))))

    empty = F.from_json(F.lit("[]"), "array<struct<start:bigint,kind:int,end:bigint,value:string>>")
    return F.when(text.rlike(pattern), _let(found, spans)).otherwise(empty)


def base_spans(text: Column) -> Column:
    """Matches of the base kinds, sorted by start, then kind."""
    text = F.coalesce(text, F.lit(""))
    assign = F.filter(_matches(text, ASSIGN, 0, 2), lambda s: F.length(s["value"]) >= 8)
    return F.array_sort(F.concat(assign, _matches(text, ACCESS, 1), _matches(text, HEX, 2)))


def bare_spans(text: Column, base: Column) -> Column:
    """Further candidates that touch none of ``base``."""
    found = _matches(F.coalesce(text, F.lit("")), BARE, 3)
    return F.filter(found, lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))


def _hash(value: Column) -> Column:
    return F.xxhash64(value)


def ownership(candidates: DataFrame) -> DataFrame:
    """(hash, n, repositories, owners) of (hash, repository, owner) rows."""
    by_repository = candidates.groupBy("hash", "repository").agg(F.count("*").alias("n")).groupBy("hash").agg(
        F.sum("n").alias("n"), F.count("*").alias("repositories")
    )
    by_owner = candidates.select("hash", "owner").distinct().groupBy("hash").agg(F.count("*").alias("owners"))
    return by_repository.join(by_owner, "hash")


def _verdicts(found: DataFrame, shared_owners: int, shared_repositories: int) -> DataFrame:
    """(verdict_row, examples, most_owners, most_repositories) of (own_row, owner, repository, base, bare): the hashes of
    widely copied values among the candidates of each row, and how widely its values are copied at most."""
    candidates = found.select("own_row", "owner", "repository", F.explode(F.concat("base", "bare")).alias("s")).select(
        "own_row", "owner", "repository", _hash(F.col("s.value")).alias("hash")
    )
    counted = stored(ownership(candidates))
    wide = (F.col("owners") >= shared_owners) | (F.col("repositories") >= shared_repositories)
    met = lookup(candidates.select("own_row", "hash"), counted, "hash", "n")
    return met.groupBy(F.col("own_row").alias("verdict_row")).agg(
        F.collect_set(F.when(wide, F.col("hash"))).alias("examples"), F.max("owners").alias("most_owners"),
        F.max("repositories").alias("most_repositories"),
    )


def _found(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repository_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("id"), F.col(owner_col).alias("owner"), F.col(repository_col).alias("repository"),
                       F.col(text_col).alias("text"))
    spans = rows.withColumn("base", base_spans(F.col("text"))).withColumn("bare", bare_spans(F.col("text"), F.col("base")))
    return stored(spans.drop("text").withColumn("own_row", F.monotonically_increasing_id()))


def _listed(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repository_col: str = "doc_id",
    shared_owners: int = 3, shared_repositories: int = 100,
) -> DataFrame:
    """(id_col, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_examples, most_owners, most_repositories) of
    each row.

    ``n_live`` and ``n_examples`` split the base matches by the ownership of their values; the last two are the largest
    numbers of owners and repositories of one of the row's candidate values (0 without any).
    """
    found = _found(docs, id_col, text_col, owner_col, repository_col)
    known = _verdicts(found.filter("size(base) + size(bare) > 0"), shared_owners, shared_repositories)
    judged = found.join(known, F.col("own_row") == F.col("verdict_row"), "left")
    shared = lambda s: F.coalesce(F.array_contains("examples", _hash(s["value"])), F.lit(False))
    live = F.filter("bare", lambda s: ~shared(s))
    number = lambda condition: F.size(F.filter("base", condition)).cast("long")
    of_kind = lambda k: lambda s: s["kind"] == k
    return judged.select(
        F.col("id").alias(id_col),
        *(number(of_kind(k)).alias(f"n_{name}") for k, name in enumerate(KINDS[:3])),
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.array_sort(F.concat("base", live))).alias("spans"),
        number(lambda s: ~shared(s)).alias("n_live"), number(shared).alias("n_examples"),
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("most_owners", "most_repositories")),
    )


def _covered(text: Column, spans: Column) -> Column:
    """The text with marks in place of spans (start, end, mark); overlapping ones get the first one's mark."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(acc: Column, s: Column) -> Column:
        fresh = F.array(F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), s["mark"])
        parts = F.when(s["start"] >= acc["at"], F.concat(acc["parts"], fresh)).otherwise(acc["parts"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), parts.alias("parts"))

    return _let(F.aggregate(spans, start, step), lambda a: F.concat(
        F.array_join(a["parts"], ""), F.substring(text, (a["at"] + 1).cast("int"), F.length(text))))


def masked(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repository_col: str = "doc_id",
    shared_owners: int = 3, shared_repositories: int = 100, live_mark: str = "[SECRET]", example_mark: str = "[EXAMPLE]",
) -> DataFrame:
    """``docs`` with the value of every reported span replaced by a mark that says how it was judged."""
    taken = {c.lower() for c in docs.columns}
    own = {n: next(f"{n}{'_' * k}" for k in range(1, 99) if f"{n}{'_' * k}" not in taken) for n in ("base", "bare", "row", "verdict", "examples")}
    text = F.col(text_col)
    base, bare, examples = (F.col(own[n]) for n in ("base", "bare", "examples"))
    spotted = text.rlike(ASSIGN) | text.rlike(ACCESS) | text.rlike(HEX) | text.rlike(BARE)
    spotted = F.coalesce(spotted, F.lit(False))
    rows = docs.filter(spotted).withColumn(own["base"], base_spans(text)).withColumn(own["bare"], bare_spans(text, base))
    rows = stored(rows.withColumn(own["row"], F.monotonically_increasing_id()))  # spans are found once
    known = _verdicts(
        rows.select(F.col(own["row"]).alias("own_row"), F.col(owner_col).alias("owner"), F.col(repository_col).alias("repository"),
                    base.alias("base"), bare.alias("bare")),
        shared_owners, shared_repositories,
    ).select(F.col("verdict_row").alias(own["verdict"]), F.col("examples").alias(own["examples"]))
    judged = rows.join(known, F.col(own["row"]) == F.col(own["verdict"]), "left")
    shared = lambda s: F.coalesce(F.array_contains(examples, _hash(s["value"])), F.lit(False))
    spans = F.concat(base, F.filter(bare, lambda s: ~shared(s)))
    marked = F.array_sort(F.transform(spans, lambda s: F.struct(
        (s["end"] - F.length(s["value"])).alias("start"), (-s["end"]).alias("by_end"), s["end"].alias("end"),
        F.when(shared(s), F.lit(example_mark)).otherwise(F.lit(live_mark)).alias("mark"))))
    covered = judged.withColumn(text_col, F.when(F.size(spans) > 0, _covered(text, marked)).otherwise(text))
    return docs.filter(~spotted).unionByName(covered.select(docs.columns))
