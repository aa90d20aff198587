"""Conversations repaired at least cost: a grammar of roles, a suffix-shared automaton of what may follow, an audit.

A conversation's rows are taken by turn (nulls first), then role, then text. Each row has a first fault: blank (no
character but ASCII white space), duplicate (role and text of an earlier row), truncated (its last other character is
none of ``.!?``). Edits, with their initials and costs: Keep 0, Rerole to user or assistant 2, Delete 3 (required for
blank and duplicate rows), Insert an empty user or assistant row 2; a truncated row that isn't deleted adds 1. Repaired
role initials have the form ``(s?(ua)+)?``. Of equally cheap repairs, the one whose initials are ASCII-least counts.

* A row's symbol is what decides about it: must go, or its role initial and whether it is truncated. The symbols of a
  conversation are its signature.
* Distinct signatures are sorted from their ends. In that order those that share a suffix are neighbours, so each task
  walks its part of the suffix-shared automaton (DAWG) along one path and goes on where the last signature parts from
  the next. Suffixes with the same costs and best edits are one node; cost-to-go and best edit are computed once for
  each node and state of the grammar, whatever number of conversations passes there. Edits with one initial lead from
  a state to one state only, so the cheapest edit with the least initial begins the best audit, and an audit is read
  off along the nodes.
* Rows are sorted on Spark and streamed. A conversation is held as chunks of bounded text; only its signature (one
  letter a row) and a 16-byte hash of each different row meet in one place, however long it is.

A null role or text counts as one space. Rows without a conversation id form one conversation, whose id is null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campaign_engine.llm.shared import lookup, ship, stored

# Costs of the edits, roles, white space and the ends of whole sentences.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
USER, ASSISTANT = "user", "assistant"
SPACE, ENDS = " \t\n\v\f\r", ".!?"

# States of the grammar: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, ASKED, ANSWERED = range(4)
DUE = {START: (USER, ASKED), SYSTEM: (USER, ASKED), ASKED: (ASSISTANT, ANSWERED), ANSWERED: (USER, ASKED)}
ENDING = (START, ANSWERED)
GONE = "-"  # symbol of a row that must be deleted; others: role initial (or "x"), upper case where truncated
CHUNK_BYTES = 1 << 18


def symbol(role: str, fault: str) -> str:
    if fault in ("blank", "duplicate"):
        return GONE
    initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
    return initial.upper() if fault == "truncated" else initial


def fault_of(text: str, repeated: bool) -> str:
    """First fault of a row, or an empty text."""
    words = text.strip(SPACE)
    return "blank" if not words else "duplicate" if repeated else "" if words[-1] in ENDS else "truncated"


class Automaton:
    """Nodes of the suffix-shared automaton, minimised: suffixes are one node if for each state of the grammar they
    have the same best first edit, state after it and cost-to-go (above the least of the four).

    ``steps`` leads from (node, symbol before it) to (node, what the least cost grows by); each is computed once.
    """

    def __init__(self) -> None:
        self.nodes: list[tuple[tuple[int, ...], tuple[str, ...], tuple[int, ...]]] = []  # costs, edits, states after them
        self.numbers: dict[tuple, int] = {}
        self.steps: dict[tuple[int, str], tuple[int, int]] = {}
        self.end = self._node([[(0, "", state)] if state in ENDING else [] for state in range(4)])[0]

    def _node(self, options: list[list[tuple[int, str, int]]]) -> tuple[int, int]:
        best = [min(o, default=(1 << 40, "", state)) for state, o in enumerate(options)]
        for _ in range(4):  # an insertion stays before the same row: its cost comes from another state of this node
            for state, (_, following) in DUE.items():
                best[state] = min(best[state], (INSERT + best[following][0], "I", following))
        least = min(b[0] for b in best)
        node = (tuple(b[0] - least for b in best), tuple(b[1] for b in best), tuple(b[2] for b in best))
        if node not in self.numbers:
            self.numbers[node] = len(self.nodes)
            self.nodes.append(node)
        return self.numbers[node], least

    def before(self, node: int, symbol: str) -> tuple[int, int]:
        """The node of a suffix with one more row in front, and what the least cost grows by."""
        if (node, symbol) not in self.steps:
            cost, extra = self.nodes[node][0], TRUNCATED if symbol.isupper() else 0
            options = []
            for state, (role, following) in DUE.items():
                own = [(DELETE + cost[state], "D", state)]
                if symbol != GONE:
                    own.append((REROLE + extra + cost[following], "R", following))
                    if symbol.lower() == role[0]:
                        own.append((extra + cost[following], "K", following))
                    if symbol.lower() == "s" and state == START:
                        own.append((extra + cost[SYSTEM], "K", SYSTEM))
                options.append(own)
            self.steps[node, symbol] = self._node(options)
        return self.steps[node, symbol]

    def audit(self, path: list[int]) -> str:
        """Initials of the best edits from the path's last node back to its first, from the grammar's start."""
        out, state, at = [], START, len(path) - 1
        while True:
            _, edits, states = self.nodes[path[at]]
            edit = edits[state]
            if not edit:
                return "".join(out)
            out.append(edit)
            state = states[state]
            at -= edit != "I"


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(signature, n, cost, audit) of signatures that come sorted from their ends."""
    automaton = Automaton()
    path, least, before = [automaton.end], [0], ""  # node and least cost of the last signature's suffix of 0, 1, 2, ... rows
    for batch in batches:
        costs, audits = [], []
        for signature in batch.column("signature").to_pylist():
            backward, same = signature[::-1], 0
            for a, b in zip(backward, before):
                if a != b:
                    break
                same += 1
            del path[same + 1 :], least[same + 1 :]
            for letter in backward[same:]:
                node, added = automaton.before(path[-1], letter)
                path.append(node)
                least.append(least[-1] + added)
            before = backward
            costs.append(least[-1] + automaton.nodes[path[-1]][0][START])
            audits.append(automaton.audit(path))
        yield pa.RecordBatch.from_arrays(
            [batch.column("signature"), batch.column("n"), pa.array(costs, pa.int64()), pa.array(audits, pa.string())],
            names=["signature", "n", "cost", "audit"],
        )


def best_audits(signatures: DataFrame) -> DataFrame:
    """(signature, n, cost, audit) of distinct signatures (signature, n)."""
    ordered = signatures.withColumn("backward", F.reverse("signature")).repartitionByRange("backward").sortWithinPartitions("backward")
    return ordered.drop("backward").mapInArrow(_audits, "signature string, n long, cost long, audit string")


class _Conversation:
    """Counts and state of a conversation whose rows stream by."""

    def __init__(self) -> None:
        self.number, self.rows, self.size = 0, [], 0
        self.seen: set[bytes] = set()
        self.least = self.most = self.last_turn = None
        self.turns = 0
        self.initial: str | None = None
        self._clear()

    def _clear(self) -> None:
        self.letters: list[str] = []
        self.rows, self.size = [], 0
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)

    def add(self, turn: int | None, role: str, text: str) -> None:
        name = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
        fault = fault_of(text, name in self.seen)
        self.seen.add(name)
        if fault:
            self.counts[fault] += 1
        if self.initial is not None and self.initial + role[:1] not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        self.initial = role[:1]
        self.letters.append(symbol(role, fault))
        if turn is not None:
            self.turns += turn != self.last_turn
            self.least = turn if self.least is None else self.least
            self.most = self.last_turn = turn
        self.rows.append({"role": role, "text": text})
        self.size += len(role) + len(text)

    def full(self, chunk_rows: int) -> bool:
        return self.size >= CHUNK_BYTES or len(self.rows) >= chunk_rows

    def chunk(self) -> dict:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        out = {"chunk": self.number, "letters": "".join(self.letters), "rows": self.rows, "gaps": gaps, **self.counts}
        self.number += 1
        self._clear()
        return out


def _chunks(id_col: str, schema: pa.Schema, chunk_rows: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, key, out, size = None, None, [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if current is None or row[id_col] != key:
                    if current is not None:
                        out.append({id_col: key, **current.chunk()})
                    current, key = _Conversation(), row[id_col]
                if row["stays"]:
                    current.add(row["turn"], row["role"], row["text"])
                    size += len(row["role"]) + len(row["text"])
                    if current.full(chunk_rows):
                        out.append({id_col: key, **current.chunk()})
                if size > 1 << 22 or len(out) > 5000:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, size = [], 0
        if current is not None:
            out.append({id_col: key, **current.chunk()})
        yield pa.RecordBatch.from_pylist(out, schema)

    return cut


def repaired_rows(rows: list[dict], edits: Iterator[str], state: int, last: bool) -> Iterator[tuple[str, str, int]]:
    """(role, text, state after it) of the rows that remain or come in; ``last``: nothing follows these rows."""
    waiting = iter(rows)
    row = next(waiting, None)
    while row is not None or last:
        edit = next(edits, None)
        if edit is None:
            return
        role, following = DUE[state]
        if edit == "K":
            role, following = (row["role"], SYSTEM) if state == START and row["role"][:1] == "s" else (row["role"], following)
        if edit != "D":
            state = following
            yield role, "" if edit == "I" else row["text"], state
        if edit != "I":
            row = next(waiting, None)


def _hashes(id_col: str, schema: pa.Schema):
    """(id, hash of the repaired conversation) of chunks that come by conversation and number, the audit with the first."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edits, state, digest, begun = iter(""), START, hashlib.sha256(), False
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["chunk"] == 0:
                    edits, state, digest, begun = iter(row["audit"]), START, hashlib.sha256(), False
                for role, text, state in repaired_rows(row["rows"], edits, state, row["last"]):
                    digest.update((b"\n" if begun else b"") + f"{role}:{text}".encode())
                    begun = True
                if row["last"]:
                    out.append({id_col: row[id_col], "repaired_sha256": digest.hexdigest()})
            yield pa.RecordBatch.from_pylist(out, schema)

    return walk


def _rows_of(id_col: str, schema: pa.Schema):
    """(id, place, role, text) of the repaired rows."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edits, state, place = iter(""), START, 0
        for batch in batches:
            for row in batch.to_pylist():
                if row["chunk"] == 0:
                    edits, state, place = iter(row["audit"]), START, 0
                out = []
                for role, text, state in repaired_rows(row["rows"], edits, state, row["last"]):
                    out.append({id_col: row[id_col], "place": place, "role": role, "text": text})
                    place += 1
                yield pa.RecordBatch.from_pylist(out, schema)

    return walk


def _arrow(id_col: str, kind: T.DataType, *columns: tuple[str, T.DataType]) -> tuple[T.StructType, pa.Schema]:
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([T.StructField(id_col, kind), *(T.StructField(n, t) for n, t in columns)])
    return schema, to_arrow_schema(schema)


_TURN = T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")


class Repair:
    """Repair of conversations: ``summary()`` has one row for each, ``rows()`` their repaired rows.

    ``stays`` (a Boolean column's name) marks the rows that count; a conversation of which none does is still returned.
    """

    def __init__(
        self, turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
        stays_col: str | None = None, chunk_rows: int = 2000,
    ):
        ship(turns.sparkSession)
        self.id_col, kind = id_col, turns.schema[id_col].dataType
        self.kind = kind
        word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
        rows = turns.select(
            F.col(id_col), F.col(turn_col).cast("long").alias("turn"), word(role_col).alias("role"), word(text_col).alias("text"),
            (F.lit(True) if stays_col is None else F.col(stays_col)).alias("stays"),
        )
        ordered = rows.repartition(F.col(id_col)).sortWithinPartitions(id_col, F.asc_nulls_first("turn"), "role", "text")
        columns = [("chunk", T.LongType()), ("letters", T.StringType()), ("rows", T.ArrayType(_TURN)), *((c, T.LongType()) for c in _COUNTS)]
        schema, arrow = _arrow(id_col, kind, *columns)
        self.chunks = stored(ordered.mapInArrow(_chunks(id_col, arrow, chunk_rows), schema))

        parts = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chunk", "letters"))), lambda c: c["letters"]), "")
        counted = self.chunks.groupBy(id_col).agg(
            parts.alias("signature"), F.max("chunk").alias("last_chunk"), F.max_by("gaps", "chunk").alias("gaps"),
            *(F.sum(c).alias(c) for c in _COUNTS[1:]),
        )
        conversations = stored(counted)
        signatures = stored(conversations.groupBy("signature").agg(F.count("*").alias("n")))
        audits = stored(best_audits(signatures))
        self.found = stored(lookup(conversations, audits, "signature", "n").select(id_col, "last_chunk", *_COUNTS, "cost", "audit"))

    def _walked(self) -> DataFrame:
        """Chunks by conversation and number, with the audit at the first; ``last``: the conversation ends there."""
        mine = F.col(self.id_col).eqNullSafe(F.col("own_id"))
        starts = self.found.select(F.col(self.id_col).alias("own_id"), F.lit(0).cast("long").alias("first_chunk"), "audit")
        ends = self.found.select(F.col(self.id_col).alias("own_id"), F.col("last_chunk"))
        chunks = self.chunks.select(self.id_col, "chunk", "rows")
        begun = chunks.join(starts, mine & (F.col("chunk") == F.col("first_chunk")), "left").drop("own_id", "first_chunk")
        whole = begun.join(ends, mine & (F.col("chunk") == F.col("last_chunk")), "left")
        marked = whole.select(self.id_col, "chunk", "rows", "audit", F.col("last_chunk").isNotNull().alias("last"))
        return marked.repartition(F.col(self.id_col)).sortWithinPartitions(self.id_col, "chunk")

    def rows(self) -> DataFrame:
        """(id, place, role, text) of the repaired conversations."""
        schema, arrow = _arrow(self.id_col, self.kind, ("place", T.LongType()), ("role", T.StringType()), ("text", T.StringType()))
        return self._walked().mapInArrow(_rows_of(self.id_col, arrow), schema)

    def summary(self) -> DataFrame:
        """(id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation."""
        schema, arrow = _arrow(self.id_col, self.kind, ("repaired_sha256", T.StringType()))
        hashed = self._walked().mapInArrow(_hashes(self.id_col, arrow), schema).withColumnRenamed(self.id_col, "own_id")
        joined = self.found.join(hashed, F.col(self.id_col).eqNullSafe(F.col("own_id")))
        return joined.select(self.id_col, *_COUNTS, "cost", "audit", "repaired_sha256")


def damaged(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """(id, turn, role, text, stays): rows damaged by crc32("id:turn") % 20, a null being a space: 0 drops a row (it
    doesn't stay), 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes it the user's."""
    word = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    case: Column = F.crc32(F.concat(word(F.col(id_col)), F.lit(":"), word(F.col(turn_col))).cast("binary")) % 20
    rows = turns.select(
        F.col(id_col), F.col(turn_col).alias("turn"), word(F.col(role_col)).alias("role"), word(F.col(text_col)).alias("text"), case.alias("case")
    )
    text = F.when(F.col("case") == 1, "").when(F.col("case") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("case") == 4, USER).otherwise(F.col("role"))
    twice = F.explode(F.expr("if(case = 3, array(1, 2), array(1))"))
    return rows.select(id_col, "turn", role.alias("role"), text.alias("text"), (F.col("case") != 0).alias("stays"), twice.alias("copy")).drop("copy")
