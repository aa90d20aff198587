"""Repair of conversations: against a plain search over whole edit sequences, and on odd rows."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

from pyspark.sql import functions as F

from campaign_engine.llm import conversation_repair
from campaign_engine.llm.queries import QUERIES

TURNS = "conv_id long, turn long, role string, text string"
ROW = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
FORM = re.compile(r"(s?(ua)+)?")


def plain_audit(rows):
    """Cheapest (cost, audit, repaired rows), each tried with all roles that an edit can give."""

    @lru_cache(None)
    def best(i, made, inserted):
        """From row i, after a row with the initial ``made``; at most three insertions in a row."""
        out = []
        if i == len(rows) and made in ("", "a"):
            out.append((0, "", ()))
        follows = {"": "su", "s": "u", "u": "a", "a": "u"}[made]

        def go(cost, letter, i, row, inserted=0):
            if row is None:
                c, a, r = best(i, made, 0)
                out.append((c + cost, letter + a, r))
            elif row[0][:1] and row[0][:1] in follows:
                c, a, r = best(i, row[0][:1], inserted)
                out.append((c + cost, letter + a, (row, *r)))

        if inserted < 3:
            for role in ("user", "assistant"):
                go(2, "I", i, (role, ""), inserted + 1)
        if i < len(rows):
            role, text, fault = rows[i]
            go(3, "D", i + 1, None)
            if fault not in ("blank", "duplicate"):
                extra = 1 if fault == "truncated" else 0
                go(extra, "K", i + 1, (role, text))
                for new in ("user", "assistant"):
                    go(2 + extra, "R", i + 1, (new, text))
        return min(out, default=(10**9, "", ()))

    return best(0, "", 0)


def plain(table, damage):
    groups = {}
    for conv, turn, role, text in table:
        rows = groups.setdefault(conv, [])
        show = lambda v: " " if v is None else v
        role, text = show(role), show(text)
        case = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20 if damage else 9
        text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        role = "user" if case == 4 else role
        rows += [(turn, role, text)] * (0 if case == 0 else 2 if case == 3 else 1)
    out = {}
    for conv, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, marked, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in rows:
            words = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            marked.append((role, text, fault))
        turns = {t for t, _, _ in rows if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit, repaired = plain_audit(tuple(marked))
        assert FORM.fullmatch("".join(r[:1] for r, _ in repaired))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest)
    return out


def found(result):
    rows = [(r["conv_id"], tuple(r[c] for c in ROW)) for r in result.collect()]
    assert len(rows) == len({c for c, _ in rows})
    return dict(rows)


def test_query_equals_the_plain_search(spark, sf_dir):
    table = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    result = QUERIES["op12_conversation_repair"](spark, sf_dir)
    assert found(result) == plain(table, damage=True)
    assert [t for _, t in result.dtypes] == ["bigint"] * 7 + ["string"] * 2


def random_turns(seed, conversations, most):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "usher", "User"]
    texts = ["Yes.", "no", "", " \t", None, "Why?\n", "so!", "x" * 50 + ".", "é…", "a ", "."]
    return [
        (rng.choice([c, c, c, None]) if c % 9 == 0 else c, rng.choice([None, k, k, k, k + 3, 1]), rng.choice(roles), rng.choice(texts))
        for c in range(conversations) for k in range(rng.randint(0, most))
    ]


def test_damaged_and_undamaged_random_conversations(spark):
    table = random_turns(3, 250, 9)
    frame = spark.createDataFrame(table, TURNS).withColumns({"stays": F.lit("x"), "chunk": F.lit(1), "audit": F.lit(None), "rows": F.lit(2)})
    assert found(conversation_repair.Repair(frame).summary()) == plain(table, damage=False)
    damaged = conversation_repair.damaged(frame)
    assert found(conversation_repair.Repair(damaged, stays_col="stays").summary()) == plain(table, damage=True)


def test_long_conversations_pass_in_chunks(spark):
    table = random_turns(8, 12, 60)
    want = plain(table, damage=False)
    repair = conversation_repair.Repair(spark.createDataFrame(table, TURNS), chunk_rows=3)
    assert found(repair.summary()) == want
    assert repair.chunks.groupBy("conv_id").count().agg(F.max("count")).first()[0] > 5
    rows = {}
    for r in repair.rows().orderBy("place").collect():
        rows.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    assert {c: hashlib.sha256("\n".join(r).encode()).hexdigest() for c, r in rows.items()} == {
        c: w[-1] for c, w in want.items() if w[-1] != hashlib.sha256(b"").hexdigest()
    }


def test_empty_table_dropped_conversations_and_hot_signatures(spark):
    empty = spark.createDataFrame([], TURNS)
    assert conversation_repair.Repair(conversation_repair.damaged(empty), stays_col="stays").summary().count() == 0
    gone = next(c for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    table = [(gone, 0, "user", "Yes.")] + [(1000 + i, t, ("user", "assistant")[t], "Long text." * 3000) for i in range(300) for t in (0, 1)]
    got = found(conversation_repair.Repair(conversation_repair.damaged(spark.createDataFrame(table, TURNS)), stays_col="stays").summary())
    assert got == plain(table, damage=True)
    assert got[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_each_node_is_computed_once(monkeypatch):
    import pyarrow as pa

    made = []
    original = conversation_repair.Automaton._node
    monkeypatch.setattr(conversation_repair.Automaton, "_node", lambda self, options: made.append(1) or original(self, options))
    signatures = sorted({"".join(random.Random(i).choices("suaxSUAX-", k=i % 40)) for i in range(3000)}, key=lambda s: s[::-1])
    batch = pa.RecordBatch.from_arrays([pa.array(signatures), pa.array([1] * len(signatures))], names=["signature", "n"])
    out = list(conversation_repair._audits(iter([batch])))[0]
    assert out.num_rows == len(signatures) and len(made) < 1000 < sum(map(len, signatures)) / 10
