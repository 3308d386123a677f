"""Conversation repair against a search over all edit scripts."""

import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesloom.llm import queries, repair

RULE = re.compile(r"(s?(ua)+)?")
SOLID = re.compile(r"[^\x20\x09-\x0D]")


def best(turns):
    """(cost, audit, repaired) of (role, text, fault) turns: scripts in order of cost, then of letters."""
    todo = [(0, "", 0, ())]
    seen = set()
    while todo:
        cost, audit, i, out = heapq.heappop(todo)
        pattern = "".join(r[:1] or "-" for r, _ in out)
        if i == len(turns) and RULE.fullmatch(pattern):
            return cost, audit, list(out)
        state = (i, pattern[-1:] if pattern != "s" else "first")
        if state in seen:
            continue
        seen.add(state)
        nexts = [(cost + 3, audit + "I", i, (*out, (r, ""))) for r in ("user", "assistant")]
        if i < len(turns):
            role, text, fault = turns[i]
            nexts.append((cost + 4, audit + "D", i + 1, out))
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                nexts.append((cost + more, audit + "K", i + 1, (*out, (role, text))))
                nexts += [(cost + more + 3, audit + "R", i + 1, (*out, (r, text))) for r in ("user", "assistant")]
        for n in nexts:
            letters = "".join(r[:1] or "-" for r, _ in n[3])
            if re.fullmatch(r"s?(ua)*u?", letters):
                heapq.heappush(todo, n)


def marked(rows):
    seen, out = set(), []
    for role, text in rows:
        solid = SOLID.findall(text)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "" if solid[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def expected(rows):
    """The contract's row for the (turn, role, text) rows of one conversation, in order."""
    turns = [t for t, _, _ in rows if t is not None]
    listed = marked([(r, x) for _, r, x in rows])
    cost, audit, out = best(listed)
    pairs = [(a[0][:1], b[0][:1]) for a, b in zip(listed, listed[1:], strict=False)]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(sum(f == name for *_, f in listed) for name in ("blank", "duplicate", "truncated")),
        sum(p not in (("s", "u"), ("u", "a"), ("a", "u")) for p in pairs),
        cost,
        audit,
        hashlib.sha256("\n".join(f"{r}:{x}" for r, x in out).encode()).hexdigest(),
    )


FIELDS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def rows_of(df):
    return {r.conv_id: tuple(r[f] for f in FIELDS) for r in df.collect()}


def test_blocks_against_search():
    r = random.Random(5)
    kinds = [(role, fault) for role in ("tool", "system", "user", "assistant") for fault in ("", "truncated")] + [("user", "blank")]
    convs = [[r.randrange(9) for _ in range(r.randrange(0, 10))] for _ in range(600)]
    symbols = np.array([s for c in convs for s in (4 * (x % 2) + x // 2 if x < 8 else 8 for x in c)], np.int64)
    costs, found = repair.edits(symbols, np.array([len(c) for c in convs]))
    for conv, cost, audit in zip(convs, costs, found, strict=True):
        want = best([(*kinds[x][:1], f"t{i}", kinds[x][1]) for i, x in enumerate(conv)])
        assert (cost, audit) == want[:2]


def test_long_sequences_cost_what_their_audits_say():
    symbols = np.random.default_rng(3).integers(0, 9, 50_001)
    (cost,), (audit,) = repair.edits(symbols, np.array([len(symbols)]))
    letters = audit.replace("I", "")
    assert len(letters) == len(symbols)
    cut = sum(3 for s, e in zip(symbols, letters, strict=True) if e != "D" and 4 <= s < 8)
    assert cost == cut + 4 * audit.count("D") + 3 * (audit.count("I") + audit.count("R"))


CASES = [
    (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."),
    (2, None, None, None), (2, 5, "user", "Again?"), (2, 5, "user", "Again?"), (2, 9, "assistant", "cut off"),
    (None, 1, "system", "Be brief."), (None, 2, "assistant", "No!  \n"), (None, 2, "user", "tie."),
    (4, 3, "", "no role."), (4, 1, "User", "large."), (4, 7, "admin", "a."), (4, 2, "user", "x" * 2_000_000 + "."),
    (5, -3, "user", ""), (5, 4, "tool", "\t\r"),
    (6, 1, "user", "same."), (6, 2, "assistant", "same."), (6, 3, "user", "same."), (6, 3, "assistant", "same."),
]


def test_defined_cases(spark):
    df = spark.createDataFrame([(*c, "x", 1) for c in CASES], "conv_id long, turn long, role string, text string, hash string, place int").repartition(5)
    ids = spark.createDataFrame([(1,), (77,), (None,)], "conv_id long")
    got = rows_of(repair.report(df, ids))
    plain = {}
    for conv, turn, role, text in CASES:
        plain.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    assert got.pop(77) == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    # The tie of turn 2 is ordered by role.
    assert got == {c: expected(sorted(v, key=lambda x: (x[0] is not None, x[0] or 0, x[1]))) for c, v in plain.items()}


def test_turns_read_legally(spark):
    df = spark.createDataFrame(CASES, "conv_id long, turn long, role string, text string")
    found, turns = repair.repaired(df)
    rows = turns.where("place > 0").collect()
    for r in found.collect():
        own = sorted((t.place, t.role, t.edit) for t in rows if t.conv_id == r.conv_id)
        assert RULE.fullmatch("".join(role[0] for _, role, _ in own))
        assert "".join(e for *_, e in own) == r.audit.replace("D", "")
    empty = repair.report(df.limit(0))
    assert empty.count() == 0 and set(FIELDS) < set(empty.columns)


def test_one_conversation_of_many_turns(spark):
    rows = spark.range(30_000).selectExpr("7L conv_id", "id turn", "if(id % 3 = 0, 'user', 'assistant') role", "concat('t', id % 20000, if(id % 5 = 0, '', '.')) text")
    (r,) = repair.report(rows.repartition(7)).collect()
    assert (r.gaps, len(r.audit.replace("I", ""))) == (0, 30_000)
    turns = [("user" if i % 3 == 0 else "assistant", f"t{i % 20000}" + ("" if i % 5 == 0 else ".")) for i in range(30_000)]
    faults = [f for *_, f in marked(turns)]
    assert (r.duplicate, r.truncated) == (faults.count("duplicate"), faults.count("truncated"))


def damage(conv, turn, role, text):
    show = lambda v: " " if v is None else str(v)
    kind = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
    role, text = show(role), show(text)
    if kind == 0:
        return []
    text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
    return [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01"])
def test_query(spark, folder):
    plain = {}
    for r in spark.read.parquet(f"{folder}/conversations.parquet").orderBy(F.col("turn").asc_nulls_first()).collect():
        plain.setdefault(r.conv_id, []).extend(damage(r.conv_id, r.turn, r.role, r.text))
    assert rows_of(queries.QUERIES["op11_repair"](spark, folder)) == {c: expected(v) for c, v in plain.items()}
