import json
import random
from collections import defaultdict

from seriesloom.llm import chat, queries

TOOL = {"find": {"type": "object", "required": ["q"], "additionalProperties": False, "properties": {"q": {"type": "string"}, "n": {"type": "integer", "minimum": 1}, "of": {"type": "array", "items": {"type": "string", "enum": ["a", "b"]}}, "on": {"type": "object"}}}}
CALLS = "conv_id long, turn long, call_id string, name string, arguments string, extra string"
RESULTS = "conv_id long, turn long, call_id string, content string"


def test_links_orders_and_validates(spark):
    calls = [
        (1, 5, "c", "find", '{"q": {"$ref": "b"}}', ""),
        (1, 3, "b", "find", '{"n": 2, "q": "é", "on": {"z": 1, "a": {"$ref": "a"}}}', ""),
        (1, 1, "a", "find", '{"q":"x"}', ""),
        (1, 9, "a", "find", '{"q":"again"}', ""),
        (1, 11, "d", "find", '{"q": {"$ref": "nowhere"}}', ""),
        (2, 1, "a", "find", '{"q": {"$ref": "b"}}', ""),
        (2, 2, "b", "find", '{"q": {"$ref": "a"}}', ""),
        (3, 1, "a", "find", '{"n": 0, "of": ["a", "c"], "p": true}', ""),
        (3, 2, "b", "lose", "{}", ""),
        (3, 3, "c", "find", "no json", ""),
        (3, 4, "d", "find", None, ""),
        (3, 5, None, "find", '{"q":"x"}', ""),
        (None, 1, "a", "find", '{"q":"x"}', ""),
    ]
    results = [(1, 2, "a", "one"), (1, 4, "b", "two"), (1, 6, "c", None), (1, 8, "a", "late"), (9, 1, "a", "lost"), (None, 1, "a", "lost")]
    rows = chat.linked(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), TOOL).collect()
    assert len(rows) == len(calls) + len(results)
    got = {(r.conv_id, r.turn, r.kind, r.call_id): r for r in rows}
    first = sorted((r for r in rows if r.conv_id == 1 and r.status == "ok"), key=lambda r: (r.level, r.call_turn, r.kind))
    assert [(r.call_id, r.kind) for r in first] == [(c, k) for c in "abc" for k in ("call", "result")]
    assert got[1, 9, "call", "a"].status == "repeated" and got[1, 8, "result", "a"].status == "repeated"
    assert got[1, 11, "call", "d"].status == "unordered"
    assert got[2, 1, "call", "a"].status == got[2, 2, "call", "b"].status == "unordered"
    assert got[3, 1, "call", "a"].faults == "$.q: missing; $.n: too small; $.of[1]: not allowed; $.p: unknown"
    assert {got[3, t, "call", c].status for t, c in ((1, "a"), (2, "b"), (3, "c"), (4, "d"))} == {"invalid"}
    assert got[9, 1, "result", "a"].status == got[None, 1, "result", "a"].status == "orphan"
    assert got[1, 3, "call", "b"].json == '{"arguments":{"n":2,"on":{"a":{"$ref":"a"},"z":1},"q":"é"},"id":"b","name":"find","type":"call"}'
    assert json.loads(got[1, 6, "result", "c"].json) == {"content": None, "id": "c", "type": "result"}


def test_turns_as_calls(spark):
    turns = [(1, 0, "system", "s"), (1, 1, "user", "hi there"), (1, 2, "assistant", "yes"), (1, 3, "user", "more"), (1, 4, "assistant", "no"), (1, 5, "user", None), (2, 0, "assistant", "first"), (None, 0, "user", "x")]
    calls, results = chat.as_calls(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    rows = chat.linked(calls, results, chat.REPLY).collect()
    status = {(r.conv_id, r.turn, r.kind): (r.status, r.level) for r in rows}
    assert status[1, 1, "call"] == ("ok", 0) and status[1, 3, "call"] == ("ok", 1) and status[1, 4, "result"] == ("ok", 1)
    assert status[1, 5, "call"][0] == "invalid"  # no words
    assert status[2, 0, "result"][0] == "orphan"
    assert len(rows) == 7


def test_every_turn_is_a_row(spark):
    turns = [(1, 0, "system", "s é"), (1, 1, "user", "hi"), (1, 2, "assistant", "yes"), (1, 3, None, "lost"), (1, 4, "tool", None), (1, 5, "User", "x"), (None, None, None, None), (2, 0, "assistant", "y"), (1, 0, "system", "s é")]
    rows = chat.turns(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).collect()
    assert len(rows) == len(turns)
    others = sorted((r.conv_id or 0, r.turn or 0, r.call_turn or 0, r.status, r.call_id, r.level, r.json) for r in rows if r.kind == "message")
    want = [(c or 0, t or 0, t or 0, "ok", None, None, chat.canonical({"content": x, "role": r, "type": "message"})) for c, t, r, x in turns if r not in ("user", "assistant")]
    assert others == sorted(want)


def test_query_keeps_all_turns(spark):
    folder = "/root/testdata/sf0.001"
    assert queries.QUERIES["op8_chat"](spark, folder).count() == spark.read.parquet(f"{folder}/conversations.parquet").count()


def test_empty_tables(spark):
    assert chat.linked(spark.createDataFrame([], CALLS), spark.createDataFrame([], RESULTS), TOOL).count() == 0


def expected(calls, results):
    """(conv, turn, kind, id, level, status) of every row, by following references one by one."""
    first, answers = {}, {}
    for conv, turn, i, _, arguments in sorted(calls, key=lambda c: (c[1], c[4])):
        if conv is not None and i is not None:
            first.setdefault((conv, i), (turn, arguments))
    for conv, turn, i, content in sorted(results, key=lambda r: (r[1], chat.canonical({"content": r[3], "id": r[2], "type": "result"}))):
        if conv is not None and i is not None:
            answers.setdefault((conv, i), (turn, content))
    refs = {k: [(k[0], r) for r in set(chat.references(chat.loaded(a)))] for k, (_, a) in first.items()}
    level = {}
    for _ in range(len(refs) + 1):
        level |= {k: 1 + max((level[r] for r in rs), default=-1) for k, rs in refs.items() if k not in level and all(r in level for r in rs)}
    out = []
    seen = defaultdict(int)
    for conv, turn, i, name, arguments in calls:
        k = (conv, i)
        ours = first.get(k) == (turn, arguments) and not seen[k, "call"]
        seen[k, "call"] += ours
        value = chat.loaded(arguments)
        good = isinstance(value, dict) and name in TOOL and not chat.faults(value, TOOL[name])
        null = conv is None or i is None
        status = "repeated" if null or not ours else "invalid" if not good else "unordered" if k not in level else "ok" if k in answers else "unanswered"
        out.append((conv, turn, "call", i, level.get(k) if ours and not null else None, status))
    for conv, turn, i, content in results:
        k = (conv, i)
        ours = answers.get(k) == (turn, content) and not seen[k, "result"]
        seen[k, "result"] += ours
        status = "orphan" if k not in first else "ok" if ours else "repeated"
        out.append((conv, turn, "result", i, level.get(k) if k in first else None, status))
    return sorted(out, key=repr)


def test_random_calls_against_following_references(spark):
    r = random.Random(8)
    calls, results = [], []
    for conv in [*range(25), None]:
        ids = [f"c{i}" for i in range(r.randrange(1, 14))]
        for turn, i in enumerate([*ids, *r.choices(ids, k=2), None]):
            to = [{"$ref": r.choice([*ids, "none"]) if r.random() < 0.15 else r.choice(ids[: max(1, turn)])} for _ in range(r.choice([0, 1, 1, 1, 2, 3]))]
            arguments = r.choice([json.dumps({"q": "x", "on": {"of": to}})] * 6 + [json.dumps({"on": to}), "[1]", None])
            calls.append((conv, turn, i, r.choice(["find"] * 9 + ["lose"]), arguments or "null"))
        results += [(conv, 100 + n, i, f"r{n}") for n, i in enumerate(r.choices([*ids, "none", None], k=8))]
    rows = chat.linked(spark.createDataFrame([(*c, "") for c in calls], CALLS), spark.createDataFrame(results, RESULTS), TOOL).collect()
    assert sorted(((x.conv_id, x.turn, x.kind, x.call_id, x.level, x.status) for x in rows), key=repr) == expected(calls, results)


def test_long_chains_take_few_rounds(spark):
    """1,000 calls in a row, one of them with two references, and a ring of 5."""
    rows = [(1, f"c{i}", [f"c{i - 1}"] if i else []) for i in range(1000)]
    rows[500] = (1, "c500", ["c499", "c3"])
    rows += [(2, f"c{i}", [f"c{(i + 1) % 5}"]) for i in range(5)] + [(2, "in", ["c0"])]
    table = spark.createDataFrame(rows, "conv_id long, call_id string, refs array<string>")
    ends, rounds = chat.chains(table)
    assert rounds <= 12 and ends.count() == 998
    got = {(r.conv_id, r.call_id): r.level for r in chat.levels(table).collect()}
    assert got == {(1, f"c{i}"): i for i in range(1000)}


def test_odd_json(spark):
    tool = {"t": {"type": ["object", "null"], "properties": {"s": {"type": ["string", "null"]}, "n": {"type": "integer"}, "e": {"enum": [1, None]}, "no": False, "any": True, "odd": {"type": "colour"}}}}
    texts = [
        '{"s": "\\ud800"}', "[" * 100_000 + "]" * 100_000, '{"a":' * 300 + "1" + "}" * 300, '{"n": NaN}', '{"n": 1e999}', '{"n": -Infinity}',
        '{"s": null, "n": 2.0, "e": null, "any": [1], "odd": 3}', '{"e": true}', '{"no": 1}', '{"\\udfff": {"$ref": "\\ud801"}}', '{"n": true}', '{"n":' + "9" * 5000 + "}", '{"s": "\\ud83d\\ude00"}',
    ]
    calls = spark.createDataFrame([(1, n, f"c{n}", "t", t, "") for n, t in enumerate(texts)], CALLS)
    rows = {r.turn: r for r in chat.linked(calls, spark.createDataFrame([], RESULTS), tool).collect()}
    for r in rows.values():
        json.loads(r.json, parse_constant=lambda c: 1 / 0)
    fine = {n: (r.faults == "", r.status) for n, r in rows.items()}
    assert {n for n, (ok, _) in fine.items() if ok} == {0, 6, 9, 12}
    assert "\\ud800" in rows[0].json and "😀" in rows[12].json and fine[9][1] == "unordered"
    assert rows[7].faults == "$.e: not allowed" and rows[10].faults == "$.n: not integer"
    assert json.loads(rows[2].json)["arguments"] is None
