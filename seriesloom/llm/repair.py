"""Structure repair of conversations: the cheapest edits after which roles read ``(s?(ua)+)?``, by Four-Russians blocks.

Turns are kept (0), given another role (3), deleted (4; the only choice for blank and repeated ones) or inserted
with empty text (3); a turn cut off in mid-sentence costs 3 more unless it is deleted. What is left to pay behind a
turn is a vector over four states (nothing yet, after s, after u, after a). Less its smallest entry it is one of a
few vectors, so a turn, seen as one of nine symbols, leads from vector to vector. A table holds this step for every
block of ``LENGTH`` symbols and every vector. Conversations are read block by block from their end, by lookup;
then every block is expanded backward from the vector at its right, and the edits are read off forward. With the
costs still to pay known at every turn, ties go to the first letter of Delete, Insert, Keep, Rerole.

Faults are found by Spark: blanks and cut ends by expressions, repeats by a window over (conversation, role, text),
so a conversation of any size is spread there. The sequence of a conversation passes through one task as a sorted
stream, a symbol a turn (its audit, a letter a turn, is one value in any case); texts pass as a second
sorted stream behind the audit and are never gathered.

Defined cases: a null role or text is one space; rows without ``conv_id`` are a conversation; rows with the same
turn (null turns come first) are ordered by role and a hash of the text; a role counts by its first character, so an
empty or foreign one is never kept; repeated rows are repeats; an empty table gives no rows; columns other than
``conv_id``, ``turn``, ``role`` and ``text`` are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import fields, need_columns, stored, worker_memory

#: Costs of the edits (fixed values).
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
#: Symbols of a block.
LENGTH = 4
SPACE = " \t\n\x0b\x0c\r"
COLUMNS = ["conv_id", "turn", "role", "text"]

#: Symbols: initial (0 other, 1 s, 2 u, 3 a), 4 more where cut off; then turns that must go, and filling.
MUST_GO, FILL, SYMBOLS = 8, 9, 10
#: The state an inserted or reroled turn leads to, and its role there.
NEXT_STATE = (2, 2, 3, 2)
ROLE = {2: "user", 3: "assistant"}
#: Edits behind the last turn, by state.
ENDING = ("", "II", "I", "")
_KEPT = {(0, 1): 1, (0, 2): 2, (1, 2): 2, (3, 2): 2, (2, 3): 3}
_AT_END = (0, 6, 3, 0)


def _step(ahead: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    """Least cost before a turn, by state, from that behind it."""
    if symbol == FILL:
        return ahead
    cost = [DELETE + a for a in ahead]
    if symbol != MUST_GO:
        more = CUT * (symbol // 4)
        for q in range(4):
            cost[q] = min(cost[q], REROLE + more + ahead[NEXT_STATE[q]])
            if (q, symbol % 4) in _KEPT:
                cost[q] = min(cost[q], more + ahead[_KEPT[q, symbol % 4]])
    for _ in range(3):
        cost = [min(c, INSERT + cost[NEXT_STATE[q]]) for q, c in enumerate(cost)]
    return tuple(cost)


def _read_off(ahead: tuple[int, ...], symbol: int, q: int) -> tuple[str, int]:
    """The least edits on a cheapest way past a turn, and the state behind it."""
    if symbol == FILL:
        return "", q
    costs, letters = _step(ahead, symbol), ""
    more, go = CUT * (symbol // 4), symbol == MUST_GO
    while True:
        left = costs[q]
        kept = None if go else _KEPT.get((q, symbol % 4))
        if DELETE + ahead[q] == left:
            return letters + "D", q
        if INSERT + costs[NEXT_STATE[q]] == left:
            letters, q = letters + "I", NEXT_STATE[q]
        elif kept is not None and more + ahead[kept] == left:
            return letters + "K", kept
        else:
            return letters + "R", NEXT_STATE[q]


@dataclass(frozen=True)
class Tables:
    """Steps between normalised vectors, for one symbol and for every block of symbols."""

    vectors: np.ndarray
    one: np.ndarray
    block_to: np.ndarray
    block_cost: np.ndarray
    behind: np.ndarray
    letters: np.ndarray

    @classmethod
    def made(cls) -> Tables:
        found, steps = {_AT_END: 0}, []
        for vector in (queue := [_AT_END]):
            for symbol in range(SYMBOLS):
                cost = _step(vector, symbol)
                least = min(cost)
                after = tuple(c - least for c in cost)
                if after not in found:
                    found[after] = len(found)
                    queue.append(after)
                steps.append((found[after], least))
        one, paid = np.array(steps).reshape(len(found), SYMBOLS, 2).transpose(2, 0, 1)
        to, cost = np.arange(len(found))[:, None], np.zeros((len(found), 1), np.int64)
        for _ in range(LENGTH):
            # One more symbol in front of every block, on the left of its code.
            cost = (cost[:, None, :] + paid[to].transpose(0, 2, 1)).reshape(len(found), -1)
            to = one[to].transpose(0, 2, 1).reshape(len(found), -1)
        read = [_read_off(v, s, q) for v in found for s in range(SYMBOLS) for q in range(4)]
        behind = np.array([q for _, q in read]).reshape(len(found), SYMBOLS, 4)
        letters = np.array([text for text, _ in read], object).reshape(behind.shape)
        return cls(np.array(list(found)), one, to, cost, behind, letters)


def tables() -> Tables:
    return worker_memory("repair_tables", Tables.made)


def edits(symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, list[str]]:
    """Least cost and audit of conversations whose symbols follow one another, ``sizes`` of each."""
    t = tables()
    n_blocks = -(-sizes // LENGTH)
    first_block = np.cumsum(n_blocks) - n_blocks
    padded = np.full(int(n_blocks.sum()) * LENGTH, FILL)
    inside = np.arange(len(symbols)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    padded[np.repeat(first_block * LENGTH, sizes) + inside] = symbols
    block = padded.reshape(-1, LENGTH)
    codes = block @ (SYMBOLS ** np.arange(LENGTH - 1, -1, -1))

    longest = np.argsort(-n_blocks, kind="stable")
    active = np.searchsorted(-n_blocks[longest], -np.arange(int(n_blocks.max(initial=0))), "left")
    right = np.zeros(len(block), np.int64)
    vector, cost = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    for k, n in enumerate(active):
        some = longest[:n]
        at = first_block[some] + n_blocks[some] - 1 - k
        right[at] = vector[some]
        cost[some] += t.block_cost[vector[some], codes[at]]
        vector[some] = t.block_to[vector[some], codes[at]]
    cost += t.vectors[vector, 0]

    # Vectors behind each turn, block by block from the right.
    behind = [right]
    for j in range(LENGTH - 1, 0, -1):
        behind.insert(0, t.one[behind[0], block[:, j]])
    way = np.tile(np.arange(4), (len(block), 1))
    for j in range(LENGTH):
        way = np.take_along_axis(t.behind[behind[j], block[:, j]], way, axis=1)
    start, state = np.zeros(len(block), np.int64), np.zeros(len(sizes), np.int64)
    for k, n in enumerate(active):
        some = longest[:n]
        at = first_block[some] + k
        start[at] = state[some]
        state[some] = way[at, state[some]]
    letters = np.empty(block.shape, object)
    for j in range(LENGTH):
        letters[:, j] = t.letters[behind[j], block[:, j], start]
        start = t.behind[behind[j], block[:, j], start]
    flat = letters.ravel()
    ends = (first_block + n_blocks) * LENGTH
    return cost, ["".join(flat[a:z]) + ENDING[q] for a, z, q in zip(first_block * LENGTH, ends, state, strict=True)]


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with the faults that the query plants: dropped, emptied, cut off, repeated or of another role."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    planted = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    rows = need_columns(rows, COLUMNS).withColumns({"planted": planted, "role": text("role"), "text": text("text")}).where("planted <> 0")
    rows = rows.withColumn("text", F.when(F.col("planted") == 1, "").when(F.col("planted") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    rows = rows.withColumn("role", F.when(F.col("planted") == 4, "user").otherwise(F.col("role")))
    return rows.withColumn("copy", F.explode(F.expr("sequence(1, if(planted = 3, 2, 1))"))).select(*COLUMNS)


def _ordered(*more: str) -> list[Column]:
    return [F.col("conv_id"), *map(F.col, more), F.col("turn").asc_nulls_first(), F.col("role"), F.col("hash"), F.col("again")]


def faults(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Rows with ``initial`` and ``fault`` (0 none, 1 blank, 2 repeat, 3 cut off); ``ids`` without rows as rows not ``there``."""
    rows = need_columns(rows, COLUMNS).select("conv_id", "turn", *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")))
    seen = Window.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    rows = rows.withColumn("again", F.row_number().over(seen)).withColumn("end", F.rtrim(F.col("text"), F.lit(SPACE)))
    cut = ~F.substring("end", -1, 1).isin(".", "!", "?")
    fault = F.when(F.col("end") == "", 1).when(F.col("again") > 1, 2).when(cut, 3).otherwise(0)
    initial = F.expr("position(substring(role, 1, 1), 'sua')")
    rows = rows.withColumns({"initial": F.when(F.col("role") == "", 0).otherwise(initial), "fault": fault, "hash": F.xxhash64("text"), "there": F.lit(True)}).drop("end")
    if ids is not None:
        rows = rows.unionByName(need_columns(ids, ["conv_id"]).distinct().withColumn("there", F.lit(False)), allowMissingColumns=True)
    return stored(rows)


@dataclass
class Part:
    """Turns of conversations in a row, without texts."""

    ids: list[Any]
    turn: np.ndarray
    timed: np.ndarray
    initial: np.ndarray
    fault: np.ndarray
    there: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> Part:
        number = lambda i: batch.column(i).fill_null(0).to_numpy(zero_copy_only=False)
        timed = ~np.asarray(batch.column(1).is_null())
        return cls(batch.column(0).to_pylist(), number(1).astype(np.int64), timed, number(2).astype(np.int64), number(3).astype(np.int64), np.asarray(batch.column(4)))

    @classmethod
    def joined(cls, parts: list[Part]) -> Part:
        if len(parts) == 1:
            return parts[0]
        return cls([i for p in parts for i in p.ids], *(np.concatenate([getattr(p, f) for p in parts]) for f in ("turn", "timed", "initial", "fault", "there")))

    def cut(self, at: int) -> tuple[Part, Part]:
        values = (self.ids, self.turn, self.timed, self.initial, self.fault, self.there)
        return Part(*(v[:at] for v in values)), Part(*(v[at:] for v in values))


def _summary(part: Part) -> dict[str, Any]:
    """Figures and audit of whole conversations."""
    change = [0] + [i for i in range(1, len(part.ids)) if part.ids[i] != part.ids[i - 1]]
    sizes = np.add.reduceat(part.there.astype(np.int64), change)
    turn, timed, initial, fault = (v[part.there] for v in (part.turn, part.timed, part.initial, part.fault))
    ends = np.cumsum(sizes)
    begins = ends - sizes

    def counted(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[ends] - total[begins]

    inner = np.ones(len(turn), bool)
    inner[begins[sizes > 0]] = False
    legal = np.isin(np.roll(initial, 1) * 4 + initial, (1 * 4 + 2, 2 * 4 + 3, 3 * 4 + 2))
    fresh = timed & ~(inner & np.roll(timed, 1) & (np.roll(turn, 1) == turn))
    known = counted(timed)
    high, low = (np.append(turn, 0)[np.where(known > 0, i, -1)] for i in (ends - 1, ends - known))
    symbols = np.where((fault == 1) | (fault == 2), MUST_GO, initial + 4 * (fault == 3))
    cost, audit = edits(symbols, sizes)
    figures = {
        "gaps": np.where(known > 0, high - low + 1 - counted(fresh), 0),
        "blank": counted(fault == 1),
        "duplicate": counted(fault == 2),
        "truncated": counted(fault == 3),
        "illegal": counted(inner & ~legal),
        "cost": cost,
    }
    return {"conv_id": [part.ids[i] for i in change]} | figures | {"audit": audit}


def audits(marked: DataFrame) -> DataFrame:
    """A row per conversation: ``gaps``, faults, ``illegal`` neighbours, ``cost`` and ``audit``."""
    kind = marked.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", kind), *fields(**dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), "long"), audit="string")])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = None
        held: list[Part] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            types = batch.schema.field(0).type
            part = Part.of(batch)
            last = len(part.ids)
            while last > 1 and part.ids[last - 2] == part.ids[-1]:
                last -= 1
            done, rest = part.cut(last - 1)
            if held and (done.ids or held[-1].ids[-1] != rest.ids[0]):
                yield out(Part.joined([*held, done]), types)
                held = [rest]
            else:
                if done.ids:
                    yield out(done, types)
                held.append(rest)
        if held:
            yield out(Part.joined(held), types)

    def out(part: Part, kind: pa.DataType) -> pa.RecordBatch:
        found = _summary(part)
        return pa.record_batch({k: pa.array(v, kind if k == "conv_id" else None) for k, v in found.items()} | {"audit": pa.array(found["audit"], pa.string())})

    order = _ordered()
    stream = marked.repartition("conv_id").sortWithinPartitions(*order)
    return stream.select("conv_id", "turn", "initial", "fault", "there").mapInArrow(read, schema)


def applied(marked: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired turns: ``conv_id``, ``place`` (from 1), ``role``, ``text``, ``edit``; sorted within partitions.

    Each conversation begins with a row of place 0, which carries its audit as ``text``.
    """
    turns = marked.where("there").withColumn("kind", F.lit(1)).select("conv_id", "kind", "turn", "role", "hash", "again", "text")
    heads = found.select("conv_id", F.lit(0).alias("kind"), F.col("audit").alias("text"))
    order = _ordered("kind")
    stream = turns.unionByName(heads, allowMissingColumns=True).repartition("conv_id").sortWithinPartitions(*order)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, conv, audit, at, state, place = None, None, "", 0, 0, 0
        rows: list[tuple] = []

        def inserted() -> None:
            nonlocal at, state, place
            while at < len(audit) and audit[at] == "I":
                state, place, at = NEXT_STATE[state], place + 1, at + 1
                rows.append((conv, place, ROLE[state], "", "I"))

        for batch in batches:
            kind = batch.schema.field(0).type
            for conv_id, order, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if order == 0:
                    inserted()
                    conv, audit, at, state, place = conv_id, text, 0, 0, 0
                    rows.append((conv, 0, "", audit, ""))
                    continue
                inserted()
                edit = audit[at]
                at += 1
                if edit != "D":
                    place += 1
                    state = NEXT_STATE[state] if edit == "R" else _KEPT[state, "sua".index(role[0]) + 1]
                    rows.append((conv, place, ROLE[state] if edit == "R" else role, text, edit))
            if rows:
                yield whole(rows, kind)
            rows = []
        inserted()
        if rows:
            yield whole(rows, kind)

    def whole(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        kinds = (kind, pa.int64(), pa.string(), pa.string(), pa.string())
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["conv_id", "place", "role", "text", "edit"])

    schema = T.StructType([T.StructField("conv_id", marked.schema["conv_id"].dataType), *fields(place="long", role="string", text="string", edit="string")])
    return stream.select("conv_id", "kind", "role", "text").mapInArrow(read, schema)


def digests(turns: DataFrame) -> DataFrame:
    """SHA-256 of every conversation's ``role:text`` lines, from the rows of :func:`applied` in their order."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[Any] = []
        sums: list[str] = []
        kind, current, open_ = None, hashlib.sha256(), False
        for batch in batches:
            kind = batch.schema.field(0).type
            for conv_id, place, role, text in zip(*(c.to_pylist() for c in batch.columns[:4]), strict=True):
                if place == 0:
                    if open_:
                        sums.append(current.hexdigest())
                    ids.append(conv_id)
                    current, open_ = hashlib.sha256(), True
                else:
                    current.update((("\n" if place > 1 else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
            if len(sums) > 1:
                yield pa.record_batch({"conv_id": pa.array(ids[: len(sums)], kind), "repaired_sha256": pa.array(sums)})
                ids, sums = ids[len(sums) :], []
        if open_:
            sums.append(current.hexdigest())
            yield pa.record_batch({"conv_id": pa.array(ids, kind), "repaired_sha256": pa.array(sums)})

    schema = T.StructType([T.StructField("conv_id", turns.schema["conv_id"].dataType), *fields(repaired_sha256="string")])
    return turns.mapInArrow(read, schema)


def repaired(rows: DataFrame, ids: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Audits of all conversations (and of ``ids`` that have no rows), and the turns after the cheapest edits."""
    marked = faults(rows, ids)
    found = stored(audits(marked))
    return found, applied(marked, found)


def report(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Audits with the digest of each repaired conversation."""
    found, turns = repaired(rows, ids)
    sums = digests(turns).withColumnRenamed("conv_id", "of")
    return found.join(sums, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
