"""Ranked lexical search: the best documents of every item, term lists taken both term- and document-at-a-time.

Documents are indexed in segments by the tasks that read them: for each term that an item asks for, the documents
that hold it and how often. A segment is searched for one item as follows. Short lists are added up term by term
into accumulators, which from then on are one more list, in document order and with a bound of its own. The least
score still needed starts at the accumulators' k-th largest or the k-th best score so far. Then documents are taken in
order over all lists: windows of documents are skipped where the lists' largest weights there add up to less than is
needed, and within a window only lists that can reach it together propose documents, in which the others are
looked up as long as the document can still get there. All arithmetic of scores is in integers, so no document
is lost by bounds; ties go to the lower doc_id.

Items are taken in blocks of bounded text, each broadcast with its terms. A task keeps ``k`` documents an item over all its
segments, and Spark ranks these few rows. Terms are compared by 64-bit hash.

Defined cases: a null text, or one without terms, counts for nothing and is never ranked; an item without known
terms has no rows; equal (item_id, text) rows are one item, and items that share an id are ranked each by itself; rows
repeated in documents are ranked each; a null doc_id comes last among equals; a text above the segment size is a
segment of its own; empty tables give no rows; columns other than ``doc_id``/``item_id`` and ``text`` are left out.
``doc_id`` must be an integer.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import fields, need_columns, stored
from .words import encoded, hashed_words

#: Documents for an item.
BEST = 20
#: Bytes of text in a segment, and of items in a block.
SEGMENT, BLOCK = 1 << 25, 1 << 23
#: Longest list that goes into the accumulators, and documents of a window.
SHORT, WINDOW = 512, 256

#: Bytes outside terms become spaces; A-Z become lower case.
_TERMS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first, hashes of terms, where each text's end), in runs of texts."""
    return hashed_words([encoded(t).translate(_TERMS) for t in texts])


@dataclass
class Segment:
    """Documents in a row and, term by term, which of them hold it and how often."""

    ids: list[int | None] = field(default_factory=list)
    lengths: list[np.ndarray] = field(default_factory=list)
    found: list[np.ndarray] = field(default_factory=list)
    at: list[np.ndarray] = field(default_factory=list)
    size: int = 0
    documents: int = 0

    def add(self, ids: list, words: np.ndarray, ends: np.ndarray, known: np.ndarray) -> None:
        place = np.minimum(np.searchsorted(known, words), len(known) - 1)
        hit = known[place] == words
        lengths = np.diff(ends, prepend=0)
        owner = np.repeat(np.arange(len(ends)), lengths)
        self.found.append(place[hit])
        self.at.append(owner[hit] + self.documents)
        self.ids += ids
        self.lengths.append(lengths)
        self.documents += len(ids)

    def row(self) -> pa.RecordBatch:
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        lengths, at = np.concatenate(self.lengths), np.concatenate(self.at)
        keys, often = np.unique(np.concatenate(self.found) * self.documents + at, return_counts=True)
        term, df = np.unique(keys // self.documents, return_counts=True)
        blobs = {"term": term, "df": df, "document": keys % self.documents, "often": often, "length": lengths}
        head = {"documents": pa.array([int((lengths > 0).sum())]), "terms": pa.array([int(lengths.sum())]), "doc_ids": pa.array([self.ids], pa.list_(pa.int64()))}
        return pa.record_batch(head | {k: pa.array([pack(v.astype("<u4").tobytes())], pa.binary()) for k, v in blobs.items()})


def _numbers(blob: bytes) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.decompress(blob), "<u4").astype(np.int64)


def segments(docs: DataFrame, known: np.ndarray) -> DataFrame:
    """The index of the documents for the (sorted) hashes of ``known`` terms: a stored row per segment."""
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = Segment()
        for batch in batches:
            ids, texts = (c.to_pylist() for c in batch.columns)
            for first, words, ends in terms(texts):
                last = first + len(ends)
                size = sum(len(t or "") for t in texts[first:last])
                if segment.size and segment.size + size > SEGMENT:
                    yield segment.row()
                    segment = Segment()
                segment.add(ids[first:last], words, ends, sent.value)
                segment.size += size
        if segment.documents:
            yield segment.row()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stored(rows.mapInArrow(index, fields(documents="long", terms="long", doc_ids="array<long>", **dict.fromkeys(("term", "df", "document", "often", "length"), "binary"))))


def document_counts(index: DataFrame, n: int) -> np.ndarray:
    """In how many documents each of the ``n`` known terms stands."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n, np.int64)
        for batch in batches:
            for term, df in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                total[_numbers(term)] += _numbers(df)
        some = np.flatnonzero(total)
        yield pa.record_batch({"term": pa.array(some), "df": pa.array(total[some])})

    rows = index.select("term", "df").mapInArrow(add, fields(term="long", df="long")).groupBy("term").agg(F.sum("df").alias("df"))
    out = np.zeros(n, np.int64)
    for row in rows.collect():
        out[row.term] = row.df
    return out


def term_weights(documents: int, df: np.ndarray) -> np.ndarray:
    """``floor(1000 * ln((2 N + 2) / (2 df + 1)))``, 0 for terms that no document holds."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(n) + 1))) if n else 0 for n in df], np.int64)


@dataclass
class Lists:
    """A segment ready to be searched: lists of (document, impact) by term, and their largest impact by window."""

    begins: dict[int, tuple[int, int]]
    document: np.ndarray
    impact: np.ndarray
    windows: int
    largest: dict[int, np.ndarray] = field(default_factory=dict)

    @classmethod
    def of(cls, row: dict, documents: int, tokens: int) -> Lists:
        term, df, document, often, length = (_numbers(row[k]) for k in ("term", "df", "document", "often", "length"))
        if 25 * int(length.max(initial=0)) * documents < 1 << 63:
            norm = 75 + 25 * length * documents // tokens
        else:
            norm = np.array([75 + 25 * int(n) * documents // tokens for n in length], np.int64)
        ends = np.cumsum(df)
        begins = dict(zip(term.tolist(), zip((ends - df).tolist(), ends.tolist(), strict=True), strict=True))
        return cls(begins, document, 10**9 * often // (1000 * often + 12 * norm[document]), -(-len(length) // WINDOW))

    def by_window(self, term: int) -> np.ndarray:
        if term not in self.largest:
            begin, end = self.begins[term]
            out = np.zeros(self.windows, np.int64)
            at = self.document[begin:end] // WINDOW
            first = np.flatnonzero(np.diff(at, prepend=-1))
            out[at[first]] = np.maximum.reduceat(self.impact[begin:end], first)
            self.largest[term] = out
        return self.largest[term]


@dataclass
class Best:
    """The best documents of an item so far."""

    k: int
    score: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    doc_id: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    null: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))

    @property
    def needed(self) -> int:
        """Least score that may still enter; an equal one may, by a lower doc_id."""
        return max(1, int(self.score[-1])) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, doc_id: np.ndarray, null: np.ndarray) -> None:
        score, doc_id, null = (np.concatenate(x) for x in ((self.score, score), (self.doc_id, doc_id), (self.null, null)))
        order = np.lexsort((doc_id, null, -score))[: self.k]
        self.score, self.doc_id, self.null = score[order], doc_id[order], null[order]


def accumulated(lists: Lists, short: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Term at a time: the documents of short lists, ascending, and the sums of their weighted impacts."""
    if not short:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    spans = [(*lists.begins[t], w) for t, w in short]
    document = np.concatenate([lists.document[a:z] for a, z, _ in spans])
    value = np.concatenate([lists.impact[a:z] * w for a, z, w in spans])
    order = np.argsort(document, kind="stable")
    document, value = document[order], value[order]
    first = np.flatnonzero(np.diff(document, prepend=-1))
    return document[first], np.add.reduceat(value, first)


def search(lists: Lists, item: list[tuple[int, int]], best: Best, doc_id: np.ndarray, null: np.ndarray) -> None:
    """Enter the segment's documents for an item of (term, weight) pairs."""
    held = [(t, w) for t, w in item if t in lists.begins]
    length = {t: lists.begins[t][1] - lists.begins[t][0] for t, _ in held}
    summed, sums = accumulated(lists, [(t, w) for t, w in held if length[t] <= SHORT])
    long = [(t, w) for t, w in held if length[t] > SHORT]
    needed = best.needed
    if len(sums) >= best.k:
        needed = max(needed, int(np.partition(sums, len(sums) - best.k)[len(sums) - best.k]))

    # Bounds by list and window; the accumulators are the first list.
    bound = np.zeros((len(long) + 1, lists.windows), np.int64)
    at = summed // WINDOW
    first = np.flatnonzero(np.diff(at, prepend=-1))
    if len(first):
        bound[0, at[first]] = np.maximum.reduceat(sums, first)
    for i, (t, w) in enumerate(long):
        bound[i + 1] = lists.by_window(t) * w
    whole = [(summed, sums, 1)] + [(lists.document[a:z], lists.impact[a:z], w) for (a, z), w in ((lists.begins[t], w) for t, w in long)]
    total = bound.sum(axis=0)
    for window in np.flatnonzero(total >= needed):
        if total[window] < needed:
            continue
        low = window * WINDOW
        own = bound[:, window]
        order = np.argsort(own, kind="stable")
        below = np.cumsum(own[order])
        helpers = int(np.searchsorted(below, needed, "left"))
        value, seen = np.zeros(WINDOW, np.int64), np.zeros(WINDOW, bool)
        for i in order[helpers:]:
            document, impact, weight = whole[i]
            a, z = np.searchsorted(document, (low, low + WINDOW))
            value[document[a:z] - low] += impact[a:z] * weight
            seen[document[a:z] - low] = True
        some = np.flatnonzero(seen)
        for j in range(helpers - 1, -1, -1):
            if not own[order[j]]:
                break
            some = some[value[some] + below[j] >= needed]
            if not len(some):
                break
            document, impact, weight = whole[order[j]]
            place = np.minimum(np.searchsorted(document, some + low), len(document) - 1)
            value[some] += np.where(document[place] == some + low, impact[place] * weight, 0)
        some = some[value[some] >= needed]
        if len(some):
            best.add(value[some], doc_id[some + low], null[some + low])
            needed = max(needed, best.needed)


def _block_ranked(docs: DataFrame, items: list, kind: T.DataType, k: int) -> DataFrame | None:
    """The best ``k`` documents that each task has for each item."""
    asked = [np.zeros(0, np.uint64)] * len(items)
    for first, words, ends in terms([i.text for i in items]):
        for i, part in enumerate(np.split(words, ends[:-1])):
            asked[first + i] = part
    known = np.unique(np.concatenate(asked)) if asked else np.zeros(0, np.uint64)
    if not len(known):
        return None
    index = segments(docs, known)
    size = index.agg(F.coalesce(F.sum("documents"), F.lit(0)).alias("n"), F.coalesce(F.sum("terms"), F.lit(0)).alias("l")).first()
    if not size.n:
        return None
    weight = term_weights(size.n, document_counts(index, len(known)))
    wanted = []
    for words in asked:
        term, often = np.unique(np.searchsorted(known, words), return_counts=True)
        wanted.append([(t, w) for t, w in zip(term.tolist(), (weight[term] * often).tolist(), strict=True) if w])
    sent = docs.sparkSession.sparkContext.broadcast((wanted, [i.item_id for i in items], size.n, size.l))

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, names, n, tokens = sent.value
        best = [Best(k) for _ in wanted]
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in ("term", "df", "document", "often", "length")}
                ids = batch.column("doc_ids")[i].values
                doc_id, null = ids.fill_null(0).to_numpy(zero_copy_only=False), np.asarray(ids.is_null())
                lists = Lists.of(row, n, tokens)
                for item, found in zip(wanted, best, strict=True):
                    search(lists, item, found, doc_id, null)
        for i, found in enumerate(best):
            if len(found.score):
                m = len(found.score)
                yield pa.record_batch({"item": pa.array(np.full(m, i)), "item_id": pa.array([names[i]] * m, name_type), "doc_id": pa.array(found.doc_id, mask=found.null), "score": pa.array(found.score)})

    name_type = pa.string() if isinstance(kind, T.StringType) else {"int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8()}.get(kind.simpleString(), pa.int64())
    schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", kind), *fields(doc_id="long", score="long")])
    return index.drop("documents", "terms").mapInArrow(rank, schema)


def ranked(docs: DataFrame, items: DataFrame, k: int = BEST, block: int = BLOCK) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id`` and ``score`` of the ``k`` best documents of every item."""
    docs, items = need_columns(docs, ["doc_id", "text"]), need_columns(items, ["item_id", "text"])
    if not isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        raise ValueError("doc_id must be an integer")
    kind = items.schema["item_id"].dataType
    items = items.where("text IS NOT NULL").distinct()
    blocks = -(-(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block)
    parts = []
    for b in range(blocks):
        some = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        part = _block_ranked(docs, some, kind, k)
        if part is not None:
            parts.append(part.withColumn("block", F.lit(b)))
    if not parts:
        schema = T.StructType([T.StructField("item_id", kind), *fields(rank="int", doc_id="long", score="long")])
        return docs.sparkSession.createDataFrame([], schema)
    order = Window.partitionBy("block", "item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    rows = reduce(DataFrame.unionByName, parts).withColumn("rank", F.row_number().over(order))
    return rows.where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
