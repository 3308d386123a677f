"""Bigram scores of whole texts by a weighted backoff automaton, learnt from the training part of the corpus.

States are the words of the training texts (and the start of a text). A state h has an arc for each word w
seen after it, of weight ``(c(h, w) + m p(w)) / (c(h) + m)``, and a failure arc of weight ``m / (c(h) + m)`` to
the state without history, whose arcs carry the discounted unigram probabilities p; words not seen in training
share what discounting sets free. All weights of a state sum to one. A text is read once from left to right,
carrying the state and adding log10 weights. The weight m of the fallback is the one of ``WEIGHTS`` under
which the training tokens, each left out in turn, are likeliest.

The automaton grows with the corpus and is never held anywhere whole. Texts are read in blocks of bounded
size. Each block asks for its own distinct words and word pairs, as sorted hashes dealt into buckets; a bucket
adds up the training counts of all blocks and answers each in the order it was asked, so one shuffle does both
counting and lookup. With the answers a block has every state and arc its texts can reach, and scores them.

Defined cases: a null, empty or white-space text is the end token alone; a null doc_id counts as an empty id
text; repeated rows count as often as they occur; without training texts all words are unknown and every
score is 0; an empty table gives no rows; columns other than ``doc_id`` and ``text`` are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import fields, need_columns, stored
from .words import encoded, hashed_words, mix

#: Every seventh id, by checksum, is held out.
FOLDS, HELD_OUT = 7, 2
#: Tokens of a block, unless one text has more.
BLOCK = 3_000_000
WEIGHTS = (1.0, 10.0, 100.0, 1_000.0, 10_000.0, 100_000.0)
START, END = np.uint64(0x5354415254), np.uint64(0x454E44)
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id: Any) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % FOLDS == HELD_OUT


@dataclass
class Block:
    """Texts in a row: every token as its place among the block's sorted word hashes."""

    number: int
    doc_ids: list
    held: np.ndarray
    ends: np.ndarray
    words: np.ndarray
    tokens: np.ndarray

    @property
    def trained(self) -> np.ndarray:
        return np.repeat(~self.held, np.diff(self.ends, prepend=0))

    @property
    def before(self) -> np.ndarray:
        """Place of the word before each token, -1 at the start of a text."""
        out = np.empty_like(self.tokens)
        out[1:] = self.tokens[:-1]
        out[np.concatenate([[0], self.ends[:-1]])] = -1
        return out

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted hashes of the word pairs, and each token's place among them."""
        history = np.append(self.words, START)[self.before]
        return np.unique(mix(history * _PAIR + self.words[self.tokens]), return_inverse=True)

    def print(self) -> int:
        """A checksum: answers must belong to these very words."""
        return zlib.crc32(self.words.tobytes()) ^ zlib.crc32(self.tokens.astype("<i4").tobytes())


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    """Blocks of (doc_id, text) batches, numbered by task."""
    number = TaskContext.get().partitionId() << 24
    ids, parts, lengths, size = [], [], [], 0

    def whole() -> Block:
        words, tokens = np.unique(np.concatenate(parts), return_inverse=True)
        return Block(number, ids, np.array([held_out(i) for i in ids]), np.cumsum(lengths), words, tokens.astype(np.int32))

    for batch in batches:
        named = batch.column(0).to_pylist()
        for first, words, ends in hashed_words([encoded(t) for t in batch.column(1).to_pylist()]):
            if size and size + len(words) > BLOCK:
                yield whole()
                number += 1
                ids, parts, lengths, size = [], [], [], 0
            parts.append(np.insert(words, ends, END))
            lengths += list(np.diff(ends, prepend=0) + 1)
            ids += named[first : first + len(ends)]
            size += len(words) + len(ends)
    if ids:
        yield whole()


def _bits(docs: DataFrame) -> int:
    """Buckets, as a power of two: some for each task that reads the table."""
    return max(2, int(4 * docs.rdd.getNumPartitions() - 1).bit_length())


def requests(docs: DataFrame, bits: int) -> DataFrame:
    """What each block asks for: sorted hashes by kind (1 words, 2 pairs) and bucket, with its training counts."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=1)
        for block in blocks(batches):
            stamp = block.print()
            pairs, at = block.pairs()
            counted = block.trained.astype(np.float64)
            for kind, keys, places in ((1, block.words, block.tokens), (2, pairs, at)):
                counts = np.bincount(places, counted, len(keys)).astype("<u4")
                bucket = (keys >> np.uint64(64 - bits)).astype(np.int64)
                found, starts = np.unique(bucket, return_index=True)
                stops = np.append(starts[1:], len(keys))
                n = len(found)
                yield pa.record_batch(
                    {
                        "kind": pa.array(np.full(n, kind)),
                        "bucket": pa.array(found),
                        "block": pa.array(np.full(n, block.number)),
                        "stamp": pa.array(np.full(n, stamp)),
                        "keys": pa.array([keys[a:z].astype("<u8").tobytes() for a, z in zip(starts, stops, strict=True)], pa.binary()),
                        "counts": pa.array([pack.compress(counts[a:z].tobytes()) for a, z in zip(starts, stops, strict=True)], pa.binary()),
                    }
                )

    return docs.mapInArrow(ask, fields(kind="long", bucket="long", block="long", stamp="long", keys="binary", counts="binary"))


def answers(asked: DataFrame) -> DataFrame:
    """For each request the corpus counts, in its order; a bucket's first row also has the statistics of its keys."""

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        import zstandard

        pack, unpack = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        sizes = [len(k) // 8 for k in rows["keys"]]
        keys = np.frombuffer(b"".join(rows["keys"]), "<u8")
        counts = np.frombuffer(b"".join(unpack.decompress(c, 4 * n) for c, n in zip(rows["counts"], sizes, strict=True)), "<u4")
        distinct, at = np.unique(keys, return_inverse=True)
        total = np.bincount(at, counts, len(distinct)).astype("<u8")
        answer = total[at]
        stops = np.cumsum(sizes)
        out = rows[["kind", "bucket", "block", "stamp"]].copy()
        out["answer"] = [pack.compress(answer[z - n : z].tobytes()) for z, n in zip(stops, sizes, strict=True)]
        out["size"] = sizes
        first = np.zeros(len(rows), np.int64)
        first[0] = 1
        for name, value in (("tokens", total.sum()), ("types", (total > 0).sum()), ("ones", (total == 1).sum()), ("twos", (total == 2).sum())):
            out[name] = first * int(value)
        return out

    schema = fields(kind="long", bucket="long", block="long", stamp="long", answer="binary", size="long", tokens="long", types="long", ones="long", twos="long")
    return asked.groupBy("kind", "bucket").applyInPandas(add, schema)


@dataclass(frozen=True)
class Unigrams:
    """Discounted probabilities of single words; what is set free goes to unknown ones."""

    tokens: int
    types: int
    ones: int
    twos: int

    @property
    def discount(self) -> float:
        return min(0.9, max(0.1, self.ones / max(1, self.ones + 2 * self.twos)))

    def probability(self, count: np.ndarray) -> np.ndarray:
        if not self.tokens:
            return np.ones(len(count))
        return np.where(count > 0, count - self.discount, self.discount * self.types) / self.tokens

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 1) / (self.tokens + self.types + 1))


def arc_weights(word: np.ndarray, history: np.ndarray, pair: np.ndarray, unigrams: Unigrams, m: float) -> np.ndarray:
    """log10 weight of reading a word: its arc if the state has one, else the failure arc and the unigram."""
    single = unigrams.probability(word)
    arc = np.log10(np.maximum(pair, 0) + m * single)
    fail = np.log10(m) + np.log10(single)
    return np.where(pair > 0, arc, fail) - np.log10(history + m)


def scored(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of every row."""
    docs = need_columns(docs, ["doc_id", "text"])
    kind = dict(docs.dtypes)["doc_id"]
    answered = stored(answers(requests(docs, _bits(docs))))
    sums = answered.where("kind = 1").agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens", "types", "ones", "twos"))).first()
    unigrams = Unigrams(*sums)

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=1)
        for b in blocks(batches):
            blobs = {"words": b.words.astype("<u8"), "tokens": b.tokens.astype("<i4"), "ends": b.ends.astype("<i8"), "held": b.held}
            ids = pa.array([b.doc_ids], pa.list_(batch_type))
            yield pa.record_batch({"block": pa.array([b.number]), "ids": ids} | {k: pa.array([pack.compress(v.tobytes())], pa.binary()) for k, v in blobs.items()})

    batch_type = {"int": pa.int32(), "string": pa.string()}.get(kind, pa.int64())
    held = docs.mapInArrow(carry, fields(block="long", ids=f"array<{kind}>", words="binary", tokens="binary", ends="binary", held="binary"))
    weights = np.array(WEIGHTS)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        row = {k: left.column(k)[0].as_py() for k in ("block", "words", "tokens", "ends", "held")}
        words, tokens, ends, out = (np.frombuffer(unpack.decompress(row[k]), t) for k, t in (("words", "<u8"), ("tokens", "<i4"), ("ends", "<i8"), ("held", "?")))
        block = Block(row["block"], [], out, ends, words, tokens)
        got = right.to_pandas().sort_values(["kind", "bucket"])
        if not (got["stamp"] == block.print()).all():
            raise RuntimeError("the input gave other rows when it was read again")

        def counts(kind: int) -> np.ndarray:
            return np.frombuffer(b"".join(unpack.decompress(a) for a in got["answer"][got["kind"] == kind]), "<u8").astype(np.float64)

        single = counts(1)
        _, at = block.pairs()
        pair, word = counts(2)[at], single[tokens]
        # The start of a text is a state as often as a text ends.
        history = np.append(single, single[np.searchsorted(words, END)])[block.before]
        starts = np.concatenate([[0], ends[:-1]])
        base = np.add.reduceat(unigrams.base(word), starts)
        known = np.add.reduceat((word > 0).astype(np.int64), starts)
        scores = np.stack([np.add.reduceat(arc_weights(word, history, pair, unigrams, m), starts) for m in weights], axis=1)
        own = block.trained.astype(np.float64)
        left_out = [float((arc_weights(word - own, np.maximum(history - own, 0), pair - own, unigrams, m) * own).sum()) for m in weights]
        n = len(ends)
        return pa.table(
            {
                "doc_id": left.column("ids").combine_chunks().flatten(),
                "held_out": pa.array(out),
                "n_tokens": pa.array(np.diff(ends, prepend=0)),
                "n_known": pa.array(known),
                "base_score": pa.array(base),
                "scores": pa.array(list(scores), pa.list_(pa.float64())),
                "left_out": pa.array([left_out] + [[0.0] * len(weights)] * (n - 1), pa.list_(pa.float64())),
            }
        )

    schema = fields(doc_id=kind, held_out="boolean", n_tokens="long", n_known="long", base_score="double", scores="array<double>", left_out="array<double>")
    rows = stored(held.groupBy("block").cogroup(answered.select("kind", "bucket", "block", "stamp", "answer").groupBy("block")).applyInArrow(score, schema))
    likely = rows.agg(*(F.sum(F.col("left_out")[i]) for i in range(len(weights)))).first()
    best = max(range(len(weights)), key=lambda i: (likely[i] or 0.0, i))
    return rows.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(unigrams.tokens).cast("long").alias("train_tokens"), "base_score", F.col("scores")[best].alias("score"), F.lit(WEIGHTS[best]).alias("fallback_weight"))
