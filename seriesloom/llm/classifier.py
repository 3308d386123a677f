"""A quality classifier: random-indexing word vectors pooled per document, a two-layer network, calibrated by temperature.

Words are runs of letters and digits, and runs of signs. Every word has a fixed index vector, a few random signs
among ``DIMENSIONS``; its context vector is the sum of the index vectors of the words around it, over the whole corpus.
Words share ``BUCKETS`` rows by hash, so the table of context vectors has the same size for any corpus: each task sums
its own, the tables are added up range by range, and the result goes to the tasks. A document is the mean of its
words' vectors, their deviation, and the mean step from one word to the next.

The network (one hidden layer, tanh) learns from a bounded sample of labelled rows: at most ``TRAINED_ON`` outside the
held-out fold, those whose id hashes lowest; a quarter of it only fits the temperature, by which the network's output
is divided before it becomes a probability. Labels, languages, sources and ids are no inputs.

Defined cases: a null, empty or white-space text is a vector of zeros, and has the score the network gives that; a null
doc_id counts as an empty id text and is not learnt from; labels that are null or neither 0 nor 1 are not learnt
from, and a document labelled twice counts twice; without labels of both kinds every score is the share of 1 (one half
without any); repeated rows score alike; an empty table gives no rows; columns other than ``doc_id`` and ``text``
(``quality`` of the labels) are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import fields, need_columns, stored
from .words import encoded, hashed_words, mix

#: Every fourth id, by checksum, is held out.
FOLDS, HELD_OUT = 4, 2
#: Rows and columns of the table of context vectors; signs of an index vector; words looked at on either side.
BUCKETS, DIMENSIONS, SIGNS, REACH = 1 << 15, 64, 2, 2
#: Sightings at which a word's own vector weighs half, and what stands for 1 in a vector.
TRUSTED, ONE = 5.0, 1024
TRAINED_ON = 8_000
HIDDEN, ROUNDS, BATCH, RATE, PENALTY = 32, 40, 256, 3e-3, 1e-4
KEEP = 0.7

#: Rows of the table in one piece, and words looked at at once.
_PIECE, _CHUNK = 128, 1 << 16
_CLASS = np.array([0 if b == 32 or b < 14 else 1 if b >= 128 or chr(b).isalnum() else 2 for b in range(256)])


def _edges(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin and end: runs of letters and digits, and runs of signs."""
    kind = _CLASS[b]
    cuts = np.flatnonzero(np.diff(kind, prepend=-1))
    ends = np.append(cuts[1:], len(b)).astype(np.int64)
    return cuts[kind[cuts] > 0], ends[kind[cuts] > 0]


def runs(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first, hashes of words, where each text's end) of texts in a row."""
    return hashed_words([encoded(t, lower=False) for t in texts], _edges)


def buckets(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(40)).astype(np.int64) % BUCKETS


def index_vectors(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word's index vector is not zero, and the signs there (a place may come twice)."""
    bits = mix(words + np.uint64(0x9E3779B97F4A7C15))
    shifts = np.arange(SIGNS, dtype=np.uint64)[:, None] * np.uint64(16)
    part = (bits >> shifts) & np.uint64(0xFFFF)
    return (part % np.uint64(DIMENSIONS)).astype(np.int64), 1.0 - 2.0 * ((part >> np.uint64(15)) & np.uint64(1)).astype(float)


def contexts(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the index vectors around each word, by bucket, and in the last column how often it was seen."""
    owner = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    row, (place, sign) = buckets(words) * (DIMENSIONS + 1), index_vectors(words)
    keys, weights = [row + DIMENSIONS], [np.ones(len(row))]
    for step in range(1, REACH + 1):
        near = np.flatnonzero(owner[:-step] == owner[step:])
        for word, other in ((near, near + step), (near + step, near)):
            keys += list(row[word] + place[:, other])
            weights += list(sign[:, other])
    return np.bincount(np.concatenate(keys), np.concatenate(weights), BUCKETS * (DIMENSIONS + 1)).reshape(BUCKETS, DIMENSIONS + 1)


def context_table(docs: DataFrame) -> np.ndarray:
    """Context sums over all documents: ``BUCKETS`` rows of ``DIMENSIONS`` sums and a count."""

    def pieces(table: np.ndarray) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        parts = table.astype("<i8").reshape(-1, _PIECE, DIMENSIONS + 1)
        some = np.flatnonzero(parts[:, :, -1].any(axis=1))
        # One byte plane after the other: most of a sum's bytes are alike.
        blobs = [pack(parts[i].reshape(-1, 1).view("u1").T.tobytes()) for i in some]
        if len(some):
            yield pa.record_batch({"piece": pa.array(some), "sums": pa.array(blobs, pa.binary())})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BUCKETS, DIMENSIONS + 1))
        for batch in batches:
            for _, words, ends in runs(batch.column(0).to_pylist()):
                if len(words):
                    total += contexts(words, ends)
        yield from pieces(total)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sums = np.frombuffer(unpack(blob), "u1").reshape(8, -1).T.copy().view("<i8").ravel()
                found[piece] = found[piece] + sums if piece in found else sums
        yield pa.record_batch({"piece": pa.array(list(found), pa.int64()), "sums": pa.array([v.astype("<i8").tobytes() for v in found.values()], pa.binary())})

    schema = fields(piece="long", sums="binary")
    summed = docs.select("text").mapInArrow(count, schema).repartition("piece").mapInArrow(add, schema)
    out = np.zeros((BUCKETS // _PIECE, _PIECE, DIMENSIONS + 1))
    # As many rows as the table has pieces, whatever the corpus.
    for row in summed.collect():
        out[row.piece] = np.frombuffer(row.sums, "<i8").reshape(_PIECE, -1)
    return out.reshape(BUCKETS, -1)


def word_vectors(table: np.ndarray) -> np.ndarray:
    """Unit vectors of the buckets: contexts less the mean context, weighed down where seldom seen.

    They are rounded to integers, so that sums over words are exact and equal texts score alike in any batch.
    """
    sums, seen = table[:, :-1], table[:, -1:]
    mean = sums.sum(axis=0) / max(1.0, seen.sum())
    own = sums / np.maximum(seen, 1) - mean
    size = np.linalg.norm(own, axis=1, keepdims=True)
    return np.rint(ONE * own / np.maximum(size, 1e-9) * seen / (seen + TRUSTED)).astype(np.int32)


def pooled(vectors: np.ndarray, words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A row per text: mean and deviation of its words' vectors, and the mean step between neighbours."""
    n, row = len(ends), buckets(words)
    sizes = np.diff(ends, prepend=0)
    owner = np.repeat(np.arange(n), sizes)
    total = np.zeros((3, n, DIMENSIONS), np.int64)
    for low in range(0, len(row), _CHUNK):
        # One word more, so that every step is in one chunk.
        own = owner[low : low + _CHUNK + 1]
        v = vectors[row[low : low + _CHUNK + 1]]
        step = np.abs(v[1:] - v[:-1])
        step[own[1:] != own[:-1]] = 0
        v, own = v[:_CHUNK], own[:_CHUNK]
        first = np.flatnonzero(np.diff(own, prepend=-1))
        total[0, own[first]] += np.add.reduceat(v, first, dtype=np.int64)
        total[1, own[first]] += np.add.reduceat(v * v, first, dtype=np.int64)
        if len(step):
            first = first[first < len(step)]
            total[2, own[first]] += np.add.reduceat(step, first, dtype=np.int64)
    count = np.maximum(sizes, 1)[:, None]
    mean = total[0] / count
    deviation = np.sqrt(np.maximum(total[1] / count - mean**2, 0))
    return np.concatenate([mean, deviation, total[2] / np.maximum(sizes - 1, 1)[:, None]], axis=1) / ONE


@dataclass(frozen=True)
class Network:
    """Two layers over standardised inputs; probabilities by a temperature. Without weights: ``share`` for all."""

    center: np.ndarray
    scale: np.ndarray
    weights: tuple[np.ndarray, ...]
    temperature: float
    share: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        # Not by ``@``, whose sums may differ in the last digit from one batch size to another.
        hidden = np.tanh(np.einsum("ij,jk->ik", (x - self.center) / self.scale, w1) + b1)
        return np.einsum("ij,j->i", hidden, w2) + b2

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.full(len(x), self.share)
        return _sigmoid(self.margin(x) / self.temperature)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit(x: np.ndarray, y: np.ndarray, seed: int = 7) -> tuple[np.ndarray, ...]:
    """Weights of both layers, by Adam on the cross-entropy of standardised inputs."""
    rng = np.random.default_rng(seed)
    weights = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(())]
    first, second, t = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for round_ in range(ROUNDS):
        rate = RATE * (1 - round_ / ROUNDS)
        order = rng.permutation(len(x))
        for low in range(0, len(x), BATCH):
            some = order[low : low + BATCH]
            h = np.tanh(x[some] @ weights[0] + weights[1])
            error = (_sigmoid(h @ weights[2] + weights[3]) - y[some]) / len(some)
            back = np.outer(error, weights[2]) * (1 - h * h)
            slopes = (x[some].T @ back + PENALTY * weights[0], back.sum(axis=0), h.T @ error + PENALTY * weights[2], error.sum())
            t += 1
            for i, slope in enumerate(slopes):
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.999 * second[i] + 0.001 * slope * slope
                weights[i] = weights[i] - rate * (first[i] / (1 - 0.9**t)) / (np.sqrt(second[i] / (1 - 0.999**t)) + 1e-8)
    return tuple(weights)


def temperature(margin: np.ndarray, y: np.ndarray) -> float:
    """The divisor of margins under which the labels are likeliest, by golden section on its logarithm."""

    def loss(log: float) -> float:
        z = np.where(y == 1, 1, -1) * margin / np.exp(log)
        return float(np.logaddexp(0, -z).sum())

    low, high, ratio = -3.0, 3.0, (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def train(rows: list[tuple[np.ndarray, int, bool]]) -> Network:
    """A network from (vector, label, whether it fits the weights) rows."""
    y = np.array([label for _, label, _ in rows], float)
    none = Network(np.zeros(0), np.zeros(0), (), 1.0, float(y.mean()) if len(y) else 0.5)
    if not len(y) or y.min() == y.max():
        return none
    x = np.array([v for v, _, _ in rows])
    fits = np.array([f for *_, f in rows])
    if len({*y[fits]}) < 2:
        fits = np.ones(len(y), bool)
    center, scale = x[fits].mean(axis=0), x[fits].std(axis=0) + 1e-6
    network = Network(center, scale, fit((x[fits] - center) / scale, y[fits]), 1.0, none.share)
    rest = ~fits if len({*y[~fits]}) == 2 else fits
    return Network(center, scale, network.weights, temperature(network.margin(x[rest]), y[rest]), none.share)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % FOLDS == HELD_OUT


def scored(docs: DataFrame, labels: DataFrame, most: int = TRAINED_ON) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (of label 1) and ``predicted`` of every row."""
    docs, context = need_columns(docs, ["doc_id", "text"]), docs.sparkSession.sparkContext
    labels = need_columns(labels, ["doc_id", "quality"]).where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    key = F.xxhash64("doc_id")
    chosen = labels.orderBy(key, "doc_id", "quality").limit(most)
    vectors = context.broadcast(word_vectors(context_table(docs)))

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, words, ends in runs(batch.column(3).to_pylist()):
                part = batch.slice(first, len(ends))
                x = pooled(vectors.value, words, ends).astype(np.float32)
                yield pa.record_batch({"key": part.column(0), "fits": part.column(1), "quality": part.column(2), "vector": pa.array(list(x), pa.list_(pa.float32()))})

    # At most ``most`` label rows; an id may still stand on many documents, so the pairs are bounded as well.
    pairs = docs.join(F.broadcast(chosen), "doc_id").select(key.alias("key"), (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(4)) > 0).alias("fits"), F.col("quality").cast("int").alias("quality"), "text")
    sample = stored(pairs.mapInArrow(pool, fields(key="long", fits="boolean", quality="int", vector="array<float>")).orderBy("key", "quality", "vector").limit(most))
    table = sample.toArrow().sort_by([("key", "ascending"), ("quality", "ascending")])
    rows = zip(table["vector"].to_pylist(), table["quality"].to_pylist(), table["fits"].to_pylist(), strict=True)
    network = context.broadcast(train([(np.array(v), q, f) for v, q, f in rows]))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, words, ends in runs(batch.column(2).to_pylist()):
                part = batch.slice(first, len(ends))
                score = network.value.score(pooled(vectors.value, words, ends))
                yield pa.record_batch({"doc_id": part.column(0), "held_out": part.column(1), "score": pa.array(score), "predicted": pa.array((score >= KEEP).astype(np.int32))})

    schema = T.StructType([docs.schema["doc_id"], *fields(held_out="boolean", score="double", predicted="int")])
    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(judge, schema)
