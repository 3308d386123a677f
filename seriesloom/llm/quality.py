"""Quality rules: a calibrated logistic regression over hashed word and character n-grams.

Word 1- and 2-grams and byte 3-grams are hashed into one vector of relative frequencies per kind of gram. The
model learns from a bounded sample of the labelled rows: at most ``TRAINED_ON``, those whose id hashes lowest;
three quarters of it fit the weights, one quarter the calibration (Platt's: a logistic curve over the scores).
All documents are scored in Arrow batches, with the weights, whose number is fixed, sent to the tasks. A
document is kept if no base rule rejects it and its calibrated probability of good quality reaches ``KEEP``.

Defined cases: a null, empty or white-space text has no words and fails the base rules; labels that are null
or neither 0 nor 1 are not learnt from, and a document labelled twice counts twice; without labels of both
kinds, only the base rules decide (probability null); repeated rows are judged alike; an empty table gives no
rows; columns other than ``doc_id`` and ``text`` (``quality`` of the labels) are left out.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import fields, need_columns, stored, worker_memory
from .words import SLICE, encoded, hashed_words, mix, windows

#: Base rules (fixed values).
LEAST_WORDS, REPEATED_PERCENT = 50, 50
SYMBOLS = b"#*$%&|<>"
BLANK = " \t\n\x0b\x0c\r"

BITS = 18
TRAINED_ON = 6_000
#: Scale of the features, strength of the penalty and rounds of the fit.
SCALE, PENALTY, ROUNDS = 30.0, 1e-3, 60
KEEP = 0.5

_KINDS = 3
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_SOLID = np.array([not (b == 32 or 9 <= b <= 13) and b & 0xC0 != 0x80 for b in range(256)])


def _cells(hashes: np.ndarray, kind: int) -> np.ndarray:
    return (mix(hashes + np.uint64(kind * 0x9E3779B9)) >> np.uint64(64 - BITS)).astype(np.int64)


def _byte_cells() -> np.ndarray:
    """The cell of every byte 3-gram."""
    return np.concatenate([_cells(np.arange(i << 16, (i + 1) << 16, dtype=np.uint64), 3).astype(np.int32) for i in range(256)])


def _three(data: bytes) -> np.ndarray:
    """Cells of the byte 3-grams."""
    b = np.frombuffer(data, np.uint8).astype(np.int32)
    return worker_memory("byte_cells", _byte_cells)[b[:-2] | b[1:-1] << 8 | b[2:] << 16] if len(b) > 2 else np.zeros(0, np.int32)


def _sums(values: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of ``values[begin:end]``; segments ascend and don't overlap."""
    bounds = np.stack([begins, np.maximum(begins, ends)], axis=1).ravel()
    out = np.add.reduceat(np.append(values, 0), bounds)[::2] if len(bounds) else np.zeros(0)
    return np.where(ends > begins, out, 0)


@dataclass
class Run:
    """Texts in a row with the hashes of their words."""

    first: int
    data: list[bytes]
    words: np.ndarray
    ends: np.ndarray

    def __post_init__(self):
        self.begins = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        self.sizes = np.array([len(d) for d in self.data], np.int64)

    def pieces(self) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
        """(bytes, where each text begins, where it ends); a long text comes in overlapping pieces."""
        if len(self.data) == 1 and self.sizes[0] > 2 * SLICE:
            for at in range(0, int(self.sizes[0]), SLICE):
                yield self.data[0][at : at + SLICE + 2], np.array([0]), np.array([min(SLICE, int(self.sizes[0]) - at)])
        else:
            starts = np.cumsum(self.sizes + 1) - self.sizes - 1
            yield b" ".join(self.data) + b" ", starts, starts + self.sizes

    def word_cells(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Cells of the word n-grams of the run, and where each text's end."""
        return _cells(windows(self.words, n), n), np.maximum(self.ends - n + 1, self.begins)

    def score(self, weights: np.ndarray) -> np.ndarray:
        """For each text, the mean weight of its grams of each kind, added up."""
        total = np.zeros(len(self.data))
        for n in (1, 2):
            cells, stops = self.word_cells(n)
            total += _sums(weights[cells], self.begins, stops) / np.maximum(stops - self.begins, 1)
        chars = np.zeros(len(self.data))
        for data, starts, stops in self.pieces():
            # The last two bytes of a text begin no 3-gram; a piece's overlap does.
            chars += _sums(weights[_three(data)], starts, np.minimum(stops, len(data) - 2 if len(data) > SLICE else stops - 2))
        return total + chars / np.maximum(self.sizes - 2, 1)

    def vectors(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Cells and relative frequencies of each text's grams, as :meth:`score` weighs them."""
        word = [self.word_cells(n) for n in (1, 2)]
        for i, d in enumerate(self.data):
            kinds = [cells[self.begins[i] : stops[i]] for cells, stops in word] + [_three(d)]
            kinds = [k for k in kinds if len(k)]
            cells, at = np.unique(np.concatenate(kinds) if kinds else np.zeros(0, np.int64), return_inverse=True)
            yield cells, np.bincount(at, np.concatenate([np.full(len(k), 1 / len(k)) for k in kinds]) if kinds else None, len(cells)).astype(float)

    def counts(self, texts: list[str]) -> dict[str, np.ndarray]:
        """What the base rules look at."""
        n = len(self.data)
        chars, symbols = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for data, starts, stops in self.pieces():
            b = np.frombuffer(data, np.uint8)
            chars += _sums(_SOLID[b].astype(np.int64), starts, stops)
            symbols += _sums(_SYMBOL[b].astype(np.int64), starts, stops)
        owner = np.repeat(np.arange(n), self.ends - self.begins)
        three = windows(self.words, 3)
        inside = np.flatnonzero(owner[: len(three)] == owner[2 : len(three) + 2])
        # A window counts with the text it stands in.
        _, at, often = np.unique(mix(three[inside] + owner[inside].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_inverse=True, return_counts=True)
        found = inside[often[at] > 1]
        repeated = np.zeros(len(self.words) + 2, np.int64)
        for k in range(3):
            repeated[found + k] = 1
        lines = [Counter(x for x in t.split("\n") if x.strip(BLANK)) for t in texts]
        return {
            "n_words": self.ends - self.begins,
            "word_chars": chars,
            "n_symbols": symbols,
            "n_dup_lines": np.array([sum(c.values()) - len(c) for c in lines], np.int64),
            "n_repeat_words": _sums(repeated[: len(self.words)], self.begins, self.ends),
        }


def runs(texts: list[str | None]) -> Iterator[Run]:
    data = [encoded(t, lower=False) for t in texts]
    for first, words, ends in hashed_words(data):
        yield Run(first, data[first : first + len(ends)], words, ends.astype(np.int64))


@dataclass(frozen=True)
class Model:
    """Weights per cell, their offset, and the calibration's slope and offset."""

    weights: np.ndarray
    offset: float
    slope: float
    shift: float

    def probability(self, run: Run) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (run.score(self.weights) + self.offset) + self.shift, -500, 500)))


def platt(scores: np.ndarray, good: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of the logistic curve from scores to labels, with Platt's softened targets."""
    ones, zeros = good.sum(), (1 - good).sum()
    target = np.where(good == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x = np.stack([scores, np.ones(len(scores))], axis=1)
    at = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -500, 500)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + 1e-6 * np.eye(2), x.T @ (target - p) - 1e-6 * at)
        at = at + step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-9:
            break
    return float(at[0]), float(at[1])


def packed(cells: np.ndarray, values: np.ndarray) -> bytes:
    """A row's (ascending) cells and their values, compressed."""
    import zstandard

    return zstandard.compress(np.diff(cells, prepend=0).astype("<i4").tobytes() + values.astype("<f4").tobytes(), 1)


@dataclass(frozen=True)
class Rows:
    """Some rows in a row: where each begins, and the cells and values of all."""

    starts: np.ndarray
    cells: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, packed: list[bytes]) -> Rows:
        """From rows of :func:`packed`."""
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        raw = [unpack(p) for p in packed]
        cells = [np.cumsum(np.frombuffer(r, "<i4", len(r) // 8), dtype=np.int32) for r in raw]
        values = [np.frombuffer(r, "<f4", len(r) // 8, len(r) // 2) for r in raw]
        starts = np.append(0, np.cumsum([len(c) for c in cells]))
        return cls(starts, np.concatenate(cells), np.concatenate(values).astype(np.float32, copy=False))

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.starts)

    def dot(self, w: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.starts) - 1)
        some = self.sizes > 0
        if some.any():
            out[some] = np.add.reduceat(w[self.cells] * self.values, self.starts[:-1][some])
        return out

    def spread(self, error: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.cells, self.values * np.repeat(error, self.sizes), size)


def fit_weights(blocks: list[Rows], good: np.ndarray, counts: np.ndarray, size: int, rounds: int = ROUNDS, memory: int = 10) -> np.ndarray:
    """Logistic regression with a squared penalty by L-BFGS: a weight for each cell, then the offset, which is not penalised.

    Only rows with ``counts`` 1 count. Data stays in its blocks, and sums over it are made block by block.
    """
    n = max(1.0, counts.sum())
    cuts = np.cumsum([len(b.starts) - 1 for b in blocks])[:-1]
    sign = np.where(good == 1, 1.0, -1.0)

    def margins(w: np.ndarray) -> np.ndarray:
        return np.concatenate([b.dot(w) for b in blocks]) + w[-1]

    def loss(m: np.ndarray, w: np.ndarray) -> float:
        return float(np.logaddexp(0, -sign * m) @ counts / n + PENALTY / 2 * (w[:-1] @ w[:-1]))

    def slope(m: np.ndarray, w: np.ndarray) -> np.ndarray:
        error = -sign * counts / (1 + np.exp(np.clip(sign * m, -500, 500))) / n
        out = PENALTY * w
        for b, e in zip(blocks, np.split(error, cuts), strict=True):
            out[:-1] += b.spread(e, size)
        out[-1] = error.sum()
        return out

    w = np.zeros(size + 1)
    m = margins(w)
    at, g = loss(m, w), slope(m, w)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        way, used = -g, []
        for s, y in reversed(steps):
            used.append(s @ way / (s @ y))
            way = way - used[-1] * y
        if steps:
            way = way * ((steps[-1][0] @ steps[-1][1]) / (steps[-1][1] @ steps[-1][1]))
        for (s, y), a in zip(steps, reversed(used), strict=True):
            way = way + (a - y @ way / (s @ y)) * s
        # Margins are linear along the way, so that trying a step costs no pass over the data.
        ahead, length = margins(way), 1.0
        while loss(m + length * ahead, w + length * way) > at + 1e-4 * length * (g @ way) and length > 1e-8:
            length /= 2
        s = length * way
        w, m = w + s, m + length * ahead
        before, y = at, slope(m, w) - g
        at, g = loss(m, w), g + y
        if s @ y > 1e-12 * (y @ y):
            steps = [*steps, (s, y)][-memory:]
        if before - at < 1e-9 * max(1.0, abs(before)):
            break
    return w


def fitted(blocks: list[Rows], quality: np.ndarray, fit: np.ndarray) -> Model | None:
    """A model of sampled rows: weights from those that ``fit``, calibration from the others."""
    if len({*zip(quality.tolist(), fit.tolist(), strict=True)}) < 4:
        return None
    found = fit_weights(blocks, quality, fit.astype(float), 1 << BITS)
    margins = np.concatenate([b.dot(found) for b in blocks]) + found[-1]
    slope, shift = platt(margins[~fit], quality[~fit])
    return Model(found[:-1] * SCALE, float(found[-1]), slope, shift)


def train(docs: DataFrame, labels: DataFrame, most: int = TRAINED_ON) -> Model | None:
    """A model of the labelled sample; None if it lacks one of the two labels.

    The sample is bounded, and one task fits it.
    """
    labels = need_columns(labels, ["doc_id", "quality"]).where("quality IN (0, 1) AND doc_id IS NOT NULL")
    # At most ``most`` rows, whatever the size of the tables.
    chosen = labels.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(most)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in runs(batch.column(0).to_pylist()):
                part = batch.slice(run.first, len(run.data))
                rows = [packed(cells, SCALE * values) for cells, values in run.vectors()]
                yield pa.record_batch({"quality": part.column(1), "fit": part.column(2), "key": part.column(3), "row": pa.array(rows, pa.binary())})

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quality, fit, blocks = [], [], []
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                quality += part.column(0).to_pylist()
                fit += part.column(1).to_pylist()
                blocks.append(Rows.of(part.column(2).to_pylist()))
        model = fitted(blocks, np.array(quality), np.array(fit, bool)) if quality else None
        if model:
            yield pa.record_batch({"weights": pa.array([model.weights.tobytes()], pa.binary()), **{k: pa.array([getattr(model, k)]) for k in ("offset", "slope", "shift")}})

    marked = (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(4)) > 0).alias("fit")
    rows = docs.join(F.broadcast(chosen), "doc_id").select("text", F.col("quality").cast("double").alias("quality"), marked, F.xxhash64("doc_id", "text").alias("key"))
    found = stored(rows.mapInArrow(vectors, fields(quality="double", fit="boolean", key="long", row="binary")))
    # An id may stand on many documents: the pairs are bounded as well.
    sample = found.orderBy("key", "quality").limit(most).repartition(1).sortWithinPartitions("key", "quality")
    model = sample.select("quality", "fit", "row").mapInArrow(learn, fields(weights="binary", offset="double", slope="double", shift="double")).first()
    return model and Model(np.frombuffer(model.weights), model.offset, model.slope, model.shift)


def judged(docs: DataFrame, labels: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The base counts, ``base_failed``, ``probability`` and ``kept`` of every row, after ``columns`` (``doc_id``)."""
    columns = columns or ["doc_id"]
    model = train(need_columns(docs, ["doc_id", "text"]), labels)
    sent = docs.sparkSession.sparkContext.broadcast(model and astuple(model))
    counted = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value and Model(*sent.value)
        for batch in batches:
            texts = [t or "" for t in batch.column(len(columns)).to_pylist()]
            for run in runs(texts):
                part = batch.slice(run.first, len(run.data))
                counts = run.counts(texts[run.first : run.first + len(run.data)])
                p = model.probability(run) if model else [None] * len(run.data)
                yield pa.record_batch({c: part.column(i) for i, c in enumerate(columns)} | {c: pa.array(counts[c].astype(np.int64)) for c in counted} | {"probability": pa.array(p, pa.float64())})

    schema = need_columns(docs, columns).schema
    for f in fields(**dict.fromkeys(counted, "long"), probability="double").fields:
        schema = schema.add(f)
    rows = docs.select(*columns, F.col("text").alias("judged text")).mapInArrow(judge, schema)
    failed: Column = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    return rows.withColumn("base_failed", failed).withColumn("kept", ~failed & F.coalesce(F.col("probability") >= KEEP, F.lit(True)))
