"""Pack documents into sequences of fixed length, neighbours on a space-filling curve together.

The token counts of a document are hashed into a signed vector, which a fixed random projection takes to
three dimensions; the Hilbert key of that point orders the documents, so that like ones follow each other.
Laid end to end in that order and cut at every multiple of the length, they fill all sequences but the last.

Only ids of rows, keys and lengths are sorted. A running sum inside each range and one over the ranges give
every document its place, and the ids are joined to it by a row number, which no key can skew.

Defined cases: a null or empty text is its end id alone; repeated rows are packed as often as they occur;
ties on the curve go by doc_id (null first) and then by row number; an empty table gives no rows; columns
other than ``doc_id`` and ``text`` are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .encoding import word_encoder
from .shared import fields, need_columns, stored

LENGTH = 2048
END_ID = 1
HASHED = 256
DIMENSIONS, BITS = 3, 16
SEED = 20_011


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of integer points below ``2 ** bits``, one row each."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            turned = (x[i] & q) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(turned, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    fix = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        fix ^= np.where(x[n - 1] & q, q - 1, 0)
        q >>= 1
    x ^= fix
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | x[i] >> b & 1
    return key


class Projection:
    """From token ids to a point on the grid the curve runs through."""

    def __init__(self, hashed: int = HASHED, dimensions: int = DIMENSIONS, bits: int = BITS, seed: int = SEED):
        self.hashed, self.bits = hashed, bits
        self.axes = np.random.default_rng(seed).standard_normal((hashed, dimensions))
        self.cell, self.sign = np.zeros(0, np.int64), np.zeros(0)

    def _learn(self, size: int) -> None:
        """Cell and sign of each id below ``size``."""
        h = np.arange(size, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)
        self.cell = (h % np.uint64(self.hashed)).astype(np.int64)
        self.sign = 1.0 - 2.0 * (h >> np.uint64(20) & np.uint64(1)).astype(np.float64)

    def keys(self, ids: list[np.ndarray]) -> np.ndarray:
        flat = np.concatenate(ids)
        if flat.max() >= len(self.cell):
            self._learn(int(flat.max()) + 1)
        row = np.repeat(np.arange(len(ids)) * self.hashed, [len(i) for i in ids])
        vectors = np.bincount(row + self.cell[flat], self.sign[flat], len(ids) * self.hashed).reshape(len(ids), self.hashed)
        vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
        points = (np.tanh(vectors @ self.axes) + 1) / 2 * (1 << self.bits)
        return hilbert_keys(np.clip(points, 0, (1 << self.bits) - 1).astype(np.int64), self.bits)


def encoded_documents(docs: DataFrame, tokenizer: str, end: int) -> DataFrame:
    """One row per document: a row number, the key on the curve, the number of ids and the ids."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        encoder, project, pack = word_encoder(tokenizer), Projection(), zstandard.ZstdCompressor(level=1)
        uid = TaskContext.get().partitionId() << 36
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = list(encoder.encode(part.column(1).to_pylist(), end))
                yield pa.record_batch(
                    {
                        "uid": pa.array(np.arange(uid, uid + len(ids))),
                        "doc_id": part.column(0),
                        "key": pa.array(project.keys(ids)),
                        "n": pa.array(np.array([len(i) for i in ids], np.int64)),
                        "ids": pa.array([pack.compress(i.astype("<u4" if i.max() >> 16 else "<u2").tobytes()) for i in ids], pa.binary()),
                    }
                )
                uid += len(ids)

    kind = dict(docs.dtypes)["doc_id"]
    return docs.mapInArrow(encode, fields(uid="long", doc_id=kind, key="long", n="long", ids="binary"))


def placed(encoded: DataFrame) -> DataFrame:
    """``uid`` and ``place``: how many ids stand before each document along the curve."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.column(1).to_numpy()
            sums = total + np.cumsum(n)
            yield pa.record_batch({"uid": batch.column(0), "part": pa.array(np.full(len(n), part, np.int64)), "inside": pa.array(sums - n), "n": pa.array(n)})
            total = int(sums[-1]) if len(sums) else total

    order = ["key", "doc_id", "uid"]
    ranges = encoded.select(*order, "n").repartitionByRange(*order).sortWithinPartitions(*order).select("uid", "n")
    ranges = stored(ranges.mapInArrow(run, fields(uid="long", part="long", inside="long", n="long")))
    # One row per range of the sort: as many as its tasks.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = ranges.groupBy("part").agg(F.sum("n").alias("all")).select("part", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("base"))
    return ranges.join(bases, "part").select("uid", (F.col("base") + F.col("inside")).alias("place"))


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, end: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces of documents in sequences.

    ``doc_id``, ``start`` (ids of the document before the piece), ``length``, ``ids_crc32`` (of the ids as
    little-endian 32-bit numbers), ``doc_tokens``, ``sequence_id``, ``offset`` in the sequence, and the ids
    themselves if ``with_ids``. Every sequence is full but the last.
    """
    encoded = stored(encoded_documents(need_columns(docs, ["doc_id", "text"]), tokenizer, end))
    kind = dict(encoded.dtypes)["doc_id"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows, out = [], {k: [] for k in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")}
                for i, (n, place, data) in enumerate(zip(*(part.column(k).to_pylist() for k in (1, 2, 3)), strict=True)):
                    raw = unpack.decompress(data)
                    ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype("<u4")
                    start = 0
                    while start < n:
                        offset = (place + start) % length
                        size = min(length - offset, n - start)
                        piece = ids[start : start + size].tobytes()
                        rows.append(i)
                        for k, v in zip(out, (start, size, zlib.crc32(piece), n, (place + start) // length, offset, piece if with_ids else None), strict=True):
                            out[k].append(v)
                        start += size
                columns = {"doc_id": part.column(0).take(pa.array(rows, pa.int64()))} | {k: pa.array(v, pa.binary() if k == "ids" else pa.int64()) for k, v in out.items()}
                yield pa.record_batch(columns if with_ids else {k: v for k, v in columns.items() if k != "ids"})

    kinds = {"doc_id": kind, "start": "long", "length": "long", "ids_crc32": "long", "doc_tokens": "long", "sequence_id": "long", "offset": "long"}
    rows = encoded.select("uid", "doc_id", "n", "ids").join(placed(encoded), "uid").select("doc_id", "n", "place", "ids")
    return rows.mapInArrow(cut, fields(**kinds | ({"ids": "binary"} if with_ids else {})))
