"""Token ids in binary files: each document compressed alone with a dictionary all share.

A file holds documents in ascending doc_id order. Its layout, all numbers little-endian:

    magic (8 bytes) | compressed documents | footer | footer length (8) | magic (8)

The footer is JSON (dictionary hash, bytes per id, number of documents and of index bytes) followed by the
index, compressed: doc_id, its null flag, offset and number of ids per document. One document is read with
the index and one byte range. The dictionary lies beside the files under its own hash.

Files are written by the tasks into a folder all machines share, each under a new name; only names in the
returned manifest count, so the files of lost or repeated tasks are never read.

Defined cases: a null or empty text is its end id alone; a null doc_id comes first; rows of one doc_id go by
a hash of their text; an empty table gives an empty manifest; columns other than ``doc_id`` and ``text``
are left out; a ``doc_id`` that is no integer is refused. With too few or too uniform texts to train on there is no dictionary, and its hash is empty.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .encoding import word_encoder
from .shared import fields, need_columns, shared_folder, stored

MAGIC = b"SLIDS\x00\x01\n"
END_ID = 1
#: The dictionary is trained on at most so many documents, those whose id hashes lowest, of at most so many characters.
TRAINED_ON, TRAINED_CHARS = 1_500, 16_000
DICTIONARY_BYTES = 64 << 10
LEVEL = 3


def _open(uri: str, write: bool = False):
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    return system.open_output_stream(path, compression=None) if write else system.open_input_file(path)


def write_bytes(uri: str, data: bytes) -> None:
    with _open(uri, write=True) as f:
        f.write(data)


def _serialised(ids: np.ndarray, width: int) -> bytes:
    return ids.astype(f"<u{width}").tobytes()


def train_dictionary(docs: DataFrame, tokenizer: str, width: int, end: int = END_ID, documents: int = TRAINED_ON, size: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary for serialised ids, or nothing if there is too little to learn from."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        encoder = word_encoder(tokenizer)
        samples = [_serialised(i, width) for b in batches for i in encoder.encode(b.column(0).to_pylist(), end)]
        try:
            data = zstandard.train_dictionary(size, samples).as_bytes()
        except zstandard.ZstdError:
            data = b""
        yield pa.record_batch({"dictionary": pa.array([data], pa.binary())})

    short = docs.where(F.length("text").between(1, TRAINED_CHARS))
    chosen = short.select("doc_id").where("doc_id IS NOT NULL").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(documents)
    texts = short.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text")).select("text")
    rows = texts.coalesce(1).mapInArrow(train, fields(dictionary="binary")).collect()
    return bytes(rows[0][0]) if rows else b""


def write(docs: DataFrame, folder: str, tokenizer: str, end: int = END_ID, vocabulary: int = 49_408) -> DataFrame:
    """Write all documents below ``folder``; the manifest has a row per file: its path, order and number of ids."""
    docs = need_columns(docs, ["doc_id", "text"])
    if not isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        raise ValueError("doc_id must be an integer")
    width = 2 if max(vocabulary, end + 1) <= 1 << 16 else 4
    dictionary = train_dictionary(docs, tokenizer, width, end)
    digest = hashlib.sha256(dictionary).hexdigest() if dictionary else ""
    if dictionary:
        write_bytes(f"{folder}/{digest}.dictionary", dictionary)
    kind = dict(docs.dtypes)["doc_id"]

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        encoder, pack = word_encoder(tokenizer), zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)
        out, uri, first, at, index = None, f"{folder}/ids-{uuid.uuid4().hex}", None, len(MAGIC), []
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                if out is None:
                    out, first = _open(uri, write=True), (part.column(0).slice(0, 1), part.column(2).slice(0, 1))
                    out.write(MAGIC)
                for doc_id, ids in zip(part.column(0).to_pylist(), encoder.encode(part.column(1).to_pylist(), end), strict=True):
                    data = pack.compress(_serialised(ids, width))
                    out.write(data)
                    index.append((doc_id or 0, doc_id is None, at, len(ids)))
                    at += len(data)
        if out is None:
            return
        table = np.array(index, np.int64)
        stored_index = zstandard.compress(table.T.astype("<i8").tobytes())
        head = json.dumps({"dictionary": digest, "width": width, "documents": len(index), "index": len(stored_index)}).encode()
        footer = len(head).to_bytes(4, "little") + head + stored_index
        out.write(footer + len(footer).to_bytes(8, "little") + MAGIC)
        out.close()
        yield pa.record_batch({"path": pa.array([uri]), "first": first[0], "tie": first[1], "ids": pa.array([int(table[:, 3].sum())]), "documents": pa.array([len(index)])})

    # The hash of the text splits rows of one id over several ranges.
    rows = docs.withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    return stored(rows.mapInArrow(put, fields(path="string", first=kind, tie="long", ids="long", documents="long")))


def read_footer(f: Any) -> tuple[dict, np.ndarray]:
    """The head of a file's footer and its index: rows of doc_id, null flag, offset and number of ids."""
    import zstandard

    f.seek(f.size() - 16)
    tail = f.read(16)
    if tail[8:] != MAGIC:
        raise ValueError("not a file of token ids")
    size = int.from_bytes(tail[:8], "little")
    f.seek(f.size() - 16 - size)
    footer = f.read(size)
    n = int.from_bytes(footer[:4], "little")
    head = json.loads(footer[4 : 4 + n])
    head["end"] = f.size() - 16 - size
    index = np.frombuffer(zstandard.decompress(footer[4 + n :], head["index"] * 1000 + (1 << 20)), "<i8").reshape(4, head["documents"])
    return head, index


def read_dictionary(folder: str, digest: str) -> bytes:
    if not digest:
        return b""
    with _open(f"{folder}/{digest}.dictionary") as f:
        data = f.read()
    if hashlib.sha256(data).hexdigest() != digest:
        raise ValueError(f"dictionary {digest} was changed")
    return data


def read_document(path: str, doc_id: int) -> np.ndarray | None:
    """The ids of one document, by the index and one byte range."""
    import zstandard

    with _open(path) as f:
        head, index = read_footer(f)
        found = np.flatnonzero((index[0] == doc_id) & (index[1] == 0))
        if not len(found):
            return None
        i = found[0]
        stop = index[2][i + 1] if i + 1 < index.shape[1] else head["end"]
        f.seek(int(index[2][i]))
        data = f.read(int(stop - index[2][i]))
    words = read_dictionary(path.rpartition("/")[0], head["dictionary"])
    unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(words) if words else None)
    return np.frombuffer(unpack.decompress(data), f"<u{head['width']}")


def read(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """From the files of a manifest: ``doc_id``, ``start`` (ids of all documents before), ``n_tokens`` and ``ids_crc32``."""
    kind = dict(manifest.dtypes)["first"]
    # One row per file.
    before = Window.orderBy("first", "tie").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("path", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with _open(path) as f:
                    head, (doc_ids, nulls, offsets, counts) = read_footer(f)
                    words = read_dictionary(path.rpartition("/")[0], head["dictionary"])
                    unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(words) if words else None)
                    starts = base + np.cumsum(counts) - counts
                    stops = np.append(offsets[1:], head["end"])
                    for lo in range(0, len(counts), 2048):
                        some = slice(lo, lo + 2048)
                        crcs, sizes = [], []
                        for a, z in zip(offsets[some], stops[some], strict=True):
                            f.seek(int(a))
                            ids = np.frombuffer(unpack.decompress(f.read(int(z - a))), f"<u{head['width']}")
                            crcs.append(zlib.crc32(ids.astype("<u4").tobytes()))
                            sizes.append(len(ids))
                        ids_of = pa.array(doc_ids[some], pa.int64(), mask=nulls[some].astype(bool))
                        yield pa.record_batch({"doc_id": ids_of.cast(kind_of), "start": pa.array(starts[some]), "n_tokens": pa.array(sizes, pa.int64()), "ids_crc32": pa.array(crcs, pa.int64())})

    kind_of = pa.int32() if kind == "int" else pa.int64()
    # A task for each file or few: rows are small, files are not.
    paths = files.repartition(max(1, manifest.count()), "path")
    return paths.mapInArrow(get, fields(doc_id=kind, start="long", n_tokens="long", ids_crc32="long"))


def new_folder(spark: SparkSession) -> str:
    """A folder for files, below the one all machines share."""
    from pyarrow import fs

    folder = shared_folder(spark)
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path)
    return folder
