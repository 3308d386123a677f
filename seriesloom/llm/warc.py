"""WARC archives: gzip members written by the tasks, an index of every record, and coalesced range reads.

Writing gives the index first: per record its file, offset, length, URL and payload digest. Reading takes
any selection of index rows, sorts each file's byte ranges, joins ranges that lie close together into one
read, and parses the records out of it.

A page's payload is its HTML in UTF-8. Of records with equal payloads of at least ``least_bytes`` bytes, that
of the least page_id holds the payload; the others are revisits that name it and carry only the HTTP header,
whose length field keeps the payload's size. All smaller ones are responses.

Archives go to a folder all machines share, each under a new name; only files that the index names count, so
those of lost or repeated tasks are never read.

Defined cases: a null html is an empty payload, a null url an empty target; a null page_id comes last among
equal payloads and reads back as null; rows that repeat the first page's id and payload are responses too;
an empty table gives an empty index; columns other than ``page_id``, ``url`` and ``html`` are left out.
"""

from __future__ import annotations

import base64
import hashlib
import math
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .idfiles import _open
from .shared import fields, need_columns, stored

#: Payloads below so many bytes are always written whole.
LEAST_BYTES = 0
#: Ranges of a file not further apart are read at once, up to so many bytes.
GAP, READ = 64 << 10, 8 << 20
#: Bytes of records that a task reads, about.
TASK = 16 << 20
DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def page_of(name: str) -> int | None:
    text = name.removeprefix("<urn:x-page:").removesuffix(">")
    return int(text) if text else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, revisit_of: int | None) -> bytes:
    """One WARC/1.1 record as a gzip member; a revisit if ``revisit_of`` is a page."""
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit_of is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if revisit_of is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit_of is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(revisit_of)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    gzip = zlib.compressobj(4, wbits=31)
    return gzip.compress("\r\n".join(head).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n") + gzip.flush()


def parse(member: bytes) -> dict:
    """Headers and payload of a record; the payload of a revisit is None."""
    data = zlib.decompress(member, wbits=31)
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    named = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(named["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    sizes = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    whole = named["WARC-Type"] == "response"
    if whole and len(payload) != int(sizes["Content-Length"]):
        raise ValueError("a payload is cut")
    return {"headers": named, "payload": payload if whole else None, "payload_bytes": int(sizes["Content-Length"])}


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def write(pages: DataFrame, folder: str, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write every page below ``folder``; the index has ``file``, ``offset``, ``length``, ``url``, ``digest``, ``page_id`` and ``record_type``."""
    pages = need_columns(pages, ["page_id", "url", "html"]).withColumn("html", F.coalesce("html", F.lit("")))
    keyed = pages.withColumn("sha", F.sha1(F.col("html").cast("binary"))).withColumn("bytes", F.octet_length("html"))
    # The count comes along, so that single payloads, even one of null id, are told from repeated ones.
    first = keyed.groupBy("sha", "bytes").agg(F.min("page_id").alias("first"))
    joined = keyed.join(first, ["sha", "bytes"])
    repeats = (F.col("bytes") >= least_bytes) & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    kind = dict(pages.dtypes)["page_id"]

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, uri, at = None, f"{folder}/pages-{uuid.uuid4().hex}.warc.gz", 0
        for batch in batches:
            if out is None:
                out = _open(uri, write=True)
            offsets, lengths, digests = [], [], []
            for page, url, html, of in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                payload = html.encode("utf-8", "surrogatepass")
                digest = base32_sha1(payload)
                member = record(page, url, payload, digest, of)
                out.write(member)
                offsets.append(at)
                lengths.append(len(member))
                digests.append(digest)
                at += len(member)
            n = batch.num_rows
            types = pa.array(["response" if of is None else "revisit" for of in batch.column(3).to_pylist()], pa.string())
            yield pa.record_batch({"file": pa.array([uri] * n, pa.string()), "offset": pa.array(offsets, pa.int64()), "length": pa.array(lengths, pa.int64()), "url": batch.column(1), "digest": pa.array(digests, pa.string()), "page_id": batch.column(0), "record_type": types})
        if out is not None:
            out.close()

    rows = joined.select("page_id", "url", "html", F.when(repeats, F.col("first")).alias("revisit_of"))
    return stored(rows.mapInArrow(put, fields(file="string", offset="long", length="long", url="string", digest="string", page_id=kind, record_type="string")))


def ranges(rows: list[tuple[int, int]], gap: int = GAP, most: int = READ) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """Sorted (offset, length) rows as (start, stop, rows) of joint reads."""
    start, stop, held = 0, 0, []
    for offset, length in rows:
        if held and (offset > stop + gap or offset + length - start > most):
            yield start, stop, held
            held = []
        if not held:
            start = stop = offset
        held.append((offset, length))
        stop = max(stop, offset + length)
    if held:
        yield start, stop, held


def read(selected: DataFrame) -> DataFrame:
    """The records that index rows select: ``page_id``, ``url``, ``payload`` (null for revisits), ``payload_bytes``, ``payload_digest``, ``record_type`` and ``refers_to``."""
    kind = dict(selected.dtypes)["page_id"]
    names = ["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    schema = fields(page_id=kind, url="string", payload="binary", payload_bytes="long", payload_digest="string", record_type="string", refers_to=kind)
    number = pa.int32() if kind == "int" else pa.int64()
    kinds = [number, pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), number]

    def parsed(file: str, rows: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
        with _open(file) as f:
            for start, stop, held in ranges(rows):
                f.seek(start)
                data = f.read(stop - start)
                out = {name: [] for name in names}
                for offset, length in held:
                    got = parse(data[offset - start : offset - start + length])
                    head, payload = got["headers"], got["payload"]
                    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    if payload is not None and base32_sha1(payload) != digest:
                        raise ValueError(f"a payload of {file} differs from its digest")
                    refers = head.get("WARC-Refers-To")
                    for name, value in zip(names, (page_of(head["WARC-Record-ID"]), head["WARC-Target-URI"], payload, got["payload_bytes"], digest, head["WARC-Type"], refers and page_of(refers)), strict=True):
                        out[name].append(value)
                yield pa.record_batch([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], names)

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by file and offset; a file may end in one batch and go on in the next.
        file, rows = None, []
        for batch in batches:
            for name, offset, length in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if name != file or len(rows) >= 10_000:
                    if rows:
                        yield from parsed(file, rows)
                    file, rows = name, []
                rows.append((offset, length))
        if rows:
            yield from parsed(file, rows)

    # Ranges of file and offset, as many as their bytes ask for: index rows are small, records are not.
    tasks = math.ceil((selected.agg(F.sum("length")).first()[0] or 1) / TASK)
    rows = selected.select("file", "offset", "length").repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    return rows.mapInArrow(get, schema)
