import base64
import gzip
import hashlib

from seriesloom.llm import idfiles, warc

PAGES = [
    (5, "http://a/ü", "<p>one</p>"),
    (3, "http://b", "<p>one</p>"),
    (9, None, "<p>one</p>"),
    (1, "http://c\r\nx: y", None),
    (2, "", ""),
    (7, "http://d", "\r\n\r\nWARC/1.1 ü" * 5000),
    (7, "http://d", "\r\n\r\nWARC/1.1 ü" * 5000),
    (None, "http://e", "<p>one</p>"),
    (None, "http://f", "alone"),
]
SCHEMA = "page_id long, url string, html string, payload string, file string"


def expected():
    first = {}
    for i, _, h in PAGES:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    for i, _, h in PAGES:
        data = (h or "").encode()
        of = first.get(h or "")
        revisit = of is not None and i != of
        yield i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", of if revisit else None


def written(spark, rows):
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(2)
    return warc.write(pages, idfiles.new_folder(spark))


def test_round_trip(spark):
    index = written(spark, PAGES)
    got = warc.read(index).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) == sorted(expected(), key=repr)
    texts = {(r.page_id, r.payload.decode()) for r in got if r.payload is not None}
    assert texts == {(i, h or "") for (i, _, h), e in zip(PAGES, expected(), strict=True) if e[3] == "response"}


def test_selected_records_and_plain_gzip(spark):
    index = written(spark, PAGES)
    got = warc.read(index.where("page_id = 3")).collect()
    assert [r.payload for r in got] == [b"<p>one</p>"]
    path = index.first().file
    with idfiles._open(path) as f:
        assert gzip.decompress(f.read()).startswith(b"WARC/1.1\r\n")


def test_least_bytes_and_empty(spark):
    pages = spark.createDataFrame([(*r, "x", "y") for r in PAGES], SCHEMA)
    kinds = {r.page_id: r.record_type for r in warc.read(warc.write(pages, idfiles.new_folder(spark), least_bytes=100)).collect()}
    assert set(kinds.values()) == {"response"}
    assert warc.read(written(spark, [])).count() == 0


def test_ranges_join_close_records():
    rows = [(0, 10), (10, 10), (50, 5), (200_000, 10)]
    assert [(a, z, len(h)) for a, z, h in warc.ranges(rows, gap=100, most=1000)] == [(0, 55, 3), (200_000, 200_010, 1)]
    assert [len(h) for _, _, h in warc.ranges([(0, 600), (600, 600)], gap=100, most=1000)] == [1, 1]
