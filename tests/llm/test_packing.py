import zlib
from collections import Counter

import numpy as np
import pytest
from samples import ROWS

from seriesloom.llm import idfiles, packing
from seriesloom.llm.encoding import WordEncoder, tokenizer_path


def ids_of(name, text):
    e = encoders.setdefault(name, WordEncoder(tokenizer_path(name)))
    return np.array([*e.tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


encoders = {}


def test_pieces_make_up_the_documents(docs):
    rows = packing.pack(docs(ROWS), tokenizer_path("byte_bpe_50k.json"), length=64, with_ids=True).collect()
    want = Counter((i, ids_of("byte_bpe_50k.json", t).tobytes()) for i, t in ROWS)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
    for i, own in by_sequence.items():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == 64 or i == max(by_sequence)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    # Pieces of one document follow each other along the sequences.
    texts, current = Counter(), b""
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        current = r.ids if r.start == 0 else current + r.ids
        if len(current) == 4 * r.doc_tokens:
            texts[r.doc_id, current] += 1
    assert texts == want


def test_hilbert_curve_visits_every_cell_and_neighbours():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3), -1).reshape(-1, 3)
    keys = packing.hilbert_keys(cells, 3)
    assert sorted(keys) == list(range(512))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_like_documents_lie_together():
    project = packing.Projection()
    near, far = np.arange(100, 400), np.arange(9000, 9300)
    a, b, c = project.keys([near, np.append(near, 5), far])
    assert abs(a - b) < abs(a - c)


def test_packing_nothing(docs):
    assert packing.pack(docs([]), tokenizer_path("byte_bpe_50k.json")).count() == 0


def test_id_files(spark, docs):
    manifest = idfiles.write(docs(ROWS), idfiles.new_folder(spark), tokenizer_path("word_bpe_49k.json"))
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in idfiles.read(spark, manifest).collect())
    start = 0
    want = Counter()
    for i, t in ROWS:
        want[i, zlib.crc32(ids_of("word_bpe_49k.json", t).tobytes())] += 1
    assert Counter((i, crc) for _, i, _, crc in got) == want
    for s, _, n, _ in got:
        assert s == start
        start += n
    named = [i for _, i, _, _ in got]
    assert named == sorted(named, key=lambda i: (i is not None, i or 0))
    paths = [r.path for r in manifest.collect()]
    found = [x for p in paths if (x := idfiles.read_document(p, 12)) is not None]
    assert len(found) == 1 and (found[0] == ids_of("word_bpe_49k.json", dict(ROWS)[12])).all()


def test_id_files_of_nothing(spark, docs):
    manifest = idfiles.write(docs([]), idfiles.new_folder(spark), tokenizer_path("word_bpe_49k.json"))
    assert idfiles.read(spark, manifest).count() == 0


def test_id_files_with_a_dictionary(spark, docs):
    from samples import words

    rows = [(i, words(150, i, 300)) for i in range(400)]
    folder = idfiles.new_folder(spark)
    manifest = idfiles.write(docs(rows), folder, tokenizer_path("word_bpe_49k.json"))
    with idfiles._open(manifest.first().path) as f:
        head, _ = idfiles.read_footer(f)
    assert head["dictionary"] and idfiles.read_dictionary(folder, head["dictionary"])
    assert idfiles.read(spark, manifest).count() == 400


def test_string_ids_are_refused(spark):
    rows = spark.createDataFrame([("a", "x")], "doc_id string, text string")
    with pytest.raises(ValueError, match="integer"):
        idfiles.write(rows, idfiles.new_folder(spark), tokenizer_path("word_bpe_49k.json"))
