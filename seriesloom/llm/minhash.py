"""Near-duplicate documents: banded MinHash candidates, sequential Bayesian pruning, exact verification.

A document's set is its distinct five-word shingles, as 64-bit hashes. Texts of equal sets form a class and
are compared once. MinHash bands put classes into buckets. A bucket's members are compared with its least
one first; what then hangs together needs no further comparison, so a group of copies costs as many pairs as
it has members. Members of different components that share a small bucket (up to ``SMALL``) are then compared
pair by pair; those of larger ones in blocks of full sets, from which only links come back. No pair that
shares a bucket is left out.

A pair's signatures are compared in batches: after each, the posterior of the similarity (uniform prior)
tells how likely it still reaches the threshold, and the pair is dropped where that is below ``MISSED``.
Survivors are verified on the full sets. The chance that a pair at the threshold shares no band is
``(1 - 0.75 ** ROWS) ** BANDS``, about 5e-6.

Defined cases: null, empty and white-space texts have empty sets and stand alone; a text of one to four
words has one shingle; repeated rows belong to one component of which one row is kept (least doc_id, null
last, then the first row); a component of rows without ids has a null id; an empty table gives no rows;
columns other than ``doc_id`` and ``text`` are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import fields, need_columns, stored
from .words import encoded, hashed_words, mix, windows

WORDS = 5
THRESHOLD = 75  # percent
ROWS, BANDS = 5, 45
#: Signature bytes compared, in so many batches, and the chance at which a pair is given up.
COMPARED, BATCHES, MISSED = 96, 4, 1e-7
#: Most members of a bucket that are compared pair by pair; members of a block of sets; shingles of a slab.
SMALL, BLOCK, SLAB = 64, 128, 8192
SEED = 7


def shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of all runs of five words; of the whole sequence if it is shorter."""
    return windows(words, min(WORDS, len(words)) or 1)


def text_shingles(texts: list[str | None]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first, shingles of each text from first on), in runs of about a megabyte."""
    for first, words, ends in hashed_words([encoded(t) for t in texts]):
        begins = [0, *ends[:-1]]
        yield first, [shingles(words[a:z]) for a, z in zip(begins, ends, strict=True)]


class Signer:
    """MinHash signatures of runs of texts."""

    def __init__(self, seed: int = SEED):
        draw = np.random.default_rng(seed)
        self.factors = draw.integers(0, 1 << 63, ROWS * BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.shifts = draw.integers(0, 1 << 63, ROWS * BANDS, dtype=np.uint64)

    def sign(self, sets: list[np.ndarray]) -> np.ndarray:
        """One row of minima per set; sets must not be empty."""
        flat = np.concatenate(sets)
        starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
        out = np.empty((len(sets), len(self.factors)), np.uint32)
        for i, (a, b) in enumerate(zip(self.factors, self.shifts, strict=True)):
            out[:, i] = np.minimum.reduceat((flat * a + b) >> np.uint64(32), starts)
        return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key per band."""
    cut = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    keys = np.zeros(cut.shape[:2], np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for r in range(ROWS):
        keys = mix(keys + cut[:, :, r])
    return keys


def least_matches(compared: int = COMPARED, batches: int = BATCHES, missed: float = MISSED) -> list[tuple[int, int]]:
    """(bytes compared, fewest matches to go on): below, the posterior chance of the threshold is under ``missed``."""
    grid = (np.arange(20_000) + 0.5) / 20_000
    match = grid + (1 - grid) / 256
    out = []
    for n in range(compared // batches, compared + 1, compared // batches):
        for m in range(n + 1):
            like = m * np.log(match) + (n - m) * np.log1p(-match)
            weight = np.exp(like - like.max())
            if weight[grid >= THRESHOLD / 100].sum() >= missed * weight.sum():
                out.append((n, m))
                break
    return out


def plausible(left: Column, right: Column) -> Column:
    """Whether two signatures leave the threshold possible."""
    steps = least_matches()

    @F.pandas_udf("boolean")
    def survive(a: pd.Series, b: pd.Series) -> pd.Series:
        if not len(a):
            return pd.Series([], dtype=bool)
        x, y = (np.frombuffer(b"".join(s), np.uint8).reshape(len(s), COMPARED) for s in (a, b))
        alive, matches, before = np.arange(len(a)), np.zeros(len(a), np.int64), 0
        for n, least in steps:
            matches[alive] += (x[alive, before:n] == y[alive, before:n]).sum(axis=1)
            alive = alive[matches[alive] >= least]
            before = n
        out = np.zeros(len(a), bool)
        out[alive] = True
        return pd.Series(out)

    return survive(left, right)


def signed(docs: DataFrame) -> DataFrame:
    """One row per document: row number, text hash, set size, two hashes of the set, band keys and signature bytes."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer, uid = Signer(), TaskContext.get().partitionId() << 36
        for batch in batches:
            for first, sets in text_shingles(batch.column(2).to_pylist()):
                n, k1, k2 = (np.zeros(len(sets), np.int64) for _ in range(3))
                for i, s in enumerate(sets):
                    distinct = mix(np.unique(s))
                    n[i] = len(distinct)
                    k1[i], k2[i] = distinct.sum().view(np.int64), mix(distinct ^ np.uint64(SEED)).sum().view(np.int64)
                full = np.flatnonzero(n)
                bands, lows = [None] * len(sets), [None] * len(sets)
                if len(full):
                    signatures = signer.sign([sets[i] for i in full])
                    keys, low = band_keys(signatures).view(np.int64), signatures[:, :COMPARED].astype(np.uint8)
                    for at, i in enumerate(full):
                        bands[i], lows[i] = keys[at], low[at].tobytes()
                ids = np.arange(uid, uid + len(sets))
                uid += len(sets)
                k1[n == 0] = ids[n == 0]
                part = batch.slice(first, len(sets))
                yield pa.record_batch({"uid": pa.array(ids), "doc_id": part.column(0), "hash": part.column(1), "n": pa.array(n), "k1": pa.array(k1), "k2": pa.array(k2), "bands": pa.array(bands, pa.list_(pa.int64())), "low": pa.array(lows, pa.binary())})

    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", F.xxhash64("text").alias("hash"), "text")
    return rows.mapInArrow(sign, fields(uid="long", doc_id=kind, hash="long", n="long", k1="long", k2="long", bands="array<long>", low="binary"))


def set_rows(texts: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``shingles``, the distinct shingle hashes of ``text``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets in text_shingles(batch.column(len(keep)).to_pylist()):
                part = batch.slice(first, len(sets))
                columns = {k: part.column(i) for i, k in enumerate(keep)}
                yield pa.record_batch(columns | {"shingles": pa.array([np.unique(s).view(np.int64) for s in sets], pa.list_(pa.int64()))})

    return texts.select(*keep, "text").mapInArrow(cut, fields(**dict.fromkeys(keep, "long"), shingles="array<long>"))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets (``uid``, ``shingles``) reach the threshold."""
    left, right = (sets.select(F.col("uid").alias(x), F.col("shingles").alias(y)) for x, y in (("a", "left"), ("b", "right")))
    both = F.size(F.array_intersect("left", "right"))
    return pairs.join(right, "b").join(left, "a").where(100 * both >= THRESHOLD * (F.size("left") + F.size("right") - both)).select("a", "b")


def _alike_in_size(left: str, right: str) -> Column:
    return 100 * F.least(left, right) >= THRESHOLD * F.greatest(left, right)


def _open_rows(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows (key, uid, n) of buckets that hold several components, with each row's ``label`` and the bucket's ``size``."""
    labels = roots.select(F.col("node").alias("uid"), "root")
    labelled = rows.join(labels, "uid", "left").withColumn("label", F.coalesce("root", "uid")).drop("root")
    keys = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("size"), F.min("uid").alias("first"))
    return stored(labelled.join(keys.where("low <> high").select("key", "size", "first"), "key"))


def _compared_in_blocks(large: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between members of large buckets, found by comparing full sets block by block.

    Members that buckets hang together form a cluster. It is dealt into blocks by hash, and a task gets one
    pair of blocks: it counts what all their sets share by products of slabs of the incidence matrix, and
    returns one link per member and foreign component. No pairs leave the task but links.
    """
    clusters = components(large.where("uid <> first").select(F.col("uid").alias("a"), F.col("first").alias("b")))
    members = large.select("uid", "label").distinct()
    placed = members.join(clusters.select(F.col("node").alias("uid"), "root"), "uid", "left").withColumn("cluster", F.coalesce("root", "uid"))
    sizes = placed.groupBy("cluster").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"), F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    dealt = placed.join(sizes.select("cluster", "blocks"), "cluster").withColumn("block", F.pmod(F.xxhash64("uid"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    copies = dealt.join(sets, "uid").withColumn("other", other).select(
        "cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "uid", "label", "shingles"
    )

    def compare(rows: pa.Table) -> pa.Table:
        uid, label, block = (rows.column(k).to_numpy() for k in ("uid", "label", "block"))
        lists = rows.column("shingles").combine_chunks()
        sizes, flat = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy()
        owner = np.repeat(np.arange(len(uid)), sizes)
        _, column, df = np.unique(flat, return_inverse=True, return_counts=True)
        shared = np.flatnonzero(df > 1)
        rank = np.full(len(df), -1)
        rank[shared] = np.arange(len(shared))
        at = rank[column]
        order = np.argsort(at, kind="stable")
        at, owner = at[order], owner[order]
        both = np.zeros((len(uid), len(uid)), np.float32)
        for low in range(0, len(shared), SLAB):
            some = slice(*np.searchsorted(at, (low, low + SLAB)))
            slab = np.zeros((len(uid), min(SLAB, len(shared) - low)), np.float32)
            slab[owner[some], at[some] - low] = 1
            both += slab @ slab.T
        linked = (100 * both >= THRESHOLD * (sizes[:, None] + sizes[None] - both)) & (label[:, None] != label[None])
        if len(np.unique(block)) > 1:
            linked &= block[:, None] != block[None]
        a, b = np.nonzero(linked)
        _, first = np.unique(np.stack([a, label[b]], axis=1), axis=0, return_index=True) if len(a) else (None, np.zeros(0, np.int64))
        return pa.table({"a": pa.array(uid[a[first]]), "b": pa.array(uid[b[first]])})

    return copies.groupBy("cluster", "i", "j").applyInArrow(compare, fields(a="long", b="long"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (least doc_id reachable by links) and ``kept`` for every row.

    ``uid`` numbers the rows, and ``hash`` is the text's hash, by which rows are joined back to their texts.
    """
    docs = need_columns(docs, ["doc_id", "text"])
    sign = stored(signed(docs))
    classes = sign.groupBy("n", "k1", "k2").agg(F.min("uid").alias("rep"))
    members = stored(sign.select("uid", "doc_id", "hash", "n", "k1", "k2").join(classes, ["n", "k1", "k2"]).select("uid", "doc_id", "hash", "n", "rep"))
    reps = members.where("uid = rep and n > 0").select("uid", "doc_id", "hash", "n")

    # Buckets of at least two classes, with their least member.
    rows = sign.select("uid", "bands").join(reps.select("uid", "n"), "uid").select("uid", "n", F.explode("bands").alias("key"))
    shared = rows.groupBy("key").agg(F.min(F.struct("uid", "n")).alias("leader"), F.count("*").alias("size")).where("size > 1")
    busy = stored(rows.join(shared, "key").select("key", "uid", "n", F.col("leader.uid").alias("leader"), F.col("leader.n").alias("leader_n"), "size"))
    lows = stored(sign.select("uid", "low").join(busy.select("uid").distinct(), "uid"))

    def survivors(pairs: DataFrame) -> DataFrame:
        a, b = (lows.select(F.col("uid").alias(x), F.col("low").alias(f"low_{x}")) for x in "ab")
        return stored(pairs.join(a, "a").join(b, "b").where(plausible(F.col("low_a"), F.col("low_b"))).select("a", "b"))

    to_leader = busy.where("uid <> leader").where(_alike_in_size("n", "leader_n")).select(F.col("leader").alias("a"), F.col("uid").alias("b")).distinct()
    first = survivors(to_leader)
    wanted = reps.join(busy.select("uid").distinct(), "uid").select("uid", F.col("doc_id").alias("wanted_id"), F.col("hash").alias("wanted_hash"))
    sources = docs.withColumn("hash", F.xxhash64("text"))
    found = sources.join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted_id")) & (F.col("hash") == F.col("wanted_hash")))
    # Rows equal in id and text give the same set.
    sets = stored(set_rows(found, ["uid"]).dropDuplicates(["uid"]))
    roots = components(verified(first, sets))

    # The least member of a bucket was compared with all. What is still apart is compared pair by pair in
    # small buckets, in blocks of sets in large ones.
    left = _open_rows(busy.where("uid <> leader").select("key", "uid", "n"), roots)
    small = left.where(F.col("size") <= SMALL)
    one, other = (small.select("key", F.col("uid").alias(x), F.col("n").alias(f"n_{x}"), F.col("label").alias(f"label_{x}")) for x in "ab")
    pairs = one.join(other, "key").where((F.col("a") < F.col("b")) & (F.col("label_a") != F.col("label_b")) & _alike_in_size("n_a", "n_b"))
    new = verified(survivors(pairs.select("a", "b").distinct()), sets)
    large = left.where(F.col("size") > SMALL)
    if not large.isEmpty():
        new = new.union(_compared_in_blocks(large, sets))
    new = stored(new)
    if not new.isEmpty():
        roots = components(new.union(roots.select("node", "root")))

    labels = roots.select(F.col("node").alias("rep"), "root")
    grouped = members.join(labels, "rep", "left").withColumn("label", F.coalesce("root", "rep"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid")
    heads = grouped.groupBy("label").agg(F.min(order).alias("head"))
    return grouped.join(heads, "label").select("uid", "doc_id", "hash", F.col("n").alias("n_shingles"), F.col("head.doc_id").alias("component_id"), (F.col("uid") == F.col("head.uid")).alias("kept"))
