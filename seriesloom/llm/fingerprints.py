"""Document fingerprints from closed syncmers, in DataFrame functions only.

A text's words are hashed. A run of ``K`` words is a closed syncmer if the least hash among its words stands
first or last; whether it is chosen depends on its own words alone, so equal passages give equal anchors
wherever they stand.

:func:`matched` keeps all anchors with their positions. A link is two anchors in a row and the words between
them (the first anchor has one to the text's start); the likeness of two texts is the Jaccard similarity of all
their links, the n-th of equal links matching the n-th only. So passages count wherever they stand, each border of
a moved one lowers the likeness, and so does repeating one. The fingerprint has a digest in hex for every stretch
of anchors and their places in it; a stretch ends with an anchor whose hash is a multiple of ``STRETCH``.

:func:`edits` is the sketch: its fingerprint is the ``KEPT`` least distinct anchor hashes, in hex; the likeness of
two is the share of the least hashes of both that both have, which estimates the Jaccard similarity of all anchors.

Defined cases: a null or empty text, or one of white space, has an empty fingerprint; a text of fewer than
``K`` words has its whole word sequence as one anchor; two empty fingerprints have likeness 1, an empty and
another 0; a null doc_id comes first in order, and rows of one doc_id follow each other by a hash of their text;
an empty table gives no rows; columns other than ``doc_id`` and ``text`` are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import need_columns

K = 3
KEPT = 64
STRETCH = 16
SPACE = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """The words of a text; none for a text without words."""
    bare = F.btrim(text, F.lit(SPACE))
    return F.when(F.coalesce(F.length(bare), F.lit(0)) > 0, F.split(bare, "[\\x20\\x09-\\x0D]+")).otherwise(F.array().cast("array<string>"))


def anchors(hashes: Column) -> Column:
    """(hash, position) of the closed syncmers among word hashes."""
    n = F.size(hashes)

    def chosen(i: Column) -> Column:
        run = [F.get(hashes, i + j) for j in range(K)]
        least = F.least(*run)
        return (least == run[0]) | (least == run[-1])

    def anchor(i: Column) -> Column:
        return F.struct(F.xxhash64(*(F.get(hashes, i + j) for j in range(K))).alias("hash"), i.alias("position"))

    places = F.filter(F.sequence(F.lit(0), n - K), chosen)
    whole = F.array(F.struct(F.xxhash64(hashes).alias("hash"), F.lit(0).alias("position")))
    none = F.array().cast("array<struct<hash:bigint,position:int>>")
    return F.when(n >= K, F.transform(places, anchor)).when(n > 0, whole).otherwise(none)


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds ``name``: the least distinct anchor hashes of ``text``, ascending."""
    hashed, found = f"{name} hashes", f"{name} anchors"
    return (
        df.withColumn(hashed, F.transform(words(F.col(text)), lambda w: F.xxhash64(w)))
        .withColumn(found, anchors(F.col(f"`{hashed}`")))
        .withColumn(name, F.slice(F.array_sort(F.array_distinct(F.col(f"`{found}`").getField("hash"))), 1, KEPT))
        .drop(hashed, found)
    )


def as_text(fingerprint: str) -> Column:
    """A fingerprint in hex, 16 digits per anchor."""
    return F.array_join(F.transform(F.col(fingerprint), lambda h: F.lpad(F.hex(h), 16, "0")), "")


def likeness(left: str, right: str) -> Column:
    """Share of the least anchors of both that both have, 0 to 1."""
    both = F.slice(F.array_sort(F.array_union(left, right)), 1, KEPT)
    shared = F.size(F.array_intersect(both, F.array_intersect(left, right)))
    return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(shared / F.size(both))


def _ranges(docs: DataFrame) -> DataFrame:
    """Adds ``range``: doc_ids in ascending ranges, four to a shuffle partition."""
    n = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / n for i in range(1, n)]
    row = docs.agg(F.percentile_approx("doc_id", shares, 10 * n).alias("bounds")).first()
    bounds = sorted(set(row.bounds or []))
    below = F.array(*(F.lit(b) for b in bounds)) if bounds else F.array().cast(f"array<{dict(docs.dtypes)['doc_id']}>")
    # A null id is below all bounds.
    place = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(F.size(F.filter(below, lambda b: b <= F.col("doc_id"))) + 1)
    return docs.withColumn("range", place)


def with_links(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds ``name`` anchors: all (hash, position) of ``text``, and ``name``: its links, each with its number among equal ones, as hashes."""
    hashed, found, ordered, firsts = f"{name} hashes", f"{name} anchors", f"{name} ordered", f"{name} firsts"

    def link(a: Column, i: Column) -> Column:
        last = F.get(F.col(f"`{found}`"), i - 1)
        return F.xxhash64(last["hash"], a["hash"], a["position"] - F.coalesce(last["position"], F.lit(0)))

    def first(x: Column, i: Column) -> Column:
        return F.when((i == 0) | (x != F.get(F.col(f"`{ordered}`"), i - 1)), i)

    def numbered(i: Column, k: Column) -> Column:
        end = F.coalesce(F.get(F.col(f"`{firsts}`"), k + 1), F.size(f"`{ordered}`"))
        return F.transform(F.sequence(F.lit(0), end - i - 1), lambda j: F.xxhash64(F.get(F.col(f"`{ordered}`"), i), j))

    return (
        df.withColumn(hashed, F.transform(words(F.col(text)), lambda w: F.xxhash64(w)))
        .withColumn(found, anchors(F.col(f"`{hashed}`")))
        .withColumn(ordered, F.array_sort(F.transform(f"`{found}`", link)))
        .withColumn(firsts, F.filter(F.transform(f"`{ordered}`", first), lambda i: i.isNotNull()))
        .withColumn(name, F.flatten(F.transform(f"`{firsts}`", numbered)))
        .drop(hashed, ordered, firsts)
    )


def with_digests(df: DataFrame, name: str) -> DataFrame:
    """Adds ``name`` digests: 16 hex digits for each stretch of ``name`` anchors."""
    found, ends = f"`{name} anchors`", f"`{name} ends`"

    def end(a: Column, i: Column) -> Column:
        return F.when((F.pmod(a["hash"], F.lit(STRETCH)) == 0) | (i == F.size(found) - 1), i)

    def digest(e: Column, k: Column) -> Column:
        start = F.coalesce(F.get(F.col(ends), k - 1) + 1, F.lit(0))
        places = F.transform(F.slice(F.col(found), start + 1, e - start + 1), lambda a: F.xxhash64(a["hash"], a["position"] - F.get(F.col(found), start)["position"]))
        return F.lpad(F.hex(F.xxhash64(places)), 16, "0")

    stretches = df.withColumn(ends.strip("`"), F.filter(F.transform(found, end), lambda i: i.isNotNull()))
    return stretches.withColumn(f"{name} digests", F.array_join(F.transform(ends, digest), "")).drop(ends.strip("`"), found.strip("`"))


def linked(left: str, right: str) -> Column:
    """Jaccard similarity of two texts' links, 0 to 1."""
    shared = F.size(F.array_intersect(left, right))
    both = F.size(left) + F.size(right) - shared
    return F.when(both == 0, F.lit(1.0)).otherwise(shared / both)


def matched(docs: DataFrame) -> DataFrame:
    """As :func:`edits`, from all anchors and their positions."""
    rows = with_digests(with_links(_edited(docs), "text", "print"), "print")
    rows = with_digests(with_links(rows, "edited", "edited_print"), "edited_print")
    rows = with_links(rows, "next_text", "next_print")
    return rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.col("print digests").alias("fingerprint"),
        F.col("edited_print digests").alias("edited_fingerprint"),
        linked("print", "edited_print").alias("near_edited"),
        linked("print", "next_print").alias("near_next"),
    )


def _edited(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, ``next_text`` and ``edited``: the text whose last half comes from the next one.

    The next document is that of the next doc_id, and the first one after the last.
    """
    docs = need_columns(docs, ["doc_id", "text"]).withColumn("text", F.coalesce("text", F.lit(""))).withColumn("tie", F.xxhash64("text"))
    ranged = _ranges(docs)
    order = ["doc_id", "tie"]
    # The first row of each range: one row per range, hence bounded by the shuffle partitions.
    heads = ranged.groupBy("range").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), *order)).alias("head"))
    place = Window.orderBy("range")
    after = heads.select(
        F.col("range").alias("of"),
        F.coalesce(F.lead("head").over(place), F.first("head").over(place.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("next"),
    )
    marked = ranged.join(F.broadcast(after), F.col("doc_id").eqNullSafe(F.col("next.doc_id")) & (F.col("tie") == F.col("next.tie")))
    texts = marked.groupBy("of").agg(F.min("text").alias("head_text"))

    w = Window.partitionBy("range").orderBy(*order)
    rows = ranged.withColumn("next_text", F.lead("text").over(w))
    # Only the last row of a range has no next row in it.
    full = rows.join(texts, F.col("range") == F.col("of"), "left").withColumn("next_text", F.coalesce("next_text", "head_text"))
    size = F.length("text").cast("long")
    half = F.floor(size / 2).cast("int")
    edited = full.withColumn("edited", F.concat(F.substring("text", F.lit(1), (size - half).cast("int")), F.substring("next_text", F.lit(1), half)))
    return edited.select("doc_id", "text", "next_text", "edited")


def edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last half comes from the next document.

    ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and
    ``near_next``. The next document is that of the next doc_id, and the first one after the last.
    """
    rows = _edited(docs)
    for text, name in (("text", "print"), ("next_text", "next_print"), ("edited", "edited_print")):
        rows = with_fingerprint(rows, text, name)
    return rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text("print").alias("fingerprint"),
        as_text("edited_print").alias("edited_fingerprint"),
        likeness("print", "edited_print").alias("near_edited"),
        likeness("print", "next_print").alias("near_next"),
    )
