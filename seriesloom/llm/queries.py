"""The registered queries: one per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, classifier, fingerprints, idfiles, licenses, lm, minhash, mixing, packing, quality, repair, search, warc
from .encoding import tokenizer_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


#: Words of a normalised text, in SQL.
_BARE = "list_filter(string_split(regexp_replace(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '')"

OP1_SQL = """WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
d AS (
  SELECT page_id, html, array_to_string(list_transform(range(8), lambda j: array_to_string(list_transform([15, 10, 5, 0], lambda s:
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + ((('0x' || h[5 * j + 1:5 * j + 5])::BIGINT >> s) & 31)]), '')), '') AS digest FROM p),
f AS (SELECT digest, min(page_id) AS first FROM d GROUP BY 1)
SELECT page_id, strlen(html) AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM d JOIN f USING (digest)"""


@query("op1_warc", OP1_SQL)
def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    index = warc.write(table(spark, folder, "pages"), idfiles.new_folder(spark))
    return warc.read(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP2_SQL = """WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w),
n AS (SELECT doc_id, len(s) AS n FROM s),
e AS (SELECT doc_id, unnest(s) AS g FROM s),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
edges AS MATERIALIZED (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  WITH RECURSIVE r(a, b) AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM r JOIN edges e ON e.a = r.b) SELECT a, min(b) AS b FROM r GROUP BY 1)
SELECT n.doc_id, n.n AS n_shingles, least(n.doc_id, coalesce(r.b, n.doc_id)) AS component_id,
  n.doc_id = least(n.doc_id, coalesce(r.b, n.doc_id)) AS kept
FROM n LEFT JOIN reach r ON r.a = n.doc_id"""


@query("op2_minhash", OP2_SQL)
def op2_minhash(spark: SparkSession, folder: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op3_lm")
def op3_lm(spark: SparkSession, folder: str) -> DataFrame:
    return lm.scored(table(spark, folder, "documents"))


@query("op4_mixing")
def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source", "n_chars")
    rows = mixing.mixed(docs, mixing.Target(repeated=mixing.REPEATED))
    return rows.select("doc_id", "source", "n_chars", F.col("mix pass").alias("pass"), F.col("mix block").alias("block"))


OP5_SQL = f"""WITH t AS (
  SELECT row_number() OVER () - 1 AS i, name, {_BARE.format('text')} AS w
  FROM (VALUES {', '.join(f"({_quoted(n)}, {_quoted(t)})" for n, t in licenses.TEMPLATES)}) AS v(name, text)),
tg AS (SELECT i, name, list_distinct(list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1])) AS g FROM t),
lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS p, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents
  UNION ALL SELECT doc_id, text, 0 FROM documents WHERE contains(text, chr(10))),
words AS (SELECT doc_id, place, {_BARE.format('p')} AS w FROM lines),
pg AS (
  SELECT doc_id, place, list_distinct(list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1])) AS g FROM words
  WHERE len(w) >= 2),
hits AS (
  SELECT doc_id, place, i, name, 2 * len(list_intersect(pg.g, tg.g)) / (len(pg.g) + len(tg.g)) AS dice
  FROM pg JOIN tg ON len(pg.g) * {200 - licenses.LEAST} >= {licenses.LEAST} * len(tg.g) AND len(tg.g) * {200 - licenses.LEAST} >= {licenses.LEAST} * len(pg.g)
  WHERE 200 * len(list_intersect(pg.g, tg.g)) >= {licenses.LEAST} * (len(pg.g) + len(tg.g))),
best AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY dice DESC, place = 0, place, i) AS r FROM hits),
here AS (SELECT *, row_number() OVER (PARTITION BY doc_id, place ORDER BY dice DESC, i) AS r FROM hits),
counted AS (
  SELECT doc_id, count(*) AS n, string_agg(name || ':' || place, ' ' ORDER BY place = 0, place, name) AS notices
  FROM here WHERE r = 1 GROUP BY 1)
SELECT d.doc_id, coalesce(c.n, 0) AS n_notices, b.name AS license, b.dice, b.place AS passage, coalesce(c.notices, '') AS notices
FROM documents d LEFT JOIN counted c ON c.doc_id = d.doc_id LEFT JOIN best b ON b.doc_id = d.doc_id AND b.r = 1"""


@query("op5_licenses", OP5_SQL)
def op5_licenses(spark: SparkSession, folder: str) -> DataFrame:
    listed = F.array_join(F.transform("notices", lambda n: F.concat_ws(":", n["license"], n["passage"])), " ")
    return licenses.scan(table(spark, folder, "documents")).withColumn("notices", listed)


@query("op6_fingerprints")
def op6_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.matched(table(spark, folder, "documents"))


@query("op7_packing")
def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"))


@query("op8_chat")
def op8_chat(spark: SparkSession, folder: str) -> DataFrame:
    return chat.turns(table(spark, folder, "conversations"))


@query("op9_quality")
def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judged(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op10_idfiles")
def op10_idfiles(spark: SparkSession, folder: str) -> DataFrame:
    manifest = idfiles.write(table(spark, folder, "documents"), idfiles.new_folder(spark), tokenizer_path("word_bpe_49k.json"))
    return idfiles.read(spark, manifest)


@query("op11_repair")
def op11_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations")
    return repair.report(repair.damaged(rows), rows)


_SEARCHED = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

OP12_SQL = f"""WITH d AS (SELECT doc_id, {_SEARCHED} AS t FROM documents),
s AS (SELECT count(*) AS docs, CAST(sum(len(t)) AS BIGINT) AS terms FROM d WHERE len(t) > 0),
p AS (SELECT doc_id, len(t) AS n, unnest(t) AS term FROM d),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM p GROUP BY ALL),
q AS (SELECT item_id, unnest({_SEARCHED}) AS term FROM benchmark),
a AS (SELECT item_id, term, count(*) AS often FROM q GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf WHERE term IN (SELECT term FROM a) GROUP BY 1),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM df, s),
scores AS (
  SELECT item_id, doc_id, CAST(sum(often * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms)))) AS BIGINT) AS score
  FROM tf JOIN w USING (term) JOIN a USING (term), s GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= {search.BEST}"""


@query("op12_search", OP12_SQL)
def op12_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op13_classifier")
def op13_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return classifier.scored(table(spark, folder, "documents"), table(spark, folder, "labels"))
