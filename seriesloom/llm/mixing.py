"""Mix sources by temperature: weights are the sources' token shares to a common exponent, made real by documents.

The exponent (1 keeps the shares, 0 makes all sources alike) is bisected until the mix meets a target: an
entropy of the weights, or a limit on how often a source is repeated. Each step evaluates many exponents in
one job over the table of sources, which may have any number of rows.

Every source then gets its weight's part of a token budget. Its documents are dealt into blocks by a hash;
each pass over the source takes the blocks in a permutation of their own. Whole passes take every document;
the last takes blocks in order until the budget is met, and in the block where it is met documents by hash.
Without a given budget it is the least one that takes every document at least once.

Only hashes and token counts are gathered for this, never texts. The cut of each source (passes, blocks,
hash) goes to the documents by a join with the table of sources, which Spark broadcasts where it is small.

Defined cases: rows with a null source are a source of their own; a null or empty text has no tokens and
is taken in whole passes only; rows equal in doc_id and text share a hash and are taken or left together;
sources without tokens are taken once; an empty table gives no rows; all columns are kept, and where one already
has the name of an added column, underscores are put behind the added one's.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

#: Tokens of a block, and most blocks of a source.
BLOCK_TOKENS, MOST_BLOCKS = 1 << 16, 4096
#: Exponents tried in one job, and jobs.
TRIED, STEPS = 32, 6
#: What the registered query and the pipeline ask for.
REPEATED = 1.5


@dataclass(frozen=True)
class Target:
    """Least entropy of the weights in nats, or how often a source may be repeated on average."""

    entropy: float | None = None
    repeated: float | None = None


def tokens_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def row_hash(id_column: str = "doc_id", text_column: str = "text") -> Column:
    return F.xxhash64(id_column, text_column)


def _figures(sources: DataFrame, exponents: list[float], budget: float | None) -> list[tuple[float, float]]:
    """(entropy, most repetition) of the mix at each exponent."""
    share = F.col("share")
    columns = []
    for i, a in enumerate(exponents):
        power = F.pow(share, F.lit(a))
        columns += [F.sum(power).alias(f"z{i}"), F.sum(power * F.log(share)).alias(f"s{i}")]
    row = sources.where("tokens > 0").agg(F.max("share").alias("high"), F.min("share").alias("low"), F.sum("tokens").alias("all"), *columns).first()
    out = []
    for i, a in enumerate(exponents):
        z = row[f"z{i}"]
        entropy = math.log(z) - a * row[f"s{i}"] / z
        if budget is None:
            repeated = (row.high / row.low) ** (1 - a)
        else:
            repeated = row.low ** (a - 1) * budget / (z * row["all"])
        out.append((entropy, repeated))
    return out


def exponent(sources: DataFrame, target: Target, budget: float | None = None) -> float:
    """The largest exponent up to 1 that reaches an entropy, or the least from 0 on that keeps to a repetition limit."""
    if sources.where("tokens > 0").isEmpty():
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(STEPS):
        tried = [low + (high - low) * i / TRIED for i in range(TRIED + 1)]
        figures = _figures(sources, tried, budget)
        if target.entropy is not None:
            met = [e >= target.entropy - 1e-12 for e, _ in figures]
            if not met[0]:
                return 0.0
            at = max(i for i, ok in enumerate(met) if ok)
            if at == TRIED:
                return tried[-1]
            low, high = tried[at], tried[at + 1]
        else:
            met = [r <= target.repeated + 1e-12 for _, r in figures]
            if not met[-1]:
                return 1.0
            at = min(i for i, ok in enumerate(met) if ok)
            if at == 0:
                return tried[0]
            low, high = tried[at - 1], tried[at]
    return low if target.entropy is not None else high


def plan(sources: DataFrame, power: float, budget: float | None = None) -> DataFrame:
    """Per source with ``tokens`` and ``share``: ``weight``, ``blocks``, whole ``passes`` and what is ``left`` for the last one.

    Without a budget the largest source is taken once and the others by the ratio of weights, which is at least one:
    no rounding can take a document away.
    """
    z = sources.where("tokens > 0").agg(F.sum(F.pow("share", F.lit(power))).alias("z"), F.max("share").alias("high")).first()
    weight = F.when(F.col("tokens") > 0, F.pow("share", F.lit(power)) / F.lit(z.z or 1.0))
    if budget is None:
        ratio = F.greatest(F.lit(1.0), F.pow(F.col("share") / F.lit(z.high or 1.0), F.lit(power - 1.0)))
    else:
        ratio = weight * F.lit(float(budget)) / F.col("tokens")
    ratio = F.when(F.col("tokens") > 0, ratio).otherwise(1.0)
    # A power of two, so that any odd step permutes the blocks.
    blocks = F.least(F.lit(MOST_BLOCKS), F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.ceil(F.col("tokens") / BLOCK_TOKENS), F.lit(1)))))).cast("long")
    whole = F.floor(ratio)
    return sources.select("source", weight.alias("weight"), blocks.alias("blocks"), whole.alias("passes"), F.floor((ratio - whole) * F.col("tokens")).alias("left"))


def cuts(docs: DataFrame, target: Target, budget: float | None = None, seed: int = 1) -> DataFrame:
    """Per source: ``weight``, whole ``passes``, ``blocks``, and up to which block rank and hash the last pass goes."""
    measured = stored(docs.select("source", tokens_of(F.col("text")).alias("tokens"), row_hash().alias("hash")))
    totals = measured.groupBy("source").agg(F.sum("tokens").alias("tokens"))
    all_tokens = totals.agg(F.sum("tokens").alias("n")).first().n or 0
    sources = stored(totals.withColumn("share", F.when(F.col("tokens") > 0, F.col("tokens") / F.lit(max(all_tokens, 1)))))
    power = exponent(sources, target, budget)
    planned = stored(plan(sources, power, budget))
    dealt = measured.where("tokens > 0").join(planned.where("left > 0").withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).withColumn("rank", rank(F.col("passes"), seed))
    by_block = dealt.groupBy("of", "rank", "left").agg(F.sum("tokens").alias("tokens"))
    until = Window.partitionBy("of").orderBy("rank")
    # At most MOST_BLOCKS rows per source.
    reached = by_block.withColumn("before", F.sum("tokens").over(until) - F.col("tokens")).where("before <= left").groupBy("of").agg(F.max_by(F.struct("rank", (F.col("left") - F.col("before")).alias("rest")), "rank").alias("cut"))
    inside = dealt.select("of", "rank", "hash", "tokens").join(reached.select(F.col("of").alias("cut_of"), "cut"), F.col("of").eqNullSafe(F.col("cut_of")) & (F.col("rank") == F.col("cut.rank")))
    running = Window.partitionBy("of").orderBy("hash")
    taken = inside.withColumn("sum", F.sum("tokens").over(running)).where("sum <= cut.rest").groupBy("of").agg(F.max("hash").alias("cut_hash"))
    found = reached.join(taken.withColumnRenamed("of", "taken_of"), F.col("of").eqNullSafe(F.col("taken_of")), "left").select("of", F.col("cut.rank").alias("cut_rank"), "cut_hash")
    return planned.join(found, F.col("source").eqNullSafe(F.col("of")), "left").select("source", "weight", "blocks", "passes", "cut_rank", "cut_hash")


def rank(turn: Column, seed: int = 1) -> Column:
    """The place of a row's block in pass ``turn``: an affine permutation of ``blocks``, another one in each pass."""
    block = F.pmod(F.shiftrightunsigned("hash", 17), F.col("blocks"))
    step = F.pmod(F.xxhash64(turn, F.lit(seed)), F.col("blocks")).bitwiseOR(F.lit(1))
    shift = F.pmod(F.xxhash64(turn, F.lit(seed + 1)), F.col("blocks"))
    return F.pmod(block * step + shift, F.col("blocks"))


def mixed(docs: DataFrame, target: Target, budget: float | None = None, seed: int = 1) -> DataFrame:
    """``docs`` with each row as often as the mix takes it, and ``mix pass`` and ``mix block``: the pass, and the block's rank in it."""
    taken = {c.lower() for c in docs.columns}
    turn, block = (next(n for k in range(len(taken) + 1) if (n := name + "_" * k) not in taken) for name in ("mix pass", "mix block"))
    planned = stored(cuts(docs, target, budget, seed))
    # The row travels as one struct, so that its columns can have any name.
    rows = docs.select(F.struct("*").alias("mix row"), F.col("source").alias("mix source"), row_hash().alias("hash"), tokens_of(F.col("text")).alias("tokens"))
    rows = rows.join(planned, F.col("mix source").eqNullSafe(F.col("source")))
    place = rank(F.col("passes"), seed)
    last = (F.col("tokens") > 0) & ((place < F.col("cut_rank")) | ((place == F.col("cut_rank")) & (F.col("hash") <= F.col("cut_hash"))))
    times = F.col("passes") + F.coalesce(last, F.lit(False)).cast("long")
    turns = rows.where(times > 0).withColumn("mix pass", F.explode(F.sequence(F.lit(0).cast("long"), times - 1)))
    return turns.select("mix row.*", F.col("mix pass").alias(turn), rank(F.col("mix pass"), seed).alias(block))
