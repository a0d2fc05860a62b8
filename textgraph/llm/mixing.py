"""Mixing sources to target weights by balanced sampling with the cube method.

Every document has an expected number of times to be taken. Its whole part is taken for sure; of the fraction, the
cube method makes a choice: in blocks of documents, fractions walk through the null space of the constraints (total
words, number of documents) until all but two of a block are 0 or 1. The undecided of all blocks are dealt to new
blocks and walk on, until a source has a few at most; these land near its target, together with a few small documents.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.durable import durable
from ..plans.skew import lookup_join
from .columns import WORD, whole_text

# The sources' weights in turn, the share of all words to be taken, the most a source is repeated.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
# Documents of a source that walk together.
BLOCK = 4096
# Equal rows that are numbered together.
LOT = 1024
# Small documents that help the last undecided ones of a source to land near its target.
HELPERS = 10
# A fraction this close to 0 or 1 is decided.
EPSILON = 1e-9


def source_targets(sources: DataFrame, share: float = SHARE, most: float = MOST, weights: tuple = WEIGHTS) -> DataFrame:
    """``<source, source_size, target, n>`` of ``<source, source_size, n>``: words to take of each source.

    Sources weigh ``weights`` in turn, by code point, null last. They share ``share`` of all words by weight; a
    target stops at ``most`` times its source's words, and what is over is shared again until none is above. Ranks
    come from range partitions and their counts, so no task sorts all sources.
    """
    nulls_last = [F.col("source").isNull().cast("int").alias("absent"), F.col("source")]
    parts = max(1, int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = sources.select("*", nulls_last[0]).repartitionByRange(parts, "absent", "source").sortWithinPartitions("absent", "source")
    placed = durable(ordered.select("source", "source_size", "n", F.monotonically_increasing_id().alias("place")), "sources")
    part = F.shiftright("place", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("rows"))
    before = F.coalesce(F.sum("rows").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = F.broadcast(sizes.select("part", before.alias("before")))  # one row per partition
    rank = F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = placed.withColumn("part", part).join(offsets, "part").withColumn("rank", rank).withColumn("weight", weight)
    weighted = durable(ranked.select("source", "source_size", "n", "weight"), "weights")
    total = share * (weighted.agg(F.sum("source_size")).first()[0] or 0)
    cap, level, settled = most * F.col("source_size"), 0.0, -1
    while True:  # each turn caps one more source at least, and ends with the first that caps none
        capped = F.lit(level) * F.col("weight") >= cap
        used, free, n = weighted.agg(
            F.sum(F.when(capped, cap).otherwise(0.0)), F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))), F.count_if(capped)
        ).first()
        if n == settled or not free:
            break
        level, settled = (total - used) / free, n
    target = F.least(cap, F.lit(level) * F.col("weight"))
    return weighted.select("source", "source_size", "n", target.alias("target"))


def flight(chance: np.ndarray, size: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Walk ``chance`` until at most two entries are undecided, keeping their sum and their sum weighted by ``size``.

    Three undecided entries at a time have one direction that keeps both sums; a step along it, either way with the
    probability that keeps the expectation, decides one of them at least.
    """
    chance = chance.copy()
    open_ = []
    for i in range(len(chance)):
        if EPSILON < chance[i] < 1 - EPSILON:
            open_.append(i)
        else:
            chance[i] = round(chance[i])
        if len(open_) < 3:
            continue
        a, b, c = open_
        away = (size[b] - size[c], size[c] - size[a], size[a] - size[b])
        if away == (0.0, 0.0, 0.0):
            away = (1.0, -1.0, 0.0)
        up = min((1 - chance[k]) / u if u > 0 else chance[k] / -u for k, u in zip(open_, away) if u)
        down = min(chance[k] / u if u > 0 else (1 - chance[k]) / -u for k, u in zip(open_, away) if u)
        step = up if draws[i] * (up + down) < down else -down
        for k, u in zip((a, b, c), away):
            chance[k] += step * u
            if chance[k] <= EPSILON or chance[k] >= 1 - EPSILON:
                chance[k] = round(chance[k])
                open_.remove(k)
    return chance


def landing(chance: np.ndarray, size: np.ndarray, helpers: int = HELPERS) -> np.ndarray:
    """Decide the last few, together with the ``helpers`` smallest decided ones: a choice whose words are nearest to
    what is expected, of such ones that with the fewest decisions changed."""
    chance = chance.copy()
    is_open = (chance > EPSILON) & (chance < 1 - EPSILON)
    smallest = np.argsort(np.where(is_open, np.inf, size), kind="stable")[: min(helpers, int((~is_open).sum()))]
    free = np.concatenate([np.flatnonzero(is_open), smallest])
    choices = np.arange(1 << len(free))[:, None] >> np.arange(len(free)) & 1
    missed = np.abs(choices @ size[free] - (chance[free] * size[free]).sum())
    changed = (choices[:, int(is_open.sum()) :] != chance[smallest].round()).sum(axis=1)
    chance[free] = choices[np.lexsort((changed, missed.round(6)))[0]]
    return chance.round()


def _walk(last: bool):
    def block(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "size", "row", "copy"], kind="stable")
        size = group["size"].to_numpy(float)
        draws = np.random.default_rng([len(group), int(group["row"].iloc[0]) & (1 << 62) - 1]).random(len(group))
        chance = flight(group["chance"].to_numpy(float), size, draws)
        return group.assign(chance=landing(chance, size) if last else chance)

    return block


def _each(counted: DataFrame) -> DataFrame:
    """Rows with ``copies`` one by one, each with its number as ``copy``; those of one row come from many tasks."""
    lots = counted.withColumn("lot", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(copies - 1) div {LOT}"))))
    within = F.sequence(F.lit(0).cast("bigint"), F.least(F.lit(LOT), F.col("copies") - F.col("lot") * LOT) - 1)
    spread = lots.repartition("doc_id", "row", "lot").withColumn("within", F.explode(within))
    return spread.withColumn("copy", F.col("lot") * LOT + F.col("within")).drop("lot", "within", "copies")


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", block: int = BLOCK) -> DataFrame:
    """``<doc_id, source, size, source_size, target, times, taken>``, one row per document.

    ``size`` is the number of words, 0 for a null or blank text; ``times`` how often the mix takes the document and
    ``taken`` the words it takes of it. A document without words is never taken. Null is a source of its own.
    Repeated rows are documents of their own. The same table gives the same mix: blocks and draws depend on ids,
    sizes and counts only, and rows equal in all of these are interchangeable.
    """
    counted = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.col(source).alias("source"),
        F.regexp_count(whole_text(text), F.lit(WORD)).cast("bigint").alias("size"),
        F.xxhash64(whole_text(text)).alias("row"),
    )
    # Equal rows are counted first and numbered later, so that however many there are they are dealt to blocks as others.
    counted = durable(counted.groupBy(*counted.columns).agg(F.count("*").alias("copies")), "sizes")
    totals = counted.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"), F.sum("copies").alias("n"))
    targets = durable(source_targets(totals), "targets")
    # A null source gets a key that no source's name can have.
    key = F.when(F.col("source").isNotNull(), F.concat(F.lit("s"), "source")).otherwise("n").alias("key")
    lookup = targets.select(key, "source_size", "target", "n")
    rows = lookup_join(_each(counted).select("doc_id", "source", "size", "row", "copy", key), lookup, "key", "n", broadcast_bytes=16 << 20)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.when(F.col("size") > 0, F.floor(ratio)).otherwise(0)
    expected = rows.withColumns({"sure": whole.cast("bigint"), "chance": F.when(F.col("size") > 0, ratio - whole).otherwise(0.0)})
    undecided = (F.col("chance") > EPSILON) & (F.col("chance") < 1 - EPSILON)
    expected = durable(expected.withColumn("chance", F.when(undecided, F.col("chance")).otherwise(F.round("chance"))), "expected")
    done, open_, salt = [expected.filter(~undecided)], expected.filter(undecided), 0
    while True:
        most = open_.groupBy("key").count().agg(F.max("count")).first()[0] or 0
        blocks = F.lit(max(1, -(-most // block))).cast("bigint")
        dealt = open_.withColumn("block", F.pmod(F.xxhash64("doc_id", "row", "copy", F.lit(salt)), blocks))
        walked = dealt.groupBy("key", "block").applyInPandas(_walk(most <= block), dealt.schema).drop("block")
        walked = durable(walked, "walked")
        done.append(walked.filter(~undecided))
        if most <= block:
            break
        open_, salt = walked.filter(undecided), salt + 1
    decided = done[0]
    for part in done[1:]:
        decided = decided.unionByName(part)
    times = F.col("sure") + F.round("chance").cast("bigint")
    return decided.select("doc_id", "source", "size", "source_size", "target", times.alias("times"), (times * F.col("size")).alias("taken"))
