"""Tokens of lines, and counts over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import alpha_tokens, ws_tokens
from ..plans.durable import durable

TOKENIZERS = {"alpha": alpha_tokens, "ws": ws_tokens}


def tokenize(lines: DataFrame, mode: str = "ws", distinct: bool = False) -> DataFrame:
    """One row ``<..., term>`` a token of ``line``, the other columns kept; ``distinct``: each token once a line."""
    tokens = TOKENIZERS[mode](F.col("line"))
    if distinct:
        tokens = F.array_distinct(tokens)
    others = [c for c in lines.columns if c != "line"]
    return lines.select(*others, F.explode(tokens).alias("term"))


def word_count(tokens: DataFrame) -> DataFrame:
    """``<term, cnt>``."""
    return tokens.groupBy("term").agg(F.count("*").alias("cnt"))


def doc_freq(distinct_tokens: DataFrame) -> DataFrame:
    """``<term, df>``: lines holding the term, given each line's distinct tokens."""
    return distinct_tokens.groupBy("term").agg(F.count("*").alias("df"))


def line_count(lines: DataFrame) -> DataFrame:
    """``<n>``: all lines, blank ones too."""
    return lines.agg(F.count("*").alias("n"))


def distinct_terms(tokens: DataFrame) -> DataFrame:
    """``<terms>``: size of the vocabulary, counted over its already reduced groups."""
    return tokens.select("term").distinct().agg(F.count("*").alias("terms"))


# Places told of a sorted vocabulary when none are asked for: the first, and the third from the end.
POSITIONS = (1, -3)


def at_positions(rows: DataFrame, key: str, positions: Sequence[int] = POSITIONS, parts: int | None = None) -> DataFrame:
    """``<position, ...>``: the rows at ``positions`` of the order by ``key``, 1 the first, -1 the last; each where there is one.

    The rows are dealt to ``parts`` ranges of keys (the session's number of shuffle partitions) and written; the
    sizes of the ranges tell in which one a position lies. Only these ranges are put in order, each in a task of its
    own, so no task sees all rows. Rows of equal keys have no order among themselves.
    """
    spark = rows.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = durable(rows.repartitionByRange(parts, key).withColumn("_part", F.spark_partition_id()), "ranged")
    sizes = sorted(tuple(r) for r in ranged.groupBy("_part").count().collect())  # ``parts`` numbers at most
    total, start, wanted = sum(n for _, n in sizes), 0, []
    places = {p: p - 1 if p > 0 else total + p for p in positions if 0 < abs(p) <= total}
    for part, n in sizes:
        wanted += [(p, part, at - start + 1) for p, at in places.items() if start <= at < start + n]
        start += n
    asked = F.broadcast(spark.createDataFrame(wanted, "position bigint, _part int, _rank int"))
    needed = ranged.filter(F.col("_part").isin(sorted({part for _, part, _ in wanted})))
    ranked = needed.withColumn("_rank", F.row_number().over(W.partitionBy("_part").orderBy(key)))
    return ranked.join(asked, ["_part", "_rank"]).select("position", *rows.columns)


def part_positions(rows: DataFrame, key: str, positions: Sequence[int] = POSITIONS, parts: int | None = None) -> DataFrame:
    """``<part, position, ...>``: the rows at ``positions`` of each of ``parts`` hashed output files in their order by ``key``."""
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashed = rows.withColumn("part", F.pmod(F.hash(key), F.lit(parts)).cast("bigint"))
    ways = {1: F.asc(key), -1: F.desc(key)}
    found = None
    for way, order in ways.items():
        asked = [p for p in positions if p * way > 0]
        if not asked:
            continue
        # Spark keeps the first rows of a part in each task before the shuffle, as many as the farthest position.
        ranked = hashed.withColumn("position", F.row_number().over(W.partitionBy("part").orderBy(order)))
        ranked = ranked.filter(F.col("position") <= max(map(abs, asked))).withColumn("position", (F.col("position") * way).cast("bigint"))
        told = ranked.filter(F.col("position").isin(asked)).select("part", "position", *rows.columns)
        found = told if found is None else found.unionByName(told)
    return found


def vocab_positions(counts: DataFrame, positions: Sequence[int] = POSITIONS) -> DataFrame:
    """``<position, term, cnt>``: the words at ``positions`` of the vocabulary in sorted order."""
    return at_positions(counts, "term", positions)
