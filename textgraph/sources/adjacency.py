"""Adjacency text: a node, then its neighbours, blank separated; a lone node has no out-edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import ws_tokens
from .lines import read_lines


def parse_adjacency(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``nodes<node>`` with a row for each record, ``edges<src, dst>`` with repeated neighbours kept."""
    ids = lines.select(ws_tokens(F.col("line")).cast("array<bigint>").alias("ids")).filter(F.size("ids") > 0)
    nodes = ids.select(F.col("ids")[0].alias("node"))
    edges = ids.select(F.col("ids")[0].alias("src"), F.explode(F.slice("ids", F.lit(2), F.size("ids"))).alias("dst"))
    return nodes, edges


def read_adjacency(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return parse_adjacency(read_lines(spark, path))
