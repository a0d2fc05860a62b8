"""Graphs as ``nodes<node>`` and ``edges<src, dst>``, repeated edges kept: checks, statistics, partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def out_degrees(edges: DataFrame) -> DataFrame:
    """``<node, degree>`` of the nodes with out-edges; a repeated neighbour counts each time."""
    return edges.groupBy(F.col("src").alias("node")).agg(F.count("*").alias("degree"))


def in_degrees(edges: DataFrame) -> DataFrame:
    """``<node, messages>`` of the nodes edges point to, whether they have a record or not."""
    return edges.groupBy(F.col("dst").alias("node")).agg(F.count("*").alias("messages"))


def graph_stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``<nodes, edges, active>``: records, their out-edges, records with at least one."""
    degrees = nodes.join(out_degrees(edges), "node", "left")
    return degrees.agg(
        F.count("*").alias("nodes"),
        F.coalesce(F.sum("degree"), F.lit(0)).alias("edges"),
        F.count("degree").alias("active"),
    )


def duplicate_nodes(nodes: DataFrame) -> DataFrame:
    """``<node, records>`` of the nodes with more than one record."""
    return nodes.groupBy("node").agg(F.count("*").alias("records")).filter(F.col("records") > 1)


def checked_nodes(nodes: DataFrame) -> DataFrame:
    """The nodes; when they are read, a node with more than one record is an error."""
    counted = nodes.groupBy("node").agg(F.count("*").alias("records"))
    told = F.concat(F.lit("node "), F.col("node").cast("string"), F.lit(" has "), F.col("records").cast("string"), F.lit(" records"))
    return counted.select(F.when(F.col("records") > 1, F.raise_error(told).cast("bigint")).otherwise(F.col("node")).alias("node"))


def missing_nodes(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``<node, messages>``: edge targets without a record and the edges to them.

    Edges are counted per target before they meet the records, so that a target of many edges is one row.
    """
    return in_degrees(edges).join(nodes, "node", "left_anti")


def range_partition(nodes: DataFrame, parts: int, node_count: int) -> DataFrame:
    """Move each node to the partition of its share of the id range 0..node_count, ids beyond it wrapped; add ``part``."""
    share = F.floor(F.col("node").cast("double") / node_count * parts)
    placed = nodes.withColumn("part", F.pmod(share, F.lit(parts)).cast("bigint"))
    return placed.repartitionById(parts, F.col("part").cast("int"))


def hash_partition(df: DataFrame, parts: int, key: str = "src") -> DataFrame:
    """Rows of one key together, by default the edges of a source node."""
    return df.repartition(parts, key)


def save_graph(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    edges.write.mode("overwrite").parquet(f"{path}/edges")


def load_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The saved ``(nodes, edges)``; a node with two records is an error."""
    nodes, edges = spark.read.parquet(f"{path}/nodes"), spark.read.parquet(f"{path}/edges")
    repeated = duplicate_nodes(nodes).limit(1).collect()
    if repeated:
        raise ValueError(f"node {repeated[0]['node']} has {repeated[0]['records']} records")
    return nodes, edges
