import pytest
from table_rows import as_dict
from pyspark.sql import functions as F

from textgraph import (
    duplicate_nodes,
    graph_stats,
    hash_partition,
    load_graph,
    missing_nodes,
    parse_adjacency,
    range_partition,
    read_adjacency,
    save_graph,
)


def graph(spark, nodes, edges):
    return (
        spark.createDataFrame([(n,) for n in nodes], "node bigint"),
        spark.createDataFrame(edges, "src bigint, dst bigint"),
    )


ADJACENCY = ["1\t2\t3", "  2  3 3 ", "3", "", "   ", "4 4 9"]


def test_adjacency_text(lines):
    nodes, edges = parse_adjacency(lines(*ADJACENCY))
    assert sorted(r["node"] for r in nodes.collect()) == [1, 2, 3, 4]
    assert sorted((r["src"], r["dst"]) for r in edges.collect()) == [(1, 2), (1, 3), (2, 3), (2, 3), (4, 4), (4, 9)]


def test_adjacency_file(spark, tmp_path):
    (tmp_path / "g.txt").write_text("\n".join(ADJACENCY))
    nodes, edges = read_adjacency(spark, str(tmp_path / "g.txt"))
    assert (nodes.count(), edges.count()) == (4, 6)


def test_statistics_and_checks(lines):
    nodes, edges = parse_adjacency(lines(*ADJACENCY))
    assert graph_stats(nodes, edges).first().asDict() == {"nodes": 4, "edges": 6, "active": 3}
    assert as_dict(missing_nodes(nodes, edges), "node") == {9: 1}
    assert duplicate_nodes(nodes).count() == 0
    assert as_dict(duplicate_nodes(nodes.union(nodes.filter("node = 2"))), "node") == {2: 2}


def test_graph_without_edges(spark):
    assert graph_stats(*graph(spark, [1, 2], [])).first().asDict() == {"nodes": 2, "edges": 0, "active": 0}


def test_saved_graph(spark, tmp_path):
    nodes, edges = graph(spark, [1, 2], [(1, 2), (1, 2)])
    path = str(tmp_path / "g")
    save_graph(nodes, edges, path)
    back = load_graph(spark, path)
    assert sorted(back[0].collect()) == sorted(nodes.collect()) and back[1].count() == 2
    save_graph(nodes.union(nodes), edges, path)
    with pytest.raises(ValueError, match="2 records"):
        load_graph(spark, path)


def test_range_partition(spark):
    nodes, _ = graph(spark, [0, 1, 24, 25, 50, 99, 100, 130, 1_000_003], [])
    moved = range_partition(nodes, 4, 100)
    parts = as_dict(moved, "node")
    assert all(r["part"] == r["at"] for r in moved.withColumn("at", F.spark_partition_id()).collect())
    assert parts == {0: 0, 1: 0, 24: 0, 25: 1, 50: 2, 99: 3, 100: 0, 130: 1, 1_000_003: 0}


def test_hash_partition_keeps_a_source_together(spark):
    _, edges = graph(spark, [], [(i % 5, i) for i in range(50)])
    owners = hash_partition(edges, 3).rdd.mapPartitionsWithIndex(lambda i, rows: {(r["src"], i) for r in rows}).collect()
    assert len(owners) == len({src for src, _ in owners}) == 5
