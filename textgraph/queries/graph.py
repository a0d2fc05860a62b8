"""Graph preparation and personalized PageRank over the graph of parts and suppliers.

A part's node is twice its key, a supplier's twice its key plus one. Each row of ``lineitem`` is an edge from
part to supplier and one back, repeated ones kept. The trade graph goes from customers over orders and parts to
suppliers, who have no record; orders without lines have no out-edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import (
    duplicate_nodes,
    format_top,
    graph_stats,
    init_ranks,
    iteration_metrics,
    missing_nodes,
    parse_adjacency,
    ppr,
    ppr_logs,
    ppr_step,
    range_partition,
    top_k,
    top_k_per_source,
    total_mass,
)
from . import table

# Two parts, two suppliers, and no node at all.
SOURCES = [2, 14, 7, 11, -1]
# Two customers, an order, a part, and no node at all.
TRADERS = [4, 28, 21, 10, -1]
PARTS = 8

WHOLE_SQL = """
nodes AS (SELECT 2 * p_partkey AS node FROM part UNION ALL SELECT 2 * s_suppkey + 1 FROM supplier),
edges AS (
  SELECT 2 * l_partkey AS src, 2 * l_suppkey + 1 AS dst FROM lineitem
  UNION ALL SELECT 2 * l_suppkey + 1, 2 * l_partkey FROM lineitem
)"""

TRADE_SQL = """
nodes AS (
  SELECT 4 * c_custkey AS node FROM customer UNION ALL SELECT 4 * o_orderkey + 1 FROM orders UNION ALL SELECT 4 * p_partkey + 2 FROM part
),
edges AS (
  SELECT 4 * o_custkey AS src, 4 * o_orderkey + 1 AS dst FROM orders
  UNION ALL SELECT 4 * l_orderkey + 1, 4 * l_partkey + 2 FROM lineitem
  UNION ALL SELECT 4 * l_partkey + 2, 4 * l_suppkey + 3 FROM lineitem
)"""

ADJACENCY_SQL = """
records AS (
  SELECT l_orderkey AS node, [l_partkey, l_suppkey] AS neighbours FROM lineitem
  UNION ALL SELECT p_partkey, [] FROM part
)"""


def _ppr_sql(graph: str, iterations: int, sources: list[int] = SOURCES) -> str:
    """CTEs r0..rN, each step with its explicit total and missing mass."""
    ctes = [
        graph,
        f"asked AS (SELECT unnest([{', '.join(map(str, sources))}]::BIGINT[]) AS source)",
        "degrees AS MATERIALIZED (SELECT src AS node, count(*) AS degree FROM edges GROUP BY 1)",
        "r0 AS (SELECT source, source AS node, 1.0::DOUBLE AS p FROM asked JOIN nodes ON source = node)",
    ]
    for i in range(1, iterations + 1):
        ctes.append(
            f"""m{i} AS MATERIALIZED (
              SELECT r.source, e.dst AS node, sum(r.p / d.degree) AS p
              FROM r{i - 1} r JOIN degrees d ON d.node = r.node JOIN edges e ON e.src = r.node
                JOIN nodes n ON n.node = e.dst
              GROUP BY 1, 2)"""
        )
        ctes.append(
            f"""t{i} AS MATERIALIZED (
              SELECT a.source, coalesce(sum(m.p), 0) AS total, greatest(1 - coalesce(sum(m.p), 0), 0) AS missing
              FROM asked a LEFT JOIN m{i} m ON m.source = a.source GROUP BY 1)"""
        )
        ctes.append(
            f"""r{i} AS MATERIALIZED (
              SELECT source, node, sum(p) AS p FROM (
                SELECT source, node, 0.85 * p AS p FROM m{i}
                UNION ALL
                SELECT t.source, t.source, 0.15 + 0.85 * t.missing FROM t{i} t JOIN nodes n ON n.node = t.source)
              GROUP BY 1, 2)"""
        )
    return "WITH " + ",\n".join(ctes) + "\n"


def _part_nodes(part: DataFrame) -> DataFrame:
    return part.select((F.col("p_partkey") * 2).alias("node"))


def _supplier_nodes(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").select((F.col("s_suppkey") * 2 + 1).alias("node"))


def _whole(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    part, supplier = F.col("l_partkey") * 2, F.col("l_suppkey") * 2 + 1
    both = F.array(F.struct(part.alias("src"), supplier.alias("dst")), F.struct(supplier.alias("src"), part.alias("dst")))
    edges = table(spark, folder, "lineitem").select(F.inline(both))
    nodes = _part_nodes(table(spark, folder, "part")).union(_supplier_nodes(spark, folder))
    return nodes, edges


def _trade(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    orders, lines = table(spark, folder, "orders"), table(spark, folder, "lineitem")
    order, part = F.col("l_orderkey") * 4 + 1, F.col("l_partkey") * 4 + 2
    onwards = F.array(
        F.struct(order.alias("src"), part.alias("dst")), F.struct(part.alias("src"), (F.col("l_suppkey") * 4 + 3).alias("dst"))
    )
    placed = orders.select((F.col("o_custkey") * 4).alias("src"), (F.col("o_orderkey") * 4 + 1).alias("dst"))
    nodes = (
        table(spark, folder, "customer").select((F.col("c_custkey") * 4).alias("node"))
        .union(orders.select(F.col("o_orderkey") * 4 + 1))
        .union(table(spark, folder, "part").select(F.col("p_partkey") * 4 + 2))
    )
    return nodes, placed.union(lines.select(F.inline(onwards)))


def adjacency_parse(spark: SparkSession, folder: str) -> DataFrame:
    """Records as text, with blanks of all kinds, and what is read from it: nodes have a null dst."""
    orders = table(spark, folder, "lineitem").select(F.format_string(" %d\t%d  %d", "l_orderkey", "l_partkey", "l_suppkey"))
    alone = table(spark, folder, "part").select(F.format_string("%d \t", "p_partkey"))
    nodes, edges = parse_adjacency(orders.union(alone).toDF("line"))
    return edges.union(nodes.select(F.col("node").alias("src"), F.lit(None).cast("bigint").alias("dst")))


def graph_duplicate_nodes(spark: SparkSession, folder: str) -> DataFrame:
    return duplicate_nodes(table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("node")))


def node_range_part(spark: SparkSession, folder: str) -> DataFrame:
    nodes, _ = _whole(spark, folder)
    return range_partition(nodes, PARTS, nodes.count())


def _rounded(ranks: DataFrame, digits: int = 10) -> DataFrame:
    return ranks.withColumn("p", F.round("p", digits))


def _ranked(spark: SparkSession, folder: str, sources: list[int] = SOURCES) -> DataFrame:
    return _rounded(ppr(*_whole(spark, folder), sources, 3))


def ppr_iter1(spark: SparkSession, folder: str) -> DataFrame:
    nodes, edges = _whole(spark, folder)
    return _rounded(ppr_step(nodes, edges, init_ranks(nodes, SOURCES), SOURCES))


def ppr_total_mass(spark: SparkSession, folder: str) -> DataFrame:
    nodes, edges = _trade(spark, folder)
    found = total_mass(nodes, edges, ppr(nodes, edges, TRADERS, 2), TRADERS)
    return found.select("source", F.round("total", 10).alias("total"), F.round("missing", 10).alias("missing"))


def ppr_metrics(spark: SparkSession, folder: str) -> DataFrame:
    nodes, edges = _trade(spark, folder)
    return iteration_metrics(nodes, edges, ppr(nodes, edges, TRADERS, 1))


def ppr_topk(spark: SparkSession, folder: str) -> DataFrame:
    return top_k_per_source(_ranked(spark, folder), 10)


TOP_SQL = _ppr_sql(WHOLE_SQL, 3) + """,
top AS (
  SELECT source, row_number() OVER (PARTITION BY source ORDER BY p DESC, node DESC) AS rank, node, p
  FROM (SELECT source, node, round(p, 10) AS p FROM r3) QUALIFY rank <= 10
)"""

QUERIES = {
    "adjacency_parse": (
        adjacency_parse,
        f"""WITH {ADJACENCY_SQL}
        SELECT node AS src, unnest(neighbours) AS dst FROM records UNION ALL SELECT node, NULL FROM records""",
    ),
    "graph_stats": (
        lambda spark, folder: graph_stats(*_trade(spark, folder)),
        f"""WITH {TRADE_SQL},
        degrees AS (SELECT node, count(src) AS degree FROM nodes LEFT JOIN edges ON src = node GROUP BY node)
        SELECT count(*) AS nodes, sum(degree)::BIGINT AS edges, count(*) FILTER (WHERE degree > 0) AS active FROM degrees""",
    ),
    "graph_duplicate_nodes": (
        graph_duplicate_nodes,
        "SELECT l_orderkey AS node, count(*) AS records FROM lineitem GROUP BY 1 HAVING count(*) > 1",
    ),
    "node_range_part": (
        node_range_part,
        f"""WITH {WHOLE_SQL}
        SELECT node, floor(node::DOUBLE / (SELECT count(*) FROM nodes) * {PARTS})::BIGINT % {PARTS} AS part FROM nodes""",
    ),
    "ppr_init": (
        lambda spark, folder: init_ranks(_whole(spark, folder)[0], SOURCES),
        _ppr_sql(WHOLE_SQL, 0) + "SELECT source, node, p FROM r0",
    ),
    "ppr_iter1": (ppr_iter1, _ppr_sql(WHOLE_SQL, 1) + "SELECT source, node, round(p, 10) AS p FROM r1"),
    "ppr_total_mass": (
        ppr_total_mass,
        _ppr_sql(TRADE_SQL, 3, TRADERS) + "SELECT source, round(total, 10) AS total, round(missing, 10) AS missing FROM t3",
    ),
    "ppr_missing_nodes": (
        lambda spark, folder: missing_nodes(*_trade(spark, folder)),
        f"""WITH {TRADE_SQL}
        SELECT dst AS node, count(*) AS messages FROM edges WHERE dst NOT IN (SELECT node FROM nodes) GROUP BY 1""",
    ),
    "ppr_metrics": (
        ppr_metrics,
        _ppr_sql(TRADE_SQL, 1, TRADERS)
        + """SELECT 'nodes' AS metric, (SELECT count(*) FROM nodes) AS value
        UNION ALL SELECT 'edges', (SELECT count(*) FROM edges WHERE src IN (SELECT node FROM nodes))
        UNION ALL SELECT 'mass_messages', (SELECT count(*) FROM edges WHERE src IN (SELECT node FROM nodes))
        UNION ALL SELECT 'mass_messages_received', (SELECT count(*) FROM edges WHERE dst IN (SELECT node FROM nodes))
        UNION ALL SELECT 'missing_structure', (SELECT count(DISTINCT dst) FROM edges WHERE dst NOT IN (SELECT node FROM nodes))
        UNION ALL SELECT 'active_with_mass',
          (SELECT count(DISTINCT node) FROM r1 WHERE node IN (SELECT node FROM degrees))""",
    ),
    "ppr_3iter": (_ranked, _ppr_sql(WHOLE_SQL, 3) + "SELECT source, node, round(p, 10) AS p FROM r3"),
    "ppr_dangling": (
        lambda spark, folder: _rounded(ppr(*_trade(spark, folder), TRADERS, 3)),
        _ppr_sql(TRADE_SQL, 3, TRADERS) + "SELECT source, node, round(p, 10) AS p FROM r3",
    ),
    "ppr_log_mass": (
        lambda spark, folder: ppr_logs(*_whole(spark, folder), SOURCES, 2).withColumn("log_p", F.round("log_p", 8)),
        _ppr_sql(WHOLE_SQL, 2) + "SELECT source, node, round(ln(p), 8) AS log_p FROM r2",
    ),
    "ppr_topk_single": (
        lambda spark, folder: top_k(_ranked(spark, folder, SOURCES[:1]), 10),
        _ppr_sql(WHOLE_SQL, 3, SOURCES[:1])
        + "SELECT source, node, round(p, 10) AS p FROM r3 ORDER BY round(r3.p, 10) DESC, node DESC LIMIT 10",
    ),
    "ppr_topk": (ppr_topk, TOP_SQL + "SELECT source, rank, node, p FROM top"),
    "ppr_topk_text": (
        lambda spark, folder: format_top(ppr_topk(spark, folder)).select("source", "rank", "line"),
        TOP_SQL + "SELECT source, rank, printf('%.5f %d', p, node) AS line FROM top",
    ),
}
