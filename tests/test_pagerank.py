import math
import os
import random
from collections import defaultdict
from functools import partial

import pytest
from table_rows import as_dict
from pyspark.sql import functions as F
from test_graph import graph

from textgraph import (
    format_top,
    from_log_mass,
    init_ranks,
    iteration_metrics,
    load_transitions,
    log_mass,
    log_sum_exp,
    ppr,
    ppr_logs,
    ppr_step,
    run_ppr,
    save_transitions,
    top_k,
    top_k_per_source,
    total_mass,
    transitions,
    write_top_k,
)
from textgraph.operators import pagerank
from textgraph.plans.skew import lookup_join


def brute_step(nodes, edges, ranks, sources, alpha=0.15):
    out = defaultdict(list)
    for src, dst in edges:
        out[src].append(dst)
    after = {}
    for s in sources:
        got = defaultdict(float)
        for (source, node), p in ranks.items():
            if source == s:
                for dst in out[node]:
                    if dst in nodes:
                        got[dst] += p / len(out[node])
        missing = max(1 - sum(got.values()), 0)
        for node, p in got.items():
            after[s, node] = (1 - alpha) * p
        if s in nodes:
            after[s, s] = after.get((s, s), 0) + alpha + (1 - alpha) * missing
    return after


def brute(nodes, edges, sources, iterations, alpha=0.15):
    ranks = {(s, s): 1.0 for s in sources if s in nodes}
    for _ in range(iterations):
        ranks = brute_step(nodes, edges, ranks, sources, alpha)
    return ranks


def random_graph(seed, size=30):
    rng = random.Random(seed)
    nodes = list(range(size))
    edges = [(1, rng.randrange(size + 4)) for _ in range(60)] + [(rng.randrange(size), 2) for _ in range(40)]
    edges += [(rng.randrange(size // 2), rng.randrange(size + 4)) for _ in range(60)] + [(5, 5), (5, 6), (5, 6)]
    return nodes, [(s, d) for s, d in edges if s not in (7, 8)]


def same(found, expected):
    found = as_dict(found, "source", "node")
    assert found.keys() == expected.keys()
    for key, p in expected.items():
        assert found[key] == pytest.approx(p, abs=1e-12)


@pytest.mark.parametrize("salt_edges", [1_000_000, 7])
def test_ranks_equal_brute_force(spark, salt_edges):
    nodes, edges = random_graph(1)
    sources = [1, 7, 20, 99]
    found = ppr(*graph(spark, nodes, edges), sources, 7, salt_edges=salt_edges, cut_every=3)
    same(found, brute(set(nodes), edges, sources, 7))
    assert found.filter("source = 99").count() == 0
    for total in as_dict(found.groupBy("source").agg(F.sum("p").alias("t")), "source").values():
        assert total == pytest.approx(1)


def test_hot_nodes_join_apart_from_the_others(spark, monkeypatch):
    nodes, edges = random_graph(2)
    monkeypatch.setattr(pagerank, "lookup_join", partial(lookup_join, broadcast_bytes=0, head_keys=10))
    same(ppr(*graph(spark, nodes, edges), [1, 3], 3), brute(set(nodes), edges, [1, 3], 3))


def test_one_step_to_five_neighbours(spark):
    nodes, edges = graph(spark, range(8), [(0, i) for i in range(1, 6)])
    logs = as_dict(log_mass(ppr(nodes, edges, [0], 1)), "source", "node")
    assert logs.keys() == {(0, i) for i in range(6)}
    assert logs[0, 0] == pytest.approx(math.log(0.15))
    assert logs[0, 5] == pytest.approx(math.log(0.17))


def test_a_graph_without_dead_ends_loses_nothing(spark):
    nodes, edges = graph(spark, [0, 1, 2], [(0, 1), (1, 2), (2, 0)])
    same(ppr(nodes, edges, [0], 2, alpha=0.5), {(0, 0): 0.5, (0, 1): 0.25, (0, 2): 0.25})


def test_a_graph_without_edges_returns_all_mass(spark):
    same(ppr(*graph(spark, [0, 1], []), [0], 2), {(0, 0): 1.0})


def test_no_iteration(spark):
    same(ppr(*graph(spark, [0, 1], [(0, 1)]), [1, 4], 0), {(1, 1): 1.0})


def test_a_source_without_mass_gets_all_of_it_in_a_step(spark):
    nodes, edges = random_graph(3)
    tables = graph(spark, nodes, edges)
    ranks = init_ranks(tables[0], [1])
    same(ppr_step(*tables, ranks, [1, 4]), brute_step(set(nodes), edges, {(1, 1): 1.0}, [1, 4]))


def test_snapshots_resume(spark, tmp_path):
    nodes, edges = random_graph(4)
    tables, base = graph(spark, nodes, edges), str(tmp_path / "ranks")
    run_ppr(base, *tables, [1, 3], 0, 2)
    assert sorted(p.name for p in (tmp_path / "ranks").iterdir()) == ["iter0000", "iter0001", "iter0002", "manifest"]
    same(run_ppr(base, *tables, [1, 3], 2, 5), brute(set(nodes), edges, [1, 3], 5))
    same(spark.read.parquet(f"{base}/iter0003"), brute(set(nodes), edges, [1, 3], 3))


def test_total_and_missing_mass(spark):
    nodes, edges = random_graph(5)
    tables, sources = graph(spark, nodes, edges), [1, 7, 99]
    ranks = brute(set(nodes), edges, sources, 2)
    found = as_dict(total_mass(*tables, ppr(*tables, sources, 2), sources), "source")
    for s in sources:
        degrees = {n: [d for src, d in edges if src == n] for n in nodes}
        kept = sum(
            p * sum(d in nodes for d in degrees[n]) / len(degrees[n])
            for (source, n), p in ranks.items()
            if source == s and degrees[n]
        )
        assert found[s] == pytest.approx((kept, 1 - kept))


def test_metrics(spark):
    tables = graph(spark, [1, 2, 3, 4], [(1, 2), (1, 3), (2, 9), (2, 9), (4, 8)])
    found = as_dict(iteration_metrics(*tables, ppr(*tables, [1], 1)), "metric")
    assert found == {
        "nodes": 4,
        "edges": 5,
        "mass_messages": 5,
        "mass_messages_received": 2,
        "missing_structure": 2,
        "active_with_mass": 2,
    }


def test_log_mass_round_trip(spark):
    ranks = spark.createDataFrame([(1, 1, 0.25), (1, 2, 0.0)], "source bigint, node bigint, p double")
    logs = log_mass(ranks).union(spark.createDataFrame([(1, 3, float("-inf"))], "source bigint, node bigint, log_p double"))
    assert as_dict(from_log_mass(logs), "node") == {1: (1, 0.25)}


def test_top_k_prefers_the_higher_node_among_equals(spark, tmp_path):
    rows = [(s, n, 1.0 / (1 + n // 3)) for s in (1, 2) for n in range(40)]
    ranks = spark.createDataFrame(rows, "source bigint, node bigint, p double").repartition(5)
    order = sorted(range(40), key=lambda n: (-1.0 / (1 + n // 3), -n))
    assert [r["node"] for r in top_k(ranks.filter("source = 1"), 7).collect()] == order[:7]
    best = top_k_per_source(ranks, 7)
    expected = {(s, i + 1): n for s in (1, 2) for i, n in enumerate(order[:7])}
    assert as_dict(best.drop("p"), "source", "rank") == expected
    assert format_top(best).filter("source = 2 and rank = 1").first()["line"] == "1.00000 2"
    write_top_k(best, str(tmp_path / "top"))
    assert sorted(p.name for p in (tmp_path / "top").glob("source=*")) == ["source=1", "source=2"]
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "5")
    try:
        assert as_dict(top_k_per_source(ranks, 7).drop("p"), "source", "rank") == expected
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


def test_iterations_do_not_shuffle_the_moves_again(spark):
    tables = graph(spark, *random_graph(6))
    held = pagerank._held(pagerank.transitions(*tables))
    present = pagerank._present(tables[0], [1])
    jumps = pagerank._jumps(present, None, 0.15)
    step = pagerank._advance(init_ranks(tables[0], present), held, jumps, 0.15)
    plan = step._jdf.queryExecution().executedPlan().toString()
    join = plan[plan.index("SortMergeJoin") :]
    scan_side = join[: join.index("InMemoryTableScan")].rsplit("+- ", 2)
    assert "Exchange" not in scan_side[-1] and "Sort" not in scan_side[-2]
    held.moves.unpersist()


def test_a_second_record_is_an_error(spark):
    nodes, edges = graph(spark, [1, 2, 2, 3], [(1, 2), (2, 3), (3, 1)])
    for job in (
        lambda: ppr(nodes, edges, [1], 3),
        lambda: ppr_step(nodes, edges, init_ranks(nodes, [1]), [1]),
        lambda: total_mass(nodes, edges, init_ranks(nodes, [1]), [1]),
    ):
        with pytest.raises(Exception, match="node 2 has 2 records"):
            job()


def test_a_run_does_not_go_on_from_another(spark, tmp_path):
    nodes, edges = random_graph(8)
    tables, base = graph(spark, nodes, edges), str(tmp_path / "run")
    with pytest.raises(ValueError, match="no manifest"):
        run_ppr(base, *tables, [1, 3], 2, 3)
    run_ppr(base, *tables, [1, 3], 0, 2)
    with pytest.raises(ValueError, match="other sources_hash"):
        run_ppr(base, *tables, [1, 4], 2, 3)
    with pytest.raises(ValueError, match="other alpha"):
        run_ppr(base, *tables, [1, 3], 2, 3, alpha=0.2)
    with pytest.raises(ValueError, match="moves_hash"):
        run_ppr(base, tables[0], tables[1].union(tables[1].limit(1)), [1, 3], 2, 3)
    with pytest.raises(ValueError, match="snapshot 7"):
        run_ppr(base, *tables, [1, 3], 7, 8)
    (tmp_path / "run" / "iter0002" / "_SUCCESS").unlink()
    with pytest.raises(ValueError, match="unfinished"):
        run_ppr(base, *tables, [3, 1], 2, 3)


def test_a_run_tells_its_metrics(spark, tmp_path):
    nodes, edges = random_graph(9)
    tables, told = graph(spark, nodes, edges), []
    last = run_ppr(str(tmp_path / "run"), *tables, [1], 0, 2, metrics=told)
    expected = as_dict(iteration_metrics(*tables, spark.read.parquet(str(tmp_path / "run" / "iter0001"))), "metric")
    assert [m["iteration"] for m in told] == [1, 2]
    assert {k: told[1][k] for k in expected if k != "active_with_mass"} == {k: v for k, v in expected.items() if k != "active_with_mass"}
    assert told[1]["ranks"] == last.count() and told[1]["mass"] == pytest.approx(1)
    assert told[0]["moved"] + told[0]["returned"] >= 1


def test_a_saved_graph_is_prepared_once(spark, tmp_path, monkeypatch):
    nodes, edges = random_graph(10)
    tables = graph(spark, nodes, edges)
    for salt_edges in (2, 10**6):
        save_transitions(transitions(*tables, salt_edges), "saved_graph", 4, str(tmp_path / f"saved{salt_edges}"))
        with monkeypatch.context() as m:
            m.setattr(pagerank, "transitions", None)  # nothing is prepared from here on
            saved = load_transitions(spark, "saved_graph")
            for sources in ([1, 3], [2]):
                same(ppr(tables[0], None, sources, 3, graph=saved), brute(set(nodes), edges, sources, 3))
            ranks = spark.createDataFrame([(1, 1, 1.0)], "source bigint, node bigint, p double")
            joined = pagerank._at_moves(ranks, pagerank._held(saved))._jdf.queryExecution().executedPlan().toString()
            assert joined.count("Exchange hashpartitioning") == 1  # that of the ranks
        spark.sql("DROP TABLE saved_graph")
        spark.sql("DROP TABLE saved_graph_hot")


def test_logs_equal_linear_ranks_and_go_below_them(spark):
    nodes, edges = random_graph(11)
    tables = graph(spark, nodes, edges)
    logs = ppr_logs(*tables, [1, 3], 4).selectExpr("source", "node", "exp(log_p) AS p")
    same(logs, brute(set(nodes), edges, [1, 3], 4))
    chain = [(i, i + 1) for i in range(25)]
    tables = graph(spark, range(26), chain)
    alpha = 1 - 2.0**-50
    linear = as_dict(ppr(*tables, [0], 24, alpha=alpha), "source", "node")
    found = as_dict(ppr_logs(*tables, [0], 24, alpha=alpha), "source", "node")
    assert linear[0, 24] == 0 and found[0, 24] == pytest.approx(-50 * 24 * math.log(2), rel=1e-12)
    assert found[0, 0] == pytest.approx(0, abs=1e-12)


def test_log_sum_exp(spark):
    rows = [(1, -2000.0), (1, -2000.0), (1, -5000.0), (2, 800.0), (2, 799.0), (3, float("-inf")), (3, None), (4, 0.0)]
    found = as_dict(log_sum_exp(spark.createDataFrame(rows, "k int, l double"), ["k"], "l"), "k")
    assert found == {
        1: pytest.approx(-2000 + math.log(2)),
        2: pytest.approx(800 + math.log1p(math.exp(-1))),
        4: 0.0,
    }


# The published best ten nodes of three sources on the small graph, and after how many iterations.
PUBLISHED = {
    (9470136, 19): """9470136 0.38841224
7992850 0.09422297
7891871 0.08589738
10208640 0.08066668
9427340 0.06607274
8747858 0.06607274
8702415 0.035442345
8669492 0.031823438
7970234 0.022452628
8846238 0.016921291""",
    (9300650, 20): """9300650 0.44688183
10765057 0.091079235
9074395 0.08888377
10687744 0.075968415
9621997 0.075968415
8832646 0.075968415
10448801 0.015560566
9785148 0.015110979
11890488 0.0151108205
10369305 0.0151108205""",
    (10207721, 20): """10207721 0.38493827
11775232 0.07980563
12787320 0.076640494
12876259 0.06565022
10541592 0.06543003
8642164 0.06543003
8669492 0.022244994
10940674 0.019633085
10867785 0.019114291
9619639 0.018150235""",
}
# A folder with the small graph as text: a node, and its neighbours in the last brackets of the line.
SMALL_GRAPH = os.environ.get("TEXTGRAPH_SMALL_GRAPH")


@pytest.mark.skipif(not SMALL_GRAPH, reason="TEXTGRAPH_SMALL_GRAPH names no graph")
def test_published_top_nodes(spark):
    lines = spark.read.text(SMALL_GRAPH)
    records = lines.select(
        F.regexp_extract("value", r"^(\d+)", 1).cast("bigint").alias("node"),
        F.expr(r"cast(regexp_extract_all(regexp_extract(value, r'\[([^\[]*)\]\}$', 1), r'(\d+)') as array<bigint>)").alias("to"),
    )
    nodes, edges = records.select("node"), records.select(F.col("node").alias("src"), F.explode("to").alias("dst"))
    for (source, iterations), told in PUBLISHED.items():
        found = top_k_per_source(ppr(nodes, edges, sources=[source], iterations=iterations), k=10).orderBy("rank").collect()
        expected = [line.split() for line in told.splitlines()]
        assert [r["node"] for r in found] == [int(node) for node, _ in expected]
        assert [r["p"] for r in found] == pytest.approx([float(p) for _, p in expected], abs=1e-6)
