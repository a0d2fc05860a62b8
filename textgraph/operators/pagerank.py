"""Personalized PageRank from several sources at once, over ``nodes<node>`` and ``edges<src, dst>``.

Ranks are sparse, ``<source, node, p>``: a node without mass from a source has no row.

Of a source's mass, the part at a node without out-edges, and the part sent to targets without a record,
return to the source; then the source gets ``alpha`` and everything else shrinks by ``1 - alpha``. As what is
lost only depends on where the mass is, it is modelled as one more edge "to the source" of a node. So an
iteration is one join and one aggregation, needs no total over all nodes, and refers to its input once.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import score_text
from ..plans.durable import durable
from ..plans.skew import HEAD_KEYS, lookup_join
from .graph import checked_nodes, in_degrees, missing_nodes, out_degrees

# The random jump factor and the number of nodes reported.
ALPHA = 0.15
TOP_K = 100
# Ranks moved along the edges of one node by one task; a node with more edges, times sources, is dealt out to several.
SALT_EDGES = 1_000_000
# Iterations between two lineage cuts.
CUT_EVERY = 5
# Files of a saved graph, each with the moves of its share of the nodes.
BUCKETS = 64
# Log masses that lie in one stretch of this width are added up with their own scale.
STRETCH = 512

Sources = Sequence[int] | DataFrame


@dataclass(frozen=True)
class Transitions:
    """``moves<node, salt, dst, weight>``, where a null dst is "back to the source" and a node's weights add up
    to 1; ``hot<node, salts>``, the nodes (HEAD_KEYS at most) whose moves are dealt out over several salts.

    ``metrics`` are counts that were observed while the graph was prepared. The moves of a ``stored`` graph lie in
    the order in which iterations join them."""

    moves: DataFrame
    hot: DataFrame | None
    metrics: dict[str, int] = field(default_factory=dict)
    stored: bool = False

    @property
    def keys(self) -> list[str]:
        return ["node"] if self.hot is None else ["node", "salt"]


def _observed(df: DataFrame, name: str, **aggregates: Column) -> tuple[DataFrame, dict[str, int]]:
    """``df`` written, and aggregates over it that the write itself has told; no further job."""
    seen = Observation(name)
    out = durable(df.observe(seen, *[a.alias(k) for k, a in aggregates.items()]), name)
    return out, {k: v or 0 for k, v in seen.get.items()}


def source_table(spark: SparkSession, sources: Sources) -> DataFrame:
    """``<pos, source>`` of a list of node ids; a DataFrame that has ``source`` already is taken as it is."""
    if isinstance(sources, DataFrame):
        return sources
    return spark.createDataFrame(list(enumerate(sources)), "pos bigint, source bigint")


def init_ranks(nodes: DataFrame, sources: Sources) -> DataFrame:
    """Probability 1 for each source at its own node; a source that is not a node has no row."""
    table = source_table(nodes.sparkSession, sources).select("source").distinct()
    present = table.join(nodes, F.col("source") == F.col("node"), "left_semi")
    return present.select("source", F.col("source").alias("node"), F.lit(1.0).alias("p"))


def transitions(nodes: DataFrame, edges: DataFrame, salt_edges: int = SALT_EDGES) -> Transitions:
    """Prepare a graph for iterating. Both joins of the edges, on either end, stand hot nodes.

    Repeated edges are added up first, so that no copies of one edge meet in a task. A second record of a node is
    an error.
    """
    nodes, told_nodes = _observed(checked_nodes(nodes), "nodes", nodes=F.count("*"))
    repeated = durable(edges.groupBy("src", "dst").agg(F.count("*").alias("m")), "edges")
    sent = repeated.groupBy(F.col("src").alias("node")).agg(F.sum("m").alias("degree"))
    degrees, told_edges = _observed(sent.join(nodes, "node", "left_semi"), "degrees", edges=F.sum("degree"), active=F.count("*"))
    known = nodes.withColumn("known", F.lit(True))
    aims = repeated.groupBy(F.col("dst").alias("node")).agg(F.count("*").alias("messages"), F.sum("m").alias("edges"))
    targets, told_targets = _observed(
        aims.join(known, "node", "left"),
        "targets",
        mass_messages_received=F.sum(F.when(F.col("known"), F.col("edges"))),
        missing_structure=F.count_if(F.col("known").isNull()),
    )
    targets = targets.drop("edges")
    metrics = {**told_nodes, **told_edges, "mass_messages": told_edges["edges"], **told_targets}
    aimed = lookup_join(repeated.withColumnRenamed("dst", "node"), targets, "node", "messages").select(
        F.col("src").alias("node"),
        F.xxhash64("node").alias("deal"),
        F.when(F.col("known"), F.col("node")).alias("dst"),
        "m",
    )
    total = degrees.agg(F.sum("degree")).first()[0] or 0
    per_salt = max(salt_edges, -(-total // HEAD_KEYS))
    salts = F.ceil(F.col("degree") / per_salt).cast("int")
    along_edges = lookup_join(aimed, degrees, "node", "degree").select(
        "node", F.pmod("deal", salts).cast("int").alias("salt"), "dst", (F.col("m") / F.col("degree")).alias("weight")
    )
    from_dead_ends = nodes.join(degrees, "node", "left_anti").select(
        "node", F.lit(0).alias("salt"), F.lit(None).cast("bigint").alias("dst"), F.lit(1.0).alias("weight")
    )
    hot = degrees.filter(F.col("degree") > per_salt).select("node", salts.alias("salts"))
    has_hot = bool(hot.limit(1).collect())
    return Transitions(durable(along_edges.union(from_dead_ends), "moves"), hot if has_hot else None, metrics)


def save_transitions(graph: Transitions, name: str, buckets: int = BUCKETS, path: str | None = None) -> None:
    """Drop and recreate the catalog tables ``name`` and ``name_hot``: a prepared graph in join order.

    The moves are bucketed and sorted by the keys of an iteration's join, so that later runs, in other sessions too,
    neither prepare nor shuffle them again. ``path`` is where the files go if not to the warehouse.
    """
    keys = graph.keys
    moves = graph.moves.repartition(buckets, *keys).sortWithinPartitions(*keys)
    hot = graph.hot if graph.hot is not None else graph.moves.sparkSession.createDataFrame([], "node bigint, salts int")
    for table, df, where in ((name, moves.write.bucketBy(buckets, *keys).sortBy(*keys), "moves"), (f"{name}_hot", hot.write, "hot")):
        writer = df.mode("overwrite").format("parquet")
        (writer.option("path", f"{path}/{where}") if path else writer).saveAsTable(table)


def load_transitions(spark: SparkSession, name: str) -> Transitions:
    """A graph saved by :func:`save_transitions`."""
    hot = spark.table(f"{name}_hot")
    return Transitions(spark.table(name), None if hot.isEmpty() else hot, stored=True)


def _at_moves(ranks: DataFrame, graph: Transitions) -> DataFrame:
    """Each rank with its node's moves; that of a hot node goes to every salt.

    ``merge`` joins in the order in which the moves are held.
    """
    if graph.hot is None:
        return ranks.join(graph.moves.hint("merge"), "node")
    dealt = ranks.join(F.broadcast(graph.hot), "node", "left")
    every = F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)
    return dealt.select("source", "node", "p", F.explode(every).alias("salt")).join(graph.moves.hint("merge"), ["node", "salt"])


def _jumps(sources: DataFrame, ranks: DataFrame | None, alpha: float) -> DataFrame:
    """What each source's node gets besides the moves: ``alpha``, and its share of mass absent from ``ranks``."""
    if ranks is None:
        return sources.select("source", F.col("source").alias("node"), F.lit(alpha).alias("p"))
    totals = ranks.groupBy("source").agg(F.sum("p").alias("total"))
    absent = F.greatest(1 - F.coalesce("total", F.lit(0.0)), F.lit(0.0))
    return sources.join(totals, "source", "left").select(
        "source", F.col("source").alias("node"), (alpha + (1 - alpha) * absent).alias("p")
    )


def _advance(ranks: DataFrame, graph: Transitions, jumps: DataFrame, alpha: float, seen: Observation | None = None) -> DataFrame:
    """An iteration; ``seen`` observes how many ranks moved along edges and back to their sources."""
    at_moves = _at_moves(ranks, graph)
    if seen is not None:
        at_moves = at_moves.observe(seen, F.count("dst").alias("moved"), F.count_if(F.col("dst").isNull()).alias("returned"))
    moved = at_moves.select(
        "source",
        F.coalesce("dst", "source").alias("node"),
        (F.col("p") * F.col("weight") * (1 - alpha)).alias("p"),
    )
    return moved.unionByName(jumps).groupBy("source", "node").agg(F.sum("p").alias("p"))


def _present(nodes: DataFrame, sources: Sources) -> DataFrame:
    return durable(init_ranks(nodes, sources), "sources").select("source")


def _prepared(nodes: DataFrame, edges: DataFrame, present: DataFrame, salt_edges: int) -> Transitions:
    """A graph whose hot nodes are dealt out the finer, the more sources may reach them: a task moves at most about
    ``salt_edges`` ranks of one node, over all sources."""
    return transitions(nodes, edges, max(1, salt_edges // max(1, present.count())))


def ppr_step(
    nodes: DataFrame,
    edges: DataFrame,
    ranks: DataFrame,
    sources: Sources,
    alpha: float = ALPHA,
    salt_edges: int = SALT_EDGES,
) -> DataFrame:
    """One iteration from any ``ranks``; mass a source's ranks lack up to 1 goes to the source."""
    present = _present(nodes, sources)
    return _advance(ranks, _prepared(nodes, edges, present, salt_edges), _jumps(present, ranks, alpha), alpha)


def _held(graph: Transitions) -> Transitions:
    """The moves in join order, so that no iteration shuffles them again: as they are stored, or kept by the executors."""
    if graph.stored:
        return graph
    parts = int(graph.moves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = graph.moves.repartition(parts, *graph.keys).sortWithinPartitions(*graph.keys)
    return Transitions(ordered.persist(StorageLevel.MEMORY_AND_DISK), graph.hot)


def _let_go(held: Transitions) -> None:
    if not held.stored:
        held.moves.unpersist()


def ppr(
    nodes: DataFrame,
    edges: DataFrame | None,
    sources: Sources,
    iterations: int,
    alpha: float = ALPHA,
    salt_edges: int = SALT_EDGES,
    cut_every: int = CUT_EVERY,
    graph: Transitions | None = None,
) -> DataFrame:
    """``<source, node, p>`` after ``iterations`` steps from the sources' own nodes; a ``graph`` stands for the edges."""
    present = _present(nodes, sources)
    jumps = _jumps(present, None, alpha)
    ranks = init_ranks(nodes, present)
    held = _held(graph or _prepared(nodes, edges, present, salt_edges))
    for done in range(1, iterations + 1):
        ranks = _advance(ranks, held, jumps, alpha)
        if done % cut_every == 0 or done == iterations:
            ranks = durable(ranks, f"ranks{done}")
    _let_go(held)
    return ranks


def _snapshot(base: str, iteration: int) -> str:
    # Fixed value: the name of an iteration's snapshot.
    return f"{base}/iter{iteration:04d}"


def _described(present: DataFrame, graph: Transitions, alpha: float) -> dict:
    """What tells a run's sources, graph and alpha from those of another run."""

    def summed(df: DataFrame, name: str, *columns: str) -> dict:
        # Sums of parts of the hashes: no repeated row cancels another, and nothing overflows.
        part = F.pmod(F.xxhash64(*columns), F.lit((1 << 31) - 1))
        return df.agg(F.count("*").alias(name), F.coalesce(F.sum(part), F.lit(0)).alias(f"{name}_hash")).first().asDict()

    return {**summed(present, "sources", "source"), **summed(graph.moves, "moves", "node", "dst", "weight"), "alpha": float(alpha)}


def _finished(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def _resumed(spark: SparkSession, base: str, start: int, described: dict) -> None:
    """An error unless snapshot ``start`` is whole and comes from a run with the same sources, graph and alpha."""
    try:
        before = spark.read.parquet(f"{base}/manifest").first()
    except AnalysisException:
        before = None
    if before is None:
        raise ValueError(f"{base} has no manifest of an earlier run")
    other = [c for c in described if described[c] != before[c]]
    if other:
        raise ValueError(f"{base} comes from a run with other {', '.join(other)}")
    if not _finished(spark, _snapshot(base, start)):
        raise ValueError(f"snapshot {start} in {base} is absent or unfinished")


def run_ppr(
    base: str,
    nodes: DataFrame,
    edges: DataFrame | None,
    sources: Sources,
    start: int,
    end: int,
    alpha: float = ALPHA,
    salt_edges: int = SALT_EDGES,
    graph: Transitions | None = None,
    metrics: list[dict] | None = None,
) -> DataFrame:
    """Iterate from snapshot ``start`` to ``end`` under ``base``, writing each, and return the last.

    Start 0 writes a manifest of the sources, the graph and alpha, and the initial snapshot. A later start goes on
    from what an earlier run left there; a ``ValueError`` says so if that run was another one or the snapshot is not
    whole. A ``graph``, stored or prepared, stands for the edges.

    To ``metrics`` a row is added for each iteration, observed by the iteration's own write: ``moved`` and
    ``returned``, the ranks that went along edges and back to their sources, ``ranks`` and ``mass``, the rows and sum
    of what came out, and where the graph was prepared by this run, its ``nodes``, ``edges``, ``active`` nodes,
    ``mass_messages``, ``mass_messages_received`` and ``missing_structure``.
    """
    spark = nodes.sparkSession
    present = _present(nodes, sources)
    graph = graph or _prepared(nodes, edges, present, salt_edges)
    described = _described(present, graph, alpha)
    if start == 0:
        row = spark.createDataFrame([tuple(described.values())], "sources bigint, sources_hash bigint, moves bigint, moves_hash bigint, alpha double")
        row.write.mode("overwrite").parquet(f"{base}/manifest")
        init_ranks(nodes, present).write.mode("overwrite").parquet(_snapshot(base, 0))
    else:
        _resumed(spark, base, start, described)
    ranks = spark.read.parquet(_snapshot(base, start))
    held = _held(graph)
    for i in range(start, end):
        jumps = _jumps(present, ranks if i == start else None, alpha)
        sent, made = Observation(f"sent{i + 1}"), Observation(f"made{i + 1}")
        step = _advance(ranks, held, jumps, alpha, sent).observe(made, F.count("*").alias("ranks"), F.sum("p").alias("mass"))
        step.write.mode("overwrite").parquet(_snapshot(base, i + 1))
        if metrics is not None:
            metrics.append({"iteration": i + 1, **graph.metrics, **sent.get, **made.get})
        ranks = spark.read.parquet(_snapshot(base, i + 1))
    _let_go(held)
    return ranks


def log_sum_exp(df: DataFrame, keys: Sequence[str], log: str) -> DataFrame:
    """``<keys, log>``: the log of the sum of what the logs of each key stand for; none of them is ever turned into a
    number that is too small or too large.

    Logs are added up in stretches of fixed width, each scaled by its own upper end, with partial sums before the
    shuffle; then the few stretches of a key are scaled by the highest. Minus infinity and null are no mass.
    """
    stretch = F.ceil(F.col(log) / STRETCH)
    parts = (
        df.filter(F.col(log) > float("-inf"))
        .groupBy(*keys, stretch.alias("_stretch"))
        .agg(F.sum(F.exp(F.col(log) - stretch * STRETCH)).alias("_sum"))
        .groupBy(*keys)
        .agg(F.max("_stretch").alias("_top"), F.collect_list(F.struct("_stretch", "_sum")).alias("_parts"))
    )
    scaled = F.transform("_parts", lambda p: p["_sum"] * F.exp((p["_stretch"] - F.col("_top")).cast("double") * STRETCH))
    total = F.aggregate(scaled, F.lit(0.0), lambda a, b: a + b)
    return parts.select(*keys, (F.ln(total) + F.col("_top") * STRETCH).alias(log))


def ppr_logs(
    nodes: DataFrame,
    edges: DataFrame | None,
    sources: Sources,
    iterations: int,
    alpha: float = ALPHA,
    salt_edges: int = SALT_EDGES,
    cut_every: int = CUT_EVERY,
    graph: Transitions | None = None,
) -> DataFrame:
    """``<source, node, log_p>`` as :func:`ppr`, in natural logs throughout: masses below the smallest double stay apart from none."""
    present = _present(nodes, sources)
    kept = math.log1p(-alpha) if alpha < 1 else float("-inf")
    jumps = present.select("source", F.col("source").alias("node"), F.lit(math.log(alpha) if alpha > 0 else float("-inf")).alias("log_p"))
    ranks = init_ranks(nodes, present).select("source", "node", F.lit(0.0).alias("log_p"))
    held = _held(graph or _prepared(nodes, edges, present, salt_edges))
    for done in range(1, iterations + 1):
        moved = _at_moves(ranks.withColumnRenamed("log_p", "p"), held)
        moved = moved.select("source", F.coalesce("dst", "source").alias("node"), (F.col("p") + F.ln("weight") + kept).alias("log_p"))
        ranks = log_sum_exp(moved.unionByName(jumps), ["source", "node"], "log_p")
        if done % cut_every == 0 or done == iterations:
            ranks = durable(ranks, f"logs{done}")
    _let_go(held)
    return ranks


def _losses(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``<node, loss>``: the part of its mass a node cannot hand on to nodes with a record, where there is any."""
    nodes = durable(checked_nodes(nodes), "nodes")
    absent = durable(missing_nodes(nodes, edges), "missing")
    astray = lookup_join(edges.withColumnRenamed("dst", "node"), absent, "node", "messages")
    lost = astray.groupBy(F.col("src").alias("node")).agg(F.count("*").alias("lost"))
    shares = out_degrees(edges).join(lost, "node").select("node", (F.col("lost") / F.col("degree")).alias("loss"))
    dead_ends = nodes.join(out_degrees(edges), "node", "left_anti").select("node", F.lit(1.0).alias("loss"))
    return shares.union(dead_ends)


def total_mass(nodes: DataFrame, edges: DataFrame, ranks: DataFrame, sources: Sources) -> DataFrame:
    """``<source, total, missing>`` of one distribution of ``ranks`` along the edges, before any jump.

    A node's loss is one number, so ranks meet nodes only, not edges.
    """
    kept = F.col("p") * (1 - F.coalesce("loss", F.lit(0.0)))
    totals = ranks.join(_losses(nodes, edges), "node", "left").groupBy("source").agg(F.sum(kept).alias("total"))
    asked = source_table(nodes.sparkSession, sources).select("source").distinct().join(totals, "source", "left")
    total = F.coalesce("total", F.lit(0.0))
    return asked.select("source", total.alias("total"), F.greatest(1 - total, F.lit(0.0)).alias("missing"))


def iteration_metrics(nodes: DataFrame, edges: DataFrame, ranks: DataFrame) -> DataFrame:
    """``<metric, value>`` of one iteration.

    nodes and edges; mass_messages sent, one per edge of a node with a record; messages received by nodes with a
    record; missing_structure, the targets without one; active_with_mass, nodes of ``ranks`` with out-edges.
    """
    degrees = out_degrees(edges)
    sent = nodes.join(degrees, "node", "left").agg(
        F.count("*").alias("nodes"), F.coalesce(F.sum("degree"), F.lit(0)).alias("edges")
    )
    targets = in_degrees(edges).join(nodes.withColumn("known", F.lit(True)), "node", "left")
    received = targets.agg(
        F.coalesce(F.sum(F.when(F.col("known"), F.col("messages"))), F.lit(0)).alias("mass_messages_received"),
        F.count_if(F.col("known").isNull()).alias("missing_structure"),
    )
    holding = ranks.select("node").distinct().join(degrees, "node").agg(F.count("*").alias("active_with_mass"))

    def rows(table: DataFrame) -> DataFrame:
        return table.unpivot([], table.columns, "metric", "value")

    sent = sent.withColumn("mass_messages", F.col("edges"))
    return rows(sent).union(rows(received)).union(rows(holding))


def log_mass(ranks: DataFrame) -> DataFrame:
    """``<source, node, log_p>``: natural logs; no mass is no row rather than minus infinity."""
    return ranks.filter(F.col("p") > 0).select("source", "node", F.ln("p").alias("log_p"))


def from_log_mass(logs: DataFrame) -> DataFrame:
    """Ranks of log masses; minus infinity is no row."""
    return logs.filter(F.col("log_p") > float("-inf")).select("source", "node", F.exp("log_p").alias("p"))


def top_k(ranks: DataFrame, k: int = TOP_K) -> DataFrame:
    """The ``k`` rows of highest probability, the higher node first among equals."""
    return ranks.orderBy(F.desc("p"), F.desc("node")).limit(k)


def top_k_per_source(ranks: DataFrame, k: int = TOP_K) -> DataFrame:
    """``<source, rank, node, p>``: each source's ``k`` best nodes, all sources in one job.

    Spark keeps a task's own best ``k`` before the shuffle; for a ``k`` beyond its limit for that, the best of
    as many shares of each source as there are shuffle partitions are taken first, which is exact too.
    """
    conf = ranks.sparkSession.conf
    limit = int(conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    best = [F.desc("p"), F.desc("node")]
    if k > limit:
        share = F.pmod(F.xxhash64("node"), F.lit(int(conf.get("spark.sql.shuffle.partitions"))))
        in_share = F.row_number().over(W.partitionBy("source", share).orderBy(*best))
        ranks = ranks.withColumn("in_share", in_share).filter(F.col("in_share") <= k).drop("in_share")
    ranked = ranks.withColumn("rank", F.row_number().over(W.partitionBy("source").orderBy(*best)))
    return ranked.filter(F.col("rank") <= k).select("source", F.col("rank").cast("bigint").alias("rank"), "node", "p")


def format_top(top: DataFrame) -> DataFrame:
    """Add ``line``: probability with five decimals and node."""
    return top.withColumn("line", score_text(F.col("p"), F.col("node")))


def write_top_k(top: DataFrame, path: str) -> None:
    """One folder a source."""
    top.write.mode("overwrite").partitionBy("source").parquet(path)
