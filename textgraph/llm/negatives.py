"""Hard negatives of embeddings, found in a multiway hyperplane tree with distance ranges (GNAT).

A node of the tree has some split points; a row belongs to the subtree of the nearest one. For each split point the
node knows the least and the greatest distance to the rows of every sibling's subtree. A search has a window of
scores (inner products), which for a subtree is an annulus of distances around the anchor; where a sibling's range
about any split point and the annulus widened by the anchor's own distance do not meet, the sibling is passed over.
In the leaves that are left, all rows are scored.

The tree is fitted on a bounded sample and holds every row. Its leaves are dealt out as blocks of bounded size; a
block's rows are held while the anchors that have to look at it stream by.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.durable import durable

# Fixed values of the contract: parts of a unit, rows chosen, and the window in hundredths of a positive's score.
SCALE, POSITIVES, NEGATIVES, WINDOW, ANCHOR_EVERY = 256, 5, 5, (80, 100), 100
# Rows the tree is fitted on, split points of a node, rows a leaf is meant to have, rows of a block.
FIT_ROWS, FANOUT, LEAF_ROWS, BLOCK_ROWS = 4096, 8, 2048, 8192
# A component is at most so large, so that products stay whole numbers of 64 bits.
LARGEST = 1 << 23
# Room for rounding of distances, as a part of their squares.
SLACK = 1e-9

INDEX = "leaf int, vec_id bigint, label bigint, vector binary, node int, split int, child int, low bigint, high bigint"


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two whole-number matrices, exact."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = int(np.abs(a).max()) * int(np.abs(b).max()) * a.shape[1]
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def squares(a: np.ndarray) -> np.ndarray:
    wide = a.astype(np.int64)
    return (wide * wide).sum(axis=1)


def square_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return squares(a)[:, None] + squares(b)[None, :] - 2 * products(a, b)


@dataclass
class Node:
    """Split points, and for each the child: a node's number, or -1 - leaf."""

    points: np.ndarray
    children: list[int]


@dataclass
class Tree:
    """Nodes in order, the first the root; with ranges known, of each node ``low`` and ``high`` [split, child] of
    square distances, and ``least`` and ``most`` [child] of square lengths; a child without rows has an empty range."""

    nodes: list[Node]
    leaves: int
    low: list[np.ndarray] | None = None
    high: list[np.ndarray] | None = None
    least: list[np.ndarray] | None = None
    most: list[np.ndarray] | None = None


def fit(sample: np.ndarray, leaf: int, fanout: int = FANOUT) -> Tree:
    """A tree whose leaves have about ``leaf`` rows of the sample; split points lie far from each other."""
    tree = Tree([], 0)

    def grow(rows: np.ndarray) -> int:
        chosen = [0]
        if len(rows) > leaf:
            near = square_distances(rows, rows[:1])[:, 0]
            while len(chosen) < fanout and near.max() > 0:
                chosen.append(int(near.argmax()))
                near = np.minimum(near, square_distances(rows, rows[chosen[-1:]])[:, 0])
        if len(chosen) < 2:
            tree.leaves += 1
            return -tree.leaves
        node, points = len(tree.nodes), rows[chosen]
        tree.nodes.append(Node(points, []))
        home = square_distances(rows, points).argmin(axis=1)
        for child in range(len(chosen)):
            tree.nodes[node].children.append(grow(rows[home == child]))
        return node

    if grow(sample) < 0:
        tree.nodes, tree.leaves = [], 1
    return tree


def _placed(tree: Tree, vectors: np.ndarray) -> tuple[np.ndarray, list[tuple]]:
    """The leaf of each vector, and ``(node, split, child, low, high)`` of square distances, split -1 for square lengths."""
    leaf, ranges = np.zeros(len(vectors), np.int64), []
    waiting = [(0, np.arange(len(vectors)))] if tree.nodes else []
    lengths = squares(vectors)
    while waiting:
        number, rows = waiting.pop()
        node = tree.nodes[number]
        away = square_distances(vectors[rows], node.points)
        home = away.argmin(axis=1)
        for child, to in enumerate(node.children):
            mine = home == child
            if not mine.any():
                continue
            low, high = away[mine].min(axis=0), away[mine].max(axis=0)
            ranges += [(number, split, child, int(low[split]), int(high[split])) for split in range(len(node.points))]
            ranges.append((number, -1, child, int(lengths[rows[mine]].min()), int(lengths[rows[mine]].max())))
            if to < 0:
                leaf[rows[mine]] = -1 - to
            else:
                waiting.append((to, rows[mine]))
    return leaf, ranges


def ranged(tree: Tree, ranges: list[tuple]) -> Tree:
    """The tree with the ranges of all its rows."""
    tree.low = [np.full((len(n.points),) * 2, np.inf) for n in tree.nodes]
    tree.high = [np.full((len(n.points),) * 2, -np.inf) for n in tree.nodes]
    tree.least = [np.full(len(n.points), np.inf) for n in tree.nodes]
    tree.most = [np.full(len(n.points), -np.inf) for n in tree.nodes]
    for node, split, child, low, high in ranges:
        if split < 0:
            tree.least[node][child], tree.most[node][child] = low, high
        else:
            tree.low[node][split, child], tree.high[node][split, child] = low, high
    return tree


def surviving(tree: Tree, anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """``(leaf, anchors)``: the anchors that have to look into a leaf for scores in any of their windows [low, high].

    ``low`` and ``high`` have a row for each anchor and a column for each window; an empty window is low > high.
    """
    if not tree.nodes:
        yield 0, np.flatnonzero((low <= high).any(axis=1))
        return
    lengths = squares(anchors).astype(np.float64)
    waiting = [(0, np.flatnonzero((low <= high).any(axis=1)))]
    while waiting:
        number, rows = waiting.pop()
        node = tree.nodes[number]
        if not len(rows):
            continue
        away = np.sqrt(square_distances(anchors[rows], node.points).astype(np.float64))
        for child, to in enumerate(node.children):
            if tree.most[number][child] < 0:
                continue  # no row of the table is there
            near, far = np.sqrt(tree.low[number][:, child]), np.sqrt(tree.high[number][:, child])
            least = np.maximum(np.maximum(away - far, near - away), 0).max(axis=1)
            most = (away + far).min(axis=1)
            room = SLACK * (lengths[rows] + tree.most[number][child]) + 1
            best = (lengths[rows] + tree.most[number][child] - least**2) / 2 + room
            worst = (lengths[rows] + tree.least[number][child] - most**2) / 2 - room
            meets = (low[rows] <= high[rows]) & (low[rows] <= best[:, None]) & (high[rows] >= worst[:, None])
            left = rows[meets.any(axis=1)]
            if to >= 0:
                waiting.append((to, left))
            elif len(left):
                yield -1 - to, left


def first(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores in order, the earlier place first among equals."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > least)
        places = np.r_[above, np.flatnonzero(scores == least)[: k - len(above)]]
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((places, -scores[places]))]


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int32).reshape(len(column), size)


def _windows(column: pa.Array) -> np.ndarray:
    """A row of whole numbers for each anchor, all of one length."""
    rows = [np.frombuffer(v, np.int64) for v in column.to_pylist()]
    return np.array(rows, np.int64).reshape(len(rows), -1)


EVERY = np.int64(1) << 62
# What a search looks for: rows of the anchor's label, or of others.
SAME, OTHER = "same", "other"


def _router(shared, kind: str, size: int, k: int):
    """Each anchor once for every block that it has to look at, with its windows as narrow as the sample makes them."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, blocks, sample, sample_ids, sample_labels = shared.value
        sample_keys = np.array([EVERY if i is None else i for i in sample_ids], np.int64)
        for batch in batches:
            vectors = _matrix(batch["vector"], size)
            labels, ids = batch["label"].to_numpy(), batch["vec_id"].to_numpy()
            low, high = _windows(batch["low"]).copy(), _windows(batch["high"])
            scores = products(vectors, sample)
            for a in range(len(vectors)):
                fits = (sample_labels == labels[a]) & (sample_keys != ids[a]) if kind == SAME else sample_labels != labels[a]
                found = scores[a][fits]
                for w in range(low.shape[1]):
                    inside = found[(found >= low[a, w]) & (found <= high[a, w])]
                    if len(inside) >= k:  # so many rows have this score or a higher one
                        low[a, w] = np.partition(inside, len(inside) - k)[len(inside) - k]
            for leaf, rows in surviving(tree, vectors, low, high):
                start, stop = blocks[leaf]
                for block in range(start, stop):
                    for i in range(0, len(rows), 1024):
                        part = rows[i : i + 1024]
                        taken = batch.take(pa.array(part))
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(part), block), pa.int64()),
                                pa.array(np.ones(len(part)), pa.int32()),
                                taken["query"],
                                taken["vec_id"],
                                taken["label"],
                                taken["vector"],
                                pa.array([r.tobytes() for r in low[part]], pa.binary()),
                                taken["high"],
                            ],
                            names=["block", "kind", "query", "vec_id", "label", "vector", "low", "high"],
                        )

    return route


def _searcher(kind: str, size: int, k: int):
    """Rows come sorted by block, a block's own rows before the anchors that look at it. All of a block's rows are scored."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts, held = None, [], None
        for batch in batches:
            blocks, kinds = batch["block"].to_numpy(), batch["kind"].to_numpy()
            cut = np.flatnonzero(np.r_[True, (blocks[1:] != blocks[:-1]) | (kinds[1:] != kinds[:-1])]) if len(blocks) else []
            for at, end in zip(cut, [*cut[1:], len(blocks)]):
                if blocks[at] != block:
                    block, parts, held = blocks[at], [], None
                part = batch.slice(at, end - at)
                if kinds[at] == 0:
                    parts.append((_matrix(part["vector"], size), part["label"].to_numpy(), part["vec_id"].to_pylist()))
                    continue
                if not parts:
                    continue
                if held is None:
                    held = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), [i for p in parts for i in p[2]]
                    keys = np.array([EVERY if i is None else i for i in held[2]], np.int64)
                vectors, labels, ids = held
                for i in range(0, len(part), 256):
                    some = part.slice(i, 256)
                    scores = products(_matrix(some["vector"], size), vectors)
                    low, high = _windows(some["low"]), _windows(some["high"])
                    out: list[tuple] = []
                    for a, (query, own, own_id) in enumerate(zip(some["query"].to_pylist(), some["label"].to_pylist(), some["vec_id"].to_pylist())):
                        fits = np.flatnonzero((labels == own) & (keys != own_id) if kind == SAME else labels != own)
                        mine = scores[a][fits]
                        for w in range(low.shape[1]):
                            inside = np.flatnonzero((mine >= low[a, w]) & (mine <= high[a, w]))
                            for place in inside[first(mine[inside], k)].tolist():
                                out.append((query, w, ids[fits[place]], int(mine[place])))
                    columns = zip(*out) if out else [[]] * 4
                    kinds_ = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds_)], names=["query", "window", "other_id", "score"])

    return search


def _indexer(shared, size: int):
    """Rows with their leaves; after them, the task's ranges."""
    names = [c.split()[0] for c in INDEX.split(", ")]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared.value
        met: dict[tuple[int, int, int], tuple[int, int]] = {}
        for batch in batches:
            values, sizes = batch["vector"].flatten().to_numpy(), batch["vector"].value_lengths().to_numpy()
            vectors = np.zeros((len(sizes), size), np.int32)
            row = np.repeat(np.arange(len(sizes)), sizes)
            vectors[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
            leaf, ranges = _placed(tree, vectors)
            for *key, low, high in ranges:
                before = met.get(tuple(key), (low, high))
                met[tuple(key)] = min(before[0], low), max(before[1], high)
            empty = [pa.nulls(len(leaf), t) for t in types[4:]]
            told = pa.array([v.tobytes() for v in vectors], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int32()), batch["vec_id"], batch["label"], told, *empty], names=names)
        columns = list(zip(*((*key, *span) for key, span in met.items()))) if met else [[]] * 5
        empty = [pa.nulls(len(met), t) for t in types[:4]]
        yield pa.RecordBatch.from_arrays([*empty, *(pa.array(c, t) for c, t in zip(columns, types[4:]))], names=names)

    return index


def _whole(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component."""
    parts = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    large = F.exists(parts, lambda x: F.abs(x) > LARGEST)
    return F.when(large, F.raise_error(F.lit(f"a component is beyond {LARGEST}")).cast("array<bigint>")).otherwise(parts)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query", "window").orderBy(F.desc("score"), F.asc_nulls_last("other_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str | Column = "label",
    anchor_every: int = ANCHOR_EVERY,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    window: tuple[int, int] = WINDOW,
    scale: int = SCALE,
    fit_rows: int = FIT_ROWS,
    leaf_rows: int = LEAF_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``<anchor_id, positive_id, rank, negative_id, positive_score, negative_score>``.

    Components become ``floor(scale * x)``; a score is the inner product of two rows, the shorter one filled up with
    zeros. Anchors are the rows whose id is divisible by ``anchor_every``. Positives of an anchor are the first
    ``positives`` rows of its label with another id; of each, the negatives are the first ``negatives`` rows of
    other labels whose score lies in ``window``, in hundredths of the positive's. First are higher scores, then
    smaller ids. Results are exact.

    Rows without label or vector, or with a null, infinite or NaN component take no part. A row without an id is no
    anchor; as a positive or negative it comes after others of its score. Each row is a candidate of its own, also
    one that repeats an id; of anchors that are alike in id, label and vector, one is asked. A component beyond
    2**23 after scaling is an error. Columns besides the three named are not read.

    The tree is fitted on the ``fit_rows`` rows of least hash, its only bound on rows; it has about one leaf for
    ``leaf_rows`` rows, as far as the sample has rows to tell leaves apart, and larger leaves are dealt out as
    blocks of ``block_rows``. Rows move once for each of the two searches, anchors to the blocks they look at.
    """
    spark: SparkSession = rows.sparkSession
    named = rows.select(F.col(vec_id).cast("bigint").alias("vec_id"), (F.col(label) if isinstance(label, str) else label).cast("bigint").alias("label"), F.col(vector).alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    usable = named.filter(F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)
    whole = usable.select("vec_id", "label", _whole(F.col("vector"), scale).alias("vector"))
    count, size = whole.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    taken = whole.orderBy(F.xxhash64("vec_id", "vector", "label"), "vec_id").limit(fit_rows).collect()
    sample = np.zeros((len(taken), size), np.int32)
    for i, r in enumerate(taken):
        sample[i, : len(r.vector)] = r.vector
    tree = fit(sample, max(4, len(taken) * leaf_rows // max(1, count)))
    index = durable(whole.mapInArrow(_indexer(spark.sparkContext.broadcast(tree), size), INDEX), "index")
    ranges = index.filter("node IS NOT NULL").groupBy("node", "split", "child").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    tree = ranged(tree, [tuple(r) for r in ranges.collect()])
    index = index.filter("node IS NULL").select("leaf", "vec_id", "label", "vector")
    blocks, start = {}, 0
    for leaf, n in sorted(tuple(r) for r in index.groupBy("leaf").count().collect()):
        blocks[leaf] = (start, start + -(-n // block_rows))
        start = blocks[leaf][1]
    known = spark.createDataFrame([(leaf, a, b - a) for leaf, (a, b) in blocks.items()], "leaf int, start bigint, blocks bigint")
    # Any place will do for a row of a leaf: those of equal vectors are dealt out like others.
    place = F.col("start") + F.pmod(F.monotonically_increasing_id(), F.col("blocks"))
    dealt = index.join(F.broadcast(known), "leaf").select(place.alias("block"), "vec_id", "label", "vector")
    shared = spark.sparkContext.broadcast((tree, blocks, sample, [r.vec_id for r in taken], np.array([r.label for r in taken], np.int64)))

    def searched(asked: DataFrame, kind: str, k: int) -> DataFrame:
        schema = "block bigint, kind int, query bigint, vec_id bigint, label bigint, vector binary, low binary, high binary"
        queries = asked.mapInArrow(_router(shared, kind, size, k), schema)
        nothing = F.lit(None)
        held = dealt.select("block", F.lit(0).alias("kind"), nothing.cast("bigint").alias("query"), "vec_id", "label", "vector", nothing.cast("binary").alias("low"), nothing.cast("binary").alias("high"))
        met = held.unionByName(queries).repartition("block").sortWithinPartitions("block", "kind", F.asc_nulls_last("vec_id"))
        found = met.mapInArrow(_searcher(kind, size, k), "query bigint, window int, other_id bigint, score bigint")
        return _best(found, k)

    asked = index.filter(F.col("vec_id") % anchor_every == 0).select("vec_id", "label", "vector").distinct()
    anchors = durable(asked.withColumn("query", F.monotonically_increasing_id()), "anchors")
    edge = [F.lit(int(e).to_bytes(8, "little", signed=True)) for e in (-EVERY, EVERY)]
    open_ = anchors.select("query", "vec_id", "label", "vector", edge[0].alias("low"), edge[1].alias("high"))
    chosen = durable(searched(open_, SAME, positives).select("query", (F.col("rank") - 1).alias("window"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, high = [], []
            for scores in batch["scores"].to_pylist():
                scores = sorted(scores, reverse=True)
                spans = [(-(-s * window[0] // 100), s * window[1] // 100) for s in scores] + [(1, 0)] * (positives - len(scores))
                low.append(np.array([a for a, _ in spans], np.int64).tobytes())
                high.append(np.array([b for _, b in spans], np.int64).tobytes())
            yield pa.RecordBatch.from_arrays([batch[c] for c in ("query", "vec_id", "label", "vector")] + [pa.array(low, pa.binary()), pa.array(high, pa.binary())], names=["query", "vec_id", "label", "vector", "low", "high"])

    scores = chosen.groupBy("query").agg(F.collect_list("positive_score").alias("scores"))
    narrowed = anchors.join(scores, "query").mapInArrow(bounds, "query bigint, vec_id bigint, label bigint, vector binary, low binary, high binary")
    found = searched(narrowed, OTHER, negatives).select("query", "window", "rank", F.col("other_id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = chosen.join(anchors.select("query", F.col("vec_id").alias("anchor_id")), "query")
    return found.join(named, ["query", "window"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
