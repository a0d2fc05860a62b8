"""Boolean retrieval: many queries in one pass over the index, answers joined with their texts."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import snippet
from ..plans.durable import durable
from ..plans.sizing import broadcast_if_small
from .postings import BlockIndex, lookup_postings

# The operators of a query in postfix form; every other token is a term.
OPERATORS = {"AND": Column.__and__, "OR": Column.__or__}
# Terms per BIGINT of match flags.
FLAGS = 62
# Stretches of docids that a fetch puts into its scan.
RANGES = 100


def bool_and(postings: DataFrame, a: str, b: str) -> DataFrame:
    """``<docid>`` of the documents holding both terms."""
    return _single(postings, f"{a} {b} AND")


def bool_or(postings: DataFrame, a: str, b: str) -> DataFrame:
    """``<docid>`` of the documents holding either term."""
    return _single(postings, f"{a} {b} OR")


def _single(postings: DataFrame, query: str) -> DataFrame:
    return bool_search(postings, {"q": query}).select("docid")


def _shape(query: str) -> tuple[tuple[int | str, ...], list[str]]:
    """The query with each term replaced by its number by first appearance, and the terms in that order."""
    numbers: dict[str, int] = {}
    shape = tuple(t if t in OPERATORS else numbers.setdefault(t, len(numbers)) for t in query.split())
    return shape, list(numbers)


def _condition(shape: tuple[int | str, ...], query: str) -> Column:
    """A query's shape as a condition on match flags; operands beyond the last result are left unused."""
    operands: list[Column] = []
    for token in shape:
        if token not in OPERATORS:
            word, flag = divmod(token, FLAGS)
            operands.append(F.col(f"m{word}").bitwiseAND(F.lit(1 << flag)) != 0)
            continue
        if len(operands) < 2:
            raise ValueError(f"{token} lacks operands in query: {query}")
        right, left = operands.pop(), operands.pop()
        operands.append(OPERATORS[token](left, right))
    if not operands:
        raise ValueError("empty query")
    return operands[-1]


@dataclass(frozen=True)
class _Asked:
    """Queries as rows ``(query_id, shape, term, word, flag)``, the condition by shape, and words of flags."""

    rows: list[tuple]
    answers: Column
    words: int


def _asked(queries: Mapping[str, str]) -> _Asked:
    """Queries that differ in their terms alone are of one shape and share one condition."""
    if not queries:
        raise ValueError("no query")
    shapes: dict[tuple[int | str, ...], int] = {}
    answers, rows, most = None, [], 1
    for q, text in queries.items():
        shape, terms = _shape(text)
        if shape not in shapes:
            branch = F.col("shape") == len(shapes), _condition(shape, text)
            answers = F.when(*branch) if answers is None else answers.when(*branch)
            shapes[shape] = len(shapes)
        most = max(most, len(terms))
        rows += [(q, shapes[shape], t, i // FLAGS, 1 << (i % FLAGS)) for i, t in enumerate(terms)]
    return _Asked(rows, answers, -(-most // FLAGS))


ASKED = "query_id string, shape int, term string, word int, flag bigint"


def _hits(matched: DataFrame, asked: _Asked) -> DataFrame:
    """``<query_id, docid>`` of match rows: each document's flags put together and held to its query's condition."""
    flags = [F.bit_or(F.when(F.col("word") == w, F.col("flag")).otherwise(0)).alias(f"m{w}") for w in range(asked.words)]
    return matched.groupBy("query_id", "shape", "docid").agg(*flags).filter(asked.answers).select("query_id", "docid")


def bool_search(postings: DataFrame, queries: Mapping[str, str]) -> DataFrame:
    """``<query_id, docid>`` of each postfix query, such as ``{"q1": "white red OR rose AND"}``, by docid.

    One scan, pruned to the terms asked for, serves all queries, and one shuffle on (query, docid) puts each
    document's match flags together; no term's postings meet in one task. Queries that differ in their terms alone
    are of one shape and share one condition, so thousands of queries are a small table and a few branches. An
    unknown term matches nothing; no query at all is a ``ValueError``. Over a saved index, :func:`search_index`
    reads less.
    """
    asked = _asked(queries)
    table = postings.sparkSession.createDataFrame(asked.rows, ASKED)
    matched = lookup_postings(postings, sorted({row[2] for row in asked.rows})).join(broadcast_if_small(table), "term")
    return _hits(matched, asked).orderBy("query_id", "docid")


def leading_terms(query: str, df: Mapping[str, int]) -> set[str]:
    """The cheapest terms of which every hit of a postfix query holds one at least, by the documents they are in.

    A hit of an AND is a hit of either side, so the rarer side leads; an OR needs the leaders of both sides.
    """
    operands: list[set[str]] = []
    for token in query.split():
        if token not in OPERATORS:
            operands.append({token})
            continue
        right, left = operands.pop(), operands.pop()
        costs = [sum(df.get(t, 0) for t in side) for side in (left, right)]
        operands.append(left | right if token == "OR" else left if costs[0] <= costs[1] else right)
    return operands[-1]


def search_index(index: BlockIndex, queries: Mapping[str, str]) -> DataFrame:
    """``<query_id, docid>`` as :func:`bool_search` finds them, in no order, reading common terms only where rare ones are.

    The leading terms of each query are read first; their documents are the only ones that can be hits. The other
    terms are then read in the blocks of these documents alone: the (term, block) pairs wanted are a written table,
    by which Spark prunes the index's folders before it reads, and of what is read only postings of candidates move.
    How many documents hold the terms asked for comes from the index's own table.
    """
    spark = index.postings.sparkSession
    asked = _asked(queries)
    known = index.terms.join(broadcast_if_small(spark.createDataFrame([(t,) for t in {r[2] for r in asked.rows}], "term string")), "term")
    df = {r["term"]: r["df"] for r in known.collect()}  # at most the terms of the queries
    leaders = {q: leading_terms(text, df) for q, text in queries.items()}
    lead = [r for r in asked.rows if r[2] in leaders[r[0]]]
    rest = [r for r in asked.rows if r[2] not in leaders[r[0]] and r[2] in df]

    def read(rows: list[tuple]) -> DataFrame:
        return lookup_postings(index.postings, sorted({r[2] for r in rows}))

    columns = ["query_id", "shape", "docid", "block", "word", "flag"]
    first = durable(read(lead).join(broadcast_if_small(spark.createDataFrame(lead, ASKED)), "term").select(*columns), "candidates")
    if not rest:
        return _hits(first, asked)
    candidates = durable(first.groupBy("query_id", "docid").agg(F.max("block").alias("block")), "documents")
    wanted = candidates.groupBy("query_id", "block").agg(F.count("*").alias("documents"))
    wanted = durable(wanted.join(broadcast_if_small(spark.createDataFrame(rest, ASKED)), "query_id"), "wanted")
    # Told as a condition, for Spark prunes by a side that has one.
    others = read(rest).join(broadcast_if_small(wanted.filter(F.col("documents") > 0)), ["term", "block"]).select(*columns)
    others = others.join(broadcast_if_small(candidates.select("query_id", "docid")), ["query_id", "docid"], "left_semi")
    return _hits(first.unionByName(others), asked)


def _near(keys: DataFrame, key: str, ranges: int) -> Column | None:
    """A condition on ``key`` that holds for all ``keys``, as ``ranges`` stretches at most, which a scan can prune by."""
    low, high = keys.agg(F.min(key), F.max(key)).first()
    if low is None:
        return None
    width = (high - low) // ranges + 1
    stretch = F.expr(f"({key} - {low}L) div {width}L").alias("stretch")
    found = keys.groupBy(stretch).agg(F.min(key).alias("low"), F.max(key).alias("high")).collect()
    return reduce(Column.__or__, [F.col(key).between(r["low"], r["high"]) for r in sorted(found, key=lambda r: r["stretch"])])


def fetch_lines(hits: DataFrame, collection: DataFrame, width: str = "whole", ranges: int = RANGES) -> DataFrame:
    """``hits`` with each document's ``line``, whole or as a ``snippet``.

    The hits are written first: with their size known, a small answer is sent to the collection and only a
    large one has the collection shuffled. At most ``ranges`` stretches of docids, taken from the hits, go into the
    scan as a condition; on a collection that lies in the order of docids (``save_collection``) it passes over the
    row groups and pages that hold none of them.
    """
    written = durable(hits, "hits")
    near = _near(written, "docid", ranges)
    text = F.col("line") if width == "whole" else snippet(F.col("line"))
    pruned = collection.filter(F.lit(False) if near is None else near)
    return pruned.join(broadcast_if_small(written), "docid").select(*hits.columns, text.alias("line"))
