"""Near duplicates by SimHash fingerprints, found with deletion-variant signatures.

Fingerprints that differ in at most three bits have a half that differs in at most one. So each half, with each of
its bits in turn left out, is a signature; two linked fingerprints share one, and an equality join finds them. A
signature held by many fingerprints is not paired out: its members are signed again by the quarters of their other
half. What is verified is emitted as a forest, not as all pairs: it connects the same documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.durable import durable
from ..plans.skew import lookup_join
from .columns import LOWER, UPPER, doc_rows, text_bytes
from .components import components

# Fixed values of the contract: words of a shingle, seed, bits that may differ.
SHINGLE, SEED, RADIUS = 3, 42, 3
# Shingles whose bits are counted at a time.
SLICE = 1 << 16
# A signature with more members is signed again.
GROUP = 512

_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())


def fingerprint(text: bytes, width: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of a text's word shingles; fewer words than ``width`` are one shingle, no words give zero."""
    words = text.translate(_FOLD).split()
    if not words:
        return 0
    shingles = max(1, len(words) - width + 1)
    counts, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for start in range(0, shingles, SLICE):
        stop = min(start + SLICE, shingles)
        hashes = np.fromiter((digest(b" ".join(words[i : i + width]), seed) for i in range(start, stop)), np.uint64, stop - start)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > shingles, bitorder="little").tobytes(), "little")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.array([fingerprint(t) for t in text_bytes(batch.column("text"))], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints, pa.int64())], names=["doc_id", "print"])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``<doc_id, print>``: the fingerprint as BIGINT, one row per document."""
    return doc_rows(docs, doc_id, text).mapInArrow(_fingerprints, "doc_id bigint, print bigint")


def _forest(prints: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that connect exactly those of ``prints`` which links of at most ``radius`` bits connect."""
    links, waiting = [], prints.view(np.uint64)  # of signed numbers, NumPy counts the bits of the magnitude
    while len(waiting):
        frontier, waiting = waiting[:1], waiting[1:]
        while len(frontier) and len(waiting):
            at, frontier = frontier[0], frontier[1:]
            near = np.bitwise_count(waiting ^ at) <= radius
            links += [(int(at.view(np.int64)), int(other)) for other in waiting[near].view(np.int64)]
            frontier = np.concatenate([frontier, waiting[near]])
            waiting = waiting[~near]
    return links


def _grouped_links(group: int, radius: int, last: bool):
    """Rows come sorted by signature. Small groups give links; the members of large ones are passed on."""

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(a, b, sign):
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, sign)], names=["a", "b", "sign"])

        def close(sign: int, parts: list[np.ndarray]) -> pa.RecordBatch | None:
            found = _forest(np.concatenate(parts), radius)
            return rows([a for a, _ in found], [b for _, b in found], [None] * len(found)) if found else None

        open_sign, parts, held = None, [], 0
        for batch in batches:
            signs, prints = (batch.column(c).to_numpy() for c in ("sign", "print"))
            starts = np.flatnonzero(np.r_[True, signs[1:] != signs[:-1]]) if len(signs) else []
            for start, stop in zip(starts, [*starts[1:], len(signs)]):
                if signs[start] != open_sign:
                    if 1 < held and parts and (out := close(open_sign, parts)):
                        yield out
                    open_sign, parts, held = signs[start], [], 0
                members = prints[start:stop]
                if not last and held + len(members) > group:  # passed on as they come, never held
                    passed = np.concatenate([*parts, members])
                    parts, held = [], group
                    yield rows(passed, passed, np.full(len(passed), open_sign))
                else:
                    parts.append(members)
                    held += len(members)
        if 1 < held and parts and (out := close(open_sign, parts)):
            yield out

    return resolve


def near_links(prints: DataFrame, radius: int = RADIUS, group: int = GROUP) -> DataFrame:
    """``<a, b>``: links that connect the same fingerprints as all pairs of at most ``radius`` (3) differing bits.

    ``prints``: ``<print>``, distinct. A signature's members are compared inside a task as bit operations on arrays;
    members of a signature with more than ``group`` are signed again by the quarters of the half that may differ,
    which leaves at most 2**18 different fingerprints to a signature.
    """
    half_signs = F.expr(
        """concat(
            transform(sequence(0, 31), i -> (print & 4294967295) & ~shiftleft(1L, i) | shiftleft(bigint(i), 32)),
            transform(sequence(0, 31), i ->
                shiftrightunsigned(print, 32) & ~shiftleft(1L, i) | shiftleft(bigint(i), 32) | shiftleft(1L, 37)))"""
    )
    schema = "a bigint, b bigint, sign bigint"
    signed = prints.select("print", F.explode(half_signs).alias("sign")).repartition("sign").sortWithinPartitions("sign")
    first = durable(signed.mapInArrow(_grouped_links(group, radius, last=False), schema), "signed")
    other = "IF(sign & shiftleft(1L, 37) = 0, shiftrightunsigned(a, 32), a & 4294967295)"
    quarter_signs = F.expr(
        f"""transform(sequence(0, 31), i -> shiftleft(sign, 21) | shiftleft(bigint(i), 16)
            | (IF(i < 16, {other} & 65535, shiftrightunsigned({other}, 16)) & ~shiftleft(1L, i % 16)))"""
    )
    passed = first.filter("sign IS NOT NULL").select(F.col("a").alias("print"), F.explode(quarter_signs).alias("sign"))
    again = passed.repartition("sign").sortWithinPartitions("sign").mapInArrow(_grouped_links(group, radius, last=True), schema)
    return first.filter("sign IS NULL").select("a", "b").unionByName(again.select("a", "b"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``<doc_id, fingerprint, component_id>``, one row per document.

    ``fingerprint`` is 16 hex digits; ``component_id`` the smallest id reachable over links of at most three bits.
    Texts without words have fingerprint zero and are linked like any others. Copies meet as one fingerprint, before
    any signature is made. A null id never is a component's smallest unless all its ids are null; repeated rows are
    rows of the same component.
    """
    prints = durable(fingerprints(docs, doc_id, text), "prints")
    distinct = durable(prints.groupBy("print").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "distinct")
    rooted = components(near_links(distinct.select("print"))).withColumnRenamed("node", "print")
    placed = durable(
        distinct.join(rooted, "print", "left").select("print", "first", "n", F.coalesce("root", "print").alias("root")), "rooted"
    )
    smallest = durable(placed.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("members")), "roots")
    of_print = durable(
        lookup_join(placed, smallest, "root", "members", broadcast_bytes=16 << 20).select("print", "n", "component_id"), "components"
    )
    joined = lookup_join(prints, of_print, "print", "n", broadcast_bytes=16 << 20)
    return joined.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
