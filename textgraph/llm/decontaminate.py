"""Benchmark decontamination by pigeonhole edit matching.

An item that occurs with at most e edits, cut into e + 1 pieces, has a piece without an edit. All pieces of all items
are found in one pass over a text by an Aho-Corasick automaton; around each hit, Myers' bit-parallel algorithm
measures the edit distance of the whole item to the best-fitting stretch of the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.durable import durable
from .columns import BLANKS, LOWER, UPPER, doc_rows

# An item may occur with one edit for so many of its characters.
CHARS_PER_EDIT = 16
# Items are looked for in blocks of at most so many characters, which bounds what is sent to the executors.
BLOCK_CHARS = 1 << 22

_FOLD = {ord(u): low for u, low in zip(UPPER, LOWER)}
_BLANK = re.compile(f"[{BLANKS}]+")


def normalised(text: str) -> str:
    """A-Z lower-cased, runs of blanks as one space, none at the ends."""
    return _BLANK.sub(" ", text.translate(_FOLD)).strip(" ")


def placed(text: str, folded: str, start: int, end: int) -> tuple[int, int]:
    """Where a stretch of the normalised text lies in the text itself, in code points."""
    lead = len(text) - len(text.lstrip(BLANKS))
    shifts = [(m.end() - m.start() - 1, m.end()) for m in _BLANK.finditer(text, lead)]
    spans, moved = [], lead
    at = 0
    for target in (start, end - 1):
        while at < len(shifts) and shifts[at][1] - shifts[at][0] - moved <= target:
            moved += shifts[at][0]
            at += 1
        spans.append(target + moved)
    return spans[0], spans[1] + 1


def budget(item: str, chars_per_edit: int = CHARS_PER_EDIT) -> int:
    """Edits that an item of this length may have."""
    return len(item) // chars_per_edit


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """``edits + 1`` consecutive pieces of about equal length, each with its place in the item."""
    bounds = [len(item) * k // (edits + 1) for k in range(edits + 2)]
    return [(a, item[a:b]) for a, b in zip(bounds, bounds[1:]) if b > a]


class Pattern:
    """Myers' algorithm for one item: its characters' places as bit masks."""

    def __init__(self, item: str):
        self.length = len(item)
        self.masks: dict[str, int] = {}
        for i, c in enumerate(item):
            self.masks[c] = self.masks.get(c, 0) | 1 << i

    def best_end(self, text: str) -> tuple[int, int]:
        """The least edit distance of the item to any stretch of ``text``, and where the first such stretch ends."""
        full, top, masks = (1 << self.length) - 1, 1 << (self.length - 1), self.masks
        plus, minus, distance = full, 0, self.length
        best, end = distance, 0
        for i, c in enumerate(text):
            equal = masks.get(c, 0)
            across = (((equal & plus) + plus) ^ plus) | equal
            horizontal_plus = minus | ~(across | plus) & full
            horizontal_minus = plus & across
            if horizontal_plus & top:
                distance += 1
            elif horizontal_minus & top:
                distance -= 1
            horizontal_plus = horizontal_plus << 1 & full
            horizontal_minus = horizontal_minus << 1 & full
            vertical = equal | minus
            plus = horizontal_minus | ~(vertical | horizontal_plus) & full
            minus = horizontal_plus & vertical
            if distance < best:
                best, end = distance, i + 1
        return best, end


class Matcher:
    """The pieces of a block of items as one automaton."""

    def __init__(self, items: list[tuple[int, str]], chars_per_edit: int):
        self.items = [(item_id, normalised(text)) for item_id, text in items]
        self.items = [(item_id, item) for item_id, item in self.items if item]
        self.edits = [budget(item, chars_per_edit) for _, item in self.items]
        self.patterns = [Pattern(item) for _, item in self.items]
        self.reversed = [Pattern(item[::-1]) for _, item in self.items]
        found: dict[str, list[tuple[int, int]]] = {}
        for k, (_, item) in enumerate(self.items):
            for at, piece in pieces(item, self.edits[k]):
                found.setdefault(piece, []).append((k, at))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in found.items():
            self.automaton.add_word(piece, (len(piece), uses))
        self.automaton.make_automaton()

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """``(item_id, distance, start, end)``: the best occurrence of each item within its budget, in code points."""
        if not self.items:
            return []
        folded = normalised(text)
        tried: dict[int, tuple[int, int]] = {}
        best: dict[int, tuple[int, int, int]] = {}
        for last, (length, uses) in self.automaton.iter(folded):
            for k, at in uses:
                edits, size = self.edits[k], self.patterns[k].length
                start = last + 1 - length - at  # where the item starts, give or take its edits
                low, high = max(0, start - edits), start + size + edits
                done = tried.get(k)
                if done and done[0] <= low and high <= done[1]:
                    continue  # the last stretch looked at holds this one
                tried[k] = (low, high)
                distance, end = self.patterns[k].best_end(folded[low:high])
                if distance <= edits and (k not in best or distance < best[k][0]):
                    _, back = self.reversed[k].best_end(folded[low : low + end][::-1])
                    best[k] = (distance, low + end - back, low + end)
        return [(self.items[k][0], d, *placed(text, folded, a, b)) for k, (d, a, b) in sorted(best.items())]


def _items(benchmark: DataFrame, item_id: str, text: str, block_chars: int) -> tuple[DataFrame, int]:
    """``<item_id, text, block>``, each different item once, and the number of blocks, of bounded size each."""
    named = benchmark.select(F.col(item_id).cast("bigint").alias("item_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    items = durable(named.distinct(), "items")
    blocks = -(-(items.agg(F.sum(F.length("text"))).first()[0] or 0) // block_chars)
    return items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, blocks)))), blocks


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    chars_per_edit: int = CHARS_PER_EDIT,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``<doc_id, item_id, distance, start, end>``: each item that a document holds within its edit budget.

    Both sides are compared with A-Z lower-cased and runs of blanks as one space. ``start`` and ``end`` (exclusive)
    are code points of the document's text; of an item's occurrences in a document the one of least distance, then
    the first, is told. Items of fewer than ``chars_per_edit`` characters must occur unchanged. Null and blank
    texts hold nothing, null and blank items are not looked for, an item without an id is told with a null one, an
    item given twice once for each different text. The benchmark goes to the executors block by block, and of several
    blocks the matches of one are written before the next is fetched, so what the driver holds is bounded.
    """
    rows = doc_rows(docs, doc_id, text)
    schema = "doc_id bigint, item_id bigint, distance bigint, start bigint, end bigint"

    def finder(shared):
        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value, chars_per_edit)
            for batch in batches:
                found = [
                    (doc, *match)
                    for doc, value in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
                    for match in matcher.matches(value)
                ]
                columns = zip(*found) if found else [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], names=["doc_id", "item_id", "distance", "start", "end"]
                )

        return find

    found = docs.sparkSession.createDataFrame([], schema)
    items, blocks = _items(benchmark, item_id, item_text, block_chars)
    for b in range(blocks):
        block = [tuple(r) for r in items.filter(F.col("block") == b).select("item_id", "text").sort("item_id", "text").collect()]
        shared = docs.sparkSession.sparkContext.broadcast(block)
        matches = rows.mapInArrow(finder(shared), schema)
        if blocks > 1:  # done before the next block is fetched, so that the driver holds one at a time
            matches = durable(matches, "leaks")
            shared.destroy()
        found = found.unionByName(matches)
    return found
