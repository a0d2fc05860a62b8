"""Removal of passages that an earlier document has, by suffix trees of groups of suffixes with a common prefix.

A suffix here is the text from one word on, as far as a window of LENGTH words. Suffixes that share a window lie below
one node of LENGTH words' depth, so a group of suffixes has to hold all that begin alike, and must fit into memory:

1. Of each window, the 5-word gram of least hash names its group; windows next to each other mostly agree on it, so a
   stretch of them moves as one. A gram that occurs once in all documents has no repeat, and its windows go no further.
2. A group that would be too large is split by a longer prefix, all words of the window: only equal windows meet.
3. Each group's suffixes are put in the order of their words, with the depth of the node between neighbours; that is
   the subtree. Its nodes of a window's depth or more are the repeats, compared word by word, and the smallest document
   below a node keeps its words.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from ..plans.durable import durable
from ..plans.sizing import broadcast_if_small
from .columns import each_text, whole_text
from .repeats import Hashes, _least, _mixed

# Words of a window, words of the gram that names a group.
LENGTH, GRAM = 13, 5
# Stretches of a group from which on it is split by whole windows.
GROUP = 1_000
# Bytes of text looked at together; bytes of a long text cut into words together.
TOGETHER, PIECE = 2 << 20, 4 << 20
# Bytes of stretches held by a task, and rows of a subtree's batch.
HELD, ROWS = 8 << 20, 20_000

BLANK = re.compile(rb"[\x20\x09-\x0D]")


def pieces(text: bytes, length: int, size: int = PIECE) -> Iterator[tuple[int, list[bytes]]]:
    """A text's words in parts, each with the place of its first word; every window of ``length`` lies in one part."""
    at, first, kept = 0, 0, []
    while at < len(text):
        border = BLANK.search(text, at + size)
        end = border.start() if border else len(text)
        words = kept + text[at:end].split()
        yield first, words
        kept = words[-(length - 1) :] if length > 1 else []
        first += len(words) - len(kept)
        at = end


def runs(words: list[bytes], part: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(gram's hash, first window, last window)`` of neighbouring windows of one part that chose the same gram."""
    if len(words) < length:
        return (np.zeros(0, np.int64),) * 3
    data = np.frombuffer(b" ".join(words), np.uint8)
    start = np.r_[0, np.flatnonzero(data == 32) + 1]
    stop = np.r_[start[1:] - 1, len(data)]
    grams = _mixed(Hashes(data).of(start[: len(start) - gram + 1], stop[gram - 1 :]))
    chosen = _least(grams, length - gram + 1)
    window = np.flatnonzero(part[: len(part) - length + 1] == part[length - 1 :])
    if not len(window):
        return (np.zeros(0, np.int64),) * 3
    chose = chosen[window]
    cut = np.flatnonzero(np.r_[True, (chose[1:] != chose[:-1]) | (window[1:] != window[:-1] + 1) | (part[window[1:]] != part[window[:-1]])])
    last = np.r_[cut[1:], len(window)] - 1
    return grams[chose[cut]].view(np.int64), window[cut], window[last]


# A stretch known to be needed; one whose group's size is not known yet; word of a group, without a stretch.
KNOWN, RUN, NOTICE = 0, 1, 2
RUN_NAMES = ["h", "doc", "digest", "first", "last"]
RUN_DDL = "kind int, h bigint, doc bigint, digest bigint, first bigint, last bigint"


def _run_rows(kind: int, columns: list[np.ndarray]) -> pa.RecordBatch:
    kinds = pa.array(np.full(len(columns[0]), kind, np.int32))
    return pa.RecordBatch.from_arrays([kinds, *(pa.array(c.astype(np.int64)) for c in columns)], names=["kind", *RUN_NAMES])


def _runs_of_texts(length: int, gram: int):
    """All stretches of the task's texts. A gram that texts looked at together repeat is told once, its stretches are known."""

    def out(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        sizes = [len(p[3]) for p in parts]
        owner = np.repeat(np.arange(len(parts)), sizes)
        h, first, last = runs([w for p in parts for w in p[3]], owner, length, gram)
        if not len(h):
            return
        whose = owner[first]
        doc, digest, place = (np.array([p[i] for p in parts], np.int64)[whose] for i in range(3))
        shift = place - (np.cumsum(sizes) - sizes)[whose]
        order = np.argsort(h, kind="stable")
        columns = [c[order] for c in (h, doc, digest, first + shift, last + shift)]
        same = columns[0][1:] == columns[0][:-1]
        again = np.r_[False, same]
        repeated = again | np.r_[same, False]
        yield _run_rows(KNOWN, [c[repeated] for c in columns])
        yield _run_rows(NOTICE, [c[repeated & ~again] for c in columns])
        yield _run_rows(RUN, [c[~repeated] for c in columns])

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for doc, digest, text in zip(batch["doc"].to_pylist(), batch["digest"].to_pylist(), each_text(batch["text"])):
                for first, words in pieces(text, length):
                    parts.append((doc, digest, first, words))
                    held += min(len(text), PIECE)
                    if held >= TOGETHER:
                        yield from out(parts)
                        parts, held = [], 0
        if parts:
            yield from out(parts)

    return tell


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches come sorted by gram; those of a gram that occurs again go on. Only the last row of a batch is held."""
    before = None  # the last row, and whether it has gone on already
    for batch in batches:
        kind = batch["kind"]
        if (known := batch.filter(pc.equal(kind, KNOWN))).num_rows:
            yield known
        batch = batch.filter(pc.not_equal(kind, KNOWN))
        if not batch.num_rows:
            continue
        columns = [batch[c].to_numpy() for c in ("kind", *RUN_NAMES)]
        done = np.zeros(len(columns[0]), bool)
        if before is not None:
            columns, done = [np.r_[b, c] for b, c in zip(before[0], columns)], np.r_[before[1], done]
        same = columns[1][1:] == columns[1][:-1]
        found = (np.r_[same, False] | np.r_[False, same]) & (columns[0] == RUN)
        if (fresh := found & ~done).any():
            yield _run_rows(KNOWN, [c[fresh] for c in columns[1:]])
        before = [c[-1:] for c in columns], (found | done)[-1:]


# A span of windows that an earlier document has; a stretch for its group's tree.
MARK, STRETCH = 0, 1
TREE_DDL = "kind int, prefix bigint, stretch binary, doc bigint, digests array<bigint>, firsts array<bigint>, windows bigint"


def _tree_rows(kind: int, rows: list[tuple]) -> pa.RecordBatch:
    prefix, stretch, doc, digests, firsts, windows = zip(*rows) if rows else [[]] * 6
    types = [pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64()]
    columns = [pa.array(c, t) for c, t in zip((prefix, stretch, doc, digests, firsts, windows), types)]
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), kind, np.int32)), *columns], names=[c.split()[0] for c in TREE_DDL.split(", ")])


def _prefix(window: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(window, digest_size=8).digest(), "little", signed=True)


def _stretches(length: int, held_bytes: int):
    """The words of the stretches, or of each window where the group is frequent.

    Of equal ones in a task only the one of the smallest document goes on; those of larger ones are marked at once.
    """

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        held: dict[tuple[int, bytes], list] = {}
        marks: list[tuple] = []
        before, size = None, 0

        def put(prefix: int, stretch: bytes, doc: int, digest: int, first: int, windows: int) -> int:
            known = held.get((prefix, stretch))
            if known is None:
                held[prefix, stretch] = [doc, [digest], [first], windows]
                return len(stretch) + 64
            if known[0] == doc:
                known[1].append(digest)
                known[2].append(first)
            elif known[0] < doc:
                marks.append((prefix, b"", doc, [digest], [first], windows))
            else:
                marks.append((prefix, b"", known[0], known[1], known[2], windows))
                held[prefix, stretch] = [doc, [digest], [first], windows]
            return 16

        def emptied() -> Iterator[pa.RecordBatch]:
            yield _tree_rows(MARK, marks)
            yield _tree_rows(STRETCH, [(*key, *value) for key, value in held.items()])
            held.clear()
            marks.clear()

        for batch in batches:
            edges = batch["edges"]
            ends = np.cumsum(edges.value_lengths().to_numpy())
            flat = edges.flatten()
            h, frequent, first, last = (flat.field(c).to_pylist() for c in ("h", "frequent", "first", "last"))
            at = 0
            for doc, digest, packed, end in zip(batch["doc"].to_pylist(), batch["digest"].to_pylist(), batch["packed"].to_pylist(), ends.tolist()):
                if (doc, digest) != before:  # else a repeated row, whose windows are told already
                    words = unpack(packed).split()
                    for e in range(at, end):
                        if not frequent[e]:
                            size += put(h[e], b" ".join(words[first[e] : last[e] + length]), doc, digest, first[e], last[e] - first[e] + 1)
                            continue
                        for i in range(first[e], last[e] + 1):
                            window = b" ".join(words[i : i + length])
                            size += put(_prefix(window), window, doc, digest, i, 1)
                        if size >= held_bytes:
                            yield from emptied()
                            size = 0
                before, at = (doc, digest), end
                if size >= held_bytes:
                    yield from emptied()
                    size = 0
        yield from emptied()

    return fetch


def subtree(words: np.ndarray, start: np.ndarray, group: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix trees of groups: leaves in order, and between each and the one before the depth of their lowest node.

    Suffixes go ``length`` words deep; leaves of different groups have a node of depth -1 between them.
    """
    suffixes = words[start[:, None] + np.arange(length)]
    order = np.lexsort([*suffixes.T[::-1], group])
    equal = suffixes[order[1:]] == suffixes[order[:-1]]
    depth = np.logical_and.accumulate(equal, axis=1).sum(axis=1)
    return order, np.where(group[order[1:]] == group[order[:-1]], depth, -1)


def _trees(length: int, rows_together: int):
    """Stretches come sorted by group and words, of equal ones the smallest document first. Whole groups make trees together."""

    def spans(doc: int, digests: list, firsts: list, hit: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        cut = np.flatnonzero(np.r_[True, hit[1:] != hit[:-1] + 1])
        ends = np.r_[cut[1:], len(hit)] - 1
        for digest, first in zip(digests, firsts):
            for a, b in zip(hit[cut].tolist(), hit[ends].tolist()):
                yield doc, digest, first + a, first + b

    def resolve(rows: list[tuple]) -> Iterator[tuple[int, int, int, int]]:
        """Removed windows of rows ``(prefix, stretch, doc, digests, firsts, windows)``."""
        words = pa.array(b" ".join(r[1] for r in rows).split(b" "), pa.binary()).dictionary_encode().indices.to_numpy()
        windows = np.array([r[5] for r in rows], np.int64)
        begin = np.cumsum(windows + length - 1) - (windows + length - 1)
        owner = np.repeat(np.arange(len(rows)), windows)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
        prefix, doc = (np.array([r[i] for r in rows], np.int64) for i in (0, 2))
        order, depth = subtree(words, begin[owner] + step, prefix[owner], length)
        node = np.flatnonzero(np.r_[True, depth < length])  # leaves below one deep node lie together
        docs = doc[owner[order]]
        least = np.repeat(np.minimum.reduceat(docs, node), np.diff(np.r_[node, len(order)]))
        gone = np.sort(order[docs > least])
        whose = owner[gone]
        cut = np.flatnonzero(np.r_[True, whose[1:] != whose[:-1]]) if len(gone) else []
        for a, b in zip(cut, [*cut[1:], len(gone)]):
            r = rows[whose[a]]
            yield from spans(r[2], r[3], r[4], step[gone[a:b]])

    def told(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found)) if found else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc", "digest", "first", "last"])

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            found: list[tuple] = []
            columns = [batch[c].to_pylist() for c in ("kind", "prefix", "stretch", "doc", "digests", "firsts", "windows")]
            for kind, *row in zip(*columns):
                if kind == MARK:
                    found += [(row[2], digest, first, first + row[5] - 1) for digest, first in zip(row[3], row[4])]
                elif held and held[-1][:2] == (row[0], row[1]) and held[-1][2] < row[2]:
                    found += [(row[2], digest, first, first + row[5] - 1) for digest, first in zip(row[3], row[4])]
                else:
                    if len(held) >= rows_together and held[-1][0] != row[0]:
                        found += resolve(held)
                        held = []
                    held.append(tuple(row))
            yield told(found)
        if held:
            yield told(list(resolve(held)))

    return tell


def _cut(length: int):
    names = ["doc_id", "n_words", "n_removed", "kept_sha256", "spans"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            rows = []
            for packed, spans in zip(batch["packed"].to_pylist(), batch["spans"]):
                words, kept, told, at = unpack(packed).split(), [], [], 0
                if spans.is_valid:
                    first, last = (spans.values.field(c).to_numpy() for c in ("first", "last"))
                    order = np.argsort(first)
                    reach = np.maximum.accumulate(last[order] + length)
                    start = first[order]
                    new = np.flatnonzero(np.r_[True, start[1:] > reach[:-1]])
                    for a, b in zip(start[new].tolist(), reach[np.r_[new[1:], len(start)] - 1].tolist()):
                        kept += words[at:a]
                        told.append(f"{a}:{b}")
                        at = b
                kept += words[at:]
                rows.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest(), ",".join(told)))
            columns = zip(*rows) if rows else [[]] * 4
            types = [pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array(c, t) for c, t in zip(columns, types))], names=names)

    return cut


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        texts = pa.array([pack(text) for text in each_text(batch["text"])], pa.binary())
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["doc"], batch["digest"], texts], names=["doc_id", "doc", "digest", "packed"])


def _half(sha: Column, at: int) -> Column:
    """The first (0) or second (1) 64 bits of a hexadecimal digest."""
    return F.conv(F.substring(sha, 16 * at + 1, 16), 16, -10).cast("bigint")


def remove_passages(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    group: int = GROUP,
    held_bytes: int = HELD,
    rows_together: int = ROWS,
) -> DataFrame:
    """``<doc_id, n_words, n_removed, kept_sha256, spans>``, one row per document.

    Removed is every word in a window of ``length`` words that also starts in a document of a smaller id; windows are
    judged on the whole input. ``spans`` are the maximal removed runs as ``start:end`` in words, ``kept_sha256`` is the
    digest of the words left, joined by single spaces.

    A null text has no words; texts shorter than a window keep all. A document without an id is not smaller or larger
    than any other: it keeps its words, and takes none from others. Rows that share an id take nothing from each other,
    be their texts equal or not; each is judged by its own text, told apart by 128 bits of its SHA-256.

    ``group`` is the number of stretches from which on a group is split by whole windows; ``held_bytes`` and
    ``rows_together`` bound what a task holds. None of them changes results.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), whole_text(text).alias("text"))
    sha = F.sha2(F.col("text").cast("binary"), 256)
    keyed = rows.select("doc_id", F.coalesce("doc_id", _half(sha, 1)).alias("doc"), _half(sha, 0).alias("digest"), "text")
    told = keyed.filter("doc_id IS NOT NULL").select("doc", "digest", "text").mapInArrow(_runs_of_texts(length, gram), RUN_DDL)
    # Stretches meet by gram; known ones, of which a frequent gram has many, are spread.
    meeting = F.when(F.col("kind") == KNOWN, F.xxhash64("doc", "first")).otherwise(F.col("h"))
    needed = told.repartition(meeting).sortWithinPartitions("h").mapInArrow(_met, RUN_DDL)
    needed = durable(needed.drop("kind"), "stretches")
    frequent = durable(needed.groupBy("h").count().filter(F.col("count") > group).select("h", F.lit(True).alias("frequent")), "frequent")
    edge = F.struct("h", F.coalesce("frequent", F.lit(False)).alias("frequent"), "first", "last").alias("e")
    wanted = needed.join(broadcast_if_small(frequent), "h", "left").select("doc", "digest", edge).groupBy("doc", "digest").agg(F.collect_set("e").alias("edges"))
    # The texts are read by both joins below, and shuffled once: Spark reuses the exchange of both plans if they are
    # alike. So both take all columns, and the keys are never null, which spares the inner join a filter.
    schema = StructType([StructField("doc_id", LongType()), *(StructField(c, t, False) for c, t in (("doc", LongType()), ("digest", LongType()), ("packed", BinaryType())))])
    texts = keyed.mapInArrow(_packed, schema)
    fetched = texts.join(wanted, ["doc", "digest"]).mapInArrow(_stretches(length, held_bytes), TREE_DDL)
    meeting = F.when(F.col("kind") == MARK, F.xxhash64("doc", "firsts")).otherwise(F.col("prefix"))
    grouped = fetched.repartition(meeting).sortWithinPartitions("kind", "prefix", "stretch", "doc")
    marks = grouped.mapInArrow(_trees(length, rows_together), "doc bigint, digest bigint, first bigint, last bigint")
    spans = marks.groupBy("doc", "digest").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    cut = texts.join(spans, ["doc", "digest"], "left").select("doc_id", "packed", "spans")
    return cut.mapInArrow(_cut(length), "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, spans string")
