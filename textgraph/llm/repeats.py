"""Removal of long repeated byte strings, by a suffix sort over hashed strings.

Every string of LENGTH bytes (a window) chooses an anchor among its own K-grams, by content alone, so equal windows
choose equal anchors at the same place in them. Neighbouring windows share an anchor; such a run of windows is one
small record, dealt out by the anchor's hash.

1. Runs with equal anchors are repeats as a whole where 128-bit digests of all their bytes prove them equal, never for
   polynomial hashes alone; nothing but hashes and digests is moved for them.
2. Where runs with equal anchors differ, at the edges of repeats, one run of each kind has its bytes fetched, and
   its windows are sorted: a mergesort that compares two suffixes by binary search for their common extension over
   prefix polynomial hashes. Neighbours in the order that agree over LENGTH bytes are compared byte by byte.
3. Windows of a frequent anchor are sorted where their texts are read, some runs at a time; one of each kind goes on
   without bytes, as a digest of them, and meets those of other tasks as a neighbour in a sorted stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.durable import durable
from .columns import doc_rows, each_text

# Bytes of a repeat, bytes of an anchor.
LENGTH, K = 200, 64
# Bytes of text looked at together in a task.
TOGETHER = 2 << 20
# Runs with one anchor that are sorted together; of a more frequent anchor, windows meet one by one.
GROUP = 1_000

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
UNBASE = np.uint64(pow(int(BASE), -1, 1 << 64))
SPREAD = np.uint64(0xD6E8FEB86659FD93)


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    factors, inverses = np.full(n, BASE), np.full(n, UNBASE)
    factors[:1] = inverses[:1] = 1
    return np.multiply.accumulate(factors), np.multiply.accumulate(inverses)


class Hashes:
    """Prefix polynomial hashes of a byte string: the hash of any stretch of it by one subtraction."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(max(1 << 16, 1 << len(data).bit_length()))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (self.sums[stop] - self.sums[start]) * self.down[start]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * SPREAD
    return x ^ x >> np.uint64(29)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the least of every ``width`` values in a row, the first among equals."""
    best, covered = np.arange(len(values), dtype=np.int32), 1
    while covered < width:
        step = min(covered, width - covered)
        left, right = best[:-step], best[step:]
        best = np.where(values[left] <= values[right], left, right)
        covered += step
    return best


def _digests(data: np.ndarray, first: np.ndarray, last: np.ndarray, anchor: np.ndarray, length: int) -> np.ndarray:
    """Both halves of a digest of each run: its bytes, and where in them the anchor stands."""
    view, places = memoryview(data), (anchor - first).astype("<i8").tobytes()
    ends = zip(first.tolist(), (last + length).tolist())
    told = (hashlib.blake2b(view[a:b], digest_size=16, salt=places[8 * i : 8 * i + 8]).digest() for i, (a, b) in enumerate(ends))
    return np.frombuffer(b"".join(told), np.int64).reshape(-1, 2).T


def runs(data: np.ndarray, length: int, k: int) -> tuple[np.ndarray, ...]:
    """``(anchor hash, digest, first window, last window, anchor, rest of the digest)`` of a text's runs of windows with one anchor."""
    if len(data) < length:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    hashes = Hashes(data)
    starts = np.arange(len(data) - k + 1)
    grams = _mixed(hashes.of(starts, starts + k))
    chosen = _least(grams, length - k + 1)
    first = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
    last = np.r_[first[1:], len(chosen)] - 1
    anchor = chosen[first].astype(np.int64)
    full, rest = _digests(data, first, last, anchor, length)
    return grams[anchor].view(np.int64), full, first, last, anchor, rest


RECORD = ["h", "full", "doc", "digest", "first", "last", "anchor"]
SCHEMA = "h bigint, full bigint, doc bigint, digest bigint, first bigint, last bigint, anchor bigint, kind int"
# Until they are compared, runs have the rest of their digest too.
RUN_RECORD = [*RECORD, "rest"]
RUN_SCHEMA = "h bigint, full bigint, doc bigint, digest bigint, first bigint, last bigint, anchor bigint, rest bigint, kind int"
# A run that is a repeat as a whole; one to be compared; one to be compared by its bytes; a window of a frequent anchor.
REPEAT, RUN, EDGE, WINDOW = 0, 1, 2, 3


def _rows(columns: list[np.ndarray], kind: int, names: list[str] = RECORD) -> pa.RecordBatch:
    arrays = [pa.array(c.astype(np.int64)) for c in columns]
    return pa.RecordBatch.from_arrays([*arrays, pa.array(np.full(len(columns[0]), kind, np.int32))], names=[*names, "kind"])


def _runs_of_texts(length: int, k: int):
    """All runs of the task's texts. Of equal ones among texts looked at together, all are repeats, one is passed on."""

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0

        def out(parts: list) -> Iterator[pa.RecordBatch]:
            columns = [np.concatenate(c) for c in zip(*parts)]
            order = np.lexsort((columns[-1], columns[1], columns[0]))
            columns = [c[order] for c in columns]
            h, full, rest = columns[0], columns[1], columns[-1]
            same = (h[1:] == h[:-1]) & (full[1:] == full[:-1]) & (rest[1:] == rest[:-1])
            again = np.r_[False, same] if len(h) else np.zeros(0, bool)
            repeated = again | np.r_[same, False] if len(h) else again
            if repeated.any():
                yield _rows([c[repeated] for c in columns], REPEAT, RUN_RECORD)
            yield _rows([c[~again] for c in columns], RUN, RUN_RECORD)

        for batch in batches:
            for doc, digest, value in zip(batch.column("doc").to_pylist(), batch.column("digest").to_pylist(), each_text(batch.column("text"))):
                found = runs(np.frombuffer(value, np.uint8), length, k)
                n = len(found[0])
                if n:
                    parts.append([found[0], found[1], np.full(n, doc), np.full(n, digest), *found[2:]])
                    held += len(value)
                if held >= TOGETHER:
                    yield from out(parts)
                    parts, held = [], 0
        if parts:
            yield from out(parts)

    return tell


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs come sorted by anchor and digest. Equal ones are repeats; of an anchor with several kinds, one of each is an edge.

    Repeats that are known already go through. A row is judged by its neighbours alone, so nothing is held but the last row of a batch.
    """
    before = None  # the last row so far, and whether it was equal to the one before it and began its anchor
    for batch in batches:
        if (done := batch.filter(pc.equal(batch.column("kind"), REPEAT))).num_rows:
            yield done.select([*RECORD, "kind"])
        batch = batch.filter(pc.equal(batch.column("kind"), RUN))
        if not batch.num_rows:
            continue
        columns = [batch.column(c).to_numpy() for c in RUN_RECORD]
        if before is not None:
            columns = [np.r_[b, c] for b, c in zip(before[0], columns)]
        h, full, rest = columns[0], columns[1], columns[-1]
        same_h = h[1:] == h[:-1]
        same = same_h & (full[1:] == full[:-1]) & (rest[1:] == rest[:-1])
        repeated = np.r_[same, False] | np.r_[False, same]
        new_kind = np.r_[False, same_h & ~same]  # the first of a further kind
        told_edge = new_kind.copy()
        # The first kind of an anchor is told when a second one appears: by the row just before it.
        second = np.flatnonzero(new_kind)
        told_edge[second - 1] = True
        fresh = np.ones(len(h), bool)
        if before is not None:
            repeated[0] &= not before[1]
            told_edge[0] &= not before[2]
        held = len(h) - 1
        if repeated.any():
            yield _rows([c[repeated & fresh] for c in columns[:-1]], REPEAT)
        if told_edge.any():
            yield _rows([c[told_edge & fresh] for c in columns[:-1]], EDGE)
        was_repeated = bool(repeated[held]) or (before is not None and held == 0 and before[1])
        was_edge = bool(told_edge[held]) or (before is not None and held == 0 and before[2])
        before = ([c[held:] for c in columns], was_repeated, was_edge)


CONTEXT = "kind int, h bigint, h2 bigint, doc bigint, digest bigint, first bigint, last bigint, anchor bigint, bytes binary"
CONTEXT_TYPES = [("kind", pa.int32()), *((c, pa.int64()) for c in ("h", "h2", "doc", "digest", "first", "last", "anchor")), ("bytes", pa.binary())]


def _context_rows(columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, CONTEXT_TYPES)], names=[n for n, _ in CONTEXT_TYPES])


def _contexts(length: int, group: int):
    """The bytes around each edge run. Of frequent anchors, repeats among ``group`` runs, and one window of each kind.

    Such a window has the halves of its digest as ``h`` and ``h2``, and in ``anchor`` whether it is a known repeat.
    """

    def windows(runs_: list[tuple]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches([_context_rows(list(zip(*sorted(runs_, key=lambda r: r[1]))))])
        data, owner, step, start, found, again = _judged(rows, length)
        spans = _spans(rows, owner, step, np.flatnonzero(found))
        n = len(spans[0])
        yield _context_rows([np.full(n, REPEAT), *spans, [b""] * n])
        one = np.flatnonzero(~again)
        view = memoryview(data)
        told = b"".join(hashlib.blake2b(view[s : s + length], digest_size=16).digest() for s in start[one].tolist())
        high, low = np.frombuffer(told, np.int64).reshape(-1, 2).T
        doc, digest, first = (rows[c].to_numpy()[owner[one]] for c in ("doc", "digest", "first"))
        at = first + step[one]
        yield _context_rows([np.full(len(one), WINDOW), high, low, doc, digest, at, at, found[one].astype(np.int64), [b""] * len(one)])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, crowd = None, []
        for batch in batches:
            rows = []
            for doc, digest, value, edges in zip(batch["doc"].to_pylist(), batch["digest"].to_pylist(), each_text(batch["text"]), batch["edges"]):
                if (doc, digest) == before:
                    continue  # a repeated row: all its runs are known to be repeats
                before = (doc, digest)
                for e in edges.as_py():
                    stretch = value[e["first"] : e["last"] + length]
                    (crowd if e["frequent"] else rows).append((EDGE, e["h"], 0, doc, digest, e["first"], e["last"], e["anchor"], stretch))
                    if len(crowd) >= group:
                        yield from windows(crowd)
                        crowd = []
            yield _context_rows(list(zip(*rows)) if rows else [[]] * 9)
        if crowd:
            yield from windows(crowd)

    return fetch


def common_extension(hashes: Hashes, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """How many bytes, ``most`` at most, the strings from ``a`` and ``b`` on agree, by binary search over hashes."""
    low, high = np.zeros(len(a), np.int64), np.full(len(a), most)
    while (open_ := low < high).any():
        middle = (low + high + 1) // 2
        equal = hashes.of(a, a + middle) == hashes.of(b, b + middle)
        low, high = np.where(open_ & equal, middle, low), np.where(open_ & ~equal, middle - 1, high)
    return low


def suffix_order(data: np.ndarray, hashes: Hashes, starts: np.ndarray, bucket: np.ndarray, length: int) -> np.ndarray:
    """``starts`` in an order sorted inside each (contiguous) bucket by their first ``length`` bytes, all buckets at once.

    A bottom-up mergesort: each turn joins neighbouring sorted stretches, an element finding its place in the other
    stretch by binary search; a comparison is a common extension and the byte after it.
    """
    order = starts.copy()
    place = np.arange(len(starts))
    begin = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    size = np.diff(np.r_[begin, len(starts)])
    begin, end = np.repeat(begin, size), np.repeat(begin + size, size)
    width, widest = 1, int(size.max(initial=0))
    while width < widest:
        run = (place - begin) // width
        other = np.minimum(begin + (run ^ 1) * width, end)
        low, high = other.copy(), np.minimum(other + width, end)
        left = run % 2 == 0
        while len(active := np.flatnonzero(low < high)):
            middle = (low[active] + high[active]) // 2
            mine, theirs = order[active], order[middle]
            agree = common_extension(hashes, mine, theirs, length)
            at = np.minimum(agree, length - 1)
            a, b = data[mine + at].astype(np.int16), data[theirs + at].astype(np.int16)
            sign = np.where(agree == length, 0, b - a)  # above 0: theirs is greater
            passes = np.where(left[active], sign < 0, sign <= 0)  # equal ones keep the left stretch first
            low[active] = np.where(passes, middle + 1, low[active])
            high[active] = np.where(passes, high[active], middle)
        rank = low - other
        target = begin + run // 2 * 2 * width + (place - begin - run * width) + rank
        merged = np.empty_like(order)
        merged[target] = order
        order, width = merged, width * 2
    return order


def repeated_windows(data: np.ndarray, starts: np.ndarray, bucket: np.ndarray, length: int) -> np.ndarray:
    """Which of the windows of ``data`` at ``starts`` (grouped by ``bucket``) equal another of their bucket."""
    return same_windows(data, starts, bucket, length)[0]


def same_windows(data: np.ndarray, starts: np.ndarray, bucket: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Which windows equal another of their bucket, and which of these are not the one that stands for its kind."""
    hashes = Hashes(data)
    order = suffix_order(data, hashes, starts, bucket, length)
    views = np.lib.stride_tricks.sliding_window_view(data, length)
    near = np.flatnonzero(bucket[1:] == bucket[:-1])
    near = near[hashes.of(order[near], order[near] + length) == hashes.of(order[near + 1], order[near + 1] + length)]
    found, again, wrong = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool), set()
    for i in range(0, len(near), 20_000):
        part = near[i : i + 20_000]
        equal = (views[order[part]] == views[order[part + 1]]).all(axis=1)
        found[order[part[equal]]] = found[order[part[equal] + 1]] = again[order[part[equal] + 1]] = True
        wrong.update(bucket[part[~equal]].tolist())
    for b in wrong:  # different bytes of one hash: this bucket is grouped by its bytes
        seen: dict[bytes, list[int]] = {}
        for s in starts[bucket == b]:
            seen.setdefault(data[s : s + length].tobytes(), []).append(s)
        for same in seen.values():
            found[same] = len(same) > 1
            again[same] = np.arange(len(same)) > 0
    return found[starts], again[starts]


def _judged(rows: pa.Table, length: int) -> tuple[np.ndarray, ...]:
    """``(data, owner, step, start, found, again)``: all windows of contexts that lie together by anchor, as ``same_windows`` has them."""
    data = np.frombuffer(b"".join(rows["bytes"].to_pylist()), np.uint8)
    h, first, last, anchor = (rows[c].to_numpy() for c in ("h", "first", "last", "anchor"))
    windows = last - first + 1
    offset = np.cumsum(windows + length - 1) - (windows + length - 1)
    group = np.cumsum(np.r_[0, h[1:] != h[:-1]])
    owner = np.repeat(np.arange(len(h)), windows)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    start = offset[owner] + step
    bucket = group[owner] * (length + 1) + (anchor[owner] - first[owner] - step)
    order = np.argsort(bucket, kind="stable")
    crowded = order[_shared(bucket[order])]
    found, again = np.zeros(len(start), bool), np.zeros(len(start), bool)
    found[crowded], again[crowded] = same_windows(data, start[crowded], bucket[crowded], length)
    return data, owner, step, start, found, again


def _spans(rows: pa.Table, owner: np.ndarray, step: np.ndarray, hit: np.ndarray) -> list[np.ndarray]:
    """The columns of RECORD for the runs of neighbouring windows among ``hit``."""
    owner, step = owner[hit], step[hit]
    cut = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (step[1:] != step[:-1] + 1)]) if len(hit) else np.zeros(0, np.int64)
    final = np.r_[cut[1:], len(hit)] - 1 if len(hit) else cut
    whose = owner[cut]
    h, doc, digest, first, anchor = (rows[c].to_numpy()[whose] for c in ("h", "doc", "digest", "first", "anchor"))
    return [h, np.zeros(len(cut), np.int64), doc, digest, first + step[cut], first + step[final], anchor]


def _sorted_edges(length: int):
    """Contexts come sorted by anchor; whole groups of them are sorted together. Windows are judged by their neighbours, known repeats go through."""

    def resolve(rows: pa.Table) -> pa.RecordBatch:
        _, owner, step, _, found, _ = _judged(rows, length)
        return _rows(_spans(rows, owner, step, np.flatnonzero(found)), REPEAT)

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, before = None, None
        names = ["h", "h2", *RECORD[2:]]
        for batch in batches:
            kind = batch.column("kind")
            if (done := batch.filter(pc.equal(kind, REPEAT))).num_rows:
                yield _rows([done.column(c).to_numpy() for c in names], REPEAT)
            if (contexts := batch.filter(pc.equal(kind, EDGE))).num_rows:
                table = pa.Table.from_batches([contexts])
                held = table if held is None else pa.concat_tables([held, table])
                if len(held) >= GROUP:
                    h = held["h"].to_numpy()
                    cut = np.flatnonzero(h[1:] != h[:-1])
                    if len(cut):
                        yield resolve(held.slice(0, int(cut[-1]) + 1))
                        held = held.slice(int(cut[-1]) + 1)
            if (windows := batch.filter(pc.equal(kind, WINDOW))).num_rows:
                columns = [windows.column(c).to_numpy() for c in names]
                if before is not None:
                    columns = [np.r_[b, c] for b, c in zip(before, columns)]
                high, low, known = columns[0], columns[1], columns[-1]
                same = (high[1:] == high[:-1]) & (low[1:] == low[:-1])
                repeated = np.r_[same, False] | np.r_[False, same]
                if (fresh := repeated & (known == 0)).any():
                    yield _rows([c[fresh] for c in columns], REPEAT)
                before = [*(c[-1:] for c in columns[:-1]), (known | repeated)[-1:]]
        if held is not None and len(held):
            yield resolve(held)

    return tell


def _shared(sorted_values: np.ndarray) -> np.ndarray:
    """Places of values that occur more than once."""
    same = sorted_values[1:] == sorted_values[:-1]
    return np.flatnonzero(np.r_[same, False] | np.r_[False, same]) if len(sorted_values) else np.zeros(0, np.int64)


def merged_spans(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one."""
    if not len(starts):
        return []
    order = np.argsort(starts)
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    first = np.flatnonzero(np.r_[True, starts[1:] > reach[:-1]])
    return list(zip(starts[first].tolist(), reach[np.r_[first[1:], len(starts)] - 1].tolist()))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for value, spans in zip(each_text(batch["text"]), batch["spans"]):
            found = spans.values
            merged = merged_spans(*(found.field(c).to_numpy() for c in ("start", "end"))) if spans.is_valid else []
            kept, at = [], 0
            for start, end in merged:
                kept.append(value[at:start])
                at = end
            kept.append(value[at:])
            rest = b"".join(kept)
            told = ",".join(f"{a}:{b}" for a, b in merged)
            rows.append((len(value), len(value) - len(rest), len(merged), hashlib.sha256(rest).hexdigest(), told))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        columns = zip(*rows) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], *(pa.array(c, k) for c, k in zip(columns, kinds))],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
        )


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, k: int = K, group: int = GROUP) -> DataFrame:
    """``<doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans>``, one row per document.

    Removed is every byte in a string of ``length`` bytes that also starts elsewhere, in the same document or another;
    ``spans`` are the maximal removed runs as ``start:end`` in bytes. Texts shorter than ``length`` keep all; a null
    text is an empty one. A repeated row is a further document, so both of its copies are repeats of each other. Of
    rows with one id but different texts, each has spans of its own: they are told apart by 64 bits of their texts'
    SHA-256, rows without an id by 128.
    """
    rows = doc_rows(docs, doc_id, text)
    keyed = rows.select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha"), "text")
    keyed = keyed.select("doc_id", F.coalesce("doc_id", _half("sha", 1)).alias("doc"), _half("sha", 0).alias("digest"), "text")
    told = keyed.select("doc", "digest", "text").mapInArrow(_runs_of_texts(length, k), RUN_SCHEMA)
    # Runs meet by anchor; known repeats, of which a frequent anchor has many, are spread.
    meeting = F.when(_is(RUN), F.col("h")).otherwise(F.xxhash64("doc", "first"))
    ordered = told.repartition(meeting).sortWithinPartitions("kind", "h", "full", "rest")
    compared = durable(ordered.mapInArrow(_compared, SCHEMA), "compared")
    edges = compared.filter(_is(EDGE))
    frequent = edges.groupBy("h").count().filter(F.col("count") > group)
    crowded = durable(frequent.select("h", F.lit(True).alias("frequent")), "frequent")
    # At most one in ``group`` edges has a frequent anchor of its own; how many there are decides the join.
    told_edges = edges.join(crowded, "h", "left").select("doc", "digest", F.struct("h", F.coalesce("frequent", F.lit(False)).alias("frequent"), "first", "last", "anchor").alias("e"))
    wanted = told_edges.groupBy("doc", "digest").agg(F.collect_list("e").alias("edges"))
    fetched = keyed.select("doc", "digest", "text").join(wanted, ["doc", "digest"]).mapInArrow(_contexts(length, group), CONTEXT)
    meeting = F.when(_is(REPEAT), F.xxhash64("doc", "first")).otherwise(F.col("h"))
    sorted_ = fetched.repartition(meeting).sortWithinPartitions("kind", "h", "h2").mapInArrow(_sorted_edges(length), SCHEMA)
    repeats = compared.filter(_is(REPEAT)).unionByName(sorted_)
    span = F.struct(F.col("first").alias("start"), (F.col("last") + length).alias("end"))
    spans = repeats.select("doc", "digest", span.alias("s")).groupBy("doc", "digest").agg(F.collect_set("s").alias("spans"))
    placed = keyed.join(spans, ["doc", "digest"], "left").select("doc_id", "text", "spans")
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans string"
    return placed.mapInArrow(_cut, schema)


def _half(sha: str, at: int) -> Column:
    """The first (0) or second (1) 64 bits of a hexadecimal digest as BIGINT."""
    return F.conv(F.substring(sha, 16 * at + 1, 16), 16, -10).cast("bigint")


def _is(kind: int) -> Column:
    return F.col("kind") == kind
