"""Words that share a line: pair counts, stripes, pointwise mutual information."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import pmi_score, ws_tokens
from ..functions.cells import cells_of, numbers_of, offsets_of
from ..plans.durable import once_settled, settled
from ..plans.sizing import BROADCAST_BYTES, measured_bytes
from ..plans.skew import lookup_join
from .counts import line_count

# Fixed value: a pair counts from its tenth line on.
MIN_COUNT = 10
# Larger words of a line that travel together with the smaller ones.
BLOCK = 256
# Partners held by one stripe row.
STRIPE_ENTRIES = 100_000
# Pairs of words that a task adds up at once; a range of words that one task counts owns as many, unless it is a single word.
CELLS = 8_000_000
TOLD = 1_000_000
# Words that a task sends at once.
SENT_WORDS = 4_000_000
# Words sent in one pass: so many for each word of the lines, or FEW if that is more.
PASS_PAIRS = 3
FEW = 40_000_000
# Tasks that count at once in a pass.
MOST_TASKS = 1000
# The first words have a range of their own each; of those from each power of two on there are so many ranges.
OWN_RANGES = 1 << 14
RANGES = 1 << 12
# Passes in which more than FEW_PARTNERS named pairs are put into stripes.
STRIPE_PASSES = 8
FEW_PARTNERS = 2_000_000


def _dictionary(terms: DataFrame, min_count: int) -> tuple[DataFrame, int]:
    """``<term, df, word>`` of the words that can be part of a frequent pair, and how many there are.

    They are numbered from 0, the most frequent first. The table is written, so that a word keeps its number; the
    sizes of its parts make the numbers close up.
    """
    order = (F.desc("df"), F.asc("term"))
    ranged = terms.filter(F.col("df") >= min_count).repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = ranged.withColumns({"id": F.monotonically_increasing_id(), "part": F.spark_partition_id()})
    written = settled([numbered], "dictionary")
    parts = settled([written.groupBy("part").agg(F.min("id").alias("low"), F.count("*").alias("n"))], "parts")
    parts, size, starts = sorted(tuple(r) for r in parts.collect()), 0, []  # a row for each shuffle partition at most
    for part, low, n in parts:
        starts.append((part, low, size))
        size += n
    start = terms.sparkSession.createDataFrame(starts, "part int, low bigint, start bigint")
    word = (F.col("id") - F.col("low") + F.col("start")).cast("int")
    return written.join(F.broadcast(start), "part").select("term", "df", word.alias("word")), size


def _line_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``<term, n>`` of ``<terms>``: on how many lines of a batch each term stands."""
    for rows in batches:
        coded = rows["terms"].flatten().dictionary_encode()
        cells = pc.list_parent_indices(rows["terms"]).to_numpy().astype(np.int64) << 32 | coded.indices.to_numpy()
        cells.sort()
        cells = cells[np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])] if len(cells) else cells
        n = np.bincount(cells & 0xFFFFFFFF, minlength=len(coded.dictionary))
        yield pa.RecordBatch.from_arrays([coded.dictionary, pa.array(n)], names=["term", "n"])


def _known_words(sent: Broadcast):
    """``<words>`` of ``<hashes>``: the words of each line that are in the dictionary, in order, if there are two or more."""

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, words = sent.value
        for rows in batches:
            row, told = pc.list_parent_indices(rows["hashes"]).to_numpy(), rows["hashes"].flatten().to_numpy()
            order = np.argsort(told)  # neighbours are looked up in memory that lies close
            row, told = row[order], told[order]
            place = np.minimum(np.searchsorted(hashes, told), len(hashes) - 1)
            known = hashes[place] == told
            cells = row[known].astype(np.int64) << 32 | words[place[known]]
            cells.sort()
            cells = cells[np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])] if len(cells) else cells
            sizes = np.bincount(cells >> 32, minlength=rows.num_rows)
            cells = cells[sizes[cells >> 32] > 1]
            ends = np.cumsum(sizes[sizes > 1])
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array((cells & 0xFFFFFFFF).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([lists], names=["words"])

    return look_up


def _sent_dictionary(terms: DataFrame, words: DataFrame, size: int) -> Broadcast | None:
    """Hashes of the dictionary's terms in order, and the words, with all executors; none if they are too many or not unique.

    A hash stands for its term only where no other term of the lines, frequent or not, has the same.
    """
    if not size or size * 12 > 2 * BROADCAST_BYTES:
        return None
    spark = terms.sparkSession
    if not settled([terms.groupBy(F.xxhash64("term").alias("hash")).count().filter("count > 1")], "clashes").isEmpty():
        return None
    told = words.select(F.xxhash64("term").alias("hash"), "word").toArrow()
    hashes, numbers = told["hash"].to_numpy(), told["word"].to_numpy()
    order = np.argsort(hashes)
    return spark.sparkContext.broadcast((hashes[order], numbers[order]))


def _numbered_lines(lines: DataFrame, min_count: int) -> tuple[DataFrame, DataFrame, int]:
    """``<words, w>``, the dictionary's words of the lines and how many lines have just these, written; the dictionary and its size.

    A word on fewer than ``min_count`` lines cannot be part of a frequent pair, so only the dictionary's words
    are paired. Equal lists of words (copies of a line, above all) are counted before they are paired. While the
    dictionary is sent to all tasks, a line's words stay together where it is read; else they are brought together
    again by ids that lines get in the order in which each task reads them.
    """
    tokens = ws_tokens(F.col("line"))
    partial = lines.select(tokens.alias("terms")).mapInArrow(_line_terms, "term string, n bigint")
    terms = settled([partial.groupBy("term").agg(F.sum("n").alias("df"))], "terms")
    words, size = _dictionary(terms, min_count)
    sent = _sent_dictionary(terms, words, size)
    if sent is not None:
        hashes = F.transform(tokens, lambda t: F.xxhash64(t)).alias("hashes")
        known = lines.select(hashes).mapInArrow(_known_words(sent), "words array<int>")
    else:
        whole = settled([lines.select(F.monotonically_increasing_id().alias("id"), F.array_distinct(tokens).alias("terms"))], "lines")
        found = lookup_join(whole.select("id", F.explode("terms").alias("term")), words, "term", "df")
        known = found.groupBy("id").agg(F.sort_array(F.collect_list("word")).alias("words")).select("words").filter(F.size("words") > 1)
    return settled([known.groupBy("words").agg(F.count("*").cast("bigint").alias("w"))], "numbered"), words, size


def _lists(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of all lists end to end, where each starts, and how many it has."""
    lists = rows["words"]
    starts = lists.offsets.to_numpy().astype(np.int64)
    return lists.flatten().to_numpy(), starts[:-1] - starts[0], np.diff(starts)


def _owned_pairs(lows: np.ndarray):
    """``<range, pairs>``: how many pairs of a line's words have their larger word in each range, from ``lows`` on."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, many = np.zeros(len(lows), np.int64), np.zeros(len(lows), np.int64)
        for rows in batches:
            words, starts, sizes = _lists(rows)
            before = np.arange(len(words)) - np.repeat(starts, sizes)
            at = np.searchsorted(lows, words, "right") - 1
            pairs += np.bincount(at, before, len(lows)).astype(np.int64)
            many += np.bincount(at, minlength=len(lows))
        told = np.flatnonzero(many)
        yield pa.RecordBatch.from_arrays([pa.array(told.astype(np.int32)), pa.array(pairs[told]), pa.array(many[told])], names=["range", "pairs", "words"])

    return add_up


def _ranges(counted: DataFrame, size: int, cells: int) -> list[tuple[list[int], list[bool]]]:
    """The passes in which to count: for each the lowest words of its ranges, with the end of the last, and which are summed up.

    A range owns the pairs whose larger word is in it, ``cells`` at most unless it is a single word. As words are
    numbered by frequency, even that cannot own more pairs than the lines have words. Where the words of a range can form
    far fewer pairs than they do, tasks sum them up before they send them.
    """
    lows = [np.arange(min(size, OWN_RANGES))]
    for e in range(OWN_RANGES.bit_length() - 1, max(1, size - 1).bit_length()):
        lows.append(np.unique((RANGES + np.arange(RANGES)) << e >> (RANGES.bit_length() - 1)))
    lows = np.concatenate(lows)
    lows = lows[lows < size]
    owned = counted.mapInArrow(_owned_pairs(lows), "range int, pairs bigint, words bigint")
    owned = settled([owned.groupBy("range").agg(F.sum("pairs").alias("pairs"), F.sum("words").alias("words"))], "owned")
    told = sorted(tuple(r) for r in owned.collect())  # ranges grow with the bits of the dictionary's size only
    tasks = 2 * counted.sparkSession.sparkContext.defaultParallelism
    room = max(FEW, PASS_PAIRS * sum(n for _, _, n in told))
    cells = min(cells, max(1, room // tasks))  # so that all have work in a pass
    passes, sent = [], 0
    groups, low, pairs = [], 0, 0  # lowest word, end, and pairs of each
    ends = [*(int(lows[at]) for at, _, _ in told[1:]), size]
    for (_, more, _), start, end in zip(told, [0, *ends], ends):
        if pairs and pairs + more > cells:
            groups.append((low, start, pairs))
            low, pairs = start, 0
        pairs += more
    if pairs:
        groups.append((low, size, pairs))
    for low, end, pairs in groups:
        few = (end - low) * (low + end) // 2 * tasks * 2
        volume = min(few, pairs)
        if not passes or sent + volume > room:
            passes.append(([low], []))
            sent = 0
        sent += volume
        passes[-1][0].append(end)
        passes[-1][1].append(few <= pairs)
    return passes


def _added_up(codes: np.ndarray, weights: np.ndarray | None, spare: int) -> tuple[np.ndarray, np.ndarray]:
    """The different codes in order, and the sum of the weights (1 if none) of each. Codes leave ``spare`` bits of 63."""
    if weights is None:
        codes.sort()
        first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
        return codes[first], np.diff(np.r_[first, len(codes)])
    if spare > 0 and int(weights.max()) < 1 << spare:
        both = codes << spare | weights
        both.sort()
        codes, weights = both >> spare, both & ((1 << spare) - 1)
    else:
        order = np.argsort(codes)
        codes, weights = codes[order], weights[order]
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
    return codes[first], np.add.reduceat(weights, first)


class _Sums:
    """Pairs as codes ``larger * size + smaller``, added up whenever ``cells`` are held."""

    def __init__(self, size: int, cells: int) -> None:
        self.size, self.cells, self.spare = size, cells, 63 - (size * size).bit_length()
        self.codes, self.weights, self.held = [], [], 0

    def add(self, codes: np.ndarray, weights: np.ndarray | None) -> None:
        self.codes.append(codes)
        self.weights.append(weights)
        self.held += len(codes)

    def summed(self) -> tuple[np.ndarray, np.ndarray]:
        """All that is held; nothing is, afterwards."""
        plain = [w is None for w in self.weights]
        weights = None if all(plain) else np.concatenate([np.ones(len(c), np.int64) if w is None else w for c, w in zip(self.codes, self.weights)])
        codes = np.concatenate(self.codes) if len(self.codes) > 1 else self.codes[0]
        self.codes, self.weights, self.held = [], [], 0
        return _added_up(codes, weights, self.spare)

    def add_lists(self, words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, owned: np.ndarray, w: np.ndarray) -> Iterator[None]:
        """The pairs of each of the last ``owned`` words of lists with those before it; stops whenever ``cells`` are held."""
        words, last = words.astype(np.int64), np.repeat(starts + sizes - owned, owned)
        place = last + np.arange(len(last)) - np.repeat(np.cumsum(owned) - owned, owned)
        start = np.repeat(starts, owned)
        many, code, w = place - start, words[place] * self.size, np.repeat(w, owned)
        ends, at = np.cumsum(many), 0
        while at < len(many):
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + max(1, self.cells - self.held), "right")))
            k, of = many[at:to], w[at:to]
            smaller = np.arange(k.sum()) + np.repeat(start[at:to] - (ends[at:to] - k - done), k)
            self.add(words[smaller] + np.repeat(code[at:to], k), None if (of == 1).all() else np.repeat(of, k))
            at = to
            if self.held >= self.cells:
                yield


# What is sent to the range of words from x on: lists of words, the larger ones of which are owned there, or pairs added up.
LISTS, STRIPES, PAIRS = range(3)
SENT_DDL = "x int, kind int, words binary, sizes binary, owned binary, weights binary"


def _sent(size: int, lows: list[int], summed: list[bool], cells: int, block: int, by: int):
    """Rows of :data:`SENT_DDL` of ``<words, w>``, for the ranges of one pass."""
    lows, summed = np.array(lows, np.int32), np.array(summed)

    def rows(x: np.ndarray, kind: int, *columns: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int32)), pa.array(np.full(len(x), kind, np.int32)), *columns], names=[c.split()[0] for c in SENT_DDL.split(", ")])

    def lists(at: np.ndarray, words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, owned: np.ndarray, w: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.argsort(at, kind="stable")
        at, starts, sizes, owned, w = (c[order] for c in (at, starts, sizes, owned, w))
        ends, i = np.cumsum(sizes), 0
        while i < len(at):
            done = ends[i - 1] if i else 0
            to = max(i + 1, int(np.searchsorted(ends, done + SENT_WORDS, "right")))
            k = sizes[i:to]
            place = np.arange(k.sum()) + np.repeat(starts[i:to] - (ends[i:to] - k - done), k)
            last = np.flatnonzero(np.r_[at[i + 1 : to] != at[i : to - 1], True])
            cut = last + 1
            numbers = [cells_of(c[i:to].astype(np.int32), cut) for c in (sizes, owned)]
            yield rows(lows[at[i:to][last]], LISTS, cells_of(words[place], ends[i:to][last] - done), *numbers, cells_of(w[i:to], cut))
            i = to

    def sums(codes: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        larger, smaller = np.divmod(codes, size)
        at = np.searchsorted(lows, larger, "right") - 1
        last = np.flatnonzero(np.r_[at[1:] != at[:-1], True])
        none = cells_of(np.zeros(0, np.int32), np.zeros(len(last), np.int64))
        if by == PAIRS:
            yield rows(lows[at[last]], PAIRS, cells_of(codes, last + 1), none, none, cells_of(n, last + 1))
            return
        ends = np.flatnonzero(np.r_[larger[1:] != larger[:-1], True])
        cut = np.searchsorted(ends, last) + 1
        of = [cells_of(c.astype(np.int32), cut) for c in (np.diff(np.r_[-1, ends]), larger[ends])]
        yield rows(lows[at[last]], STRIPES, cells_of(smaller.astype(np.int32), last + 1), *of, cells_of(n, last + 1))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Sums(size, cells)
        for batch in batches:
            words, starts, sizes = _lists(batch)
            w = batch["w"].to_numpy()
            own = np.flatnonzero((words >= lows[0]) & (words < lows[-1]))
            line = np.searchsorted(starts, own, "right") - 1
            later = own > starts[line]
            own, line = own[later], line[later]
            if not len(own):
                continue
            at = np.searchsorted(lows, words[own], "right") - 1
            fresh = np.r_[True, (line[1:] != line[:-1]) | (at[1:] != at[:-1])]
            nth = np.arange(len(own)) - np.repeat(np.flatnonzero(fresh), np.diff(np.r_[np.flatnonzero(fresh), len(own)]))
            first = np.flatnonzero(nth % block == 0)
            owned = np.diff(np.r_[first, len(own)])
            line, at, end = line[first], at[first], own[first + owned - 1] + 1
            pieces = (starts[line], end - starts[line], owned, w[line])
            for here, add in ((summed[at], True), (~summed[at], False)):
                some = [c[here] for c in pieces]
                if add and len(some[0]):
                    for _ in held.add_lists(words, *some):
                        yield from sums(*held.summed())
                elif len(some[0]):
                    yield from lists(at[here], words, *some)
        if held.held:
            yield from sums(*held.summed())

    return send


def _received(size: int, min_count: int, cells: int):
    """``<x, y, n>``, x < y, of the rows of :func:`_sent` in order of their ranges: the pairs on ``min_count`` lines or more."""

    def flat(rows: list[pa.RecordBatch], sums: _Sums) -> Iterator[None]:
        for kind in (LISTS, STRIPES, PAIRS):
            of = [r for b in rows for r in [b.filter(pc.equal(b["kind"], kind))] if r.num_rows]
            if not of:
                continue
            of = pa.Table.from_batches(of).combine_chunks()
            column = {c: of[c].combine_chunks() for c in ("words", "sizes", "owned", "weights")}
            words, n = numbers_of(column["words"], np.int64 if kind == PAIRS else np.int32), numbers_of(column["weights"])
            if kind == PAIRS:
                sums.add(words, n)
                continue
            sizes, owned = (numbers_of(column[c], np.int32).astype(np.int64) for c in ("sizes", "owned"))
            if kind == STRIPES:
                sums.add(words + np.repeat(owned * size, sizes), n)
            else:
                yield from sums.add_lists(words, np.cumsum(sizes) - sizes, sizes, owned, n)
        yield

    def told(sums: _Sums) -> Iterator[pa.RecordBatch]:
        if sums.held:
            code, n = sums.summed()
            code, n = code[n >= min_count], n[n >= min_count]
            for i in range(0, len(code), TOLD):
                y, x = np.divmod(code[i : i + TOLD], size)
                yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int32)), pa.array(y.astype(np.int32)), pa.array(n[i : i + TOLD])], names=["x", "y", "n"])

    def receive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, rows, many, key = _Sums(size, cells), [], 0, None

        def add() -> None:
            for _ in flat(rows, sums):
                if sums.held >= 2 * cells:  # what is new is added to what was summed up before
                    sums.add(*sums.summed())
            rows.clear()

        for batch in batches:
            x = batch["x"].to_numpy()
            cuts = [*np.flatnonzero(np.r_[True, x[1:] != x[:-1]]), len(x)]
            for at, to in zip(cuts, cuts[1:]):
                if rows and (x[at] != key or many >= SENT_WORDS):
                    add()
                    many = 0
                if x[at] != key:
                    yield from told(sums)
                    key = x[at]
                rows.append(batch.slice(at, to - at))
                many += sum(int(o[-1] - o[0]) // 4 for o in [offsets_of(rows[-1]["words"])])
        if rows:
            add()
        yield from told(sums)

    return receive


def _counts(lines: DataFrame, min_count: int, block: int, cells: int, by: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    counted, words, size = _numbered_lines(lines, min_count)

    def count(lows: list[int], summed: list[bool]) -> DataFrame:
        sent = counted.mapInArrow(_sent(size, lows, summed, cells, block, by), SENT_DDL)
        ranges = sent.repartition(max(2, min(len(summed), MOST_TASKS)), "x").sortWithinPartitions("x")
        return ranges.mapInArrow(_received(size, min_count, cells), "x int, y int, n bigint")

    passes = _ranges(counted, size, cells) or [([0, 0], [False])]
    return count(*passes[0]) if len(passes) == 1 else settled((count(*one) for one in passes), "counts"), words, lines


def _pair_counts(
    lines: DataFrame, min_count: int, block: int = BLOCK, cells: int = CELLS
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``<x, y, n>`` with x < y as dictionary ids, the dictionary, and the lines.

    A task counts all pairs whose larger word is in its range of words. To it move the words of lines up to those, many
    lines in a row, in passes over the ranges; of frequent words, pairs and their counts in a task.
    """
    return _counts(lines, min_count, block, cells, PAIRS)


def _stripe_counts(
    lines: DataFrame, min_count: int, block: int = BLOCK, entries: int = STRIPE_ENTRIES, cells: int = CELLS
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``<x, y, n>`` as :func:`_pair_counts`; what moves of frequent words are stripes, a word's partners and their counts.

    A task holds no more than ``cells`` or ``entries`` partners at once, whichever is more.
    """
    return _counts(lines, min_count, block, max(cells, entries), STRIPES)


COUNTING = {"pairs": _pair_counts, "stripes": _stripe_counts}


def _with_terms(counts: DataFrame, words: DataFrame, sides: str = "xy") -> DataFrame:
    """``<a, b, df_a, df_b, n>`` of id pairs; ``sides`` says which word is joined first.

    The most frequent words are broadcast, as many as BROADCAST_BYTES hold. The pairs with others are joined by
    shuffles; as these words are rare, none of them has many pairs.
    """
    counts = once_settled(counts, "counts")
    size, need = words.count(), measured_bytes(words)
    head = size if need <= BROADCAST_BYTES else size * BROADCAST_BYTES // need

    def named(pairs: DataFrame, side: str, sent: bool) -> DataFrame:
        term = {"x": "a", "y": "b"}[side]
        own = words.filter(F.col("word") < head) if sent else words.filter(F.col("word") >= head).hint("merge")
        own = own.select(F.col("word").alias(side), F.col("term").alias(term), F.col("df").alias(f"df_{term}"))
        return pairs.join(F.broadcast(own) if sent else own, side).drop(side)

    x, y = F.col("x") < head, F.col("y") < head
    parts = [(y, {"x": True, "y": True}), (x & ~y, {"x": True, "y": False}), (~x, {"x": False, "y": False})]
    if head == size:
        parts = [(F.lit(True), parts[0][1])]
    return reduce(DataFrame.unionByName, [reduce(lambda p, side: named(p, side, sent[side]), sides, counts.filter(of)) for of, sent in parts])


def _both_orders(pairs: DataFrame, *others: str) -> DataFrame:
    """Each pair as (x, y) and as (y, x), from one evaluation of ``pairs``."""
    orders = F.array(
        F.struct(F.col("a").alias("x"), F.col("b").alias("y")), F.struct(F.col("b").alias("x"), F.col("a").alias("y"))
    )
    return pairs.select(F.explode(orders).alias("o"), *others).select("o.x", "o.y", *others)


def cooccurrence(lines: DataFrame, min_count: int = MIN_COUNT, block: int = BLOCK, by: str = "pairs") -> DataFrame:
    """``<x, y, n>``: ordered pairs of different words and the number of lines, ``min_count`` or more, with both.

    Each row of ``lines`` is a line, whether it has an id or not; columns besides ``line`` are not read. ``by`` says
    what is counted and moved, single ``pairs`` or ``stripes`` of a word's partners; the result is the same.
    """
    counts, words, _ = COUNTING[by](lines, min_count, block)
    if by == "pairs":
        return _both_orders(_with_terms(counts, words), "n")
    # Who groups stripes asks for some words at a time, so each order is told by itself, and joins its first word first.
    counts = once_settled(counts, "counts")
    orders = (("xy", "a", "b"), ("yx", "b", "a"))
    parts = [_with_terms(counts, words, sides).select(F.col(x).alias("x"), F.col(y).alias("y"), "n") for sides, x, y in orders]
    return parts[0].unionByName(parts[1])


def pmi(lines: DataFrame, min_count: int = MIN_COUNT, block: int = BLOCK) -> DataFrame:
    """``<x, y, n, pmi>``: the pairs of :func:`cooccurrence` with their pointwise mutual information (log10)."""
    counts, words, written = _pair_counts(lines, min_count, block)
    pairs = _with_terms(counts, words)
    total = line_count(written).scalar()
    scored = pairs.withColumn("pmi", pmi_score(F.col("n"), F.col("df_a"), F.col("df_b"), total))
    return _both_orders(scored, "n", "pmi")


def stripes(pairs: DataFrame, entries: int = STRIPE_ENTRIES) -> DataFrame:
    """``<x, shard, stripe MAP<y, n>>``: the partners of a word as maps of about ``entries`` at most.

    Almost every word has one stripe; those of a word with more partners are sharded by partner.
    """
    pairs = pairs.select("x", "y", "n")
    partners = settled([pairs.groupBy("x").agg(F.count("*").alias("partners"))], "partners")
    total = partners.agg(F.sum("partners")).first()[0] or 0
    passes = STRIPE_PASSES if total > FEW_PARTNERS else 1

    def build(part: int) -> DataFrame:
        own = F.pmod(F.xxhash64("x"), F.lit(passes)) == part
        sized = lookup_join(pairs.filter(own), partners.filter(own), "x", "partners")
        shards = F.ceil(F.col("partners") / entries)
        return (
            sized.withColumn("shard", F.pmod(F.xxhash64("y"), shards))
            .groupBy("x", "shard")
            .agg(F.map_from_entries(F.collect_list(F.struct("y", "n"))).alias("stripe"))
        )

    return build(0) if passes == 1 else settled((build(part) for part in range(passes)), "stripes")


def pair_counts(pairs: DataFrame) -> DataFrame:
    """``<ordered, unordered>``: pairs with (x, y) and (y, x) told apart, and taken as one."""
    return pairs.agg(F.count("*").alias("ordered"), F.count_if(F.col("x") < F.col("y")).alias("unordered"))


def top_pair(pmi_pairs: DataFrame) -> DataFrame:
    """The pair of highest PMI, first in word order among equals."""
    return pmi_pairs.filter(F.col("x") < F.col("y")).orderBy(F.desc("pmi"), "x", "y").limit(1)


def top_partners(pmi_pairs: DataFrame, anchors: Sequence[str], k: int = 3) -> DataFrame:
    """``<x, rank, y, pmi>``: the ``k`` words of highest PMI with each anchor word."""
    best = W.partitionBy("x").orderBy(F.desc("pmi"), "y")
    return (
        pmi_pairs.filter(F.col("x").isin(list(anchors)))
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("x", F.col("rank").cast("bigint").alias("rank"), "y", "pmi")
    )
