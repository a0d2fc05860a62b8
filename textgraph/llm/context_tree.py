"""Language-model scores by context-tree weighting over bytes, beside a unigram base score.

A text is predicted byte by byte, a byte bit by bit. Each bit has one binary context tree: its node at depth d is the
last d bytes and the byte's bits so far, with a Krichevsky-Trofimov estimate of the next bit. Weighting mixes the
estimates of all depths, and since block probabilities need counts alone, the tree is learnt by counting:

1. Documents are dealt to blocks; a block tells its distinct (context, byte) strings and words, with training counts.
   Documents travel compressed, strings packed: one row holds a block's strings of one part, dealt by hash, as a
   sorted array.
2. Counts are summed over blocks. Subtrees below two context bytes are weighted inside tasks, each in one task; what
   is above is two levels of bounded size, summed over all subtrees.
3. Every distinct string gets its code length from the tree, and each part answers the blocks that hold its strings;
   there the documents' sums are made. So neither the tree nor the vocabulary is ever in one place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.durable import durable
from .columns import LOWER, UPPER, fold, placed_rows, text_bytes

# Fixed values of the contract: documents of this fold of seven are not learnt from.
FOLDS, HELD_OUT = 7, 2
# Context bytes of the deepest nodes.
DEPTH = 5
# Text bytes of a block, and of the slices in which a block is read.
BLOCK_BYTES, SLICE_BYTES = 16 << 20, 1 << 20
# Parts that the strings are dealt to for each block; a part is merged and looked up as a whole.
PARTS_PER_BLOCK = 2
# Strings weighted together; a subtree is never cut.
TOGETHER = 1 << 17
# UTF-8 has no such byte: it ends a text and stands before it.
END = b"\xff"
# The end of a text among the words, which hold no blanks.
END_WORD = "\n"

_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, eight steps up where it is exact to double precision."""
    low = np.ones_like(x)
    for k in range(8):
        low *= x + k
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7) + 1 / (1188 * y**9)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(low)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log probability of a block with so many zeros and ones by the Krichevsky-Trofimov estimator."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - np.log(np.pi)


class Level:
    """The nodes of one depth: what they weigh against their children, and their own estimate of a one."""

    def __init__(self, zeros: np.ndarray, ones: np.ndarray, children: np.ndarray | None):
        own = log_kt(zeros, ones)
        self.estimate = (ones + 0.5) / (zeros + ones + 1.0)
        if children is None:  # the deepest nodes
            self.weight, self.log_p = np.ones_like(own), own
        else:
            self.weight = 1 / (1 + np.exp(np.clip(children - own, -700, 700)))
            self.log_p = np.logaddexp(own, children) - np.log(2)

    def mixed(self, at: np.ndarray, below: np.ndarray) -> np.ndarray:
        """Probability of a one at the nodes ``at``, given that of the nodes below them."""
        return self.weight[at] * self.estimate[at] + (1 - self.weight[at]) * below


class Subtrees:
    """Nodes of depth 2 and more of whole subtrees, from sorted strings (latest context byte first) and counts."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, depth: int):
        byte = (keys & 255).astype(np.int64)
        shifts = np.arange(8, 0, -1)
        node = (256 | byte)[:, None] >> shifts  # 1, then the bits so far
        self.bit = (byte[:, None] >> (shifts - 1)) & 1
        context = (keys >> 8).astype(np.int64)
        full = (context[:, None] << 8 | node).ravel()
        self.nodes, inverse = np.unique(full, return_inverse=True)
        self.of_string = inverse.reshape(node.shape)
        n = np.repeat(counts.astype(float), 8)
        ones = np.bincount(self.of_string.ravel(), n * self.bit.ravel(), len(self.nodes))
        zeros = np.bincount(self.of_string.ravel(), n, len(self.nodes)) - ones
        level = Level(zeros, ones, None)
        self.levels, self.parents = [level], []
        names = self.nodes
        for _ in range(depth - 2):  # one context byte less each time, the oldest
            up = names >> 16 << 8 | names & 255
            names, inverse = np.unique(up, return_inverse=True)
            zeros, ones, children = (np.bincount(inverse, v, len(names)) for v in (zeros, ones, level.log_p))
            level = Level(zeros, ones, children)
            self.levels.append(level)
            self.parents.append(inverse)
        self.top, self.zeros, self.ones = names, zeros, ones

    def sums_above(self) -> tuple[np.ndarray, ...]:
        """``(node, zeros, ones, children)``: what these subtrees add to the nodes of depth 1."""
        names, inverse = np.unique((self.top >> 16 << 8 | self.top & 255) & 0xFFFF, return_inverse=True)
        return names, *(np.bincount(inverse, v, len(names)) for v in (self.zeros, self.ones, self.levels[-1].log_p))

    def log10_of_strings(self, upper: list[Level]) -> np.ndarray:
        """Log probability of each string's byte; ``upper`` are the levels of depths 1 and 0, by context and node."""
        p, at = self.levels[0].estimate, np.arange(len(self.nodes))
        for level, parent in zip(self.levels[1:], self.parents):
            at = parent[at]
            p = level.mixed(at, p)
        top = self.top[at]
        p = upper[0].mixed((top >> 16 << 8 | top & 255) & 0xFFFF, p)
        p = upper[1].mixed(top & 255, p)
        ones = p[self.of_string]
        return np.log10(np.where(self.bit == 1, ones, 1 - ones)).sum(axis=1)


def upper_levels(nodes: np.ndarray, zeros: np.ndarray, ones: np.ndarray, children: np.ndarray) -> list[Level]:
    """The levels of depths 1 and 0, as full tables: 65,536 and 256 nodes."""
    full = [np.bincount(nodes, v, 1 << 16) for v in (zeros, ones, children)]
    one = Level(*full)
    # A node without data has nothing to weigh.
    root = [v.reshape(256, 256).sum(axis=0) for v in (full[0], full[1], np.where(full[0] + full[1] > 0, one.log_p, 0.0))]
    return [one, Level(*root)]


def strings(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """All (context, byte) strings of lower-cased texts, ends included, and where each text's strings start."""
    gap = END * depth
    blob = np.frombuffer(gap + gap.join(texts) + END, np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    key = np.zeros(len(blob) - depth, np.uint64)
    for k in range(1, depth + 1):  # the byte k before
        key |= blob[depth - k : len(blob) - k].astype(np.uint64) << np.uint64(8 * (depth + 1 - k))
    key |= blob[depth:]
    real = np.ones(len(key), bool)
    ends = np.cumsum(sizes + depth - 1) - (depth - 1)
    for k in range(depth - 1):  # what only parts two texts is not predicted
        real[ends[:-1] + k] = False
    return key[real], np.cumsum(sizes) - sizes


def _bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a batch that go to one block as one compressed record batch."""
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    for batch in batches:
        block = batch.column("block").to_numpy()
        order = np.argsort(block, kind="stable")
        cuts = np.flatnonzero(np.r_[True, block[order][1:] != block[order][:-1], True]) if len(block) else [0]
        rows = []
        for a, b in zip(cuts, cuts[1:]):
            taken = batch.select(["doc_id", "train", "text"]).take(order[a:b])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, taken.schema, options=options) as out:
                out.write_batch(taken)
            rows.append((int(block[order[a]]), sink.getvalue().to_pybytes()))
        columns = zip(*rows) if rows else [[]] * 2
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.binary()))], names=["block", "rows"])
        pa.default_memory_pool().release_unused()


def _slices(bundles: pa.Table) -> Iterator[pa.Table]:
    """A block's documents, unpacked, in runs of bounded text; one row a document."""
    held, size = [], 0
    for bundle in bundles["rows"]:
        with pa.ipc.open_stream(bundle.as_buffer()) as rows:
            table = rows.read_all()
        ends = np.cumsum(pc.binary_length(table["text"]).to_numpy()) // SLICE_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), len(table)]
        for a, b in zip(cuts, cuts[1:]):
            held.append(table.take(np.arange(a, b)))  # copied: string functions see no offsets
            size += held[-1].nbytes
            if size >= SLICE_BYTES:
                yield pa.concat_tables(held).combine_chunks()
                held, size = [], 0
    if held:
        yield pa.concat_tables(held).combine_chunks()


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts and each one's text; one end word a text."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words, owner = pc.list_flatten(split), pc.list_parent_indices(split)
    filled = pc.not_equal(words, "")
    words, owner = words.filter(filled), owner.filter(filled)
    return pa.concat_arrays([words, pa.array([END_WORD] * len(texts), words.type)]), np.r_[owner.to_numpy(), np.arange(len(texts))]


def _array(column: pa.ChunkedArray) -> pa.Array:
    return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks)


def _packed(values: np.ndarray) -> bytes:
    """An array as bytes, all first bytes before all second ones: what is alike in sorted numbers then stands together."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _unpacked(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")  # of sorted stretches, so hardly more than a merge
    key, count = key[order], count[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(count, first) if len(key) else count


def _by_part(keys: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """The places of sorted keys by part, in order."""
    part = (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % parts
    order = np.argsort(part, kind="stable")
    part = part[order]
    cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True]) if len(part) else np.zeros(1, np.int64)
    for a, b in zip(cuts, cuts[1:]):
        yield int(part[a]), order[a:b]


VOCABULARY = "block bigint, part int, grams binary, counts binary, word string, n bigint"


def _vocabulary(depth: int, parts: int):
    def tell(table: pa.Table) -> pa.Table:
        keys, counts, words, held, kept = [], [], [], 0, 0
        for part in _slices(table):
            for train in (True, False):
                rows = part.filter(pc.equal(part["train"], train))
                if not len(rows):
                    continue
                text = _array(rows["text"]).cast(pa.large_string())
                found, n = np.unique(strings([t.translate(_FOLD) for t in text_bytes(text)], depth)[0].view(np.int64), return_counts=True)
                keys.append(found)
                counts.append(n if train else np.zeros(len(n), np.int64))
                told = pc.value_counts(_words(text)[0])
                n = told.field("counts") if train else pa.array(np.zeros(len(told), np.int64))
                words.append(pa.table({"key": told.field("values"), "n": n.cast(pa.int64())}))
                held += len(found)
            if held > 2 * kept + TOGETHER:
                key, count = _summed(keys, counts)
                keys, counts, held, kept = [key], [count], len(key), len(key)
                words = [pa.concat_tables(words).group_by("key").aggregate([("n", "sum")]).rename_columns(["key", "n"])]
        key, count = _summed(keys, counts)
        packed = [(p, _packed(key[at]), _packed(count[at])) for p, at in _by_part(key, parts)]
        words = pa.concat_tables(words).group_by("key").aggregate([("n", "sum")])
        pa.default_memory_pool().release_unused()  # workers are used again, and keep what Arrow keeps
        size = len(packed) + len(words)
        empty = pa.nulls(len(words), pa.binary())
        return pa.table(
            {
                "block": pa.array(np.full(size, table["block"][0].as_py(), np.int64)),
                "part": pa.concat_arrays([pa.array([p for p, _, _ in packed], pa.int32()), pa.nulls(len(words), pa.int32())]),
                "grams": pa.concat_arrays([pa.array([k for _, k, _ in packed], pa.binary()), empty]),
                "counts": pa.concat_arrays([pa.array([c for _, _, c in packed], pa.binary()), empty]),
                "word": pa.concat_arrays([pa.nulls(len(packed), pa.string()), _array(words["key"]).cast(pa.string())]),
                "n": pa.concat_arrays([pa.nulls(len(packed), pa.int64()), _array(words["n_sum"])]),
            }
        )

    return tell


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by part: a part's strings of all blocks, summed up every now and then, so each is held once."""

    def out(keys: list, counts: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()) for a in _summed(keys, counts)], names=["gram", "n"])

    part, keys, counts, held, kept = None, [], [], 0, 0
    for batch in batches:
        for p, k, c in zip(*(batch.column(n).to_pylist() for n in ("part", "grams", "counts"))):
            if p != part and keys:
                yield out(keys, counts)
                keys, counts, held, kept = [], [], 0, 0
            part = p
            keys.append(_unpacked(k, np.int64))
            counts.append(_unpacked(c, np.int64))
            held += len(keys[-1])
            if held > 2 * kept + TOGETHER:
                key, count = _summed(keys, counts)
                keys, counts, held, kept = [key], [count], len(key), len(key)
    if keys:
        yield out(keys, counts)


def _whole_subtrees(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[tuple[np.ndarray, Subtrees]]:
    """Sorted strings, cut only between strings whose last two context bytes differ."""
    shift = np.int64(8 * (depth - 1))
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        keys = np.r_[keys, batch.column("gram").to_numpy()]
        counts = np.r_[counts, batch.column("n").to_numpy()]
        if len(keys) >= TOGETHER:
            cut = int(np.searchsorted(keys >> shift, keys[-1] >> shift))
            if cut:
                yield keys[:cut], Subtrees(keys[:cut], counts[:cut], depth)
                keys, counts = keys[cut:], counts[cut:]
    if len(keys):
        yield keys, Subtrees(keys, counts, depth)


def _sums(depth: int):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, trees in _whole_subtrees(batches, depth):
            arrays = [pa.array(trees.sums_above()[0], pa.int64()), *(pa.array(v, pa.float64()) for v in trees.sums_above()[1:])]
            yield pa.RecordBatch.from_arrays(arrays, names=["node", "zeros", "ones", "children"])

    return add


def _lengths(depth: int, parts: int, upper):
    """Each string's code length, packed by part."""

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, trees in _whole_subtrees(batches, depth):
            value = trees.log10_of_strings(upper.value).astype(np.float32)
            rows = [(p, _packed(keys[at]), _packed(value[at])) for p, at in _by_part(keys, parts)]
            kinds = (pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["part", "grams", "lengths"])

    return tell


ANSWERS = "block bigint, part int, lengths binary"


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by part, its code lengths (no block) before the blocks that ask for some of them."""
    part, keys, values, table = None, [], [], None
    for batch in batches:
        rows = []
        for p, block, k, v in zip(*(batch.column(n).to_pylist() for n in ("part", "block", "grams", "lengths"))):
            if p != part:
                part, keys, values, table = p, [], [], None
            if block is None:
                keys.append(_unpacked(k, np.int64))
                values.append(_unpacked(v, np.float32))
                continue
            if table is None:
                key, value = np.concatenate(keys), np.concatenate(values)
                order = np.argsort(key)
                table = key[order], value[order]
            rows.append((block, p, _packed(table[1][np.searchsorted(table[0], _unpacked(k, np.int64))])))
        if rows:
            kinds = (pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["block", "part", "lengths"])


def _distinct_strings(bundles: pa.Table, depth: int) -> np.ndarray:
    """A block's distinct strings, sorted, as it has asked for them."""
    keys, held, kept = [], 0, 0
    for part in _slices(bundles):
        texts = [t.translate(_FOLD) for t in text_bytes(_array(part["text"]))]
        keys.append(np.unique(strings(texts, depth)[0].view(np.int64)))
        held += len(keys[-1])
        if held > 2 * kept + TOGETHER:
            keys = [np.unique(np.concatenate(keys))]
            held = kept = len(keys[0])
    return np.unique(np.concatenate(keys))


def _scores(depth: int, parts: int, known: int, distinct: int):
    def score(_, table: pa.Table, values: pa.Table) -> pa.Table:
        is_word = pc.is_valid(values["word"])
        words, packed = values.filter(is_word), values.filter(pc.invert(is_word))
        key = _distinct_strings(table, depth)
        length_of, answers = np.empty(len(key)), dict(zip(packed["part"].to_pylist(), packed["lengths"]))
        for p, at in _by_part(key, parts):
            length_of[at] = _unpacked(answers[p].as_py(), np.float32)
        grams = pd.Index(key)
        word_set, word_count = _array(words["word"]).cast(pa.large_string()), words["value"].to_numpy()
        out = []
        for part in _slices(table):
            text = _array(part["text"]).cast(pa.large_string())
            key, starts = strings([t.translate(_FOLD) for t in text_bytes(text)], depth)
            lengths = length_of[grams.get_indexer(key.view(np.int64))]
            found, owner = _words(text)
            found = found.dictionary_encode()
            count = word_count[pc.index_in(found.dictionary, value_set=word_set).to_numpy()][found.indices.to_numpy()]
            logs = np.log10((count + 1) / (known + 1.0 * (distinct + 1)))
            sums = [np.bincount(owner, v, len(part)) for v in (None, count > 0, logs)]
            out.append(
                pa.table(
                    {
                        "doc_id": _array(part["doc_id"]),
                        "n_tokens": pa.array(sums[0].astype(np.int64)),
                        "n_known": pa.array(sums[1].astype(np.int64)),
                        "base_score": pa.array(sums[2]),
                        "score": pa.array(np.add.reduceat(lengths, starts)),
                    }
                )
            )
        pa.default_memory_pool().release_unused()
        return pa.concat_tables(out)

    return score


def in_blocks(rows: DataFrame, blocks: int) -> DataFrame:
    """``<block, doc_id, train, text>``: rows dealt by their ids, sizes and places in their files, repeated rows too."""
    block = F.pmod(F.xxhash64("doc_id", F.octet_length("text"), "place"), F.lit(blocks))
    return rows.select(block.alias("block"), "doc_id", (fold("doc_id", FOLDS) != HELD_OUT).alias("train"), "text")


def context_tree_scores(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", depth: int = DEPTH, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``<doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score>``, one row per document.

    Learnt are only documents whose crc32(doc_id) mod 7 is not 2. Both models see A-Z lower-cased. ``score`` is the
    tree's log10 probability of all bytes of the text and its end, ``base_score`` the unigram model's of all words
    and the end. A null text is an empty one: its end is scored. Repeated rows are learnt and scored as often as
    they come; without any training document, every bit has probability one half. ``depth`` is 2 to 7.
    """
    if not 2 <= depth <= 7:
        raise ValueError("depth must be 2 to 7")
    rows = placed_rows(docs, doc_id, text)
    total = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    dealt = in_blocks(rows, blocks).mapInArrow(_bundles, "block bigint, rows binary")
    parts = max(8, PARTS_PER_BLOCK * blocks)
    vocabulary = durable(dealt.groupBy("block").applyInArrow(_vocabulary(depth, parts), VOCABULARY), "vocabulary")
    by_part, by_word = vocabulary.filter("part IS NOT NULL"), vocabulary.filter("word IS NOT NULL")
    meeting = by_part.select("part", "grams", "counts").repartition("part").sortWithinPartitions("part")
    grams = durable(meeting.mapInArrow(_merged, "gram bigint, n bigint"), "grams")
    words = durable(by_word.groupBy("word").agg(F.sum("n").cast("double").alias("value")), "words")
    known, distinct = words.agg(F.coalesce(F.sum("value"), F.lit(0.0)), F.count_if(F.col("value") > 0)).first()

    def in_order(strings_: DataFrame) -> DataFrame:
        subtree = F.shiftright("gram", 8 * (depth - 1))
        return strings_.repartition(subtree).sortWithinPartitions("gram")

    sums = in_order(grams.filter("n > 0")).mapInArrow(_sums(depth), "node bigint, zeros double, ones double, children double")
    above = sums.groupBy("node").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "children")]).toArrow()  # 65,280 rows at most
    upper = docs.sparkSession.sparkContext.broadcast(upper_levels(*(above[c].to_numpy() for c in ("node", "zeros", "ones", "children"))))
    lengths = in_order(grams).mapInArrow(_lengths(depth, parts, upper), "part int, grams binary, lengths binary")
    nothing = F.lit(None)
    asked = by_part.select("part", "block", "grams", nothing.cast("binary").alias("lengths"))
    both = lengths.select("part", nothing.cast("bigint").alias("block"), "grams", "lengths").unionByName(asked)
    answers = both.repartition("part").sortWithinPartitions("part", F.asc_nulls_first("block")).mapInArrow(_answered, ANSWERS)
    values = answers.select("*", nothing.cast("string").alias("word"), nothing.cast("double").alias("value")).unionByName(
        by_word.join(words, "word").select("block", nothing.cast("int").alias("part"), nothing.cast("binary").alias("lengths"), "word", "value")
    )
    result = "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double"
    scored = dealt.groupBy("block").cogroup(values.groupBy("block")).applyInArrow(_scores(depth, parts, int(known), distinct), result)
    return scored.select(
        "doc_id",
        (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(int(known)).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    )
