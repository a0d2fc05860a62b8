"""Inverted index over ``<docid, line>`` records.

The long table ``<term, docid, tf>`` is the index; it has no group to outgrow a task. Lists, maps and gaps are
views of it, cut into blocks of ``span`` docids: block b of a term holds its documents from b * span up to
(b + 1) * span, so a list never has more than ``span`` entries, however common the term is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from ..functions.cells import bytes_of, cells_of, numbers_of, offsets_of, sizes_of, strings_of
from ..functions.text import ws_tokens
from ..plans.durable import durable, once_settled, settled
from ..plans.sizing import broadcast_if_small
from ..plans.skew import lookup_join

SPAN = 1 << 16
# Postings that are encoded, listed or decoded at once; more are dealt to passes by term, PASSES at most.
FEW = 2_000_000
PASSES = 8
# Documents whose terms are counted at once.
COUNTED = 2000
# Buckets of terms, and docids that a task encodes at once of one bucket.
BUCKET_BITS = 12
RANGE = 1 << 22
# Postings that a task puts in order at once, those of a written row, and rows passed on at once.
CHUNK = 1_000_000
ROW_GAPS = 512
TOLD = 50_000


@dataclass(frozen=True)
class BlockIndex:
    """``postings<term, docid, tf, block>``, of which a read of few blocks reads nothing else, and ``terms<term, df>``."""

    postings: DataFrame
    terms: DataFrame | None


def _counted_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``<term, docid, tf>`` of ``<docid, terms>``, each row by itself."""
    for rows in (batch.slice(i, COUNTED) for batch in batches for i in range(0, batch.num_rows, COUNTED)):
        tokens = pa.table({"row": pc.list_parent_indices(rows["terms"]), "term": pc.list_flatten(rows["terms"])})
        counted = tokens.group_by(["row", "term"], use_threads=False).aggregate([([], "count_all")])
        told = {"term": counted["term"], "docid": rows["docid"].take(counted["row"].combine_chunks()), "tf": counted["count_all"]}
        yield from pa.table(told).to_batches(max_chunksize=100_000)


def build_postings(lines: DataFrame) -> DataFrame:
    """``<term, docid, tf>``: how often each document holds each of its blank-separated terms.

    Each row's terms are counted where the row is read. Only if some docid stands in several rows (the docids alone
    are counted first) are these counts shuffled and added up.
    """
    schema = StructType().add("term", StringType()).add(lines.schema["docid"]).add("tf", LongType())
    tokens = lines.select("docid", ws_tokens(F.col("line")).alias("terms"))
    counted = tokens.mapInArrow(_counted_terms, schema)
    if lines.groupBy("docid").agg(F.count("*").alias("rows")).filter(F.col("rows") > 1).isEmpty():
        counted.tokens = tokens  # for who goes on with them in the same task
        return counted
    return counted.groupBy("term", "docid").agg(F.sum("tf").alias("tf"))


def _by_terms(table: DataFrame, build: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """``build(table)`` of a written table; of a large one in passes over hashes of terms, each written before the next.

    ``build`` must treat each term by itself.
    """
    passes = min(PASSES, -(-table.count() // FEW))
    if passes <= 1:
        return build(table)
    of = F.pmod(F.xxhash64("term"), F.lit(passes))
    return settled((build(table.filter(of == part)) for part in range(passes)), name)


def term_df(postings: DataFrame) -> DataFrame:
    """``<term, df>``: documents holding the term."""
    return postings.groupBy("term").agg(F.count("*").alias("df"))


def block_of(span: int) -> Column:
    return F.expr(f"docid div {span}")


def _with_df(blocks: DataFrame, counts: DataFrame) -> DataFrame:
    """``blocks`` with ``df``, the documents of the term, from ``counts<term, block, block_df>`` of all its blocks."""
    sums = counts.groupBy("term").agg(F.sum("block_df").alias("df"), F.count("*").alias("blocks"))
    return lookup_join(blocks, settled([sums], "df"), "term", "blocks").drop("blocks")


def _block_counts(postings: DataFrame, span: int) -> DataFrame:
    return postings.groupBy("term", block_of(span).alias("block")).agg(F.count("*").alias("block_df"))


def postings_lists(postings: DataFrame, span: int = SPAN) -> DataFrame:
    """``<term, block, df, block_df, postings ARRAY<docid, tf>>``, docids ascending.

    ``df`` is the number of documents of the term, ``block_df`` of those in the block. The blocks of a term in block
    order are its whole list. The long table is written once; ``df`` is counted from it before any list is built.
    """
    postings = once_settled(postings.select("term", "docid", "tf"), "postings")
    lists = postings.groupBy("term", block_of(span).alias("block")).agg(
        F.count("*").alias("block_df"),
        F.array_sort(F.collect_list(F.struct("docid", "tf"))).alias("postings"),
    )
    return _with_df(lists, _block_counts(postings, span)).select("term", "block", "df", "block_df", "postings")


def postings_map(postings: DataFrame, span: int = SPAN) -> DataFrame:
    """``<term, block, cells MAP<docid, tf>>``: the wide-row view."""
    cells = F.map_from_entries(F.collect_list(F.struct("docid", "tf")))
    return postings.groupBy("term", block_of(span).alias("block")).agg(cells.alias("cells"))


def forward_index(postings: DataFrame) -> DataFrame:
    """``<docid, terms MAP<term, tf>>``: the document-keyed view; a map is no larger than its document."""
    return postings.groupBy("docid").agg(F.map_from_entries(F.collect_list(F.struct("term", "tf"))).alias("terms"))


def _spread(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """The bucket of each of the strings that lie end to end: a polynomial of its bytes, mixed."""
    sizes = np.diff(offsets)
    place = np.arange(offsets[-1] - offsets[0]) - np.repeat(offsets[:-1] - offsets[0], sizes)
    powers = np.cumprod(np.full(int(sizes.max(initial=0)) + 1, 0x9E3779B97F4A7C15, np.uint64))
    sums = np.r_[np.uint64(0), np.cumsum(data[offsets[0] : offsets[-1]].astype(np.uint64) * powers[place])]
    hashed = sums[offsets[1:] - offsets[0]] - sums[offsets[:-1] - offsets[0]]
    mixed = (hashed ^ (hashed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)


SENT_DDL = "bucket int, range bigint, terms binary, lengths binary, counts binary, steps binary, tfs binary"


def _sent(span: int):
    """``<term, docid, tf>`` as a row for each bucket of terms and range of docids, with CHUNK postings put in order at once.

    ``steps`` tells the first docid of a term from the start of the range, and each other from the one before it.
    A row of no range comes before them for each bucket: it tells how many documents of these hold its terms.
    """
    width = max(1, RANGE // span)

    def send(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.filter(pc.and_(pc.is_valid(rows["term"]), pc.is_valid(rows["docid"]))).combine_chunks()
        if not rows.num_rows:
            return pa.RecordBatch.from_pylist([], pa.schema([("bucket", pa.int32()), ("range", pa.int64())] + [(c, pa.binary()) for c in ("terms", "lengths", "counts", "steps", "tfs")]))
        coded = rows["term"].combine_chunks().dictionary_encode()
        bucket = _spread(*bytes_of(coded.dictionary))
        by_bucket = np.argsort(bucket, kind="stable")
        rank = np.empty(len(bucket), np.int64)
        rank[by_bucket] = np.arange(len(bucket))
        terms, bucket = coded.dictionary.take(pa.array(by_bucket)), bucket[by_bucket]
        code, docid, tf = rank[coded.indices.to_numpy()], rows["docid"].to_numpy().astype(np.int64), rows["tf"].to_numpy().astype(np.int64)
        at = _block(_block(docid, span), width)
        order = _in_order(at, code, docid)
        at, code, docid, tf = at[order], code[order], docid[order], tf[order]
        # A term of a range, and a bucket of a range: where each ends among the postings, and among the terms.
        ends = np.flatnonzero(np.r_[(code[1:] != code[:-1]) | (at[1:] != at[:-1]), True])
        of, where = code[ends], at[ends]
        closes = np.flatnonzero(np.r_[(bucket[of[1:]] != bucket[of[:-1]]) | (where[1:] != where[:-1]), True])
        counts = np.diff(np.r_[-1, ends])
        step = docid - at * (width * span)
        fresh = np.zeros(len(step), bool)
        fresh[ends[:-1] + 1] = True
        step[1:] = np.where(fresh[1:], step[1:], np.diff(step))
        told = _row(bucket[of[closes]], where[closes], terms.take(pa.array(of)), counts, closes + 1, step, tf, ends[closes] + 1)
        last = np.flatnonzero(np.r_[bucket[1:] != bucket[:-1], True])
        none = np.zeros(0, np.int64)
        known = _row(bucket[last], None, terms, np.bincount(code, minlength=len(terms)), last + 1, none, none, np.zeros(len(last), np.int64))
        return pa.concat_batches([known, told])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many = [], 0
        for batch in batches:
            held.append(batch)
            many += batch.num_rows
            if many >= CHUNK:
                yield from pa.Table.from_batches([send(pa.Table.from_batches(held))]).to_batches(max_chunksize=1000)
                held, many = [], 0
        if many:
            yield from pa.Table.from_batches([send(pa.Table.from_batches(held))]).to_batches(max_chunksize=1000)

    return gather


def _row(bucket, at, terms, counts, term_ends, docid, tf, ends) -> pa.RecordBatch:
    offsets, data = bytes_of(terms)
    names = cells_of(data[offsets[0] : offsets[-1]], offsets[term_ends] - offsets[0])
    ranges = pa.nulls(len(bucket), pa.int64()) if at is None else pa.array(at)
    columns = [pa.array(bucket), ranges, names, *(cells_of(c.astype(np.int32), term_ends) for c in (np.diff(offsets), counts))]
    return pa.RecordBatch.from_arrays([*columns, cells_of(docid, ends), cells_of(tf, ends)], names=[c.split()[0] for c in SENT_DDL.split(", ")])


def _block(docid: np.ndarray, span: int) -> np.ndarray:
    """As SQL's ``div``: towards zero."""
    return docid // span + ((docid < 0) & (docid % span != 0))


def _in_order(at: np.ndarray, code: np.ndarray, docid: np.ndarray) -> np.ndarray:
    """The places of rows in order of ``at``, ``code`` and ``docid``."""
    lows = [int(c.min()) for c in (at, code, docid)]
    bits = [(int(c.max()) - low).bit_length() for c, low in zip((at, code, docid), lows)]
    if sum(bits) > 63:
        return np.lexsort((docid, code, at))
    return np.argsort((at - lows[0]) << (bits[1] + bits[2]) | (code - lows[1]) << bits[2] | (docid - lows[2]))


GAPS_DDL = "terms binary, lengths binary, blocks binary, prevs binary, dfs binary, sizes binary, gaps binary, tfs binary"


def _encoded(span: int):
    """Blocks with their gaps, of rows of :func:`_sent` in order of bucket and range.

    Buckets are encoded together until they are CHUNK postings or more; a larger one goes range by range, and only its
    terms with their ``df`` and last docid are held.
    """

    def encode(held: list[pa.RecordBatch], before: tuple) -> tuple[pa.RecordBatch | None, tuple]:
        rows = pa.Table.from_batches(held).combine_chunks()
        column = {c: rows[c].combine_chunks() for c in rows.column_names}
        lengths, n_terms = numbers_of(column["lengths"], np.int32), sizes_of(column["lengths"], np.int32)
        counts = numbers_of(column["counts"], np.int32).astype(np.int64)
        step, n_steps = numbers_of(column["steps"]), sizes_of(column["steps"])
        tf = numbers_of(column["tfs"])
        names = pa.concat_arrays([before[0], strings_of(column["terms"], lengths)]).dictionary_encode()
        terms, code = names.dictionary, names.indices.to_numpy()
        old, code = code[: len(before[0])], code[len(before[0]) :]
        df, last = np.zeros(len(terms), np.int64), np.zeros(len(terms), np.int64)
        df[old], last[old] = before[1], before[2]
        counting = np.repeat(column["range"].is_null().to_numpy(zero_copy_only=False), n_terms)
        np.add.at(df, code[counting], counts[counting])
        buckets = np.repeat(column["bucket"].to_numpy(), n_terms)
        told = None
        if len(step):
            of_term = counts[~counting]
            owner, sums, start = np.repeat(code[~counting], of_term).astype(np.int64), np.cumsum(step), np.cumsum(of_term) - of_term
            at = column["range"].fill_null(0).to_numpy() * (max(1, RANGE // span) * span)
            docid = sums - np.repeat((sums - step)[start], of_term) + np.repeat(at, n_steps)
            order = _in_order(np.zeros_like(owner), owner, docid)
            owner, docid, tf = owner[order], docid[order], tf[order]
            block, fresh = _block(docid, span), np.r_[True, owner[1:] != owner[:-1]]
            earlier = np.where(fresh, last[owner], np.r_[0, docid[:-1]])
            starts = np.flatnonzero(fresh | np.r_[True, block[1:] != block[:-1]])
            closes = np.r_[starts[1:], len(docid)]
            ends = np.flatnonzero(np.r_[fresh[1:], True])
            last[owner[ends]] = docid[ends]
            told = packed(terms.take(pa.array(owner[starts])), block[starts], earlier[starts], df[owner[starts]], closes - starts, docid - earlier, tf)
        stays = code[buckets == buckets[-1]] if len(buckets) else code
        stays = np.unique(np.r_[stays, old] if len(before[0]) and before[3] == column["bucket"][-1].as_py() else stays)
        return told, (terms.take(pa.array(stays)), df[stays], last[stays], column["bucket"][-1].as_py())

    def packed(terms, block, prev, df, sizes, gap, tf) -> pa.RecordBatch:
        # Rows of whole blocks, of a few hundred gaps each unless a block has more.
        closes = np.cumsum(sizes)
        cuts = np.flatnonzero(np.r_[closes[1:] // ROW_GAPS != closes[:-1] // ROW_GAPS, True]) + 1
        offsets, data = bytes_of(terms)
        columns = [cells_of(data[offsets[0] : offsets[-1]], offsets[cuts] - offsets[0]), cells_of(np.diff(offsets).astype(np.int32), cuts)]
        columns += [cells_of(c, cuts) for c in (block, prev, df, sizes)] + [cells_of(c, closes[cuts - 1]) for c in (gap, tf)]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in GAPS_DDL.split(", ")])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many, key = [], 0, None
        before = (pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, np.int64), None)
        for batch in batches:
            buckets, ranges = batch["bucket"].to_numpy(), batch["range"].to_numpy(zero_copy_only=False)
            offsets = offsets_of(batch["steps"])
            at = 0
            for i in range(batch.num_rows):
                # nan of no range is unlike itself, which only makes more places where rows may be cut apart
                if many >= CHUNK and (buckets[i], ranges[i]) != key:
                    told, before = encode([*held, batch.slice(at, i - at)], before)
                    if told is not None:
                        yield told
                    held, many, at = [], 0, i
                key = (buckets[i], ranges[i])
                many += (offsets[i + 1] - offsets[i]) // 8
            if at < batch.num_rows:
                held.append(batch.slice(at))
        if held:
            told, _ = encode(held, before)
            if told is not None:
                yield told

    return gather


def _blocks_of(rows: pa.RecordBatch) -> tuple:
    """The columns of :data:`GAPS_DDL`, flat: terms, blocks, prevs, dfs and sizes of the blocks, gaps and tfs of all."""
    numbers = (numbers_of(rows[c]) for c in ("blocks", "prevs", "dfs", "sizes", "gaps", "tfs"))
    return (strings_of(rows["terms"], numbers_of(rows["lengths"], np.int32)), *numbers)


def _flat_gaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``<term, block, prev, pos, gap, tf>``."""
    for rows in batches:
        terms, block, prev, _, sizes, gap, tf = _blocks_of(rows)
        row = np.repeat(np.arange(len(sizes)), sizes)
        pos = np.arange(len(gap)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        for i in range(0, len(gap), TOLD):
            of = row[i : i + TOLD]
            columns = [terms.take(pa.array(of)), block[of], prev[of], pos[i : i + TOLD], gap[i : i + TOLD], tf[i : i + TOLD]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["term", "block", "prev", "pos", "gap", "tf"])


def _listed_gaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``<term, block, prev, df, block_df, gaps>``."""
    for rows in batches:
        terms, block, prev, df, sizes, gap, tf = _blocks_of(rows)
        ends = np.cumsum(sizes)
        at = 0
        while at < len(sizes):
            low = ends[at] - sizes[at]
            to = max(at + 1, int(np.searchsorted(ends, low + TOLD, "right")))
            entries = pa.StructArray.from_arrays([pa.array(gap[low : ends[to - 1]]), pa.array(tf[low : ends[to - 1]])], names=["gap", "tf"])
            gaps = pa.ListArray.from_arrays(pa.array(np.r_[0, ends[at:to] - low].astype(np.int32)), entries)
            columns = [terms[at:to], *(pa.array(c[at:to]) for c in (block, prev, df, sizes)), gaps]
            yield pa.RecordBatch.from_arrays(columns, names=["term", "block", "prev", "df", "block_df", "gaps"])
            at = to


def _summed_gaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``<term, docid, tf>``: running sums of each block's gaps, from its ``prev`` on."""
    for rows in batches:
        terms, _, prev, _, sizes, gap, tf = _blocks_of(rows)
        sums = np.cumsum(gap)
        start = prev - np.r_[0, sums[np.cumsum(sizes)[:-1] - 1]][: len(sizes)]
        row = np.repeat(np.arange(len(sizes)), sizes)
        for i in range(0, len(gap), TOLD):
            of = row[i : i + TOLD]
            columns = [terms.take(pa.array(of)), pa.array(sums[i : i + TOLD] + start[of]), pa.array(tf[i : i + TOLD])]
            yield pa.RecordBatch.from_arrays(columns, names=["term", "docid", "tf"])


def encode_gaps(postings: DataFrame, span: int = SPAN, fan: int = SPAN) -> DataFrame:
    """``<term, block, prev, pos, gap, tf>``: each docid as the distance from the term's one before it.

    ``prev`` is the last docid before the block, 0 for a term's first block, and ``pos`` the place in the block,
    so each block decodes by itself. The postings move once, many in a row, to buckets of terms; a task encodes a bucket
    range of docids by range and holds no more than one, and the gaps are written as blocks. ``prev`` is handed on from
    range to range, so blocks are no longer looked at in groups of ``fan``, and every ``fan`` gives the same. Rows
    without a term or a docid have no gap.
    """
    tokens = getattr(postings, "tokens", None)
    send = _sent(span)
    if isinstance(tokens, DataFrame):  # counted and sent where the documents are read
        sent = tokens.mapInArrow(lambda batches: send(_counted_terms(batches)), SENT_DDL)
    else:
        sent = postings.select("term", "docid", "tf").mapInArrow(send, SENT_DDL)
    ordered = sent.repartition("bucket").sortWithinPartitions("bucket", F.asc_nulls_first("range"))
    blocks = settled([ordered.mapInArrow(_encoded(span), GAPS_DDL)], "gaps")
    tf = postings.schema["tf"].dataType
    flat = "term string, block bigint, prev bigint, pos bigint, gap bigint, tf bigint"
    encoded = blocks.mapInArrow(_flat_gaps, flat).withColumn("tf", F.col("tf").cast(tf))
    encoded.settled, encoded.blocks = True, blocks
    return encoded


def gap_lists(encoded: DataFrame) -> DataFrame:
    """``<term, block, prev, df, block_df, gaps ARRAY<gap, tf>>``: the gaps of a block as one list, and the term's df.

    What :func:`encode_gaps` returns lies in blocks already; other rows are brought together by block.
    """

    def build(own: DataFrame) -> DataFrame:
        entries = F.array_sort(F.collect_list(F.struct("pos", "gap", "tf")))
        lists = own.groupBy("term", "block", "prev").agg(F.count("*").alias("block_df"), entries.alias("entries"))
        gaps = F.transform("entries", lambda e: F.struct(e["gap"].alias("gap"), e["tf"].alias("tf")))
        counts = own.groupBy("term", "block").agg(F.count("*").alias("block_df"))
        lists = lists.select("term", "block", "prev", "block_df", gaps.alias("gaps"))
        return _with_df(lists, counts).select("term", "block", "prev", "df", "block_df", "gaps")

    blocks, tf = getattr(encoded, "blocks", None), encoded.schema["tf"].dataType.simpleString()
    if isinstance(blocks, DataFrame):
        schema = "term string, block bigint, prev bigint, df bigint, block_df bigint, gaps array<struct<gap:bigint,tf:bigint>>"
        lists = blocks.mapInArrow(_listed_gaps, schema)
        return lists.withColumn("gaps", F.col("gaps").cast(f"array<struct<gap:bigint,tf:{tf}>>"))
    return _by_terms(once_settled(encoded, "gaps"), build, "lists")


def decode_gaps(encoded: DataFrame) -> DataFrame:
    """``<term, docid, tf>`` of gaps: running sums inside each block, from its ``prev`` on.

    The blocks of :func:`encode_gaps` are decoded where they are read; other rows are put in order by block.
    """
    blocks = getattr(encoded, "blocks", None)
    if isinstance(blocks, DataFrame):
        decoded = blocks.mapInArrow(_summed_gaps, "term string, docid bigint, tf bigint")
        return decoded.withColumn("tf", F.col("tf").cast(encoded.schema["tf"].dataType))
    so_far = W.partitionBy("term", "block").orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    docid = F.col("prev") + F.sum("gap").over(so_far)
    return _by_terms(once_settled(encoded, "gaps"), lambda own: own.select("term", docid.alias("docid"), "tf"), "decoded")


def lookup_postings(postings: DataFrame, terms: Sequence[str]) -> DataFrame:
    """The postings of the given terms; none for an unknown one. On a written index the filter prunes the read."""
    return postings.filter(F.col("term").isin(list(terms)))


def lookup_bucket(buckets: int) -> Column:
    """The folder of a term in a lookup table."""
    return F.pmod(F.xxhash64("term"), F.lit(buckets))


def lookup_terms(table: DataFrame, terms: DataFrame, buckets: int) -> DataFrame:
    """The postings of a whole table of terms, each told once, from one saved by ``save_lookup`` with ``buckets``.

    The terms never become a literal list. While they are small enough to be broadcast, Spark prunes the folders that
    hold none of them before it reads any; a larger batch touches every folder, and joins.
    """
    asked = durable(terms.select("term").distinct().withColumn("bucket", lookup_bucket(buckets)), "asked")
    # Told as a condition, for Spark prunes by a side that has one.
    found = table.join(broadcast_if_small(asked.filter(F.col("bucket") >= 0)), ["bucket", "term"])
    return found.select("term", "docid", "tf")


def tf_histogram(postings: DataFrame, terms: Sequence[str]) -> DataFrame:
    """``<term, tf, docs>``: how many documents hold a term how often."""
    return lookup_postings(postings, terms).groupBy("term", "tf").agg(F.count("*").alias("docs"))


def with_shard(postings: DataFrame, shards: int) -> DataFrame:
    """Add ``shard`` = docid mod ``shards``, which spreads a common term's postings."""
    return postings.withColumn("shard", F.pmod("docid", F.lit(shards)))
