"""Index tables, laid out for lookups by term.

Files hold successive (term, docid) ranges: a term is found by the min/max statistics of few files, and a term
with a large share of all postings is split over several files and tasks. Bloom filters on the terms let a lookup of
a few terms pass over row groups that their ranges do not tell from others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from ..operators.postings import SPAN, BlockIndex, block_of, lookup_bucket, postings_map, term_df, with_shard
from ..plans.durable import once_settled

# Folders of a lookup table, buckets of a catalog table.
BUCKETS = 256
# Bytes of a row group of a collection, small so that a fetch of few documents reads few others.
COLLECTION_GROUP = 8 << 20
# Postings, and bytes of text, that one task puts in order; for more there are more tasks and files than asked for.
TASK_ROWS = 2_000_000
TASK_BYTES = 256 << 20


def _writer(df: DataFrame) -> DataFrameWriter:
    return df.write.mode("overwrite").option("parquet.bloom.filter.enabled#term", "true")


def _sized(postings: DataFrame, n: int) -> tuple[DataFrame, int]:
    """The postings, written, and ``n`` or, if that leaves a task more than ``TASK_ROWS`` of them, as many tasks as they need.

    They are written as they come, for the ranges that they are dealt to are sampled before they are moved.
    """
    written = once_settled(postings, "postings")
    return written, max(n, -(-written.count() // TASK_ROWS))


def write_index(postings: DataFrame, path: str, n: int) -> None:
    """The long table, sorted by term and docid, in ``n`` files; a large one in more."""
    postings, n = _sized(postings, n)
    ordered = postings.repartitionByRange(n, "term", "docid").sortWithinPartitions("term", "docid")
    _writer(ordered).parquet(path)


def save_postings(postings: DataFrame, path: str, buckets: int, shards: int = 1) -> None:
    """Drop and recreate the table at ``path``, split by docid into ``shards`` folders of term-sorted files."""
    if shards == 1:
        write_index(postings, path, buckets)
        return
    postings, buckets = _sized(postings, buckets)
    sharded = with_shard(postings, shards).repartitionByRange(buckets, "shard", "term", "docid")
    ordered = sharded.sortWithinPartitions("shard", "term", "docid")
    _writer(ordered).partitionBy("shard").parquet(path)


def save_block_index(postings: DataFrame, path: str, n: int, span: int = SPAN) -> None:
    """Drop and recreate an index for Boolean search under ``path``.

    The long table has a folder for each block of ``span`` docids, term-sorted inside, so that a search which knows
    its blocks reads no others; beside it, ``<term, df>`` tells which term of a query is the rarest.
    """
    postings, n = _sized(postings.select("term", "docid", "tf"), n)
    blocked = postings.select("term", "docid", "tf", block_of(span).alias("block"))
    ordered = blocked.repartitionByRange(n, "block", "term", "docid").sortWithinPartitions("block", "term", "docid")
    _writer(ordered).partitionBy("block").parquet(f"{path}/postings")
    counted = load_block_index(postings.sparkSession, path, terms=False).postings
    write_terms(term_df(counted), f"{path}/terms", n)


def write_terms(dfs: DataFrame, path: str, n: int) -> None:
    _writer(dfs.repartitionByRange(n, "term").sortWithinPartitions("term")).parquet(path)


def load_block_index(spark: SparkSession, path: str, terms: bool = True) -> BlockIndex:
    postings = spark.read.schema("term string, docid bigint, tf bigint, block bigint").parquet(f"{path}/postings")
    return BlockIndex(postings, spark.read.parquet(f"{path}/terms") if terms else None)


def save_lookup(postings: DataFrame, path: str, n: int, buckets: int = BUCKETS) -> None:
    """Drop and recreate the long table with a folder for each of ``buckets`` hashes of terms.

    A batch of terms reads only the folders that may hold one. A common term's folder has several files.
    """
    postings, n = _sized(postings.select("term", "docid", "tf"), n)
    placed = postings.select("term", "docid", "tf", lookup_bucket(buckets).alias("bucket"))
    ordered = placed.repartitionByRange(n, "bucket", "term", "docid").sortWithinPartitions("bucket", "term", "docid")
    _writer(ordered).partitionBy("bucket").parquet(path)


def save_wide_table(postings: DataFrame, name: str, buckets: int = BUCKETS, span: int = SPAN, path: str | None = None) -> None:
    """Drop and recreate the catalog table ``name``: ``<term, block, cells>``, bucketed by term, sorted inside.

    Joins and groupings by term read it without an exchange. A row has ``span`` cells at most; all rows of a term
    are in one bucket, so of very common terms a task reads as many rows as they have blocks. Large buckets are
    written by several tasks each, as a file each.
    """
    postings, tasks = _sized(postings.select("term", "docid", "tf"), buckets)
    writers = -(-tasks // buckets)
    # The first is Spark's own way to tell a row's bucket.
    places = ["term"] if writers == 1 else [F.pmod(F.hash("term"), F.lit(buckets)), F.pmod(F.xxhash64("term", "block"), F.lit(writers))]
    wide = postings_map(postings, span).repartition(buckets * writers, *places).sortWithinPartitions("term", "block")
    writer = wide.write.mode("overwrite").format("parquet").bucketBy(buckets, "term").sortBy("term", "block")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def save_collection(collection: DataFrame, path: str, n: int) -> None:
    """Drop and recreate ``<docid, line>`` clustered by docid: ``n`` files of successive ranges (more of a large one), in small row groups."""
    size = collection.agg(F.sum(F.octet_length("line"))).first()[0] or 0
    n = max(n, -(-size // TASK_BYTES))
    ordered = collection.select("docid", "line").repartitionByRange(n, "docid").sortWithinPartitions("docid")
    ordered.write.mode("overwrite").option("parquet.block.size", str(COLLECTION_GROUP)).parquet(path)
