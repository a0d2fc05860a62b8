"""Inverted index and Boolean retrieval with each row of ``documents`` as one record."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import (
    bool_and,
    bool_or,
    bool_search,
    build_postings,
    decode_gaps,
    documents_of,
    encode_gaps,
    fetch_lines,
    forward_index,
    gap_lists,
    load_block_index,
    lookup_postings,
    lookup_terms,
    postings_lists,
    save_block_index,
    save_collection,
    save_lookup,
    save_wide_table,
    search_index,
    term_df,
    tf_histogram,
    with_shard,
)
from ..operators.counts import tokenize
from ..plans.durable import scratch_path
from ..plans.sizing import dealt
from ..sinks.index import write_index
from . import table

# Docids a list block covers here, and blocks looked at together: few, so that every scale has several of both.
SPAN = 256
FAN = 8
SHARDS = 4
FOLDERS = 16
TERMS = ["the", "MIT", "License.", "fortune"]
SEARCHES = {
    "both": "the MIT AND",
    "either": "MIT License. OR",
    "unknown": "fortune",
    "none": "MIT License. OR fortune AND",
    "nested": "the fortune OR MIT de OR AND of AND",
    "deep": "der que OR the and OR AND License. OR",
}

POSTINGS_SQL = r"""
postings AS (
  SELECT term, docid, count(*) AS tf
  FROM (SELECT doc_id AS docid, unnest([t for t in string_split_regex(text, '\s+') if t <> '']) AS term FROM documents)
  GROUP BY 1, 2
)"""


def _holding(*terms: str) -> str:
    return f"SELECT docid FROM postings WHERE term IN ({', '.join(repr(t) for t in terms)})"


HITS_SQL = POSTINGS_SQL + f""",
hits AS (
  SELECT 'both' AS query_id, docid FROM (({_holding("the")}) INTERSECT ({_holding("MIT")}))
  UNION ALL SELECT 'either', docid FROM (({_holding("MIT")}) UNION ({_holding("License.")}))
  UNION ALL SELECT 'unknown', docid FROM ({_holding("fortune")})
  UNION ALL SELECT 'none', docid FROM (({_holding("MIT", "License.")}) INTERSECT ({_holding("fortune")}))
  UNION ALL SELECT 'nested', docid FROM (
    ({_holding("the", "fortune")}) INTERSECT ({_holding("MIT", "de")}) INTERSECT ({_holding("of")}))
  UNION ALL SELECT 'deep', docid FROM (
    (({_holding("der", "que")}) INTERSECT ({_holding("the", "and")})) UNION ({_holding("License.")}))
)"""

TERMS_SQL = ", ".join(f"'{t}'" for t in TERMS)


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return dealt(documents_of(table(spark, folder, "documents"), "doc_id", "text"))


def _postings(spark: SparkSession, folder: str) -> DataFrame:
    return build_postings(_documents(spark, folder))


def index_lists(spark: SparkSession, folder: str) -> DataFrame:
    entry = F.transform("postings", lambda e: F.concat_ws(":", e["docid"], e["tf"]))
    lists = postings_lists(_postings(spark, folder), SPAN)
    return lists.select("term", "block", "df", "block_df", F.array_join(entry, " ").alias("postings"))


def index_wide_map(spark: SparkSession, folder: str) -> DataFrame:
    """The wide-row table saved in the catalog, bucketed by term, and read back."""
    path = scratch_path(spark, "wide")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    save_wide_table(_postings(spark, folder), name, SHARDS, SPAN, path)
    return spark.table(name).select("term", "block", F.explode("cells").alias("docid", "tf"))


def index_forward(spark: SparkSession, folder: str) -> DataFrame:
    return forward_index(_postings(spark, folder)).select("docid", F.explode("terms").alias("term", "tf"))


def index_sharded_df(spark: SparkSession, folder: str) -> DataFrame:
    by_shard = with_shard(_postings(spark, folder), SHARDS).groupBy("shard", "term").agg(F.count("*").alias("df"))
    return by_shard.groupBy("term").agg(F.sum("df").alias("df"), F.count("*").alias("shards"))


def _encoded(spark: SparkSession, folder: str) -> DataFrame:
    return encode_gaps(_postings(spark, folder), SPAN, FAN)


def gap_text(spark: SparkSession, folder: str) -> DataFrame:
    entry = F.transform("gaps", lambda e: F.concat_ws(":", e["gap"], e["tf"]))
    return gap_lists(_encoded(spark, folder)).withColumn("gaps", F.array_join(entry, " "))


def index_written_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """The index written once, term-sorted, and read by term: how often documents hold a few terms."""
    path = scratch_path(spark, "index")
    write_index(_postings(spark, folder), path, SHARDS)
    return tf_histogram(spark.read.parquet(path), TERMS)


def index_batch_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """All words of the benchmark's items looked up as one batch in an index saved for lookups."""
    path = scratch_path(spark, "lookup")
    save_lookup(_postings(spark, folder), path, FOLDERS, FOLDERS)
    items = documents_of(table(spark, folder, "benchmark"), "item_id", "text")
    saved = spark.read.schema("term string, docid bigint, tf bigint, bucket bigint").parquet(path)
    return lookup_terms(saved, tokenize(items), FOLDERS)


def _searched(spark: SparkSession, folder: str) -> DataFrame:
    """The searches over a saved block index, rarest terms first."""
    path = scratch_path(spark, "blocks")
    save_block_index(_postings(spark, folder), path, SHARDS, SPAN)
    return search_index(load_block_index(spark, path), SEARCHES)


def _found(spark: SparkSession, folder: str, width: str) -> DataFrame:
    """Hits with their texts, from a collection clustered by docid."""
    path = scratch_path(spark, "collection")
    save_collection(_documents(spark, folder), path, FOLDERS)
    return fetch_lines(_searched(spark, folder), spark.read.parquet(path), width)


QUERIES = {
    "index_postings": (_postings, f"WITH {POSTINGS_SQL} SELECT term, docid, tf FROM postings"),
    "index_df": (
        lambda spark, folder: term_df(_postings(spark, folder)),
        f"WITH {POSTINGS_SQL} SELECT term, count(*) AS df FROM postings GROUP BY term",
    ),
    "index_lists": (
        index_lists,
        f"""WITH {POSTINGS_SQL}
        SELECT term, block, df, count(*) AS block_df, string_agg(docid || ':' || tf, ' ' ORDER BY docid) AS postings
        FROM (SELECT *, docid // {SPAN} AS block, count(*) OVER (PARTITION BY term) AS df FROM postings) GROUP BY 1, 2, 3""",
    ),
    "index_wide_map": (
        index_wide_map,
        f"WITH {POSTINGS_SQL} SELECT term, docid // {SPAN} AS block, docid, tf FROM postings",
    ),
    "forward_index": (index_forward, f"WITH {POSTINGS_SQL} SELECT docid, term, tf FROM postings"),
    "index_sharded_df": (
        index_sharded_df,
        f"""WITH {POSTINGS_SQL}
        SELECT term, count(*) AS df, count(DISTINCT docid % {SHARDS}) AS shards FROM postings GROUP BY term""",
    ),
    "postings_lookup": (
        lambda spark, folder: lookup_postings(_postings(spark, folder), TERMS),
        f"WITH {POSTINGS_SQL} SELECT term, docid, tf FROM postings WHERE term IN ({TERMS_SQL})",
    ),
    "tf_histogram": (
        lambda spark, folder: tf_histogram(_postings(spark, folder), TERMS),
        f"WITH {POSTINGS_SQL} SELECT term, tf, count(*) AS docs FROM postings WHERE term IN ({TERMS_SQL}) GROUP BY 1, 2",
    ),
    "index_written_lookup": (
        index_written_lookup,
        f"WITH {POSTINGS_SQL} SELECT term, tf, count(*) AS docs FROM postings WHERE term IN ({TERMS_SQL}) GROUP BY 1, 2",
    ),
    "index_batch_lookup": (
        index_batch_lookup,
        rf"""WITH {POSTINGS_SQL}
        SELECT term, docid, tf FROM postings
        WHERE term IN (SELECT unnest(string_split_regex(text, '\s+')) FROM benchmark) AND term <> ''""",
    ),
    "postings_gaps": (
        lambda spark, folder: _encoded(spark, folder).drop("prev"),
        f"""WITH {POSTINGS_SQL}
        SELECT term, docid // {SPAN} AS block,
          row_number() OVER (PARTITION BY term, docid // {SPAN} ORDER BY docid) - 1 AS pos,
          docid - lag(docid, 1, 0) OVER (PARTITION BY term ORDER BY docid) AS gap, tf
        FROM postings""",
    ),
    "postings_gap_lists": (
        gap_text,
        f"""WITH {POSTINGS_SQL},
        gaps AS (
          SELECT term, docid // {SPAN} AS block, docid, tf, count(*) OVER (PARTITION BY term) AS df,
            lag(docid, 1, 0) OVER (PARTITION BY term ORDER BY docid) AS before
          FROM postings
        )
        SELECT term, block, min(before) AS prev, df, count(*) AS block_df,
          string_agg((docid - before) || ':' || tf, ' ' ORDER BY docid) AS gaps
        FROM gaps GROUP BY term, block, df""",
    ),
    "postings_decode": (
        lambda spark, folder: decode_gaps(_encoded(spark, folder)),
        f"WITH {POSTINGS_SQL} SELECT term, docid, tf FROM postings",
    ),
    "bool_and": (
        lambda spark, folder: bool_and(_postings(spark, folder), "the", "MIT"),
        f"WITH {HITS_SQL} SELECT docid FROM hits WHERE query_id = 'both'",
    ),
    "bool_or": (
        lambda spark, folder: bool_or(_postings(spark, folder), "MIT", "License."),
        f"WITH {HITS_SQL} SELECT docid FROM hits WHERE query_id = 'either'",
    ),
    "bool_search": (
        lambda spark, folder: _searched(spark, folder).orderBy("query_id", "docid"),
        f"WITH {HITS_SQL} SELECT query_id, docid FROM hits",
    ),
    "bool_search_scan": (
        lambda spark, folder: bool_search(_postings(spark, folder), SEARCHES),
        f"WITH {HITS_SQL} SELECT query_id, docid FROM hits",
    ),
    "bool_search_lines": (
        lambda spark, folder: _found(spark, folder, "whole"),
        f"WITH {HITS_SQL} SELECT query_id, docid, text AS line FROM hits JOIN documents ON docid = doc_id",
    ),
    "bool_search_snippets": (
        lambda spark, folder: _found(spark, folder, "snippet"),
        rf"""WITH {HITS_SQL}
        SELECT query_id, docid,
          CASE WHEN length(text) < 82 THEN text
          ELSE regexp_replace(left(text, 80), '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g') END AS line
        FROM hits JOIN documents ON docid = doc_id""",
    ),
}
