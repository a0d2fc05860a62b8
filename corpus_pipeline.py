"""From raw documents to a training mix, stage by stage; each stage's rows are written and read again by the next.

Each stage gives its rows numbers, their places in the files they are read from, and decides by these: rows that share
an id, or have none, stand or fall by their own texts. Ids only order rows of a group of which one stays, null last.
All columns of the documents, whatever their names, go through unchanged; only the last stage adds its own.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textgraph.llm.columns import whole_text
from textgraph.llm.decontaminate import leaks
from textgraph.llm.exact_dedup import exact_duplicates
from textgraph.llm.mixing import mix
from textgraph.llm.simhash import near_duplicates
from textgraph.llm.toxicity import toxicity
from textgraph.plans.durable import durable
from textgraph.plans.sizing import broadcast_if_small


def unused(docs: DataFrame, name: str) -> str:
    """A column name that the documents do not have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _of_files(docs: DataFrame) -> bool:
    """Whether the rows know their places in files."""
    try:
        docs.select(docs.metadataColumn("_metadata"))
    except AnalysisException:  # a plan that is not, or no longer, a scan of files
        return False
    return True


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents with a number for each row, and the number's column: the row's place in its file and the file's number.

    Rows of no file are written first.
    """
    row, file, at = (unused(docs, name) for name in ("row", "row_file", "row_at"))
    docs = docs if _of_files(docs) else durable(docs, "documents")
    meta = docs.metadataColumn("_metadata")
    placed = docs.select("*", meta["file_path"].alias(file), meta["row_index"].alias(at))
    # One short row for each file.
    files = placed.select(file).distinct().withColumn(row, F.row_number().over(W.orderBy(file)).cast("bigint"))
    files = broadcast_if_small(durable(files, "files"))
    return placed.join(files, file).withColumn(row, F.shiftleft(F.col(row), 40) + F.col(at)).drop(file, at), row


def _without(docs: DataFrame, row: str, rejected: DataFrame) -> DataFrame:
    """The numbered documents whose number is not among the ``doc_id`` of ``rejected``."""
    gone = rejected.select(F.col("doc_id").alias(row)).distinct()
    return docs.join(gone, row, "left_anti").drop(row)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are likelier toxic than not go; each row by its own text, a null text as an empty one."""
    docs, row = _numbered(docs)
    scored = toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), told=row)
    return _without(docs, row, scored.filter("predicted = 1"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for blanks, the longest stays, of these the one of the smallest id.

    A null id comes last, of rows with one id and length the first in the files stays; null texts are empty ones, of
    which one stays.
    """
    docs, row = _numbered(docs)
    groups = exact_duplicates(docs, doc_id=row).filter("group_size > 1").select(F.col("doc_id").alias(row), F.col("keep_id").alias("group"))
    order = F.struct((-F.length(whole_text())).alias("length"), F.col("doc_id").isNull().alias("absent"), F.col("doc_id").alias("id"), F.col(row).alias("number"))
    members = durable(docs.select(row, order.alias("place")).join(groups, row), "members")
    best = members.groupBy("group").agg(F.min("place").alias("best")).select(F.col("best.number").alias(row))
    return _without(docs, row, members.join(best, row, "left_anti").select(F.col(row).alias("doc_id")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the document of the smallest id stays, a row of its id and text with it.

    A null id comes last. Texts without words are near duplicates of each other, null texts among them, so one stays.
    """
    docs, row = _numbered(docs)
    groups = near_duplicates(docs, doc_id=row).select(F.col("doc_id").alias(row), F.col("component_id").alias("group"))
    # A row that repeats an id and a text is the same document; a row without an id is one of its own.
    digest = F.when(F.col("doc_id").isNotNull(), F.sha2(whole_text().cast("binary"), 256)).otherwise("")
    document = F.struct(F.col("doc_id").isNull().alias("absent"), F.coalesce("doc_id", row).alias("id"), digest.alias("digest"))
    members = durable(docs.select(row, document.alias("document")).join(groups, row), "members")
    best = members.groupBy("group").agg(F.min("document").alias("document"))
    return _without(docs, row, members.join(best, "document", "left_anti").select(F.col(row).alias("doc_id")))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, within the edits its length allows, go; null and empty texts hold none."""
    docs, row = _numbered(docs)
    return _without(docs, row, leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), doc_id=row))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with how often (``times``) and how many words in all (``taken``).

    Each row is chosen for itself; texts without words are never taken, a null source is a source of its own. Of the
    columns added (``size``, ``target``, ``times``, ``taken``), one whose name the documents have already is left out.
    """
    docs, row = _numbered(docs)
    added = [c for c in ("size", "target", "times", "taken") if c not in docs.columns]
    chosen = mix(docs, doc_id=row).filter("times > 0").select(F.col("doc_id").alias(row), *added)
    return docs.join(chosen, row).drop(row)


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("decontaminate", drop_leaks),
    ("mix_sources", mix_sources),
]

# A trained field, a sampling method and components of links are not for SQL; tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
