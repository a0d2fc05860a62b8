"""Text lines: one record a line, with or without a document id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import lines_in
from ..plans.durable import durable
from ..plans.sizing import broadcast_if_small


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``<line>``: every line of the text files under ``path``."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def read_lines_with_offset(spark: SparkSession, path: str) -> DataFrame:
    """``<file, offset, docid, line>``: ``offset`` is the byte offset of the line in its (UTF-8) file.

    ``docid`` is the offset in all files laid end to end by path, so it is unique among them, and in a single file
    it is the offset. The files are read once, now: the lines of each split are summed up in the order they are read,
    a split at a time (``spark.sql.files.maxPartitionBytes`` of text at most), and written. Running sums over splits
    and files, one number for each, say where a split's first line starts. All that is told comes from the written
    lines, so it does not matter how finely the files are split, now or later.
    """
    raw = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        # Ids grow in the order of reading. A split is read by one task, so its lines' ids are in order.
        F.monotonically_increasing_id().alias("id"),
        F.col("value").alias("line"),
        (F.octet_length("value") + 1).cast("bigint").alias("bytes"),
    )
    earlier_lines = W.partitionBy("file", "split").orderBy("id").rowsBetween(W.unboundedPreceding, -1)
    within = F.coalesce(F.sum("bytes").over(earlier_lines), F.lit(0)).alias("within")
    lines = durable(raw.select("file", "split", within, "bytes", "line"), "lines")
    sizes = durable(lines.groupBy("file", "split").agg(F.sum("bytes").alias("bytes")), "sizes")
    earlier_splits = W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    earlier_files = W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)
    files = sizes.groupBy("file").agg(F.sum("bytes").alias("bytes"))
    files = files.select("file", F.coalesce(F.sum("bytes").over(earlier_files), F.lit(0)).alias("base"))
    starts = sizes.select("file", "split", F.coalesce(F.sum("bytes").over(earlier_splits), F.lit(0)).alias("start"))
    known = broadcast_if_small(durable(starts.join(files, "file"), "splits"))
    offset = F.col("start") + F.col("within")
    return lines.join(known, ["file", "split"]).select(
        "file",
        offset.alias("offset"),
        (F.col("base") + offset).alias("docid"),
        F.regexp_replace("line", r"\r\z", "").alias("line"),
    )


def lines_of(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``<docid, ln, line>``: the lines of each row's text, numbered from 0."""
    lines = documents_of(df, id_col, text_col).select("docid", F.posexplode(lines_in(F.col("line"))).alias("ln", "line"))
    return lines.withColumn("ln", F.col("ln").cast("bigint"))


def documents_of(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``<docid, line>``: each row's whole text as one record."""
    return df.select(F.col(id_col).cast("bigint").alias("docid"), F.col(text_col).alias("line"))
