"""Cut a plan's lineage with a table written to the shared checkpoint folder.

A written table survives lost executors, fixes generated ids, and tells Catalyst its size, so that whether
a later join broadcasts it is decided by ``spark.sql.autoBroadcastJoinThreshold`` and not by a blind hint.
The tables are scratch: they are deleted when the application ends.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
# Spark's own setting: the shuffle files of a query are removed when it has ended.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names. Only where driver and executors are one process does it get one of its own."""
    named = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError(f"set {SETTING} to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="textgraph-"))
    return _scratch(spark, spark.sparkContext.getCheckpointDir())


def _scratch(spark: SparkSession, path: str) -> str:
    """``path``, to be deleted when the application ends."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, to be deleted when the application ends."""
    return _scratch(spark, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}")


def durable(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` now and go on from the written rows."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(frames: Iterable[DataFrame], name: str) -> DataFrame:
    """Write frames of one schema now, one after another, as one table, and go on from the written rows.

    What a frame has shuffled is removed when it is written, so at any time there is one frame's on disk, not all of
    them. A generator builds each frame when its turn has come. A table written here is not written again.
    """
    path = schema = None
    for df in frames:
        spark = df.sparkSession
        if path is None:
            path, schema = scratch_path(spark, name), df.schema
        before = spark.conf.get(TIDY, "false")
        spark.conf.set(TIDY, "true")
        try:
            df.write.mode("append").option("compression", "zstd").parquet(path)
        finally:
            spark.conf.set(TIDY, before)
    table = spark.read.schema(schema).parquet(path)
    table.settled = True
    return table


def once_settled(df: DataFrame, name: str) -> DataFrame:
    """``df`` itself if :func:`settled` has written it, else what that makes of it."""
    return df if getattr(df, "settled", None) is True else settled([df], name)
