"""Broadcast only what has been measured."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

# A table is broadcast only up to this many bytes.
BROADCAST_BYTES = 64 << 20
# Bytes reckoned for a row besides its strings and nested values.
ROW_BYTES = 64


def measured_bytes(df: DataFrame) -> int:
    """Rows, string lengths and nested values (as JSON text) of ``df`` summed up in one job; only the sum is returned."""
    row = F.lit(ROW_BYTES).cast("bigint")
    for field in df.schema.fields:
        if isinstance(field.dataType, (StringType, BinaryType)):
            row = row + F.coalesce(F.octet_length(df[field.name]), F.lit(0))
        elif isinstance(field.dataType, (ArrayType, MapType, StructType)):
            row = row + F.coalesce(F.octet_length(F.to_json(F.struct(df[field.name]))), F.lit(0))
    return df.agg(F.sum(row)).first()[0] or 0


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint when it measures at most ``limit`` bytes, else ``df`` for a shuffled join.

    ``df`` is read twice, so pass a written or otherwise cheap one.
    """
    return F.broadcast(df) if measured_bytes(df) <= limit else df


def dealt(df: DataFrame) -> DataFrame:
    """``df``, dealt out evenly when it is a small table that would leave cores without work.

    A file of a few row groups is read by as few tasks, however many cores there are. Where the scan has less to read
    than one full split for each core, moving its rows costs next to nothing; a larger scan is left as it is. The
    sizes are those that the plan tells; no job is run.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < cores * split else df
