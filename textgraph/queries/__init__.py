"""The registered queries over the given tables, each with the same question as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def registered() -> dict[str, tuple[Query, str]]:
    from . import graph, hours, index, text

    return {**text.QUERIES, **index.QUERIES, **hours.QUERIES, **graph.QUERIES}
