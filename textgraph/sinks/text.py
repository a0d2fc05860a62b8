"""Text output, one line a row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import tab_joined, tuple_text


def write_tsv(df: DataFrame, path: str, n: int | None = None, sort_by: str | None = None) -> None:
    """Tab-separated fields, in ``n`` files if given; with ``sort_by`` the files hold successive key ranges."""
    if sort_by is not None:
        df = df.repartitionByRange(n, sort_by) if n else df.repartitionByRange(sort_by)
        df = df.sortWithinPartitions(sort_by)
    elif n:
        df = df.repartition(n)
    df.select(tab_joined([F.col(c) for c in df.columns]).alias("value")).write.mode("overwrite").text(path)


def write_tuples(df: DataFrame, path: str) -> None:
    """``(a,b)`` lines."""
    df.select(tuple_text([F.col(c) for c in df.columns]).alias("value")).write.mode("overwrite").text(path)
