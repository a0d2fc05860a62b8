"""Tab-separated message records ``<uid, name, date, text>``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .lines import read_lines

# The record's columns, in their order.
MESSAGE_COLUMNS = ["uid", "name", "date", "text"]


def parse_messages(lines: DataFrame, strict: bool = False) -> DataFrame:
    """Split ``line`` on tabs.

    Lenient: missing or empty fields are null, surplus ones are ignored. Strict: a line counts only when it
    has exactly four fields once the empty ones at its end are gone.
    """
    if strict:
        fields = lines.select(F.split(F.regexp_replace("line", r"\t+\z", ""), "\t").alias("f"))
        kept = fields.filter(F.size("f") == len(MESSAGE_COLUMNS))
        return kept.select(*[F.col("f")[i].alias(name) for i, name in enumerate(MESSAGE_COLUMNS)])
    fields = lines.select(F.split("line", "\t").alias("f"))
    return fields.select(
        *[F.nullif(F.get("f", F.lit(i)), F.lit("")).alias(name) for i, name in enumerate(MESSAGE_COLUMNS)]
    )


def read_messages(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    return parse_messages(read_lines(spark, path), strict)
