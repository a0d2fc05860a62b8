"""Column expressions shared by the operators: blanks, sizes, folds, and Arrow helpers."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.durable import durable

# The characters that separate words in all contracts.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def whole_text(text: str = "text") -> Column:
    """A null text counts as an empty one."""
    return F.coalesce(F.col(text), F.lit(""))


def fold(doc_id: str, folds: int) -> Column:
    """The fold of a document: crc32 of its id as text, modulo ``folds``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds


def doc_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``<doc_id, text>`` with every other column, whatever its name, left behind."""
    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), whole_text(text).alias("text"))


def placed_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``<doc_id, text, place>``: ``place`` is the row's number in its file, the same whenever and however the file is read.

    Rows of no file are written first.
    """
    try:
        place = docs.metadataColumn("_metadata")["row_index"]
        return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), whole_text(text).alias("text"), place.alias("place"))
    except AnalysisException:  # a plan that is not, or no longer, a scan of files
        return placed_rows(durable(doc_rows(docs, doc_id, text), "documents"))


def each_text(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of an Arrow string column without nulls, one text at a time."""
    return (value.as_py() for value in column.cast(pa.large_binary()))


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column without nulls."""
    return column.cast(pa.large_binary()).to_pylist()
