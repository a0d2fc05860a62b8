"""Columns whose cells hold numbers or strings end to end as bytes, so that many move as one row."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def offsets_of(column: pa.Array) -> np.ndarray:
    """Where each string or cell of bytes starts in its buffer, and where the last ends."""
    offsets = column.buffers()[1]
    return np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of strings, or of cells of bytes, without nulls."""
    data = column.buffers()[2]
    return offsets_of(column), np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def cells_of(values: np.ndarray, ends: np.ndarray) -> pa.BinaryArray:
    """Numbers as cells of bytes; a cell starts where the one before ends."""
    values = np.ascontiguousarray(values)
    starts = pa.py_buffer((np.r_[0, ends] * values.itemsize).astype(np.int32))
    return pa.BinaryArray.from_buffers(pa.binary(), len(ends), [None, starts, pa.py_buffer(values)])


def numbers_of(column: pa.BinaryArray, dtype: type = np.int64) -> np.ndarray:
    """All numbers of a column of such cells."""
    offsets, data = bytes_of(column)
    return data[offsets[0] : offsets[-1]].view(dtype)


def sizes_of(column: pa.BinaryArray, dtype: type = np.int64) -> np.ndarray:
    """How many numbers each cell holds."""
    return np.diff(offsets_of(column)) // np.dtype(dtype).itemsize


def strings_of(column: pa.BinaryArray, lengths: np.ndarray) -> pa.StringArray:
    """The strings of a column of cells that hold strings end to end, of which the lengths in bytes are known."""
    offsets, data = bytes_of(column)
    ends = np.r_[0, np.cumsum(lengths)].astype(np.int32)
    return pa.StringArray.from_buffers(len(lengths), pa.py_buffer(ends), pa.py_buffer(data[offsets[0] : offsets[-1]]))
