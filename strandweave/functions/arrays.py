"""Columns of Arrow batches as NumPy arrays: letters, lists of numbers, and back."""

import numpy as np
import pyarrow as pa


def ascii_letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after another, and where each begins (one entry more than texts); null is empty.

    A letter outside ASCII counts as one, ``?``, so that places in the text stay what they are.
    """
    data, starts = _spread(column)
    if data.size and data.max() > 127:
        texts = [(t or "").encode("ascii", "replace") for t in column.to_pylist()]
        starts, data = np.cumsum([0, *map(len, texts)]), np.frombuffer(b"".join(texts), np.uint8)
    return data, starts


def code_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """As ``ascii_letters``, with the code point of every letter."""
    data, starts = _spread(column)
    if data.size and data.max() > 127:
        before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        return np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4"), before[starts]
    return data, starts


def _spread(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    starts = np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[starts[0]:starts[-1]]
    return data, starts - starts[0]


def numbers(column: pa.Array, null: int = 0) -> np.ndarray:
    """One whole number a row."""
    if pa.types.is_boolean(column.type):
        column = column.cast(pa.int8())
    return (column.fill_null(null) if column.null_count else column).to_numpy(zero_copy_only=False).astype(np.int64)


def lists(column: pa.Array, null: int) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the lists one after another, and where each list begins; a null list is empty."""
    sizes = numbers(column.value_lengths())
    return numbers(column.flatten(), null), np.concatenate([[0], np.cumsum(sizes)])


def texts(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Texts of ASCII letters."""
    return pa.StringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data, np.uint8)))


def chosen(letters: str, others: str) -> np.ndarray:
    """A table of 256 letters that turns ``letters`` into ``others`` and leaves the rest."""
    table = np.arange(256, dtype=np.uint8)
    table[list(letters.encode())] = list(others.encode())
    return table
