"""Texts in Python a piece of a batch at a time, and memory given back after each batch."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 2 << 20  # of text that is turned into Python strings at once


def text_pieces(column: pa.Array, max_bytes: int = PIECE_BYTES, step: int = 1) -> Iterator[pa.Array]:
    """Slices of about ``max_bytes`` at most, in order; a longer text is one of its own.

    A slice ends behind a multiple of ``step`` texts that are not null, so that calls for so many
    texts are the same as for the whole column.
    """
    start, held, filled = 0, 0, 0
    for row, size in enumerate(pc.binary_length(column).to_pylist()):
        if row > start and held + (size or 0) > max_bytes and filled % step == 0:
            yield column.slice(start, row - start)
            start, held = row, 0
        held += size or 0
        filled += size is not None
    if start < len(column):
        yield column.slice(start)


def structs(rows: list[tuple[str | None, str | None]], first: str, second: str) -> pa.Array:
    """Pairs of strings as a struct array."""
    columns = [pa.array([row[n] for row in rows], pa.string(), from_pandas=True) for n in (0, 1)]
    return pa.StructArray.from_arrays(columns, [first, second])


def release() -> None:
    """Give memory that is free again back to the system: workers wait for more tasks after one."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # of the C library of most Linux systems alone
        ctypes.CDLL(None).malloc_trim(0)
