"""Blocks of documents kept as files in the shared folder.

Operators that need statistics of the whole corpus for every document, where
those statistics may be larger than a worker, cut the documents into blocks of
bounded size.  One task writes a block and says what the block has to know;
those requests are joined with the corpus-wide statistics in Spark; another
task reads the block again together with its answers.  A block's file has a
name of its own for every task attempt and counts only once the table that
names it is committed, so lost executors and repeated tasks do no harm.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from .common import filesystem, write_once


def save_block(folder: str, name: str, table: pa.Table, **options) -> str:
    """Write ``table`` as a Parquet file of its own under ``folder``; its name."""
    sink = pa.BufferOutputStream()
    pq.write_table(table, sink, compression="zstd", **options)
    return write_once(folder, name, [memoryview(sink.getvalue())])[0]


def load_block(folder: str, name: str) -> pa.Table:
    file_system, root = filesystem(folder)
    with file_system.open_input_file(f"{root.rstrip('/')}/{name}") as f:
        return pq.read_table(f)


def pack(values: np.ndarray) -> bytes:
    """Whole numbers below 2^64 in as few bytes each as the largest needs (a first byte says how many)."""
    values = np.ascontiguousarray(values, "<u8")
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    return bytes([width]) + values.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack(raw: bytes) -> np.ndarray:
    width = raw[0]
    short = np.frombuffer(raw, np.uint8, offset=1).reshape(-1, width)
    out = np.zeros((len(short), 8), np.uint8)
    out[:, :width] = short
    return out.reshape(-1).view("<u8")


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending whole numbers, as differences."""
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(unpack(raw), dtype=np.uint64)
