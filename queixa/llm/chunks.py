"""Rows of documents packed into chunks of bounded size, each with a dictionary of what it holds.

What a whole corpus knows of a word or a pair is asked once per chunk and entry, not once per
occurrence, and the answers come back to the chunk. A chunk's number is fixed by its place in
the input's partitions, and chunks are stored before anything is asked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext

# Bytes of text in a chunk; a longer text is a chunk of its own.
CHUNK_BYTES = 8 << 20


def text_chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Consecutive rows (doc_id, text) with about `size` bytes of text."""
    held, held_bytes = [], 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        at, base = 0, 0
        while at < len(lengths):
            last = max(at + 1, int(np.searchsorted(ends, base + size - held_bytes, side="right")))
            held.append(batch.slice(at, last - at))
            held_bytes += int(ends[last - 1]) - base
            at, base = last, int(ends[last - 1])
            if held_bytes >= size or last < len(lengths):
                yield pa.Table.from_batches(held)
                held, held_bytes = [], 0
    if held:
        yield pa.Table.from_batches(held)


def chunk_writer(pack: Callable[[pa.Table], dict], schema: pa.Schema, size: int):
    """A function for mapInArrow: one row per chunk, `pack`'s columns and the chunk's number."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for n, table in enumerate(text_chunks(batches, size)):
            row = {"chunk": first + n, **pack(table)}
            yield pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in schema], schema=schema)
    return write


class Numbering(dict):
    """Numbers from 0 in order of first use."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


def offsets(lengths: np.ndarray) -> np.ndarray:
    found = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=found[1:])
    return found


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places starts[i], starts[i] + 1, ... of each i, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The sum of each stretch between bounds (empty stretches: 0)."""
    total = np.zeros(len(values) + 1, dtype=np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def packed(values: np.ndarray) -> bytes:
    """Numbers as compressed bytes, for what is stored or shuffled."""
    return pa.compress(values.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, dtype, count: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, decompressed_size=count * np.dtype(dtype).itemsize, codec="zstd", asbytes=True), dtype=dtype)
