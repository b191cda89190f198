"""Rows of texts gathered into shards of bounded size, each handed over as one Arrow row of lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SHARD_BYTES = 1 << 24
SHARD_ROWS = 100_000

#: Bits of a shard's number below the number of the task's partition.
_BITS = 33


def first_shard() -> int:
    """The number of this task's first shard; it counts on from there and meets no other task's."""
    from pyspark import TaskContext

    context = TaskContext.get()
    return (context.partitionId() if context else 0) << _BITS


def gathered(
    batches: Iterator[pa.RecordBatch], most_bytes: int, most_rows: int, text: str = "text"
) -> Iterator[list[pa.RecordBatch]]:
    """Slices that make up a shard: at most ``most_bytes`` of text and ``most_rows`` rows, or one longer text."""
    held: list[pa.RecordBatch] = []
    size = rows = 0
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
        first = 0
        while first < batch.num_rows:
            base = int(ends[first - 1]) if first else 0
            last = int(np.searchsorted(ends, base + most_bytes - size, side="right"))
            last = min(last, first + most_rows - rows)
            if last <= first:
                if held:
                    yield held
                    held, size, rows = [], 0, 0
                    continue
                last = first + 1
            held.append(batch.slice(first, last - first))
            size, rows, first = size + int(ends[last - 1]) - base, rows + last - first, last
    if held:
        yield held


def joined(slices: list[pa.RecordBatch], name: str) -> pa.Array:
    """A column over all slices of a shard."""
    return pa.concat_arrays([s.column(name) for s in slices])


def one_list(values, kind: pa.DataType | None = None) -> pa.Array:
    """A list column of one row with all the values."""
    if not isinstance(values, pa.Array):
        values = pa.array(values, kind)
    elif kind is not None:
        values = values.cast(kind)
    return pa.ListArray.from_arrays(np.array([0, len(values)], dtype=np.int32), values)
