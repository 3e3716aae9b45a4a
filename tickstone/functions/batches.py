"""Arrow batches of texts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute


def text_batches(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches with about ``limit`` bytes of text each (one text at least), to bound memory."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        sizes = pa.compute.binary_length(batch.column(at)).fill_null(0).to_numpy(zero_copy_only=False)
        first, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(first, i - first)
                first, held = i, 0
            held += int(size)
        if first < batch.num_rows:
            yield batch.slice(first)
