"""Small helpers for Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute


def text_slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches into slices of about ``max_bytes`` of text (a longer single
    text is a slice of its own), so that per-slice arrays stay small."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(column))
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(col), 0), dtype=np.int64)
        ends = np.cumsum(sizes)
        at = 0
        while at < len(sizes):
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield batch.slice(at, to - at)
            at = to


def utf8_parts(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the n + 1 offsets of its values (null: empty)."""
    col = pa.compute.fill_null(col, "")
    wide = pa.types.is_large_string(col.type)
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = col.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def table_batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) if not isinstance(c, pa.Array) else c for c, f in zip(columns, schema, strict=True)], schema=schema)
