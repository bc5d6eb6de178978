"""Row-wise work in Arrow batches, cut small enough that long texts stay within memory."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

Compute = Callable[[pa.RecordBatch], dict[str, pa.Array]]

# The most of one slice; a single longer row is a slice of its own.
SLICE_BYTES = 8 << 20
SLICE_ROWS = 2_000


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    start = 0
    while start < batch.num_rows:
        rows = min(SLICE_ROWS, batch.num_rows - start)
        while rows > 1 and batch.slice(start, rows).nbytes > SLICE_BYTES:
            rows //= 2
        yield batch.slice(start, rows)
        start += rows


def with_computed(
    df: DataFrame, compute: Compute, added: str, keep: Iterable[str] | None = None
) -> DataFrame:
    """`df` with the columns of `added` (a schema in DDL), made by `compute` from each slice.

    `keep` names the columns that stay (default: all). A new column replaces an old one of
    the same name.
    """
    new = T.StructType.fromDDL(added)
    names = set(new.names)
    kept = [c for c in (df.columns if keep is None else keep) if c not in names]
    fields = {f.name: f for f in df.schema.fields}
    schema = T.StructType([*(fields[c] for c in kept), *new.fields])
    order = list(new.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                made = compute(part)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in kept), *(made[c] for c in order)],
                    [*kept, *order],
                )
        pa.default_memory_pool().release_unused()  # the worker goes on to other tasks

    return df.mapInArrow(run, schema)
