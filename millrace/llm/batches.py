"""Arrow batches through Python with bounded memory.

A batch holds at most ``spark.sql.execution.arrow.maxRecordsPerBatch`` rows and, where
the session sets it, ``spark.sql.execution.arrow.maxBytesPerBatch`` bytes. Spark's default
for the latter keeps batches of long texts small; ``slices`` cuts what comes once more, so
that a task's own working arrays follow ``BYTES`` and not the batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Bytes of Arrow data that a task works on at once; a single longer row is taken alone.
BYTES = 4 << 20


def slices(batch: pa.RecordBatch, most: int = BYTES) -> Iterator[pa.RecordBatch]:
    n = batch.num_rows
    if n <= 1 or batch.nbytes <= most:
        yield batch
        return
    yield from slices(batch.slice(0, n // 2), most)
    yield from slices(batch.slice(n // 2), most)


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str) -> DataFrame:
    """``df`` through a function on batches that ``make`` builds once in each task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in slices(batch):
                if part.num_rows:
                    yield work(part)

    return df.mapInArrow(run, schema)
