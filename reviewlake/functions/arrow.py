"""Arrow batches worked on in parts."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F

#: Bytes of a part. A row takes many times its bytes as Python objects, a batch has up to
#: ``spark.sql.execution.arrow.maxBytesPerBatch``.
PART = 1 << 20


def parts(batch: pa.Array) -> Iterator[pa.Array]:
    """The batch in order, in slices of at most ``PART`` bytes or of one row."""
    start = size = 0
    for i in range(len(batch)):
        row = batch.slice(i, 1).nbytes
        if i > start and size + row > PART:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += row
    if start < len(batch):
        yield batch.slice(start)


def udf_in_parts(convert: Callable[[pa.Array], pa.Array], returns: str) -> Callable[..., Column]:
    """``convert`` as a UDF that holds the Python objects of one part at a time."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for part in parts(batch):
                yield convert(part)

    # Else a filter on the result is moved below it, and has it worked out a second time.
    return F.arrow_udf(run, returns).asNondeterministic()


# The helpers travel with the job; executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
