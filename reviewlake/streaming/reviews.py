"""Reviews as a stream of files."""

from __future__ import annotations

import csv
import io
import itertools
import sys
from collections.abc import Iterator, Sequence
from datetime import timedelta
from operator import itemgetter

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions import text
from ..operators.filters import drop_missing_id, drop_sample
from ..schema import REVIEW_SCHEMA
from ..sources.write import load_once

#: Records that are handed on at once.
ROWS = 5000
#: Keys of the state of ``stream_first``, each of which has the ids of a hash.
BUCKETS = 1 << 14
# Files are read as text, like the batch source does.
FIELDS = REVIEW_SCHEMA.fieldNames()
FILE_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in [*FIELDS, "file"]])


def _rows_by_name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of whole files, their columns found by the header's names."""
    csv.field_size_limit(sys.maxsize)
    for batch in batches:
        for value, file in zip(batch.column("value"), batch.column("file"), strict=True):
            records = csv.reader(io.StringIO((value.as_py() or "").lstrip("\ufeff"), newline=""))
            header = next(records, [])
            at = [header.index(n) if n in header else None for n in FIELDS]
            while some := list(itertools.islice((r for r in records if r), ROWS)):
                columns = [
                    pa.array([r[i] if i is not None and i < len(r) else None for r in some], pa.string())
                    for i in at
                ]
                columns.append(pa.array([file.as_py()] * len(some), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, [*FIELDS, "file"])


def stream_reviews(spark: SparkSession, path: str) -> DataFrame:
    """Review files as they arrive in a folder, test data and rows without id left out.

    Columns are matched by the names in each file's header; a file is read by one
    task, as CSV with line breaks inside quotes cannot be split.
    """
    files = (
        spark.readStream.format("text")
        .options(wholetext=True, pathGlobFilter="*.csv")
        .load(path)
        .select("value", F.col("_metadata.file_name").alias("file"))
    )
    rows = files.mapInArrow(_rows_by_name, FILE_SCHEMA)
    reviews = rows.select(
        *[text.blank_to_null(F.col(n)).alias(n) for n in FIELDS],
        text.company_from_path(F.col("file")).alias("company"),
    ).withColumn("rating", text.rating_float(F.col("rating")))
    return clean_stream(reviews)


def clean_stream(df: DataFrame) -> DataFrame:
    """The cleaning that needs one row at a time."""
    return drop_missing_id(drop_sample(df))


def stream_dedup(
    df: DataFrame, event_time: str | None = None, watermark: str | None = None
) -> DataFrame:
    """Each review id once, ever; the state keeps every id.

    With a watermark the state is bounded and an id is known only that long. Which row of
    an id is kept depends on what arrives first; see ``stream_first``.
    """
    if event_time and watermark:
        return df.withWatermark(event_time, watermark).dropDuplicatesWithinWatermark(["review_id"])
    return df.dropDuplicates(["review_id"])


class _First(StatefulProcessor):
    """Of an id's rows, the first by an order, once no other of its time can come.

    A key is a bucket of ids. The state has, for each id and each event time for which a
    decision is due, the first row of it. It is read and written once for each batch that has
    rows of the bucket: calls between a worker and the state store take milliseconds, the rows
    within them microseconds.
    """

    def __init__(self, schema: T.StructType, key: str, order: Sequence[str], known: int):
        self.schema, self.key, self.order, self.known = schema, key, order, known

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        names = self.schema.fieldNames()
        self.named, self.at_key = Row(*names), names.index(self.key)
        self.places = [names.index(c) for c in self.order]
        state = T.StructType([T.StructField("at", T.ArrayType(T.LongType()))])
        self.held = handle.getValueState("held", state.add("rows", T.ArrayType(self.schema)))

    def place(self, row: tuple) -> list[tuple]:
        """Nulls first."""
        return [(row[i] is not None, row[i]) for i in self.places]

    def id_of(self, row: tuple) -> str | None:
        """The id as what a dictionary can have; a column has values of one type."""
        value = row[self.at_key]
        return value if value is None or isinstance(value, str) else repr(value)

    def known_rows(self) -> dict[str | None, dict[int, tuple]]:
        held, out = self.held.get(), {}
        if held is not None:
            for at, row in zip(held[0], held[1], strict=True):
                out.setdefault(self.id_of(row), {})[at] = tuple(row)
        return out

    def due(self, ids: dict[str | None, dict[int, tuple]]) -> int | None:
        """When the first decision is due."""
        return min(map(min, ids.values())) + self.known if ids else None

    def keep(self, ids: dict[str | None, dict[int, tuple]], timer: int | None) -> None:
        """Writes the state; ``timer`` is when a timer is set already."""
        if not ids:
            self.held.clear()
            return
        rows = [one for held in ids.values() for one in held.items()]
        self.held.update(([at for at, _ in rows], [row for _, row in rows]))
        if (due := self.due(ids)) != timer:
            self.handle.registerTimer(due)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        ids, take = self.known_rows(), None
        timer = self.due(ids)
        for row in rows:
            if take is None:
                take = itemgetter(*map(row.__fields__.index, ["_at", *self.schema.fieldNames()]))
            at, *new = take(row)
            held, new = ids.setdefault(self.id_of(new), {}), tuple(new)
            held[at] = min(held.get(at, new), new, key=self.place)
        self.keep(ids, timer)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now, ids = timerValues.getCurrentWatermarkInMs(), self.known_rows()
        # A timer of rows that went with an earlier one has nothing to do.
        if (due := self.due(ids)) is None or due > now:
            return
        for one, held in list(ids.items()):
            while held and min(held) + self.known <= now:
                end = min(held) + self.known
                yield self.named(*min((r for at, r in held.items() if at <= end), key=self.place))
                held = {at: r for at, r in held.items() if at > end}
            if held:
                ids[one] = held
            else:
                del ids[one]
        self.keep(ids, None)


def stream_first(
    df: DataFrame,
    order: Sequence[str],
    event_time: str,
    known: timedelta,
    late: str = "0 seconds",
    key: str = "review_id",
) -> DataFrame:
    """The first row of each id in the order of columns, whatever arrives first.

    The rows of an id whose event times are at most ``known`` after its first compete.
    One is handed on when the watermark, which is ``late`` behind the latest event time,
    has passed that span; then the id is forgotten, and a later row of it begins anew. So
    the result is told by the rows alone, as long as none comes later than ``late``, and
    the state holds only what the watermark has not passed. Rows without event time are
    left out.

    The ids are held in ``BUCKETS`` buckets by their hash, which a checkpoint is bound to. A
    batch reads and writes the buckets it has rows for.
    """
    df.sparkSession.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    timed = df.where(F.col(event_time).isNotNull()).withWatermark(event_time, late)
    first = _First(df.schema, key, list(order), known // timedelta(milliseconds=1))
    return (
        timed.withColumn("_at", F.unix_millis(F.col(event_time).cast("timestamp")))
        .withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(BUCKETS)))
        .groupBy("_bucket")
        .transformWithState(first, df.schema, "append", "EventTime")
    )


def stream_load(
    df: DataFrame,
    table: str,
    checkpoint: str,
    path: str | None = None,
    once: bool = True,
    mode: str = "append",
) -> StreamingQuery:
    """Load the stream into a table; with ``once`` up to what has arrived by now.

    Each batch is loaded once, however often it is run again (``write.load_once``).
    ``append`` adds its rows; ``replace`` has the table hold the latest batch alone, for
    sources that hand over all they have each time.
    """
    def publish(batch: DataFrame, number: int) -> None:
        # A batch without rows, as a watermark makes them, is no load.
        if not batch.isEmpty():
            query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
            load_once(batch, table, f"{query}-{number}", mode, path)

    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.foreachBatch(publish).start()


# The helpers travel with the job; executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
