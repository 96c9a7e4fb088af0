"""A topic kept as files, with partitions and offsets, read by offset ranges.

`append_topic` is the producer: one range sort by (partition, time) writes
bounded segment files in parallel, and an index row per segment and partition
says where its rows lie and which offsets they have, dense within each
partition. `StagedTopic` is Spark's Python data-source interface over it:

* as a stream it starts at the earliest, the latest or given offsets, admits at
  most `maxOffsetsPerTrigger` offsets to a micro-batch (shared out over the
  partitions by what each still holds), or `maxAppendsPerTrigger` appends, and
  resumes from the query's checkpoint;
* as a bounded read its end offsets are fixed when it is planned, and
  `maxMessages` plans only the first segments that hold so many messages.

Every micro-batch and every read is cut into input partitions of offset ranges
(`rowsPerTask` rows at most), which tasks read as Arrow batches. Planning reads
the index, never the data, but for streams of very many small micro-batches
(`readWhenAdmitted`, with a cap of `PLANNED_ROWS` offsets or fewer): those read a
micro-batch when they admit it and hand Spark the records, which saves a call of a
Python worker each. One producer at a time; an append is visible when its index
rows are.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.errors import PySparkNotImplementedError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition, SimpleDataSourceStreamReader

from orderlens.schemas import TOPIC_RECORD
from orderlens.sources.store import exists

SEGMENT_ROWS = 1_000_000
#: Bytes of a segment's row groups: a range decodes the groups it touches, and a capped stream's ranges are small.
GROUP_BYTES = 1 << 20
ROWS_PER_TASK = 250_000
#: The most offsets of a micro-batch that is read where it is planned.
PLANNED_ROWS = 10_000
_INDEX = "file string, partition int, first_row long, rows long, first_offset long, append long"
_ARROW = pa.schema([("key", pa.binary()), ("value", pa.binary()), ("topic", pa.string()), ("partition", pa.int32()),
                    ("offset", pa.int64()), ("timestamp", pa.timestamp("us", "UTC")), ("timestampType", pa.int32())])


# --- producer -------------------------------------------------------------------

def append_topic(records: DataFrame, path: str, segment_rows: int = SEGMENT_ROWS, files: int | None = None) -> str:
    """Append records (topic columns; their offsets give way to the topic's own) in time order.

    Rows are sorted by (partition, timestamp) over as many tasks as the shuffle
    has (`files`: another number), so a partition with most of the rows is
    written by many tasks; equal times follow the order of the given offsets.
    """
    spark = records.sparkSession
    index_path = f"{path}/index"
    known = spark.read.schema(_INDEX).parquet(index_path) if exists(spark, index_path) else None
    number = known.agg(F.max("append")).first()[0] + 1 if known is not None else 1
    by = ("partition", "timestamp", "offset")
    spread = records.repartitionByRange(files, *by) if files else records.repartitionByRange(*by)
    segments = f"{path}/segments/append={number}"
    spread.sortWithinPartitions(*by).drop("offset").write.option("maxRecordsPerFile", segment_rows).option(
        "parquet.block.size", GROUP_BYTES).mode("overwrite").parquet(segments)

    written = spark.read.parquet(segments).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("name"),
        F.col("_metadata.row_index").alias("row"), "partition")
    slices = written.groupBy("file", "name", "partition").agg(F.min("row").alias("first_row"), F.count(F.lit(1)).alias("rows"))
    # files are numbered by task, then by file of the task
    task, chunk = (F.regexp_extract("name", x, 1).cast("long") for x in (r"^part-(\d+)", r"-c(\d+)\."))
    before = Window.partitionBy("partition").orderBy(task, chunk).rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("first_offset", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    if known is not None:
        ends = known.groupBy("partition").agg(F.max(F.col("first_offset") + F.col("rows")).alias("next"))
        slices = slices.join(ends, "partition", "left").withColumn("first_offset", F.col("first_offset") + F.coalesce("next", F.lit(0)))
    index = slices.select("file", "partition", "first_row", "rows", "first_offset", F.lit(number).cast("long").alias("append"))
    index.coalesce(1).write.mode("append").parquet(index_path)  # one row per segment and partition
    return path


# --- readers ----------------------------------------------------------------------

@dataclass
class OffsetRange(InputPartition):
    """Rows of one segment: `rows` from `first_row` on, which are the partition's offsets from `first_offset` on."""

    file: str
    partition: int
    first_row: int
    rows: int
    first_offset: int


def _open(uri: str):
    """(file system, path) of a URI or a local path."""
    if uri.startswith("file:"):
        uri = "file:///" + uri[len("file:"):].lstrip("/")
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


def _index(path: str) -> list[dict]:
    """The index rows in (partition, offset) order; none before the first append."""
    fs, at = _open(f"{path}/index")
    # not below the folder, where an append that is under way makes and deletes folders of its own
    there = [f.path for f in fs.get_file_info(pafs.FileSelector(at, allow_not_found=True)) if f.is_file and f.base_name.endswith(".parquet") and f.base_name[0] not in "._"]
    if not there:
        return []
    rows = ds.dataset(there, filesystem=fs, format="parquet", exclude_invalid_files=False).to_table().to_pylist()
    return sorted(rows, key=lambda r: (r["partition"], r["first_offset"]))


def _ends(index: list[dict]) -> dict[str, int]:
    """The next offset of each partition."""
    out: dict[str, int] = {}
    for r in index:
        out[str(r["partition"])] = max(out.get(str(r["partition"]), 0), r["first_offset"] + r["rows"])
    return out


def _given(text: str | None, default: str, ends: dict[str, int]) -> dict[str, int]:
    """Offsets by partition from 'earliest', 'latest' or a JSON object."""
    text = text or default
    if text == "earliest":
        return {p: 0 for p in ends}
    if text == "latest":
        return dict(ends)
    return {str(p): int(o) for p, o in json.loads(text).items()}


def _ranges(index: list[dict], start: dict, end: dict, rows_per_task: int) -> list[OffsetRange]:
    """The offset ranges from start (a new partition: 0) up to end, cut to the most rows of a task."""
    out = []
    for r in index:
        p = str(r["partition"])
        lo = max(int(start.get(p, 0)), r["first_offset"])
        hi = min(int(end.get(p, 0)), r["first_offset"] + r["rows"])
        for at in range(lo, hi, rows_per_task):
            out.append(OffsetRange(r["file"], r["partition"], r["first_row"] + at - r["first_offset"], min(rows_per_task, hi - at), at))
    return out


def admitted(start: dict[str, int], ends: dict[str, int], most: int) -> dict[str, int]:
    """End offsets of a micro-batch of at most `most` offsets, shared out by what each partition still holds."""
    left = {p: max(0, e - start.get(p, 0)) for p, e in ends.items()}
    total = sum(left.values())
    if not most or total <= most:
        return {p: max(e, start.get(p, 0)) for p, e in ends.items()}
    take = {p: n * most // total for p, n in left.items()}
    spare = most - sum(take.values())
    for p in sorted(left, key=lambda p: (-(left[p] * most % total), p))[:spare]:
        take[p] += 1
    return {p: start.get(p, 0) + take[p] for p in ends}


def _next_appends(index: list[dict], start: dict, most: int) -> list[dict]:
    """The index up to the last of the next `most` appends that hold unread offsets."""
    unread = sorted({r["append"] for r in index if r["first_offset"] + r["rows"] > int(start.get(str(r["partition"]), 0))})
    return [r for r in index if r["append"] <= unread[:most][-1]] if unread else index


def read_range(part: OffsetRange | None):
    """The range's records as Arrow batches; row groups outside it are not read. None: a read without ranges."""
    if part is None:
        return
    fs, at = _open(part.file)
    with fs.open_input_file(at) as f:
        file = pq.ParquetFile(f)
        groups, first, row = [], None, 0
        for g in range(file.num_row_groups):
            n = file.metadata.row_group(g).num_rows
            if row + n > part.first_row and row < part.first_row + part.rows:
                groups.append(g)
                first = row if first is None else first
            row += n
        row, stop = first or 0, part.first_row + part.rows
        for batch in file.iter_batches(batch_size=10_000, row_groups=groups):
            lo, hi = max(0, part.first_row - row), min(batch.num_rows, stop - row)
            if lo < hi:
                yield _records(batch.slice(lo, hi - lo), part.first_offset + row + lo - part.first_row)
            row += batch.num_rows
            if row >= stop:
                return


def _records(batch: pa.RecordBatch, offset: int) -> pa.RecordBatch:
    columns = []
    for field in _ARROW:
        if field.name == "offset":
            columns.append(pa.array(range(offset, offset + batch.num_rows), pa.int64()))
            continue
        column = batch.column(field.name)
        if pa.types.is_timestamp(column.type) and column.type.tz is None:
            column = pc.assume_timezone(column, "UTC")
        columns.append(column.cast(field.type, safe=False))
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW)


class _Bounded(DataSourceReader):
    """End offsets fixed at the start, one input partition per range."""

    def __init__(self, options):
        self.options = options

    def partitions(self):
        index = _index(self.options["path"])
        ends = _ends(index)
        start = _given(self.options.get("startingOffsets"), "earliest", ends)
        end = _given(self.options.get("endingOffsets"), "latest", ends)
        out = _ranges(index, start, end, int(self.options.get("rowsPerTask", ROWS_PER_TASK)))
        most = self.options.get("maxMessages")
        if most is not None:
            out = _first(out, int(most))
        return out

    def read(self, partition):
        return read_range(partition)


def _first(ranges: list[OffsetRange], most: int) -> list[OffsetRange]:
    """The first ranges, in (partition, offset) order, that hold the first messages."""
    out = []
    for r in ranges:
        if most <= 0:
            break
        out.append(OffsetRange(r.file, r.partition, r.first_row, min(r.rows, most), r.first_offset))
        most -= r.rows
    return out


class _Stream(DataSourceStreamReader):
    """Admission by offsets.

    The interface asks for the latest offset without saying from where; that is
    in the query's own offset log, below the `checkpointLocation` option.
    """

    def __init__(self, options):
        self.options = options
        self.start: dict[str, int] | None = None

    def initialOffset(self):
        if self.start is None:
            self.start = _given(self.options.get("startingOffsets"), "latest", _ends(_index(self.options["path"])))
        return self.start

    def latestOffset(self):
        start = self._logged()
        return self.admit(self.initialOffset() if start is None else start)

    def admit(self, start: dict[str, int]) -> dict[str, int]:
        """End offsets of the micro-batch from start."""
        index = _index(self.options["path"])
        appends = int(self.options.get("maxAppendsPerTrigger", 0))
        if appends:
            index = _next_appends(index, start, appends)
        return {**start, **admitted(start, _ends(index), int(self.options.get("maxOffsetsPerTrigger", 0)))}

    def _logged(self) -> dict[str, int] | None:
        """The end offsets of the query's latest planned micro-batch."""
        checkpoint = self.options.get("checkpointLocation")
        if not checkpoint:
            return None
        fs, at = _open(f"{checkpoint.rstrip('/')}/offsets")
        if fs.get_file_info(at).type == pafs.FileType.NotFound:
            return None
        done = [f for f in fs.get_file_info(pafs.FileSelector(at)) if f.base_name.isdigit()]
        if not done:
            return None
        last = max(done, key=lambda f: int(f.base_name))
        with fs.open_input_stream(last.path) as f:
            lines = f.read().decode().splitlines()
        # version, metadata, then one line per source
        return json.loads(lines[2 + int(self.options.get("sourceIndex", 0))])

    def partitions(self, start, end):
        return _ranges(_index(self.options["path"]), start, end, int(self.options.get("rowsPerTask", ROWS_PER_TASK)))

    def read(self, partition):
        return read_range(partition)


class _SmallBatches(SimpleDataSourceStreamReader):
    """The same micro-batches, read when they are admitted; Spark says from where, and replays one by its offsets."""

    def __init__(self, options):
        self.stream = _Stream(options)

    def initialOffset(self):
        return self.stream.initialOffset()

    def read(self, start):
        end = self.stream.admit(start)
        return self.readBetweenOffsets(start, end), end

    def readBetweenOffsets(self, start, end):
        # of a list, as Spark copies the iterator
        return iter([batch for part in self.stream.partitions(start, end) for batch in read_range(part)])


class StagedTopic(DataSource):
    """Format `staged_topic`; options path, startingOffsets, endingOffsets, maxOffsetsPerTrigger, maxAppendsPerTrigger,
    maxMessages, checkpointLocation (needed by a capped stream), sourceIndex, rowsPerTask, readWhenAdmitted."""

    @classmethod
    def name(cls):
        return "staged_topic"

    def schema(self):
        return TOPIC_RECORD

    def reader(self, schema):
        return _Bounded(self.options)

    def streamReader(self, schema):
        capped = int(self.options.get("maxOffsetsPerTrigger", 0)) or int(self.options.get("maxAppendsPerTrigger", 0))
        if capped and not self.options.get("checkpointLocation"):
            raise ValueError("a capped stream needs the option checkpointLocation, the checkpoint of its query")
        if self.options.get("readWhenAdmitted") == "true" and 0 < int(self.options.get("maxOffsetsPerTrigger", 0)) <= PLANNED_ROWS:
            raise PySparkNotImplementedError(errorClass="NOT_IMPLEMENTED", messageParameters={"feature": "streamReader"})  # simpleStreamReader
        return _Stream(self.options)

    def simpleStreamReader(self, schema):
        return _SmallBatches(self.options)


def topic_stream(spark: SparkSession, path: str, checkpoint: str | None = None, starting: str = "latest",
                 max_offsets: int = 0, max_appends: int = 0, small: bool = False) -> DataFrame:
    """The topic as a stream of records, at most `max_offsets` and `max_appends` (0: no cap) a micro-batch.

    `checkpoint` is the checkpoint of the query that will read it; `small` micro-batches are read when they are admitted.
    """
    spark.dataSource.register(StagedTopic)
    reader = spark.readStream.format("staged_topic").option("path", path).option("startingOffsets", starting)
    if checkpoint:
        reader = reader.option("checkpointLocation", checkpoint)
    reader = reader.option("readWhenAdmitted", str(small).lower())
    return reader.option("maxOffsetsPerTrigger", str(max_offsets)).option("maxAppendsPerTrigger", str(max_appends)).load()


def topic_records(spark: SparkSession, path: str, starting: str = "earliest", ending: str = "latest",
                  max_messages: int | None = None) -> DataFrame:
    """A bounded read of the topic, end offsets fixed now; `max_messages` plans the first ones only."""
    spark.dataSource.register(StagedTopic)
    reader = spark.read.format("staged_topic").option("path", path).option("startingOffsets", starting).option("endingOffsets", ending)
    if max_messages is not None:
        reader = reader.option("maxMessages", str(max_messages))
    return reader.load()


def size(path: str) -> int:
    """Offsets that the topic holds."""
    return sum(_ends(_index(path)).values())


def drain(query) -> list:
    """Run a started query to the end of what its topic holds, stop it, return its progress reports."""
    try:
        query.processAllAvailable()
        return list(query.recentProgress)
    finally:
        query.stop()
