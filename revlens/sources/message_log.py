"""A log of messages in folders, and a bounded stream over it that knows its offsets.

A log is `topic=T/partition=N` folders of parquet files with the columns `offset` and `value`; the
offsets of a partition are consecutive and each file holds a stretch of them. Nothing serves it:
writers add files, readers list folders.

The stream source `message_log` starts at the first offsets, plans at most `max_offsets` messages per
trigger, shared out over the partitions that have some, and gives `topic`, `partition`, `offset` and `value`.
Spark keeps the offsets in its checkpoint. The source also notes what it has planned in the file
`progress`, beside the checkpoint, because Spark does not tell a source where it starts when it asks for
the next offsets. File footers tell the stretch of a file, and are read once per file.
"""

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from revlens.runtime import open_path, path_exists

SCHEMA = "topic string, partition int, offset long, value string"
MAX_OFFSETS = 1_000_000
_TASK_OFFSETS = 200_000
_BATCH_BYTES, _BATCH_ROWS, _READ_BYTES = 4 << 20, 10_000, 1 << 20
_LOG = "topic string, partition int, offset long"


def append(messages: DataFrame, path: str, topic: str, partition: Column, order: Column,
           rows_per_file: int = 1_000_000) -> None:
    """Add messages (column `value`) to a topic. `partition` deals them out, `order` is their order
    in a partition. One writer at a time; a partition is written by one task, as it is a sequence."""
    spark = messages.sparkSession
    rows = messages.select(
        partition.cast("int").alias("partition"), order.alias("_order"),
        F.col("value").cast("string").alias("value"))
    place = F.row_number().over(Window.partitionBy("partition").orderBy("_order", "value")) - 1
    rows = rows.withColumn("offset", place.cast("long"))
    if path_exists(spark, f"{path}/topic={topic}"):
        ends = spark.read.schema(_LOG).parquet(path).filter(F.col("topic") == topic).groupBy(
            "partition").agg((F.max("offset") + 1).alias("_end"))
        rows = rows.join(ends, "partition", "left").withColumn(
            "offset", F.col("offset") + F.coalesce("_end", F.lit(0)))
    rows.select("partition", "offset", "value").sortWithinPartitions("partition", "offset").write.mode(
        "append").option("maxRecordsPerFile", rows_per_file).option(
        # so the stored size of a stretch tells readers how long its messages are
        "parquet.enable.dictionary#value", "false").partitionBy("partition").parquet(
        f"{path}/topic={topic}")


def stream(spark: SparkSession, path: str, checkpoint: str, max_offsets: int = MAX_OFFSETS) -> DataFrame:
    """All topics of a log as a stream, for the query with this checkpoint."""
    spark.dataSource.register(MessageLog)
    return (
        spark.readStream.format("message_log").option("path", path)
        .option("progress", f"{checkpoint}-progress.json").option("max_offsets", max_offsets).load()
    )


@dataclass
class Segment:
    """A file of one partition and the offsets it holds, the end excluded."""

    file: str
    topic: str
    partition: int
    start: int
    end: int


@dataclass
class Stretch(InputPartition):
    """What one task reads: the offsets from start to end, from the files that hold them."""

    files: list
    topic: str
    partition: int
    start: int
    end: int


class MessageLog(DataSource):
    @classmethod
    def name(cls):
        return "message_log"

    def schema(self):
        return SCHEMA

    def streamReader(self, schema):
        return LogReader(self.options)


class LogReader(DataSourceStreamReader):
    def __init__(self, options):
        self.path = options["path"]
        self.progress = options["progress"]
        self.max_offsets = int(options.get("max_offsets", MAX_OFFSETS))
        self.segments: dict[str, Segment] = {}
        self.planned: dict[str, int] | None = None

    def _listed(self) -> dict[str, list[Segment]]:
        """The segments of each `topic/partition` in order. New files' footers are read."""
        system, root = open_path(self.path)
        for found in system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            if found.path.endswith(".parquet") and found.path not in self.segments:
                keys = dict(part.split("=", 1) for part in found.path.split("/") if "=" in part)
                footer = pq.read_metadata(found.path, filesystem=system)
                column = footer.schema.to_arrow_schema().get_field_index("offset")
                stretches = [footer.row_group(n).column(column).statistics
                             for n in range(footer.num_row_groups)]
                if stretches:
                    self.segments[found.path] = Segment(
                        found.path, keys["topic"], int(keys["partition"]),
                        min(s.min for s in stretches), max(s.max for s in stretches) + 1)
        by_key: dict[str, list[Segment]] = {}
        for segment in sorted(self.segments.values(), key=lambda s: (s.topic, s.partition, s.start)):
            by_key.setdefault(f"{segment.topic}/{segment.partition}", []).append(segment)
        return by_key

    def initialOffset(self):
        return {"offsets": {}}

    def latestOffset(self):
        if self.planned is None:
            self.planned = self._noted()
        start = dict(self.planned)
        left = {key: segments[-1].end - start.get(key, 0)
                for key, segments in self._listed().items()
                if segments[-1].end > start.get(key, 0)}
        end, room = dict(start), self.max_offsets
        for n, (key, waiting) in enumerate(sorted(left.items(), key=lambda item: (item[1], item[0]))):
            taken = min(waiting, max(1, room // (len(left) - n)))
            end[key] = start.get(key, 0) + taken
            room -= taken
        return {"offsets": end}

    def partitions(self, start, end):
        first, last = start["offsets"], end["offsets"]
        self.planned = {key: max(last.get(key, 0), first.get(key, 0)) for key in {**first, **last}}
        self._note(self.planned)
        out = []
        for key, segments in self._listed().items():
            at, stop = first.get(key, 0), last.get(key, 0)
            while at < stop:
                step = min(at + _TASK_OFFSETS, stop)
                files = [s.file for s in segments if s.start < step and s.end > at]
                out.append(Stretch(files, segments[0].topic, segments[0].partition, at, step))
                at = step
        return out

    def read(self, partition: Stretch) -> Iterator:
        import pyarrow as pa

        system, _ = open_path(self.path)
        for name in partition.files:
            with system.open_input_file(name) as file:
                # pages come one at a time, and only of the row groups that hold some of the stretch
                stored = pq.ParquetFile(file, buffer_size=_READ_BYTES, pre_buffer=False)
                for batch in self._batches(stored, partition):
                    offsets = batch.column(0)
                    batch = batch.filter(pc.and_(
                        pc.greater_equal(offsets, partition.start),
                        pc.less(offsets, partition.end)))
                    if len(batch):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([partition.topic] * len(batch)),
                             pa.array([partition.partition] * len(batch), pa.int32()),
                             batch.column(0).cast(pa.int64()), batch.column(1)],
                            names=["topic", "partition", "offset", "value"])

    @staticmethod
    def _batches(stored: pq.ParquetFile, wanted: Stretch) -> Iterator:
        """The rows of the row groups that reach into a stretch, about _BATCH_BYTES at a time."""
        columns = ["offset", "value"]
        at = [stored.schema_arrow.get_field_index(name) for name in columns]
        for number in range(stored.num_row_groups):
            group = stored.metadata.row_group(number)
            offsets = group.column(at[0]).statistics
            if offsets.min < wanted.end and offsets.max >= wanted.start:
                row_bytes = group.column(at[1]).total_uncompressed_size / max(1, group.num_rows)
                rows = int(min(_BATCH_ROWS, max(1, _BATCH_BYTES // max(1, row_bytes))))
                yield from stored.iter_batches(
                    batch_size=rows, row_groups=[number], columns=columns, use_threads=False)

    def commit(self, end):
        """Spark's checkpoint holds what is done."""

    def _noted(self) -> dict[str, int]:
        system, name = open_path(self.progress)
        if system.get_file_info(name).type == fs.FileType.NotFound:
            return {}
        with system.open_input_stream(name) as file:
            return json.loads(file.read())

    def _note(self, planned: dict[str, int]) -> None:
        system, name = open_path(self.progress)
        system.create_dir(name.rsplit("/", 1)[0], recursive=True)
        with system.open_output_stream(f"{name}.new") as file:
            file.write(json.dumps(planned).encode())
        system.move(f"{name}.new", name)
