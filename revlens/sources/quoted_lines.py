"""CSV records whose texts hold line breaks, read in byte ranges by many tasks.

A line break ends a record only outside quotes, so a task that starts in the middle of a file must know
whether its first line begins inside a quoted text. Files are cut into ranges at line starts. A first pass
finds for every range how it ends if it begins outside, and if it begins inside quotes; composing
these two-valued steps along a file gives the true state at the start of each range. A second pass then
cuts each range into records; a record belongs to the range it begins in, however far it reaches.

Quotes open a text only at the start of a field and are doubled inside, as the CSV reader takes them, so a
stray quote inside a plain field changes nothing. Line ends are `\\n`, with or without `\\r` before.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revlens.runtime import list_files, materialized, open_path

RANGE_BYTES = 32 << 20
_CHUNK = 1 << 20
_BATCH_BYTES = 4 << 20
# A quoted text from the start of a field, and the rest of one that began earlier.
_QUOTED = re.compile(rb'(?:^|(?<=[,\r\n]))"[^"]*+(?:""[^"]*+)*+("?)')
_REST = re.compile(rb'[^"]*+(?:""[^"]*+)*+("?)')
_COMPRESSED = (".gz", ".bz2", ".zst", ".snappy", ".lz4", ".xz")


def splittable(paths: list[str]) -> bool:
    """Can byte ranges of these files be read on their own?"""
    try:
        for path in paths[:1]:
            open_path(path)
    except Exception:  # a file system that only Spark reaches
        return False
    return not any(path.endswith(_COMPRESSED) for path in paths)


def _region(file, start: int, end: int, size: int) -> tuple[bytes, int]:
    """The bytes from the first line start at or after `start` up to the one at or after `end`,
    and where they begin."""
    def line_start(at: int) -> int:
        if at <= 0:
            return 0
        file.seek(at - 1)
        while at - 1 < size:
            piece = file.read(_CHUNK)
            found = piece.find(b"\n")
            if found >= 0:
                return at + found
            at += len(piece)
        return size

    first = line_start(start)
    last = size if end >= size else line_start(end)
    if last <= first:
        return b"", first
    file.seek(first)
    return file.read(last - first), first


def quoted_spans(data: bytes, inside: bool) -> tuple[list[tuple[int, int]], bool]:
    """Where texts in quotes lie, and whether the data ends inside one."""
    spans, at = [], 0
    if inside:
        rest = _REST.match(data)
        spans.append((0, rest.end()))
        if not rest.group(1):
            return spans, True
        at = rest.end()
    for quoted in _QUOTED.finditer(data, at):
        spans.append(quoted.span())
        if not quoted.group(1):
            return spans, True
    return spans, False


def _record_ends(data: bytes, inside: bool) -> np.ndarray:
    """The places after line breaks that end records."""
    breaks = np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == 0x0A)
    spans, _ = quoted_spans(data, inside)
    if spans:
        bounds = np.array(spans)
        before = np.searchsorted(bounds[:, 0], breaks, side="right") - 1
        breaks = breaks[(before < 0) | (breaks >= bounds[before, 1])]
    return breaks + 1


def records_of(file, start: int, end: int, size: int, inside: bool) -> Iterator[bytes]:
    """The records that begin in a range of a file whose first line begins inside quotes or not."""
    data, first = _region(file, start, end, size)
    if not data:
        return
    ends = _record_ends(data, inside)
    at = 0
    if inside:  # the first record began in an earlier range
        if not len(ends):
            return
        at, ends = int(ends[0]), ends[1:]
    for place in ends.tolist():
        yield data[at:place]
        at = place
    rest = data[at:]
    if not rest:
        return
    file.seek(first + len(data))
    while True:  # the last record goes on beyond the range
        found = _record_ends(rest, False)
        if len(found):
            yield rest[:int(found[0])]
            return
        more = file.read(max(_CHUNK, len(rest)))
        if not more:
            yield rest
            return
        rest += more


def _ranges(spark: SparkSession, files: list[tuple[str, int]], range_bytes: int) -> tuple:
    """file, size, start, end and task of each range, and the number of tasks: one for each full
    range, small files together."""
    rows, before = [], 0
    for path, size in files:
        for at in range(0, size, range_bytes):
            end = min(at + range_bytes, size)
            rows.append((path, size, at, end, before // range_bytes))
            before += end - at
    schema = "file string, size long, start long, end long, task long"
    return spark.createDataFrame(rows, schema), max(1, -(-before // range_bytes))


def _with_states(ranges: DataFrame, tasks: int) -> DataFrame:
    """The ranges with `inside`, the state at their first line, stored."""

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = []
            for row in batch.to_pylist():
                system, name = open_path(row["file"])
                with system.open_input_file(name) as file:
                    data, _ = _region(file, row["start"], row["end"], row["size"])
                ends.append([quoted_spans(data, inside)[1] if data else inside
                             for inside in (False, True)])
            outside, inside = zip(*ends) if ends else ((), ())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(outside, pa.bool_()), pa.array(inside, pa.bool_())],
                [*batch.schema.names, "from_outside", "from_inside"])

    found = ranges.repartitionByRange(tasks, "task").mapInArrow(
        steps, "file string, size long, start long, end long, task long, from_outside boolean, "
               "from_inside boolean")
    # A step is constant, or keeps or turns the state; only steps after the last constant matter.
    step = F.when(F.col("from_outside") == F.col("from_inside"), F.col("from_outside").cast("int"))
    turns = (F.col("from_outside") & ~F.col("from_inside")).cast("int")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    rows = found.withColumns({"step": step, "turned": F.coalesce(F.sum(turns).over(before), F.lit(0))})
    own = F.col("turned") + turns  # turns up to and with a constant step
    last = F.last(F.when(F.col("step").isNotNull(), F.struct("step", own.alias("turned"))), True)
    known = F.coalesce(last.over(before), F.struct(F.lit(0).alias("step"), F.lit(0).cast("long").alias("turned")))
    state = (known["step"] + F.col("turned") - known["turned"]) % 2
    return materialized(
        rows.select("file", "size", "start", "end", "task", (state == 1).alias("inside")),
        "csv-ranges")


def records(spark: SparkSession, path: str, header: bool = True,
            range_bytes: int = RANGE_BYTES) -> DataFrame:
    """`value`: the records of all files below a path, each with its line breaks, without the
    files' first records if these are headers. Empty lines are left out."""
    files = list_files(spark, path)
    ranges, tasks = _ranges(spark, files, range_bytes)
    if all(size <= range_bytes for _, size in files):  # every range begins a file
        ranges = ranges.withColumn("inside", F.lit(False))
    else:
        ranges = _with_states(ranges, tasks)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, name = open_path(row["file"])
                held, size = [], 0
                with system.open_input_file(name) as file:
                    found = records_of(file, row["start"], row["end"], row["size"], row["inside"])
                    if header and row["start"] == 0:
                        next(found, None)
                    for record in found:
                        record = record.rstrip(b"\r\n") if record[-1:] == b"\n" else record
                        if not record:
                            continue
                        held.append(record)
                        size += len(record)
                        if size > _BATCH_BYTES:
                            yield _texts(held)
                            held, size = [], 0
                if held:
                    yield _texts(held)

    return ranges.repartitionByRange(tasks, "task").mapInArrow(cut, "value string")


def _texts(records: list[bytes]) -> pa.RecordBatch:
    try:
        values = pa.array(records, pa.binary()).cast(pa.string())
    except pa.ArrowInvalid:  # not UTF-8: replaced, as the CSV reader does
        values = pa.array([record.decode("utf-8", "replace") for record in records])
    return pa.RecordBatch.from_arrays([values], ["value"])
