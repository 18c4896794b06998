"""Exactly-once storing of queue messages, keyed by topic, partition and offsets.

A trigger's rows are written to a staging folder. The commit is one small manifest: its number is the
next one free, and creating it fails if another writer was faster. It names the staged folder and holds
all offsets stored so far, as merged ranges, so the newest manifest is all that anyone needs. Then the staged
files are moved to their place; if the writer dies before, the next one to look finds the manifest and moves
them. Offsets that an earlier commit holds are left out, so the same stretch of a queue is stored once, whatever
checkpoints and however many writers read it.
"""

import json
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.runtime import small_table

QUEUE = ["queue_topic", "queue_partition", "queue_offset"]
KEPT_MANIFESTS = 50


@dataclass
class Manifest:
    """The state after a commit: ranges by topic and partition, both ends included."""

    number: int = 0
    ranges: dict = field(default_factory=dict)
    moves: list = field(default_factory=list)

    def with_ranges(self, stored: list[tuple]) -> dict:
        """The ranges with further (topic, partition, first, last), merged where they touch."""
        ranges = {topic: dict(parts) for topic, parts in self.ranges.items()}
        for topic, partition, first, last in stored:
            parts = ranges.setdefault(topic, {})
            merged = []
            for low, high in sorted(parts.get(str(partition), []) + [[first, last]]):
                if merged and low <= merged[-1][1] + 1:
                    merged[-1][1] = max(merged[-1][1], high)
                else:
                    merged.append([low, high])
            parts[str(partition)] = merged
        return ranges


class CommitLog:
    """Manifests in a folder, numbered from 1."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.hadoop = spark._jvm.org.apache.hadoop.fs

    def _file(self, name: str):
        path = self.hadoop.Path(name)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _numbers(self) -> list[int]:
        system, path = self._file(self.path)
        if not system.exists(path):
            return []
        names = [status.getPath().getName() for status in system.listStatus(path)]
        return sorted(int(name[:-5]) for name in names if name.endswith(".json"))

    def latest(self) -> Manifest:
        """The newest manifest, once what it names is in its place."""
        numbers = self._numbers()
        if not numbers:
            return Manifest()
        text = self.spark.read.text(f"{self.path}/{numbers[-1]:012d}.json", wholetext=True).first()[0]
        manifest = Manifest(**json.loads(text))
        for staged, place in manifest.moves:
            self._move(staged, place)
        return manifest

    def add(self, manifest: Manifest) -> bool:
        """Write the manifest and move what it names; False if its number is taken."""
        system, folder = self._file(self.path)
        system.mkdirs(folder)
        _, new = self._file(f"{self.path}/_{uuid.uuid4().hex}")
        out = system.create(new, False)
        out.writeBytes(json.dumps(vars(manifest)))
        out.close()
        _, place = self._file(f"{self.path}/{manifest.number:012d}.json")
        if not self._renamed(new, place):
            system.delete(new, False)
            return False
        for staged, target in manifest.moves:
            self._move(staged, target)
        for number in self._numbers()[:-KEPT_MANIFESTS]:
            system.delete(self._file(f"{self.path}/{number:012d}.json")[1], False)
        return True

    def _renamed(self, source, target) -> bool:
        rename = getattr(self.hadoop, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE  # do not replace
        context = self.hadoop.FileContext.getFileContext(
            target.toUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(context.makeQualified(source), context.makeQualified(target), options)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    def _move(self, staged: str, target: str) -> None:
        system, source = self._file(staged)
        if system.exists(source):
            _, place = self._file(target)
            system.mkdirs(place.getParent())
            if not system.rename(source, place):
                raise OSError(f"could not move {staged} to {target}")

    def discard(self, staged: str) -> None:
        system, path = self._file(staged)
        system.delete(path, True)


def queue_rows(messages: DataFrame) -> DataFrame:
    """Messages with a queue's topic, partition and offset, under names that no review has."""
    return messages.select(
        F.col("value").cast("string").alias("value"), F.col("topic").alias("queue_topic"),
        F.col("partition").cast("int").alias("queue_partition"),
        F.col("offset").cast("long").alias("queue_offset"))


def not_stored(rows: DataFrame, ranges: dict) -> DataFrame:
    """The rows whose offsets no commit holds. Ranges merge, so there is about one for each
    partition of a queue; they are literal rows, which Spark broadcasts."""
    stored = [(topic, int(partition), low, high) for topic, parts in ranges.items()
              for partition, merged in parts.items() for low, high in merged]
    if not stored:
        return rows
    held = small_table(rows.sparkSession, stored, "_topic string, _part int, _low bigint, _high bigint")
    return rows.join(
        held, (F.col("queue_topic") == F.col("_topic")) & (F.col("queue_partition") == F.col("_part"))
        & F.col("queue_offset").between(F.col("_low"), F.col("_high")), "left_anti")


def stored_ranges(rows: DataFrame) -> list[tuple]:
    """(topic, partition, first, last) of rows; a trigger reads a stretch of each partition, so
    offsets in between that are not there hold nothing to store."""
    return [tuple(r) for r in rows.groupBy("queue_topic", "queue_partition").agg(
        F.min("queue_offset"), F.max("queue_offset")).collect()]


def has_queue(rows: DataFrame) -> bool:
    return all(name in rows.columns for name in QUEUE)


