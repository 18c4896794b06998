"""Session helpers: a local session for tests, and the shared working folder."""

import hashlib
import re
import tempfile
import uuid
from datetime import datetime, timezone

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_written = []


def local_session(cores="*", shuffle_partitions=8, **settings) -> SparkSession:
    """A session for tests and benchmarks on one machine. Clusters use spark-submit."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("revlens")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in spark.checkpoint.dir.

    Only a local session may fall back to a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="revlens-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/revlens/{label}-{uuid.uuid4().hex}"


def materialized(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back.

    The result survives lost executors and cuts the lineage for everything that
    passes over it repeatedly. Column metadata is left behind: that of a text vector
    names every term, and Spark would ship it with every job.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    _written.append(path)
    plain = T.StructType([T.StructField(f.name, f.dataType, f.nullable) for f in df.schema])
    df.write.parquet(path)
    return spark.read.schema(plain).parquet(path)


def stored_id(spark: SparkSession, path: str) -> str:
    """An id made on the first call and read from `path` on later ones. It begins with its day."""
    if not path_exists(spark, path):
        made = f"{datetime.now(timezone.utc):%Y%m%d}{uuid.uuid4().hex}"
        spark.range(1).select(F.lit(made)).coalesce(1).write.text(path)
    return spark.read.text(path).first()[0]


def run_day(run_id: str) -> str:
    """The day of a stored id; a fixed early day for ids of any other form."""
    if re.fullmatch(r"\d{8}[0-9a-f]{32}", run_id):
        return f"{run_id[:4]}-{run_id[4:6]}-{run_id[6:8]}"
    return "1970-01-01"


def release_materialized(spark: SparkSession) -> None:
    """Delete what `materialized` has written in this process, once a job is done with it."""
    while _written:
        file_system, path = _file_system(spark, _written.pop())
        file_system.delete(path, True)


def small_table(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A few literal rows. Unlike rows shipped from Python, Spark knows how small they are,
    so it broadcasts them where they are joined."""
    columns = [column.split() for column in schema.split(", ")]
    literals = [
        F.struct(*[F.lit(value).cast(kind).alias(name)
                   for value, (name, kind) in zip(row, columns)])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*literals)))


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def list_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Names and sizes of all files that a path or pattern names or holds, hidden ones left out."""
    file_system, hadoop_path = _file_system(spark, path)
    found = []
    for top in file_system.globStatus(hadoop_path) or []:
        files = file_system.listFiles(top.getPath(), True)
        while files.hasNext():
            status = files.next()
            if not status.getPath().getName().startswith(("_", ".")):
                found.append((status.getPath().toString(), status.getLen()))
    return sorted(found)


def list_folders(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """The names of the folders right below a path that match a pattern."""
    file_system, hadoop_path = _file_system(spark, f"{path}/{pattern}")
    return [status.getPath().getName() for status in file_system.globStatus(hadoop_path) or []
            if status.isDirectory()]


def open_path(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, as tasks open it, and the name there."""
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def files_state(spark: SparkSession, path: str) -> str:
    """A hash of the names, sizes and times of all files below a path."""
    file_system, hadoop_path = _file_system(spark, path)
    found, seen = file_system.listFiles(hadoop_path, True), []
    while found.hasNext():
        status = found.next()
        seen.append(f"{status.getPath()} {status.getLen()} {status.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(seen)).encode()).hexdigest()


def path_exists(spark: SparkSession, path: str) -> bool:
    file_system, hadoop_path = _file_system(spark, path)
    return file_system.exists(hadoop_path)
