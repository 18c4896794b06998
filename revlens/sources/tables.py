"""Result tables: scored reviews and their counts, replaced file by file; alerts from counts.

Both are laid out by the day their source arrived, then by batch and file.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.fixed_values import RECENT_REVIEWS
from revlens.operators.anomalies import alert_documents, anomalous, share_of_counts
from revlens.operators.reports import recent_reviews
from revlens.runtime import list_folders, path_exists
from revlens.schemas import QUEUE_PLACE, REVIEW_COUNT, SCORED_DOCUMENT

SCORED_KEYS = ["ingest_day", "batch_key", "source_file"]


def _keyed(schema: T.StructType, keys: list) -> T.StructType:
    return T.StructType([*schema.fields, *[T.StructField(key, T.StringType()) for key in keys]])


STAGED = T.StructType([*SCORED_DOCUMENT.fields, *QUEUE_PLACE.fields])
SCORED_TABLE = _keyed(STAGED, SCORED_KEYS)
COUNT_TABLE = _keyed(REVIEW_COUNT, SCORED_KEYS)


def replace_partitions(rows: DataFrame, path: str, keys: list, rebalance: bool = False) -> None:
    """Overwrite only the partitions that `rows` has, so writing a batch again changes nothing.

    Rows that come from files lie together by file already and are written as they lie.
    Rows that were shuffled by something else need `rebalance`, or every task would
    write a small file into every partition.
    """
    if rebalance:
        rows = rows.hint("rebalance", *keys)
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def read_scored(spark: SparkSession, path: str, keys: list | None = None) -> DataFrame:
    """The whole table, or only the folders of the given keys."""
    rows = spark.read.schema(SCORED_TABLE)
    if keys is None:
        return rows.parquet(path)
    folders = [folder_of(path, key) for key in keys]
    stored = [folder for folder in folders if path_exists(spark, folder)]
    if not stored:
        return spark.createDataFrame([], SCORED_TABLE)
    return rows.option("basePath", path).parquet(*stored)


def folder_of(path: str, key: tuple, names: list = SCORED_KEYS) -> str:
    """The folder of a key, with values as Spark writes them into the folders' names."""
    spark = SparkSession.active()
    catalog = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    parts = [f"{name}={catalog.escapePathName(value)}" for name, value in zip(names, key)]
    return "/".join([path, *parts])


def newest_days(spark: SparkSession, counts_path: str, count: int) -> list[str]:
    """The newest days that together hold so many reviews, by the counts of one day at a time."""
    prefix, days, found = "ingest_day=", [], 0
    for folder in sorted(list_folders(spark, counts_path, f"{prefix}*"), reverse=True):
        days.append(folder[len(prefix):])
        counts = spark.read.schema(REVIEW_COUNT).parquet(f"{counts_path}/{folder}")
        found += counts.agg(F.sum("total_reviews")).first()[0] or 0
        if found >= count:
            break
    return days


def recent_scored(
    spark: SparkSession, scored_path: str, counts_path: str, count: int = RECENT_REVIEWS,
) -> DataFrame:
    """The newest reviews of the table. Only the newest days that hold so many are read; days
    come first in the order, so a file that is scored again keeps its place."""
    days = newest_days(spark, counts_path, count)
    if not days:
        return spark.createDataFrame([], SCORED_TABLE)
    folders = [f"{scored_path}/ingest_day={day}" for day in days]
    # these folders alone are listed, not the whole table
    rows = spark.read.schema(SCORED_TABLE).option("basePath", scored_path).parquet(*folders)
    return recent_reviews(rows, count, first=("ingest_day",))


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """Reviews and negative reviews by batch, file and minute of the review."""
    return spark.read.schema(COUNT_TABLE).parquet(path)


def batch_shares(counts: DataFrame) -> DataFrame:
    """Negative share of every batch, summed over the files that have arrived."""
    return share_of_counts(counts, "batch_key", also=(F.max("computed_at").alias("computed_at"),))


def keep_shares(spark: SparkSession, counts_path: str, shares_path: str, keys: list) -> None:
    """Bring the shares of the batches that these keys touch up to date.

    Totals lie by batch and file, so a batch is summed over its own files, and only touched batches
    are: the work follows the trigger, not the age of the tables. All is replaced by key, so a
    trigger that runs again changes nothing.
    """
    if not keys:
        return
    folders = [folder_of(counts_path, key) for key in keys]
    counts = spark.read.schema(COUNT_TABLE).option("basePath", counts_path).parquet(*folders)
    totals = counts.groupBy("batch_key", "source_file").agg(
        F.sum("total_reviews").alias("total_reviews"),
        F.sum("negative_reviews").alias("negative_reviews"),
        F.max("computed_at").alias("computed_at"))
    by_file = f"{shares_path}/files"
    replace_partitions(totals, by_file, ["batch_key", "source_file"], rebalance=True)
    batches = sorted({key[1] for key in keys})
    own = spark.read.schema(totals.schema).option("basePath", by_file).parquet(
        *[folder_of(by_file, (batch,), ["batch_key"]) for batch in batches])
    replace_partitions(batch_shares(own), f"{shares_path}/batches", ["batch_key"], rebalance=True)


def read_kept_alerts(spark: SparkSession, shares_path: str, keep: tuple = ()) -> DataFrame:
    """The alerts of `read_alerts`, from the shares that `keep_shares` keeps: a row per batch."""
    shares = spark.read.schema(
        "total_reviews long, negative_reviews long, computed_at string, negative_pct double, "
        "batch_key string").parquet(f"{shares_path}/batches")
    return _alerts(shares, keep)


def read_alerts(spark: SparkSession, path: str, keep: tuple = ()) -> DataFrame:
    """Alerts on the batches whose share of negative reviews is too high.

    Counts of every file are stored, not alerts: a batch that a later file brings back
    under the threshold takes its alert back.
    """
    return _alerts(batch_shares(read_counts(spark, path)), keep)


def _alerts(shares: DataFrame, keep: tuple) -> DataFrame:
    raised = anomalous(shares)
    named = raised.withColumn("alert_id", F.col("batch_key"))
    return alert_documents(named, F.col("computed_at"), keep=("alert_id", *keep))


def write_drilldown(reviews: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Flat reviews for drilling down: sorted by topic and segment, with bloom filters on both names,
    so that a drill-down reads the row groups that hold it and passes over the others."""
    writer = (
        reviews.hint("rebalance", "topic_name", "cluster_name")
        .sortWithinPartitions("topic_name", "cluster_name")
        .write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    )
    for name in ("topic_name", "cluster_name"):
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true").option(
            f"parquet.bloom.filter.expected.ndv#{name}", "1000")
    writer.parquet(path)
