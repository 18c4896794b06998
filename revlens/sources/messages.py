"""Review messages: a stream or batch of JSON texts in a `value` column."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.schemas import MESSAGE
from revlens.sources.files import numbered

CORRUPT = "_corrupt_message"
WITH_CORRUPT = T.StructType([*MESSAGE.fields, T.StructField(CORRUPT, T.StringType())])


def kafka_stream(
    spark: SparkSession, servers: str, topic: str, starting="latest",
    most_per_trigger: int = 1_000_000,
) -> DataFrame:
    """One topic as a stream. Needs the Kafka connector on the class path. A backlog is taken
    in triggers of at most so many messages."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("failOnDataLoss", "false")
        .option("maxOffsetsPerTrigger", most_per_trigger)
        .load()
    )


def file_stream(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """Replayed message files as a stream, with the batch and the file each came from."""
    return _with_origin(
        spark.readStream.schema("value string, batch_key string")
        .option("maxFilesPerTrigger", files_per_trigger)
        .text(path)
    )


def message_files(spark: SparkSession, path: str) -> DataFrame:
    """The same files as one batch."""
    return _with_origin(spark.read.schema("value string, batch_key string").text(path))


def _with_origin(lines: DataFrame) -> DataFrame:
    """The day is the one on which the file came; it stays when the file is read again."""
    day = F.date_format(F.col("_metadata.file_modification_time"), "yyyy-MM-dd")
    return lines.select("value", "batch_key", F.col("_metadata.file_name").alias("source_file"),
                        day.alias("ingest_day"))


def decode(messages: DataFrame, keep_corrupt: bool = False) -> DataFrame:
    """The fields of each message; other columns stay. A malformed message has NULL fields.

    With `keep_corrupt` its text is kept too, so it can be put aside and counted.
    """
    text = F.col("value").cast("string")
    if keep_corrupt:
        parsed = F.from_json(text, WITH_CORRUPT, {"columnNameOfCorruptRecord": CORRUPT})
    else:
        parsed = F.from_json(text, MESSAGE)
    others = [c for c in messages.columns if c != "value"]
    return messages.select(*others, parsed.alias("message")).select(*others, "message.*")


def encode(reviews: DataFrame, sent_at: Column | None = None, keep: tuple = ()) -> DataFrame:
    """Review rows as JSON messages; a field that a row lacks is sent empty.

    Rows without a `review_id` must come from `files.stage`: they are numbered in
    the order they were staged.
    """
    if "review_id" not in reviews.columns:
        rows = numbered(reviews, "_n")
        rows = rows.withColumn("review_id", F.concat(F.lit("review_"), F.col("_n").cast("string")))
    else:
        rows = reviews
    values = {name: F.col(name) if name in rows.columns else F.lit(None) for name in MESSAGE.names}
    if sent_at is not None:
        values["timestamp"] = sent_at
    elif "timestamp" not in rows.columns:
        values["timestamp"] = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    fields = [F.coalesce(v.cast("string"), F.lit("")).alias(name) for name, v in values.items()]
    return rows.select(*keep, F.to_json(F.struct(*fields)).alias("value"))


def write_replay(messages: DataFrame, path: str) -> None:
    """Messages as text files, one folder per `batch_key`.

    The rebalance hint lets Spark split a batch that holds most messages over
    several tasks and files, and join small ones.
    """
    (
        messages.select("batch_key", "value")
        .hint("rebalance", "batch_key")
        .write.partitionBy("batch_key")
        .text(path)
    )


def publish(messages: DataFrame, servers: str, topic: str) -> None:
    """Messages to a Kafka topic."""
    (
        messages.select("value").write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
