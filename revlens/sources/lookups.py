"""Names of topics and segments: saved interpretations, or defaults."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.fixed_values import DEFAULT_SEGMENT_NAMES, DEFAULT_TOPIC_NAMES
from revlens.runtime import path_exists, small_table
from revlens.schemas import SEGMENT_INTERPRETATION, TOPIC_INTERPRETATION


def save_interpretations(interpretations: DataFrame, path: str) -> None:
    interpretations.coalesce(1).write.mode("overwrite").json(path)


def default_topic_names(spark: SparkSession) -> DataFrame:
    return small_table(spark, DEFAULT_TOPIC_NAMES, "id int, name string")


def default_segment_names(spark: SparkSession) -> DataFrame:
    return small_table(spark, DEFAULT_SEGMENT_NAMES, "id int, name string")


def read_topic_interpretations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TOPIC_INTERPRETATION).json(path)


def read_segment_interpretations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SEGMENT_INTERPRETATION).json(path)


def topic_names(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return default_topic_names(spark)
    saved = read_topic_interpretations(spark, path)
    return saved.select(F.col("topic_id").alias("id"), "name")


def segment_names(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return default_segment_names(spark)
    saved = read_segment_interpretations(spark, path)
    return saved.select(F.col("cluster_id").alias("id"), "name")
