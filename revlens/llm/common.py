"""Small helpers of the operators in this folder."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.runtime import materialized

__all__ = ["bounded_batches", "materialized", "read", "texts", "hex64"]


BATCH_TEXTS = 2000
BATCH_BYTES = 16 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def bounded_batches(spark: SparkSession, most_bytes: int = BATCH_BYTES) -> None:
    """Python workers get at most so many rows or bytes at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_TEXTS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", most_bytes)


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text (null as empty) and the named columns; any others are left behind,
    so that their names cannot clash with what an operator adds.

    Texts may be long, so Python workers get a batch of bounded size at a time."""
    bounded_batches(docs.sparkSession)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        *more,
    )


def hex64(column):
    """16 lower-case hex digits of a long."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))
