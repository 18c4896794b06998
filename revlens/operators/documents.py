"""The scored review document: building it, flattening it, choosing what to report."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.functions import report_rating, sink_rating
from revlens.functions.sentiment import UNKNOWN, name_of


def with_name(rows: DataFrame, id_column: str, names: DataFrame, kind: str) -> DataFrame:
    """`<id_column>_name` from the lookup (id, name), else "<kind> <id>".

    A model has a handful of topics or segments, so its names reach the rows as one map
    value. A join on them would shuffle all texts onto a handful of keys as soon as
    Spark could not tell how small a computed lookup is.
    """
    named = names.filter("id is not null").groupBy(F.col("id").cast("int").alias("id")).agg(
        F.min("name").alias("name"))
    by_id = named.agg(F.map_from_entries(F.collect_list(F.struct("id", "name")))).scalar()
    fallback = F.concat_ws(" ", F.lit(kind), F.col(id_column).cast("string"))
    return (
        rows.withColumn("_names", by_id)
        .withColumn(
            f"{id_column}_name",
            F.coalesce(F.try_element_at("_names", F.col(id_column).cast("int")), fallback))
        .drop("_names")
    )


def scored_documents(
    annotated: DataFrame,
    topic_names: DataFrame,
    segment_names: DataFrame,
    processed_at: Column | None = None,
    keep: tuple = (),
) -> DataFrame:
    """Reviews with sentiment_pred, topic_pred and cluster_pred as documents."""
    named = with_name(annotated, "topic_pred", topic_names, "Topic")
    named = with_name(named, "cluster_pred", segment_names, "Cluster")
    return named.select(
        "review_id",
        F.col("Product").alias("product"),
        F.col("Category").alias("category"),
        F.col("Review").alias("review_text"),
        F.col("Summary").alias("summary"),
        sink_rating(F.col("Rate")).alias("rating"),
        F.col("sentiment_pred").cast("double").alias("sentiment"),
        name_of(F.col("sentiment_pred")).alias("sentiment_label"),
        F.struct(F.col("topic_pred").alias("id"), F.col("topic_pred_name").alias("name"))
        .alias("topic"),
        F.struct(F.col("cluster_pred").alias("id"), F.col("cluster_pred_name").alias("name"))
        .alias("cluster"),
        (F.current_timestamp() if processed_at is None else processed_at).alias("processed_at"),
        "timestamp",
        *keep,
    )


def _flat(documents: DataFrame, field: str, kind: str) -> dict:
    """Id and name from a nested {id, name}, from an older plain id, or from nothing."""
    id_column, name_column = f"{field}_id", f"{field}_name"
    if field not in documents.columns:
        number, name = F.lit(None).cast("int"), F.lit(None).cast("string")
    elif isinstance(documents.schema[field].dataType, T.StructType):
        number, name = F.col(f"{field}.id"), F.col(f"{field}.name")
    else:
        number = F.col(field).cast("int")
        name = F.when(number >= 0, F.concat_ws(" ", F.lit(kind), number.cast("string")))
    return {
        id_column: F.coalesce(number, F.lit(UNKNOWN)),
        name_column: F.coalesce(name, F.lit("Unknown")),
    }


def flattened(documents: DataFrame) -> DataFrame:
    """Adds topic_id, topic_name, cluster_id and cluster_name."""
    return documents.withColumns({
        **_flat(documents, "topic", "Topic"), **_flat(documents, "cluster", "Cluster"),
    })


def with_defaults(documents: DataFrame) -> DataFrame:
    """Columns an older document may lack, filled with their unknown value."""
    defaults = {
        "sentiment": F.lit(float(UNKNOWN)), "cluster": F.lit(UNKNOWN),
        "review_text": F.lit("Unknown"), "product": F.lit("Unknown"),
        "category": F.lit("Unknown"), "rating": F.lit("Unknown"),
    }
    return documents.withColumns({
        name: value for name, value in defaults.items() if name not in documents.columns
    })


def reportable(documents: DataFrame) -> DataFrame:
    """Flat documents with a text, and a rating every report can average."""
    text = F.col("review_text")
    complete = with_defaults(flattened(documents))
    return complete.filter(text.isNotNull() & (text != "") & (text != "Unknown")).withColumn(
        "rating", report_rating(F.col("rating"))
    )


