"""The training job: one labelled review table in; three models and their records out."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.operators.prepare import RowCounts, prepare_reviews
from revlens.operators.segments import segment_interpretations
from revlens.plans.train_segments import train_segments
from revlens.plans.train_sentiment import train_sentiment
from revlens.plans.train_topics import interpret_topics, train_topics
from revlens.runtime import materialized
from revlens.sources import files, lookups, models


def train_all(reviews: DataFrame, root: str, key: str, grid: list | None = None) -> dict:
    """Train on labelled reviews and save models, interpretations and the evaluation."""
    spark = reviews.sparkSession
    counts = RowCounts()
    prepared = materialized(prepare_reviews(reviews, training=True, counts=counts), "prepared")

    sentiment, metrics = train_sentiment(prepared, key, grid)
    models.save_model(spark, root, "sentiment", sentiment, metrics["accuracy"])

    topics, metrics["log_perplexity"] = train_topics(prepared)
    models.save_model(spark, root, "topic", topics, metrics["log_perplexity"])
    lookups.save_interpretations(
        interpret_topics(topics, spark), f"{root}/topic_interpretations"
    )

    segments, metrics["silhouette"], profiles = train_segments(topics.transform(prepared))
    models.save_model(spark, root, "clustering", segments, metrics["silhouette"])
    lookups.save_interpretations(
        segment_interpretations(profiles), f"{root}/cluster_interpretations"
    )

    metrics.update(counts.get())
    models.append_evaluation(spark, f"{root}/evaluations", metrics)
    return metrics


def train_from_csv(spark: SparkSession, csv: str, root: str, multiline: bool = True) -> dict:
    reviews = files.read_csv(spark, csv, multiline=multiline)
    staged = files.stage(reviews, f"{root}/staged_reviews", source=csv)
    return train_all(staged, root, key="row_key")


def label_counts(prepared: DataFrame) -> DataFrame:
    """Rows and average raw lengths per label."""
    return prepared.groupBy("sentiment_label").agg(
        F.count("*").alias("reviews"),
        F.round(F.avg(F.col("review_length").cast("double")), 4).alias("avg_review_length"),
        F.round(F.avg(F.col("summary_length").cast("double")), 4).alias("avg_summary_length"),
    )
