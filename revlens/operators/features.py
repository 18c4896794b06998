"""Numeric features: standardized inputs and the eleven inputs of the segments."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.fixed_values import SEGMENT_INPUTS, TOPIC_COUNT
from revlens.functions.arrays import even_probabilities, topic_probabilities
from revlens.functions.text import length_or_zero

TOPIC_INPUTS = [f"topic_{i}" for i in range(TOPIC_COUNT)]


def standardized(rows: DataFrame, columns: list) -> DataFrame:
    """`scaled_<column>`: distance from the mean in sample standard deviations."""
    moments = rows.agg(F.struct(*[
        F.struct(F.avg(c).alias("mean"), F.stddev_samp(c).alias("deviation")).alias(c)
        for c in columns
    ]))
    placed = rows.withColumn("_moments", moments.scalar())
    scaled = {
        f"scaled_{c}": F.when(
            F.col(f"_moments.{c}.deviation") > 0,
            (F.col(c) - F.col(f"_moments.{c}.mean")) / F.col(f"_moments.{c}.deviation"),
        ).otherwise(F.lit(0.0))
        for c in columns
    }
    return placed.withColumns(scaled).drop("_moments")


def segment_features(prepared: DataFrame, sentiment: str) -> DataFrame:
    """The eleven inputs, all double and never NULL, for rows that have text.

    `sentiment` names the column to read: the true label when training, the
    predicted one when scoring.
    """
    if "topicDistribution" in prepared.columns:
        shares = topic_probabilities(F.col("topicDistribution"))
    else:
        shares = even_probabilities()

    def number(value):
        return F.coalesce(F.nanvl(value.cast("double"), F.lit(0.0)), F.lit(0.0))

    text = F.coalesce(F.col("text_combined"), F.lit(""))
    inputs = {
        "text_len": number(F.length(text)),
        "sentiment_score": number(F.col(sentiment)),
        "review_len": number(length_or_zero(F.col("Review"))),
        "summary_len": number(length_or_zero(F.col("Summary"))),
        "rate_score": number(F.col("Rate_num")),
        "word_count": number(F.size(F.split(text, " "))),
    }
    for i, name in enumerate(TOPIC_INPUTS):
        inputs[name] = F.coalesce(F.get("_shares", F.lit(i)), F.lit(1.0 / TOPIC_COUNT))
    return (
        prepared.withColumn("_shares", shares)
        .withColumns(inputs)
        .drop("_shares")
        .filter(F.col("text_len") > 0)
    )
