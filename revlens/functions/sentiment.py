"""Sentiment labels: text to number, number to name."""

from pyspark.sql import Column
from pyspark.sql import functions as F

NEGATIVE, POSITIVE, UNKNOWN = 0, 1, -1


def label_of(sentiment: Column) -> Column:
    """0 if the text mentions "negative", else 1 if it mentions "positive", else -1."""
    text = F.lower(sentiment)
    return (
        F.when(text.contains("negative"), F.lit(NEGATIVE))
        .when(text.contains("positive"), F.lit(POSITIVE))
        .otherwise(F.lit(UNKNOWN))
    )


def known_prediction(prediction: Column) -> Column:
    """The prediction if it is a class we know, else -1."""
    return F.when(prediction.isin(0.0, 1.0), prediction).otherwise(F.lit(-1.0))


def name_of(sentiment: Column) -> Column:
    return (
        F.when(sentiment == POSITIVE, F.lit("Positive"))
        .when(sentiment == NEGATIVE, F.lit("Negative"))
        .otherwise(F.lit("Unknown"))
    )
