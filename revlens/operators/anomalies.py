"""Alerts on an unusual share of negative reviews, per batch or per time window."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.fixed_values import ALERT_MESSAGE, ALERT_SHARE, ALERT_TYPE
from revlens.functions.sentiment import NEGATIVE


def negative_share(scored: DataFrame, *by, also: tuple = ()) -> DataFrame:
    """Reviews, negative reviews and their share in percent of all reviews, per group.

    `also` adds further aggregates.
    """
    negative = F.count_if(F.col("sentiment") == NEGATIVE)
    return (
        scored.groupBy(*by)
        .agg(F.count("*").alias("total_reviews"), negative.alias("negative_reviews"), *also)
        .withColumn("negative_pct", F.col("negative_reviews") / F.col("total_reviews") * 100.0)
    )


def share_of_counts(counts: DataFrame, *by, also: tuple = ()) -> DataFrame:
    """The same from stored counts of reviews and negative reviews."""
    return (
        counts.groupBy(*by)
        .agg(F.sum("total_reviews").alias("total_reviews"),
             F.sum("negative_reviews").alias("negative_reviews"), *also)
        .withColumn("negative_pct", F.col("negative_reviews") / F.col("total_reviews") * 100.0)
    )


def review_counts(scored: DataFrame, *by) -> DataFrame:
    """Reviews and negative reviews per group and minute of the review, and sketches of their
    different topics and segments; a NULL minute counts reviews without a readable time."""
    minute = F.date_trunc("minute", event_time()).alias("minute")
    sketches = tuple(
        F.hll_sketch_agg(F.when(F.col(f"{field}.id") >= 0, F.col(f"{field}.name"))).alias(name)
        for field, name in (("topic", "topics"), ("cluster", "segments")))
    return negative_share(scored, *by, minute, also=sketches).drop("negative_pct")


def different_in(counts: DataFrame, *by) -> DataFrame:
    """About how many different topics and segments known reviews have, per group of counts. The
    sketches are merged; no review is read. Twelve bits: a standard error of 1.6 %."""
    return counts.groupBy(*by).agg(*[
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(name)), F.lit(0)).cast("long").alias(name)
        for name in ("topics", "segments")])


def anomalous(shares: DataFrame, threshold: float = ALERT_SHARE) -> DataFrame:
    return shares.filter(F.col("negative_pct") > threshold)


def alert_message(share: Column) -> Column:
    # Half to even, as the message has always been printed.
    return F.format_string(ALERT_MESSAGE, F.bround(share, 0))


def alert_documents(anomalies: DataFrame, raised_at: Column, keep: tuple = ()) -> DataFrame:
    return anomalies.select(
        F.lit(ALERT_TYPE).alias("type"),
        alert_message(F.col("negative_pct")).alias("message"),
        raised_at.alias("timestamp"),
        *keep,
    )


def event_time() -> Column:
    """The event time of a review; NULL where the text is no timestamp."""
    return F.try_to_timestamp(F.col("timestamp"))


def windowed_negative_share(
    scored: DataFrame, length: str = "1 day", lateness: str = "10 minutes"
) -> DataFrame:
    """Negative share per event-time window, for a stream or a batch alike.

    Unlike a share per micro-batch, it does not depend on when a trigger fires.
    """
    timed = scored.withColumn("event_time", event_time()).withWatermark("event_time", lateness)
    shares = negative_share(timed, F.window("event_time", length).alias("period"))
    return shares.select(
        F.col("period.start").alias("window_start"), F.col("period.end").alias("window_end"),
        "total_reviews", "negative_reviews", "negative_pct",
    )
