"""Report queries over the whole scored table, flattened by `documents.reportable`."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.fixed_values import (
    RECENT_ALERTS,
    RECENT_EVALUATIONS,
    RECENT_REVIEWS,
    SHOWN_ALERTS,
    TOP_TOPICS,
)
from revlens.functions import alert_level, name_of, percent_text, training_day
from revlens.functions.formats import decimal_text
from revlens.functions.sentiment import NEGATIVE, POSITIVE, UNKNOWN


def _share(part: Column, whole: Column) -> Column:
    """Percentage, 0 for nothing out of nothing."""
    return F.coalesce(F.try_divide(part * F.lit(100.0), whole), F.lit(0.0))


def known_topics(reviews: DataFrame) -> DataFrame:
    return reviews.filter("topic_id >= 0")


def known_segments(reviews: DataFrame) -> DataFrame:
    return reviews.filter("cluster_id >= 0")


def kpi_summary(reviews: DataFrame) -> DataFrame:
    counts = reviews.agg(
        F.count("*").alias("total_reviews"),
        F.count_if(F.col("sentiment") == POSITIVE).alias("positive_reviews"),
        F.count_if(F.col("sentiment") == NEGATIVE).alias("negative_reviews"),
    )
    known = F.col("positive_reviews") + F.col("negative_reviews")
    return counts.withColumns({
        "positive_pct": F.round(_share(F.col("positive_reviews"), known), 4),
        "negative_pct": F.round(_share(F.col("negative_reviews"), known), 4),
    })


def segment_count(reviews: DataFrame) -> DataFrame:
    return known_segments(reviews).agg(F.countDistinct("cluster_id").alias("segments"))


def sentiment_distribution(reviews: DataFrame) -> DataFrame:
    known = reviews.filter(F.col("sentiment").isin(POSITIVE, NEGATIVE, UNKNOWN))
    return known.groupBy(name_of(F.col("sentiment")).alias("sentiment_label")).agg(
        F.count("*").alias("review_count")
    )


def topic_counts(reviews: DataFrame) -> DataFrame:
    counts = known_topics(reviews).groupBy("topic_name").agg(F.count("*").alias("review_count"))
    return counts.orderBy(F.desc("review_count"), "topic_name")


def top_topics(reviews: DataFrame, count: int = TOP_TOPICS) -> DataFrame:
    """The most frequent topics; reviews without a topic count as one."""
    counts = reviews.groupBy("topic_name").agg(F.count("*").alias("review_count"))
    return counts.orderBy(F.desc("review_count"), "topic_name").limit(count)


def topic_sentiment_crosstab(reviews: DataFrame) -> DataFrame:
    """Reviews per topic and sentiment; the fixed columns save a scan for their values."""
    labels = ["Negative", "Positive", "Unknown"]
    labelled = known_topics(reviews).withColumn("label", name_of(F.col("sentiment")))
    return labelled.groupBy("topic_name").pivot("label", labels).count().fillna(0, labels)


def topic_summary(reviews: DataFrame) -> DataFrame:
    grouped = known_topics(reviews).groupBy("topic_name").agg(
        F.count("sentiment").alias("review_count"),
        F.round(F.avg("sentiment"), 2).alias("avg_sentiment"),
        F.round(F.avg("rating"), 2).alias("avg_rating"),
    )
    return grouped.orderBy(F.desc("review_count"), "topic_name")


PAGE_KEYS = ["topic_known", "topic_name", "segment_known", "cluster_name", "sentiment"]
PAGE_SETS = {
    "all": [], "sentiment": ["sentiment"], "topic": PAGE_KEYS[:2],
    "topic_sentiment": [*PAGE_KEYS[:2], "sentiment"], "segment": PAGE_KEYS[2:4],
}


def page_groups(reviews: DataFrame) -> DataFrame:
    """All groups that the report page needs, from one scan: `set` names the grouping."""
    rows = reviews.select(
        (F.col("topic_id") >= 0).alias("topic_known"), "topic_name",
        (F.col("cluster_id") >= 0).alias("segment_known"), "cluster_name", "sentiment", "rating")
    groups = rows.groupingSets(
        [[F.col(key) for key in keys] for keys in PAGE_SETS.values()], *map(F.col, PAGE_KEYS),
    ).agg(
        F.grouping_id().alias("_id"), F.count("*").alias("review_count"),
        F.count("sentiment").alias("scored"),
        F.count_if(F.col("sentiment") == POSITIVE).alias("positive_reviews"),
        F.count_if(F.col("sentiment") == NEGATIVE).alias("negative_reviews"),
        F.avg("sentiment").alias("avg_sentiment"), F.avg("rating").alias("avg_rating"),
    )
    name = F.lit(None).cast("string")
    for label, keys in PAGE_SETS.items():  # a bit is set for each key left out
        number = int("".join("0" if key in keys else "1" for key in PAGE_KEYS), 2)
        name = F.when(F.col("_id") == number, F.lit(label)).otherwise(name)
    return groups.withColumn("set", name).drop("_id")


def report_page(groups: DataFrame) -> dict:
    """The tables of the page from stored `page_groups`, each equal to its own query."""
    def of(label):
        return groups.filter(F.col("set") == label)

    topics = of("topic").filter("topic_known")
    cells = of("topic_sentiment").filter("topic_known")
    labels = ["Negative", "Positive", "Unknown"]
    named = of("sentiment").filter(F.col("sentiment").isin(POSITIVE, NEGATIVE, UNKNOWN))
    known = F.col("positive_reviews") + F.col("negative_reviews")
    return {
        "kpi_summary": of("all").select(
            F.col("review_count").alias("total_reviews"), "positive_reviews", "negative_reviews",
            F.round(_share(F.col("positive_reviews"), known), 4).alias("positive_pct"),
            F.round(_share(F.col("negative_reviews"), known), 4).alias("negative_pct")),
        "sentiment_distribution": named.groupBy(
            name_of(F.col("sentiment")).alias("sentiment_label")).agg(
            F.sum("review_count").alias("review_count")),
        "topic_counts": topics.select("topic_name", "review_count").orderBy(
            F.desc("review_count"), "topic_name"),
        "topic_sentiment_crosstab": cells.withColumn("label", name_of(F.col("sentiment"))).groupBy(
            "topic_name").pivot("label", labels).agg(F.sum("review_count")).fillna(0, labels),
        "topic_summary": topics.select(
            "topic_name", F.col("scored").alias("review_count"),
            F.round("avg_sentiment", 2).alias("avg_sentiment"),
            F.round("avg_rating", 2).alias("avg_rating"),
        ).orderBy(F.desc("review_count"), "topic_name"),
        "segment_counts": of("segment").filter("segment_known").select(
            "cluster_name", "review_count").orderBy(F.desc("review_count"), "cluster_name"),
    }


def distinct_topics(reviews: DataFrame) -> DataFrame:
    return known_topics(reviews).select("topic_name").distinct().orderBy("topic_name")


def distinct_segments(reviews: DataFrame) -> DataFrame:
    return known_segments(reviews).select("cluster_name").distinct().orderBy("cluster_name")


def topic_drilldown(reviews: DataFrame, topic: str) -> DataFrame:
    return known_topics(reviews).filter(F.col("topic_name") == topic)


def segment_drilldown(reviews: DataFrame, segment) -> DataFrame:
    """The reviews of one segment, given by name or by id."""
    column = "cluster_name" if isinstance(segment, str) else "cluster_id"
    return known_segments(reviews).filter(F.col(column) == segment)


def topic_sentiment_breakdown(reviews: DataFrame) -> DataFrame:
    """Count and percentage of each sentiment within each topic."""
    labelled = known_topics(reviews).filter(F.col("sentiment").isNotNull())
    counts = labelled.groupBy("topic_name", name_of(F.col("sentiment")).alias("sentiment_label")).agg(
        F.count("*").alias("review_count")
    )
    # The window runs over the counts: one row per topic and label is left by then.
    total = F.sum("review_count").over(Window.partitionBy("topic_name"))
    return counts.withColumn("pct", F.round(_share(F.col("review_count"), total), 4))


def segment_counts(reviews: DataFrame) -> DataFrame:
    counts = known_segments(reviews).groupBy("cluster_name").agg(F.count("*").alias("review_count"))
    return counts.orderBy(F.desc("review_count"), "cluster_name")


def segment_counts_by_id(reviews: DataFrame) -> DataFrame:
    counts = known_segments(reviews).groupBy("cluster_id").agg(F.count("*").alias("review_count"))
    segment = F.concat_ws(" ", F.lit("Segment"), F.col("cluster_id").cast("string"))
    return counts.select("cluster_id", segment.alias("segment"), "review_count").orderBy("cluster_id")


def recent_reviews(
    documents: DataFrame, count: int = RECENT_REVIEWS, first: tuple = (),
) -> DataFrame:
    """The newest documents, by the columns in `first` and the time they were processed.

    The newest keys are found on these few columns; only their documents are then fetched.
    """
    names = [*first, "processed_at", "review_id"]
    keys = documents.select(*[F.col(name).alias(f"_{name}") for name in names]).orderBy(
        *[F.desc(f"_{name}") for name in names]).limit(count)
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in names]
    newest = documents.join(keys, reduce(Column.__and__, same), "left_semi")
    return newest.orderBy(*[F.desc(name) for name in names]).limit(count)


def recent_alerts(alerts: DataFrame, count: int = RECENT_ALERTS) -> DataFrame:
    newest = alerts.orderBy(F.desc("timestamp"), F.desc("alert_id")).limit(count)
    severity = F.col("severity") if "severity" in alerts.columns else F.lit(None).cast("string")
    return newest.withColumn("level", alert_level(severity))


def open_alerts(alerts: DataFrame, dismissed: DataFrame, shown: int = SHOWN_ALERTS) -> DataFrame:
    """The newest alerts that nobody dismissed. They are taken first, so fewer may remain."""
    return recent_alerts(alerts, shown).join(dismissed, "alert_id", "left_anti")


def latest_evaluations(evaluations: DataFrame, count: int = RECENT_EVALUATIONS) -> DataFrame:
    return evaluations.orderBy(F.desc("training_date")).limit(count)


def current_evaluation(evaluations: DataFrame) -> DataFrame:
    """The newest evaluation as shown: metrics as text, date to the minute."""
    return _shown(latest_evaluations(evaluations, 1)).drop("date").withColumn(
        "last_trained", training_day(F.col("training_date"))
    ).drop("training_date")


def training_history(evaluations: DataFrame, count: int = RECENT_EVALUATIONS) -> DataFrame:
    return _shown(latest_evaluations(evaluations, count)).drop("training_date")


def _shown(evaluations: DataFrame) -> DataFrame:
    perplexity = F.col("topic_modeling_logPerplexity_score")
    return evaluations.select(
        "training_date",
        F.substring(F.coalesce("training_date", F.lit("")), 1, 19).alias("date"),
        percent_text(F.col("accuracy")).alias("accuracy"),
        decimal_text(F.col("f1_score")).alias("f1_score"),
        decimal_text(F.col("precision")).alias("precision"),
        decimal_text(F.col("recall")).alias("recall"),
        decimal_text(F.col("clustering_Silhouette_score")).alias("silhouette"),
        F.when(perplexity != 0, decimal_text(perplexity)).alias("log_perplexity"),
    )
