"""Reviews assembled from the sample warehouse tables, and a rule-based scorer for them.

The sample tables hold no reviews. A document is a review text, the event of the
same number tells when and with what rating it was sent, the opening turn of the
conversation of the same number is its summary, and quality labels give the sentiment.
Broken events become the missing and malformed values that real messages have.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.operators import quality
from revlens.operators.anomalies import alert_documents, anomalous, event_time, negative_share
from revlens.operators.documents import reportable
from revlens.operators.prepare import prepare_reviews
from revlens.plans.scoring import ReviewScorer
from revlens.sources.lookups import default_segment_names, default_topic_names


# Columns of the sample tables that reviews are made of. Reading with a known schema
# saves a job per table.
TABLES = {
    "documents": "doc_id long, text string, lang string, source string",
    "events": "event_id long, ts timestamp_ntz, event_type string, value double",
    "labels": "doc_id long, quality int, toxic int",
    "conversations": "conv_id long, turn long, role string, text string",
    "embeddings": "vec_id long, embedding array<float>, label int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def reviews(spark: SparkSession, sf_dir: str, labelled: bool = True) -> DataFrame:
    """All documents as reviews. All joins are on the document number, so the texts are
    shuffled once at most."""
    documents = table(spark, sf_dir, "documents")
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("doc_id"), "ts", "event_type", "value"
    )
    opening = (
        table(spark, sf_dir, "conversations")
        .filter("turn = 0")
        .select(F.col("conv_id").alias("doc_id"), F.col("text").alias("opening"))
    )
    joined = documents.join(events, "doc_id", "left").join(opening, "doc_id", "left")
    broken = F.col("event_type") == "error"
    value = F.col("value")
    columns = {
        "review_id": F.concat(F.lit("review_"), (F.col("doc_id") + 1).cast("string")),
        "timestamp": F.col("ts").cast("string"),
        "Product": F.col("source"),
        "Category": F.col("lang"),
        "Review": F.when(broken & (value < 2), F.lit(None)).when(broken & (value < 4), F.lit(""))
        .otherwise(F.col("text")),
        "Summary": F.coalesce("opening", F.when(F.col("event_type") == "view", F.lit("NaN"))),
        "Rate": F.when(broken & (value < 20), F.lit("")).when(broken & (value < 40), F.lit("abc"))
        .when(broken & (value < 60), F.lit("nan")).when(broken, F.lit(None))
        .otherwise((1 + F.floor(value / 15)).cast("string")),
        "product_price": value.cast("string"),
    }
    if labelled:
        joined = joined.join(table(spark, sf_dir, "labels"), "doc_id", "left")
        columns["Sentiment"] = (
            F.when(F.col("quality").isNull(), F.lit(None))
            .when((F.col("quality") == 1) & (F.col("toxic") == 0), F.lit("Positive"))
            .when((F.col("quality") == 0) & (F.col("toxic") == 0), F.lit("neutral"))
            .otherwise(F.lit("NEGATIVE"))
        )
    return joined.select(*[column.alias(name) for name, column in columns.items()])


def prepared(spark: SparkSession, sf_dir: str, training: bool = False) -> DataFrame:
    return prepare_reviews(reviews(spark, sf_dir, labelled=training), training)


def batch_key() -> Column:
    """Language and hour of the day: the batch a sample review is replayed in."""
    return F.concat_ws("-", F.col("Category"), F.substring("timestamp", 12, 2))


class SampleScorer(ReviewScorer):
    """Fixed rules in place of the models, so that results can be compared exactly."""

    @classmethod
    def default(cls, spark: SparkSession) -> "SampleScorer":
        return cls(default_topic_names(spark), default_segment_names(spark))

    def annotate(self, prepared: DataFrame) -> DataFrame:
        rating, language = F.col("Rate_num"), F.col("Category")
        length = F.length("text_combined")
        return prepared.withColumns({
            "sentiment_pred": F.when(rating >= 4, F.lit(1.0))
            .when(rating > 0, F.lit(0.0)).otherwise(F.lit(-1.0)),
            "topic_pred": F.when(language == "es", F.lit(-1)).when(length < 200, F.lit(0))
            .when(length < 1000, F.lit(1)).when(length < 3000, F.lit(2))
            .when(length < 8000, F.lit(3)).otherwise(F.lit(4)),
            "cluster_pred": F.when(rating == 0, F.lit(-1)).when(language == "en", F.lit(0))
            .when(language == "fr", F.lit(1)).when(language == "de", F.lit(2))
            .otherwise(F.lit(3)),
        })


def annotated(spark: SparkSession, sf_dir: str, training: bool = False) -> DataFrame:
    return SampleScorer.default(spark).annotate(prepared(spark, sf_dir, training))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored documents; each counts as processed when its event happened."""
    rows = reviews(spark, sf_dir, labelled=False).withColumn("batch_key", batch_key())
    return SampleScorer.default(spark).documents(
        rows, keep=("batch_key",), processed_at=event_time()
    )


def report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reportable(documents(spark, sf_dir))


def batch_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negative_share(
        documents(spark, sf_dir), "batch_key", also=(F.max("timestamp").alias("last_review"),)
    )


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts of the sample batches; those on entirely negative ones carry a severity."""
    raised = anomalous(batch_shares(spark, sf_dir))
    severity = F.when(F.col("negative_pct") == 100.0, F.lit("Very HIGH"))
    named = raised.withColumns({"alert_id": F.col("batch_key"), "severity": severity})
    return alert_documents(named, F.col("last_review"), keep=("alert_id", "severity"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """True labels against the rule-based sentiment."""
    return annotated(spark, sf_dir, training=True)


def evaluations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One evaluation per product and category; review averages stand in for the two
    scores of models that are not trained here."""
    by = ("Product", "Category")
    rows = predictions(spark, sf_dir)
    metrics = quality.classifier_metrics(
        quality.confusion(rows, "sentiment_label", "sentiment_pred", by=by), by=by
    )
    averages = rows.groupBy(*by).agg(
        F.max("timestamp").alias("latest"),
        F.avg(F.col("Rate_num").cast("double")).alias("rating"),
        F.avg(F.col("summary_length").cast("double")).alias("summary"),
    )
    joined = metrics.join(averages, list(by))
    return joined.select(
        F.lit("sentiment_analysis").alias("model_type"),
        *[F.round(c, 4).alias(c) for c in ("accuracy", "f1_score", "precision", "recall")],
        F.round(F.col("rating") / 10.0, 4).alias("clustering_Silhouette_score"),
        F.when(F.col("summary") > 0, F.round(-F.col("summary"), 4))
        .alias("topic_modeling_logPerplexity_score"),
        F.concat(F.translate("latest", " ", "T"), F.lit("Z")).alias("training_date"),
        F.lit("completed").alias("status"),
    )
