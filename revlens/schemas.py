"""Schemas of everything read from or written to storage."""

from pyspark.sql import types as T


def _strings(*names):
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


# One review event; every field arrives as text.
MESSAGE = _strings(
    "review_id", "timestamp", "Product", "Category", "Review", "Summary", "Rate", "product_price"
)

# A labelled review file.
TRAINING_FILE = _strings(
    "Product", "Category", "product_price", "Rate", "Review", "Summary", "Sentiment"
)

NAMED_ID = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("name", T.StringType()),
])

SCORED_DOCUMENT = T.StructType([
    T.StructField("review_id", T.StringType()),
    T.StructField("product", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("review_text", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("sentiment", T.DoubleType()),
    T.StructField("sentiment_label", T.StringType()),
    T.StructField("topic", NAMED_ID),
    T.StructField("cluster", NAMED_ID),
    T.StructField("processed_at", T.TimestampType()),
    T.StructField("timestamp", T.StringType()),
])

# Where a queue held a review.
QUEUE_PLACE = T.StructType([
    T.StructField("queue_topic", T.StringType()),
    T.StructField("queue_partition", T.IntegerType()),
    T.StructField("queue_offset", T.LongType()),
])

ALERT = _strings("type", "message", "timestamp")

REVIEW_COUNT = T.StructType([
    T.StructField("minute", T.TimestampType()),
    T.StructField("total_reviews", T.LongType()),
    T.StructField("negative_reviews", T.LongType()),
    T.StructField("computed_at", T.StringType()),
    T.StructField("topics", T.BinaryType()),
    T.StructField("segments", T.BinaryType()),
])

EVALUATION = T.StructType([
    T.StructField("model_type", T.StringType()),
    T.StructField("accuracy", T.DoubleType()),
    T.StructField("f1_score", T.DoubleType()),
    T.StructField("precision", T.DoubleType()),
    T.StructField("recall", T.DoubleType()),
    T.StructField("clustering_Silhouette_score", T.DoubleType()),
    T.StructField("topic_modeling_logPerplexity_score", T.DoubleType()),
    T.StructField("training_date", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("reviews", T.LongType()),
    T.StructField("unlabelled", T.LongType()),
    T.StructField("without_text", T.LongType()),
    T.StructField("training_rows", T.LongType()),
])

MODEL_METADATA = T.StructType([
    T.StructField("model_id", T.StringType()),
    T.StructField("model_path", T.StringType()),
    T.StructField("accuracy", T.DoubleType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("algorithm", T.StringType()),
])

TOPIC_INTERPRETATION = T.StructType([
    T.StructField("topic_id", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("top_words", T.ArrayType(T.StructType([
        T.StructField("word", T.StringType()),
        T.StructField("weight", T.DoubleType()),
    ]))),
    T.StructField("keywords", T.ArrayType(T.StringType())),
])

SEGMENT_INTERPRETATION = T.StructType([
    T.StructField("cluster_id", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("characteristics", T.StructType([
        T.StructField("avg_sentiment", T.DoubleType()),
        T.StructField("avg_rating", T.DoubleType()),
        T.StructField("avg_length", T.DoubleType()),
        T.StructField("review_count", T.LongType()),
    ])),
])
