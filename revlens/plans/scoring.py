"""Apply whichever of the three models exist to prepared reviews."""

from dataclasses import dataclass, field

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.functions import first_argmax, known_prediction
from revlens.functions.sentiment import UNKNOWN
from revlens.operators.documents import scored_documents
from revlens.operators.features import segment_features
from revlens.operators.prepare import prepare_reviews
from revlens.operators.segments import hash_segment
from revlens.sources import lookups
from revlens.sources.models import load_models


@dataclass
class ReviewScorer:
    """Sentiment, topic and segment for reviews.

    A missing model degrades its own column only: sentiment becomes unknown, topic
    becomes 0, and the segment is taken from a hash of the review id.
    """

    topic_names: DataFrame
    segment_names: DataFrame
    models: dict = field(default_factory=dict)

    @classmethod
    def load(cls, spark: SparkSession, root: str) -> "ReviewScorer":
        return cls(
            lookups.topic_names(spark, f"{root}/topic_interpretations"),
            lookups.segment_names(spark, f"{root}/cluster_interpretations"),
            load_models(spark, root),
        )

    def annotate(self, prepared: DataFrame) -> DataFrame:
        """Adds sentiment_pred, topic_pred and cluster_pred."""
        kept = prepared.columns
        return self._segment(self._topic(self._sentiment(prepared), kept), kept)

    def documents(self, reviews: DataFrame, keep: tuple = (), processed_at=None) -> DataFrame:
        annotated = self.annotate(prepare_reviews(reviews, training=False))
        return scored_documents(
            annotated, self.topic_names, self.segment_names, processed_at, keep
        )

    def _sentiment(self, rows: DataFrame) -> DataFrame:
        if "sentiment" not in self.models:
            return rows.withColumn("sentiment_pred", F.lit(float(UNKNOWN)))
        scored = self.models["sentiment"].transform(rows)
        return scored.select(
            *rows.columns, known_prediction(F.col("prediction")).alias("sentiment_pred")
        )

    def _topic(self, rows: DataFrame, kept: list) -> DataFrame:
        if "topic" not in self.models:
            return rows.withColumn("topic_pred", F.lit(0))
        shares = self.models["topic"].transform(rows)
        topic = first_argmax(vector_to_array("topicDistribution"))
        return shares.select(*kept, "sentiment_pred", "topicDistribution", topic.alias("topic_pred"))

    def _segment(self, rows: DataFrame, kept: list) -> DataFrame:
        if "clustering" not in self.models:
            scored = rows.withColumn("cluster_pred", hash_segment(F.col("review_id")))
        else:
            # Segments are trained on the true label but assigned by the predicted one.
            features = segment_features(rows, sentiment="sentiment_pred")
            assigned = self.models["clustering"].transform(features)
            scored = assigned.withColumn("cluster_pred", F.col("prediction").cast("int"))
        return scored.select(*kept, "sentiment_pred", "topic_pred", "cluster_pred")
