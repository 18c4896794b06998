"""Segments: standardized features into K-means, with the number of segments chosen."""

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.fixed_values import SEED, SEGMENT_MAX_ITER, SEGMENT_RANGE
from revlens.operators import kmeans
from revlens.operators.features import SEGMENT_INPUTS, segment_features
from revlens.operators.segments import segment_profiles
from revlens.runtime import materialized

SCALED_INPUTS = [f"scaled_{c}" for c in SEGMENT_INPUTS]


def sweep(scaled: DataFrame) -> list:
    """(segments, silhouette, model) for each number of segments. All are fitted together, on
    features written once."""
    numbers = list(range(SEGMENT_RANGE[0], SEGMENT_RANGE[1] + 1))
    centers = kmeans.fit(scaled, SCALED_INPUTS, numbers, SEGMENT_MAX_ITER, SEED)
    scores = kmeans.silhouettes(scaled, SCALED_INPUTS, centers)
    return [(k, scores.get(k, 0.0),
             kmeans.kmeans_model(scaled.sparkSession, centers[k], "clustering_features"))
            for k in numbers]


def scaled_features(with_topics: DataFrame, sentiment: str = "sentiment_label"):
    """The pipeline that scales features, and the features, plain and scaled, written once."""
    features = segment_features(with_topics, sentiment).select(*SEGMENT_INPUTS)
    stored = materialized(features, "segment-inputs")
    _, means, deviations = kmeans.moments(stored, SEGMENT_INPUTS)
    scaler = PipelineModel(stages=[
        # segment_features leaves nothing to skip, and a filter that looks for it would run the models
        # before it once more for each of their columns
        VectorAssembler(inputCols=SEGMENT_INPUTS, outputCol="raw_features", handleInvalid="keep"),
        kmeans.scaler_model(
            stored.sparkSession, means, deviations, "raw_features", "clustering_features"),
    ])
    scaled = kmeans.scaled(stored, SEGMENT_INPUTS, means, deviations)
    return scaler, materialized(scaled, "segment-features")


def train_segments(with_topics: DataFrame):
    """The pipeline with the best silhouette (fewest segments on ties), its score and profiles."""
    scaler, scaled = scaled_features(with_topics)
    _, score, model = max(sweep(scaled), key=lambda result: (result[1], -result[0]))
    vector = array_to_vector(F.array(*SCALED_INPUTS)).alias("clustering_features")
    placed = model.transform(scaled.select(*SEGMENT_INPUTS, vector))
    return PipelineModel(stages=[*scaler.stages, model]), score, segment_profiles(
        placed, "prediction")
