"""Saved pipelines and what is recorded about them."""

from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from revlens.runtime import path_exists
from revlens.schemas import EVALUATION, MODEL_METADATA

# Model kinds, their folders and algorithms, and the two date formats.
MODEL_KINDS = {
    "sentiment": ("sentiment_model", "LogisticRegression"),
    "topic": ("topic_modeling_model", "LDA"),
    "clustering": ("clustering_model", "KMeans"),
}
METADATA_TIME = "%Y%m%d_%H%M%S"
EVALUATION_DECIMALS = 4


def model_path(root: str, kind: str) -> str:
    return f"{root}/{MODEL_KINDS[kind][0]}"


def save_model(spark: SparkSession, root: str, kind: str, model: PipelineModel, score) -> str:
    """Save a pipeline and its metadata row, replacing earlier ones."""
    path = model_path(root, kind)
    model.write().overwrite().save(path)
    metadata = metadata_row(spark, kind, path, score)
    metadata.write.mode("overwrite").option("header", True).csv(metadata_path(root, kind))
    return path


def metadata_path(root: str, kind: str) -> str:
    return f"{root}/metadata/{MODEL_KINDS[kind][0].removesuffix('_model')}_metadata"


def metadata_row(spark: SparkSession, kind: str, path: str, score) -> DataFrame:
    name, algorithm = MODEL_KINDS[kind]
    value = float("nan") if score is None else float(score)
    now = datetime.now().strftime(METADATA_TIME)
    return spark.createDataFrame([(name, path, value, now, algorithm)], MODEL_METADATA)


def read_metadata(spark: SparkSession, root: str, kind: str) -> DataFrame:
    reader = spark.read.schema(MODEL_METADATA).option("header", True)
    return reader.csv(metadata_path(root, kind))


def load_models(spark: SparkSession, root: str) -> dict:
    """The pipelines that exist. One that exists and cannot be read is an error."""
    paths = {kind: model_path(root, kind) for kind in MODEL_KINDS}
    return {
        kind: PipelineModel.load(path)
        for kind, path in paths.items() if path_exists(spark, path)
    }


def append_evaluation(spark: SparkSession, path: str, metrics: dict) -> None:
    """One row per training run. A perplexity that is missing or 0 is stored as NULL."""
    def rounded(name):
        return round(float(metrics[name]), EVALUATION_DECIMALS)

    perplexity = metrics.get("log_perplexity")
    row = (
        "sentiment_analysis", rounded("accuracy"), rounded("f1_score"), rounded("precision"),
        rounded("recall"), rounded("silhouette"),
        round(float(perplexity), EVALUATION_DECIMALS) if perplexity else None,
        datetime.now().isoformat(), "completed",
        *[metrics.get(name) for name in ("reviews", "unlabelled", "without_text", "training_rows")],
    )
    spark.createDataFrame([row], EVALUATION).write.mode("append").parquet(path)
