"""Model quality from predictions: classifier metrics and the silhouette."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.functions.arrays import dot, squared_norm


def confusion(predictions: DataFrame, label: str, prediction: str, by: tuple = ()) -> DataFrame:
    """Rows per true and predicted class: the one pass all metrics are read from."""
    pair = [F.col(label).cast("double").alias("label"),
            F.col(prediction).cast("double").alias("prediction")]
    return predictions.select(*by, *pair).groupBy(*by, "label", "prediction").agg(
        F.count("*").alias("n")
    )


def classifier_metrics(counts: DataFrame, by: tuple = ()) -> DataFrame:
    """Accuracy, and F1, precision and recall weighted by true class."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0))
    as_true = F.struct(F.col("label").alias("class"), F.col("n").alias("actual"),
                       F.lit(0).cast("long").alias("predicted"), hit.alias("hits"))
    as_predicted = F.struct(F.col("prediction").alias("class"), F.lit(0).cast("long").alias("actual"),
                            F.col("n").alias("predicted"), F.lit(0).cast("long").alias("hits"))
    per_class = (
        counts.select(*by, F.inline(F.array(as_true, as_predicted)))
        .groupBy(*by, "class")
        .agg(*[F.sum(c).cast("double").alias(c) for c in ("actual", "predicted", "hits")])
        .filter("actual > 0")
    )
    precision = F.when(F.col("predicted") > 0, F.col("hits") / F.col("predicted")).otherwise(F.lit(0.0))
    f1 = 2.0 * F.col("hits") / (F.col("actual") + F.col("predicted"))
    total = F.sum("actual")
    return per_class.groupBy(*by).agg(
        (F.sum("hits") / total).alias("accuracy"),
        (F.sum(f1 * F.col("actual")) / total).alias("f1_score"),
        (F.sum(precision * F.col("actual")) / total).alias("precision"),
        (F.sum("hits") / total).alias("recall"),
    )


def cluster_moments(points: DataFrame, cluster: str, vector: str, dimensions: int) -> DataFrame:
    """Per cluster: number of points, vector sum, and sum of squared norms.

    The sums run column by column, so partial results stay small on the map side
    and a cluster that holds most points costs no more than any other.
    """
    sums = [F.sum(F.get(vector, F.lit(i)).cast("double")) for i in range(dimensions)]
    return points.groupBy(F.col(cluster).alias("cluster")).agg(
        F.count("*").cast("double").alias("n"),
        F.array(*sums).alias("total"),
        F.sum(squared_norm(F.col(vector))).alias("norms"),
    )


def point_silhouettes(points: DataFrame, cluster: str, vector: str, dimensions: int) -> DataFrame:
    """Silhouette of each point with squared Euclidean distance, without comparing points.

    The mean squared distance from x to a cluster of n points with vector sum Y and
    sum of squared norms P is |x|^2 + P/n - 2 x.Y/n. There is one moments row per
    cluster; they reach the points as one scalar value.
    """
    rows = points.withColumn(vector, F.col(vector).cast("array<double>"))
    moments = cluster_moments(rows, cluster, vector, dimensions)
    listed = moments.agg(F.collect_list(F.struct("cluster", "n", "total", "norms"))).scalar()
    norm = F.col("_norm")

    def distance(c):
        return F.struct(
            (c["cluster"] == F.col(cluster)).alias("own"),
            c["n"].alias("n"),
            (norm + c["norms"] / c["n"]
             - 2.0 * dot(F.col(vector), c["total"]) / c["n"]).alias("mean"),
        )

    spread = (
        rows.withColumns({"_clusters": listed, "_norm": squared_norm(F.col(vector))})
        .withColumn("_distances", F.transform("_clusters", distance))
        .withColumns({
            "_own": F.get(F.filter("_distances", lambda d: d["own"]), F.lit(0)),
            "_other": F.array_min(F.transform(
                F.filter("_distances", lambda d: ~d["own"]), lambda d: d["mean"])),
        })
    )
    inside = F.col("_own.mean") * F.col("_own.n") / (F.col("_own.n") - 1.0)
    score = (
        F.when(F.col("_own.n") <= 1.0, F.lit(0.0))
        .when(inside < F.col("_other"), 1.0 - inside / F.col("_other"))
        .when(inside > F.col("_other"), F.col("_other") / inside - 1.0)
        .otherwise(F.lit(0.0))
    )
    return spread.withColumn("silhouette", score).drop(
        "_clusters", "_norm", "_distances", "_own", "_other"
    )


def silhouette(points: DataFrame, cluster: str, vector: str, dimensions: int) -> DataFrame:
    return point_silhouettes(points, cluster, vector, dimensions).agg(
        F.avg("silhouette").alias("silhouette"), F.count("*").alias("points")
    )
