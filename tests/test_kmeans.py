"""K-means of our own: as good as the library's, and the same for any layout."""

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from revlens.functions.arrays import squared_norm
from revlens.operators import kmeans
from revlens.runtime import fresh_path, materialized

COLUMNS = ["x", "y", "z"]


@pytest.fixture(scope="module")
def blobs(spark):
    chance = np.random.default_rng(4)
    middle = np.array([[0, 0, 0], [20, 0, 5], [0, 30, -5]])
    points = np.repeat(middle, 60, axis=0) + chance.normal(size=(180, 3))
    points = np.concatenate([points, np.repeat([[50.0, 50.0, 50.0]], 90, axis=0)])  # one hot point
    rows = [tuple(map(float, p)) for p in points]
    return materialized(spark.createDataFrame(rows, "x double, y double, z double"), "blobs")


def test_clear_clusters_are_found_and_scored_as_the_library_does(spark, blobs):
    centers = kmeans.fit(blobs, COLUMNS, [2, 3, 4], 20, 42)
    scores = kmeans.silhouettes(blobs, COLUMNS, centers)
    assert max(scores, key=scores.get) == 4
    rows = blobs.withColumn("v", array_to_vector(F.array(*COLUMNS)))
    for k, own in centers.items():
        model = kmeans.kmeans_model(spark, own, "v")
        expected = ClusteringEvaluator(featuresCol="v").evaluate(model.transform(rows))
        assert scores[k] == pytest.approx(expected, abs=1e-9)
    library = KMeans(featuresCol="v", k=4, seed=1, maxIter=20).fit(rows)
    cost = kmeans.kmeans_model(spark, centers[4], "v").transform(rows)
    assert cost.select("prediction").distinct().count() == 4
    ours = sum(((np.array([r.x, r.y, r.z]) - centers[4][r.prediction]) ** 2).sum()
               for r in cost.collect())
    assert ours <= library.summary.trainingCost * 1.001


def test_saved_model_and_scaler(spark, blobs):
    path = fresh_path(spark, "model")
    number, means, deviations = kmeans.moments(blobs, COLUMNS)
    expected = blobs.agg(F.count("*"), F.avg("x"), F.stddev_samp("x")).first()
    assert (number, means[0], deviations[0]) == pytest.approx(tuple(expected))
    model = kmeans.kmeans_model(spark, np.array([[0.0, 0, 0], [9, 9, 9]]), "v")
    model.save(path)
    again = KMeansModel.load(path)
    assert again.getK() == 2 and again.getFeaturesCol() == "v"
    assert [list(c) for c in again.clusterCenters()] == [[0, 0, 0], [9, 9, 9]]


@pytest.mark.parametrize("rows", [[], [(1.0, 1.0, 1.0)] * 5])
def test_no_rows_and_a_single_point(spark, rows):
    frame = spark.createDataFrame(rows, "x double, y double, z double")
    centers = kmeans.fit(frame, COLUMNS, [2, 3], 5, 1)
    assert all(len(c) == 1 for c in centers.values())
    assert kmeans.silhouettes(frame, COLUMNS, centers) == ({2: 0.0, 3: 0.0} if rows else {})


def test_start_points_are_different_points():
    points = np.array([[0.0], [0.0], [1.0], [5.0]])
    found = kmeans.start_points(points, np.array([9.0, 1.0, 1.0, 1.0]), 9, 3)
    assert sorted(found[:, 0]) == [0.0, 1.0, 5.0]


def test_sums_of_a_task_are_those_of_expressions(spark):
    """Ties, halves at the last binary place, and values beyond 64 bits in fixed point."""
    last = 2.0 ** -41
    rows = [(float(i % 7), i * last, (-1) ** i * 2.0 ** (i % 31)) for i in range(500)]
    rows += [(0.49999999999999994 * 2 * last, -last, -3 * last), (1.0, 0.0, 2.0 ** 31)]
    frame = spark.createDataFrame(rows, "x double, y double, z double").repartition(5)
    centers = {2: np.array([[0.0, 0, 0], [2.0, 0, 0]]), 3: np.array([[0.0] * 3, [0.0] * 3, [9.0] * 3])}
    placed = kmeans.assigned(frame, COLUMNS, centers)
    expected = placed.groupBy("k", "cluster").agg(
        F.count("*").alias("n"), F.sum(kmeans._fixed(squared_norm(F.col("point")))).alias("squares"),
        *[F.sum(kmeans._fixed(F.get("point", F.lit(i)))).alias(f"s{i}") for i in range(3)]).collect()
    point = 1 << 40
    found = kmeans._sums(frame, COLUMNS, centers)
    assert len(found) == len(expected)
    for r in expected:
        n, sums, squares = found[r.k, r.cluster]
        assert n == r.n and [int(r[f"s{i}"]) / point for i in range(3)] == sums.tolist()
        assert squares == pytest.approx(int(r.squares) / point, rel=1e-15)


def test_rounds_send_one_row_per_task_and_cluster(spark, blobs, monkeypatch):
    plans = []
    collect = type(blobs).collect
    monkeypatch.setattr(type(blobs), "collect", lambda self: (
        plans.append(self._jdf.queryExecution().toString()), collect(self))[1])
    kmeans._sums(blobs, COLUMNS, {2: np.zeros((2, 3))})
    assert len(plans) == 1 and "Generate" not in plans[0] and "MapInArrow" in plans[0]
