"""K-means whose result does not depend on how rows are laid out.

Start points come from a bounded sample, the rows whose features hash lowest, by a seeded choice on the
driver. Sums are taken over fixed-point numbers, in which the order of adding changes nothing. So files,
cores and partitions decide nothing, and rows need no order or number of partitions of their own.
Several numbers of clusters are fitted at once: one pass over the rows per round serves them all.
"""

import json
from decimal import Decimal

import numpy as np
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.feature import StandardScalerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.functions.arrays import dot, squared_distance, squared_norm

SAMPLE = 4096
TOLERANCE = 1e-4
_POINT = 1 << 40  # fixed-point: 40 binary places
_WHOLE = "decimal(38,0)"


def _fixed(value: Column) -> Column:
    return F.round(value * F.lit(float(_POINT))).cast(_WHOLE)


def moments(rows: DataFrame, columns: list) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of rows, means and sample standard deviations, the same for any layout."""
    sums = rows.agg(F.count("*").alias("n"), *[F.sum(_fixed(F.col(c))).alias(f"s{i}")
                                              for i, c in enumerate(columns)]).first()
    n = sums["n"]
    if not n:
        return 0, np.zeros(len(columns)), np.zeros(len(columns))
    means = np.array([int(sums[f"s{i}"]) / n / _POINT for i in range(len(columns))])
    squares = rows.agg(*[
        F.sum(_fixed((F.col(c) - F.lit(float(m))) * (F.col(c) - F.lit(float(m))))).alias(f"s{i}")
        for i, (c, m) in enumerate(zip(columns, means))]).first()
    spread = np.array([int(squares[f"s{i}"]) / max(1, n - 1) / _POINT for i in range(len(columns))])
    return n, means, np.sqrt(spread)


def scaled(rows: DataFrame, columns: list, means: np.ndarray, deviations: np.ndarray) -> DataFrame:
    """`scaled_<column>`: distance from the mean in standard deviations, 0 without any deviation."""
    return rows.withColumns({
        f"scaled_{c}": (F.col(c) - F.lit(float(m))) * F.lit(1.0 / d if d > 0 else 0.0)
        for c, m, d in zip(columns, means.tolist(), deviations.tolist())})


def _sample(rows: DataFrame, columns: list, number: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """About SAMPLE rows' different points and how often each occurs, in a fixed order."""
    key = F.xxhash64(F.lit(seed), *columns)
    bound = min(1.0, SAMPLE / max(1, number)) * (1 << 40)
    chosen = rows.filter(F.pmod(key, F.lit(1 << 40)) < int(bound)).groupBy(*columns).count()
    found = sorted((tuple(r[c] for c in columns), r["count"]) for r in chosen.collect())
    return (np.array([p for p, _ in found], dtype=float).reshape(len(found), len(columns)),
            np.array([n for _, n in found], dtype=float))


def start_points(points: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Up to k different points, each drawn by its squared distance from those before."""
    chance = np.random.RandomState(seed)
    share = weights / weights.sum()
    chosen = [int(chance.choice(len(points), p=share))]
    nearest = ((points - points[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < k and (nearest > 0).any():
        share = nearest * weights
        chosen.append(int(chance.choice(len(points), p=share / share.sum())))
        nearest = np.minimum(nearest, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen]


def _given(value: list, schema: str) -> Column:
    """A nested value as a constant. It enters generated code by reference, so a round of the same
    form as the one before needs no new code."""
    return F.from_json(F.lit(json.dumps(value)), schema)


def assigned(rows: DataFrame, columns: list, centers: dict) -> DataFrame:
    """One row per row and number of clusters: its point (array), k and the cluster of the
    nearest center, the lowest on ties."""
    listed = _given([{"k": k, "centers": centers[k].tolist()} for k in sorted(centers)],
                    "array<struct<k:int,centers:array<array<double>>>>")
    placed = rows.select(F.array(*columns).alias("point"))

    def nearest(own):
        ranked = F.transform(own["centers"], lambda c, i: F.struct(
            squared_distance(F.col("point"), c).alias("distance"), i.alias("cluster")))
        return F.struct(own["k"].alias("k"), F.array_min(ranked)["cluster"].alias("cluster"))

    return placed.select("point", F.inline(F.transform(listed, nearest)))


def _fixed_values(values: np.ndarray) -> np.ndarray:
    """`_fixed` of doubles, as doubles: halves are rounded away from zero."""
    scaled_up = values * float(_POINT)
    size = np.abs(scaled_up)
    whole = np.where(size < 0.5, 0.0, np.where(size < 2.0 ** 52, np.floor(size + 0.5), size))
    return np.copysign(whole, scaled_up)


def _exact_sums(fixed: np.ndarray) -> list[int]:
    """The sum of each column of whole numbers, without rounding."""
    if not (np.abs(fixed) < 2.0 ** 62).all():
        return [sum(map(int, column)) for column in fixed.T]
    high = np.floor(fixed / 2.0 ** 32)
    low = (fixed - high * 2.0 ** 32).astype(np.int64).sum(axis=0)
    return [(int(h) << 32) + int(w) for h, w in zip(high.astype(np.int64).sum(axis=0), low)]


def _nearest(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """The cluster of the nearest center, the lowest on ties; terms are added in the order of `assigned`."""
    distances = np.zeros((len(centers), len(points)))
    for own, center in zip(distances, centers):
        for i, at in enumerate(center):
            own += (points[:, i] - at) ** 2
    return distances.argmin(axis=0)


def _sums(rows: DataFrame, columns: list, centers: dict) -> dict:
    """Rows, sums and sums of squares of each (k, cluster). A task adds up its own rows, batch by
    batch, and sends one row per cluster. `columns` are doubles without NULL."""
    dimensions = len(columns)
    names = ["squares", *[f"s{i}" for i in range(dimensions)]]

    def partial(batches):
        import pyarrow as pa

        totals: dict = {}
        for batch in batches:
            points = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            norms = np.zeros(len(points))
            for i in range(dimensions):
                norms += points[:, i] * points[:, i]
            fixed = _fixed_values(np.column_stack([norms, points]))
            for k, own in centers.items():
                cluster = _nearest(points, own)
                for c in np.unique(cluster).tolist():
                    members = fixed[cluster == c]
                    before = totals.get((k, c), [0] * (2 + dimensions))
                    totals[k, c] = [
                        x + y for x, y in zip(before, [len(members), *_exact_sums(members)])]
        if totals:
            found = [(k, c, *sums) for (k, c), sums in totals.items()]
            kinds = [pa.int32(), pa.int32(), pa.int64()] + [pa.decimal128(38, 0)] * (1 + dimensions)
            yield pa.RecordBatch.from_arrays(
                [pa.array([Decimal(v) for v in values] if i > 2 else values, kind)
                 for i, (values, kind) in enumerate(zip(map(list, zip(*found)), kinds))],
                names=["k", "cluster", "n", *names])

    schema = ", ".join(["k int, cluster int, n long", *[f"{name} {_WHOLE}" for name in names]])
    found = rows.select(*columns).mapInArrow(partial, schema).groupBy("k", "cluster").agg(
        *[F.sum(name).alias(name) for name in ["n", *names]]).collect()
    return {(r["k"], r["cluster"]): (
        r["n"], np.array([int(r[f"s{i}"]) / _POINT for i in range(dimensions)]),
        int(r["squares"]) / _POINT) for r in found}


def fit(rows: DataFrame, columns: list, numbers: list, max_iter: int, seed: int) -> dict:
    """Centers for each number of clusters. `rows` should be stored: each round reads them once."""
    points, weights = _sample(rows, columns, rows.count(), seed)
    if not len(points):
        return {k: np.zeros((1, len(columns))) for k in numbers}
    centers = {k: start_points(points, weights, k, seed + k) for k in numbers}
    moving = set(numbers)
    for _ in range(max_iter):
        if not moving:
            break
        found = _sums(rows, columns, {k: centers[k] for k in moving})
        for k in sorted(moving):
            moved = centers[k].copy()  # a center without rows stays
            for (own, cluster), (n, sums, _) in found.items():
                if own == k:
                    moved[cluster] = sums / n
            if ((moved - centers[k]) ** 2).sum(axis=1).max() <= TOLERANCE ** 2:
                moving.discard(k)
            centers[k] = moved
    return centers


def silhouettes(rows: DataFrame, columns: list, centers: dict) -> dict:
    """The mean silhouette (squared Euclidean) of each number of clusters, from counts, sums and
    squares of the clusters; no two rows are compared. Without a second cluster it is 0."""
    found = sorted(_sums(rows, columns, centers).items())
    if not found:
        return {}
    placed = assigned(rows, columns, centers)
    listed = _given(
        [{"k": k, "cluster": cluster, "n": float(n), "total": sums.tolist(), "squares": squares}
         for (k, cluster), (n, sums, squares) in found],
        "array<struct<k:int,cluster:int,n:double,total:array<double>,squares:double>>")

    def mean(c):
        apart = F.col("_norm") + c["squares"] / c["n"] - 2.0 * dot(
            F.col("point"), c["total"]) / c["n"]
        return F.struct((c["cluster"] == F.col("cluster")).alias("own"), c["n"].alias("n"),
                        apart.alias("mean"))

    rows = placed.withColumn("_norm", squared_norm(F.col("point"))).withColumn(
        "_means", F.transform(F.filter(listed, lambda c: c["k"] == F.col("k")), mean)).withColumns({
            "_own": F.get(F.filter("_means", lambda m: m["own"]), F.lit(0)),
            "_other": F.array_min(F.transform(
                F.filter("_means", lambda m: ~m["own"]), lambda m: m["mean"]))})
    inside = F.col("_own.mean") * F.col("_own.n") / (F.col("_own.n") - 1.0)
    outside = F.col("_other")
    score = F.when((F.col("_own.n") <= 1.0) | outside.isNull(), F.lit(0.0)).when(
        inside < outside, 1.0 - inside / outside).when(
        inside > outside, outside / inside - 1.0).otherwise(F.lit(0.0))
    totals = rows.groupBy("k").agg(
        F.sum(_fixed(score)).alias("total"), F.count("*").alias("n")).collect()
    return {r["k"]: int(r["total"]) / r["n"] / _POINT for r in totals}


def kmeans_model(spark, centers: np.ndarray, features: str) -> KMeansModel:
    """The centers as a model of the library, which saves, loads and applies like one it fitted."""
    jvm = spark._jvm.org.apache.spark
    vectors = spark.sparkContext._jvm.java.util.ArrayList()
    for center in centers.tolist():
        vectors.add(jvm.mllib.linalg.Vectors.dense(center[0], _doubles(spark, center[1:])))
    uid = f"revlens-kmeans-{len(centers)}"
    java = jvm.ml.clustering.KMeansModel(uid, jvm.mllib.clustering.KMeansModel(vectors))
    java.set(java.getParam("k"), len(centers))
    java.set(java.getParam("featuresCol"), features)
    java.set(java.getParam("predictionCol"), "prediction")
    return _wrapped(KMeansModel, java)


def scaler_model(spark, means, deviations, source: str, target: str) -> StandardScalerModel:
    jvm = spark._jvm.org.apache.spark.ml
    def vector(values):
        return jvm.linalg.Vectors.dense(values[0], _doubles(spark, values[1:]))

    java = jvm.feature.StandardScalerModel(
        "revlens-scaler", vector(deviations.tolist()), vector(means.tolist()))
    for name, value in (("inputCol", source), ("outputCol", target), ("withMean", True),
                        ("withStd", True)):
        java.set(java.getParam(name), value)
    return _wrapped(StandardScalerModel, java)


def _doubles(spark, values: list):
    array = spark.sparkContext._gateway.new_array(spark._jvm.double, len(values))
    for i, value in enumerate(values):
        array[i] = float(value)
    return array


def _wrapped(kind, java):
    model = kind(java)
    model._resetUid(java.uid())
    model._transfer_params_from_java()
    return model


