import math
import random

import numpy as np
import pytest

from revlens.llm import neighbours, registry
from tests.llm.helpers import save


def cosine(a, b):
    return sum(x * y for x, y in zip(a, b)) / (
        math.sqrt(sum(x * x for x in a)) * math.sqrt(sum(x * x for x in b)))


def brute(rows, k=5):
    usable = {
        i: v for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    }
    out = {}
    for q in usable:
        if q % 50 == 0:
            near = sorted((-cosine(usable[q], v), i) for i, v in usable.items() if i != q)
            out[q] = [(i, -s) for s, i in near[:k]]
    return out


def table(rows):
    found = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(found[r.query_id])
    return found


def test_sample_recall_and_scores(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in
            spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    vectors = dict(rows)
    got, expected = table(registry.op3_neighbours(spark, sf_dir).collect()), brute(rows)
    assert set(got) == set(expected)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in expected[q]}) for q in expected)
    assert hits >= 0.9 * 5 * len(expected)
    for query, found in got.items():
        assert len(found) == 5
        for i, score in found:
            assert score == pytest.approx(cosine(vectors[query], vectors[i]), abs=1e-12)


def test_unusable_vectors_ties_and_few_rows(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [4.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, []),
        (6, [0.0, 0.0]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [None, 1.0]), (None, [1.0, 1.0]),
        (10, [1.0, 2.0, 3.0]), (50, [0.5, 0.5]), (100, [0.0, 0.0]), (2, [4.0, 0.0]),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    frame = frame.selectExpr("*", "'clash' as part", "'clash' as block", "'clash' as score")
    got = table(registry.op3_neighbours(spark, save(tmp_path, frame, "embeddings")).collect())
    assert set(got) == {0, 50}
    assert [i for i, _ in got[0]] == [1, 2, 50, 3]
    assert got[50][0][1] == got[50][1][1] == got[50][2][1]
    assert [i for i, _ in got[50]] == [0, 1, 2, 3]


def test_empty(spark, tmp_path):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert registry.op3_neighbours(spark, save(tmp_path, frame, "embeddings")).count() == 0


def test_most_rows_equal(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 64)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 3)
    chance = random.Random(1)
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(500)]
    rows += [(500 + i, [chance.gauss(0, 1) for _ in range(4)]) for i in range(500)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = table(registry.op3_neighbours(spark, save(tmp_path, frame, "embeddings")).collect())
    assert len(got) == 20
    for query in range(50, 500, 50):
        assert [i for i, _ in got[query]] == [0, 1, 2, 3, 4]
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5]


def test_parts_are_balanced_and_cut_few_edges():
    chance = np.random.default_rng(2)
    centres = chance.normal(size=(8, 16))
    unit = neighbours._unit(np.repeat(centres, 50, axis=0) + 0.1 * chance.normal(size=(400, 16)))
    near = neighbours._graph(unit, 5)
    label = neighbours.partition_graph(unit, near, 8)
    assert np.bincount(label, minlength=8).max() <= math.ceil(50 * neighbours.SLACK)
    assert (label[near] == label[:, None]).mean() > 0.9
    router = neighbours.train(unit, label, 8)
    assert (router.parts(unit)[:, 0] == label).mean() > 0.9
