import math
import random

import duckdb
import numpy as np
import pytest

from revlens.llm import negatives, registry
from tests.llm.helpers import save


def brute(rows):
    best = {}
    lengths = {}
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or not vector or any(
                x is None or not math.isfinite(x) or abs(x) >= 65536 for x in vector):
            continue
        label = math.fmod(label + 1, 10) if vec_id % 7 == 0 else label
        lengths[len(vector)] = lengths.get(len(vector), 0) + 1
        best.setdefault(len(vector), []).append(
            (vec_id, int(label), [math.floor(256 * x) for x in vector]))
    if not lengths:
        return []
    kept = {}
    for vec_id, label, values in best[min(lengths, key=lambda n: (-lengths[n], n))]:
        kept[vec_id] = min(kept.get(vec_id, (label, values)), (label, values))
    out = []
    for anchor, (label, values) in kept.items():
        if anchor % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(values, other)), i, own)
                        for i, (own, other) in kept.items() if i != anchor)
        same = [(-s, i) for s, i, own in scored if own == label][:5]
        for positive_score, positive in same:
            near = [(-s, i) for s, i, own in scored if own != label
                    and 30 * positive_score <= 100 * -s <= 90 * positive_score][:10]
            out += [(anchor, positive, n + 1, i, positive_score, s)
                    for n, (s, i) in enumerate(near)]
    return sorted(out)


def result(spark, sf_dir):
    return sorted(tuple(r) for r in registry.op11_negatives(spark, sf_dir).collect())


def vectors(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return frame.selectExpr("*", "'clash' as values", "1 as anchor_id", "2 as unit", "3 as block")


def awkward():
    nan, inf = float("nan"), float("inf")
    chance = random.Random(6)
    rows = [(i * 5, [chance.randint(-4, 4) / 4 for _ in range(6)], chance.choice((0, 1, 2)))
            for i in range(120)]
    rows += [rows[0], rows[20], (100, [1.0] * 6, 0), (None, [1.0] * 6, 1), (3, [1.0] * 6, None),
             (4, None, 1), (6, [], 1), (8, [nan] * 6, 1), (9, [inf] * 6, 1),
             (11, [None] + [1.0] * 5, 1), (12, [1.0, 2.0], 1), (13, [65536.0] * 6, 1),
             (-100, [0.0] * 6, 1), (-200, [-1.0] * 6, -3), (1300, [0.0] * 6, 5)]
    return rows + [(2000 + i, [0.5] * 6, i % 2) for i in range(200)]  # one vector holds most rows


@pytest.mark.parametrize("case", ["sample", "awkward", "single", "empty"])
def test_query(spark, sf_dir, tmp_path, monkeypatch, case):
    if case != "sample":
        rows = {"awkward": awkward(), "single": [(0, [1.0], 1)], "empty": []}[case]
        sf_dir = save(tmp_path, vectors(spark, rows).repartition(3), "embeddings")
        monkeypatch.setattr(negatives, "SUBTREE", 64)
        monkeypatch.setattr(negatives, "ANCHORS", 3)
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        "vec_id", "embedding", "label").collect()]
    got = result(spark, sf_dir)
    assert got == brute(rows)
    if case in ("sample", "awkward"):
        assert len(got) > 100
    if case == "sample":
        twin = duckdb.connect()
        twin.execute(f"create view embeddings as from read_parquet('{sf_dir}/embeddings.parquet')")
        assert sorted(twin.execute(registry.ORACLE_SQL["op11_negatives"]).fetchall()) == got


def clustered(chance, n=2000, dims=8):
    centres = chance.normal(size=(20, dims)) * 200
    return np.round(np.repeat(centres, n // 20, axis=0) + chance.normal(size=(n, dims)) * 10
                    ).astype(np.int64)


def test_boxes_and_intervals():
    chance = np.random.default_rng(2)
    values = clustered(chance)
    order = negatives.str_order(values, negatives.PAGE)
    assert sorted(order) == list(range(len(values)))
    tree = negatives.Tree(chance.permutation(len(values)), np.zeros(len(values)), values[order])
    anchors = values[::100]
    low, high = tree.bounds(anchors)
    scores = anchors @ tree.values.T

    def rows(node):
        if node < tree.pages:
            return list(range(len(values)))[tree.rows(node)]
        return [r for child in tree.children(node) for r in rows(child)]

    for node in range(len(tree.least)):
        own = rows(node)
        assert (low[:, node] <= scores[:, own].min(axis=1)).all()
        assert (high[:, node] >= scores[:, own].max(axis=1)).all()
        assert tree.least[node] == tree.vec_ids[own].min()
    assert rows(len(tree.least) - 1) == list(range(len(values)))


def test_search_is_exact_and_opens_few_pages():
    chance = np.random.default_rng(3)
    values = clustered(chance)
    values = values[negatives.str_order(values, negatives.PAGE)]
    tree = negatives.Tree(np.arange(len(values)), chance.integers(0, 3, len(values)), values)
    anchors = values[::50]
    low, high = tree.bounds(anchors)
    opened = 0
    for n, anchor in enumerate(anchors):
        scores = values @ anchor
        allowed = tree.labels != 1
        limits = int(np.quantile(scores, 0.6)), int(np.quantile(scores, 0.8))
        wanted = [negatives.Best(None, None, 5), negatives.Best(*limits, 7)]
        opened += negatives.best_first(tree, anchor, low[n], high[n], allowed, wanted)
        ranked = sorted((-s, i) for i, s in enumerate(scores.tolist()) if allowed[i])
        assert wanted[0].rows == ranked[:5]
        assert wanted[1].rows == [r for r in ranked if limits[0] <= -r[0] <= limits[1]][:7]
    assert opened < 0.5 * tree.pages * len(anchors)


def test_products_are_exact_beyond_floats():
    a = np.array([[(1 << 24) - 1, 1]], dtype=np.int64)
    b = np.array([[(1 << 24) - 1, 1 - (1 << 24)], [1 << 30, 3]], dtype=np.int64)
    expected = [[sum(int(x) * int(y) for x, y in zip(a[0], row)) for row in b]]
    assert negatives._products(a, b).tolist() == expected
