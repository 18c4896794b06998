import hashlib
import math
import random

import duckdb
import numpy as np
import pytest

from revlens.llm import codes, registry
from tests.llm.helpers import save


def brute(rows):
    usable = []
    for vec_id, vector, label in rows:
        if vector and len(vector) % 16 == 0 and all(
                x is not None and math.isfinite(x) and abs(x) < 65536 for x in vector):
            usable.append((vec_id, label, [math.floor(256 * x) for x in vector]))
    lengths = [len(v) for _, _, v in usable]
    if not usable:
        return []
    commonest = min(set(lengths), key=lambda n: (-lengths.count(n), n))
    kept = sorted((r for r in usable if len(r[2]) == commonest),
                  key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    width = commonest // 16
    parts = [[v[p * width:(p + 1) * width] for _, _, v in kept] for p in range(16)]
    books = [[list(part) for part in parts[p][:64]] for p in range(16)]

    def nearest(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), e)
                   for e, entry in enumerate(books[p]))

    for _ in range(2):
        for p in range(16):
            groups = {}
            for part in parts[p]:
                groups.setdefault(nearest(p, part)[1], []).append(part)
            for e, own in groups.items():
                books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    final = [[nearest(p, parts[p][r]) for p in range(16)] for r in range(len(kept))]
    errors = [sum(d for d, _ in row) for row in final]
    by_label = {}
    for (_, label, _), error in zip(kept, errors):
        by_label[label] = by_label.get(label, 0) + error
    digest = hashlib.sha256(",".join(
        str(x) for p in range(16) for entry in books[p] for x in entry).encode()).hexdigest()
    return sorted(((i, "".join(f"{e:02x}" for _, e in row), error, by_label[label], digest)
                   for (i, label, _), row, error in zip(kept, final, errors)), key=str)


def result(spark, sf_dir):
    return sorted((tuple(r) for r in registry.op13_codes(spark, sf_dir).collect()), key=str)


def vectors(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return frame.selectExpr("*", "'clash' as values", "'clash' as code", "1 as error")


def awkward():
    nan, inf = float("nan"), float("inf")
    chance = random.Random(4)
    rows = [(i, [float(chance.randint(-3, 3)) / 4 for _ in range(32)],
             None if i % 3 == 0 else i % 2) for i in range(90)]
    rows += [rows[5], rows[70], (None, rows[7][1], 1), (None, [0.5] * 32, None),
             (3, [0.25] * 32, 1), (200, None, 1), (201, [], 1), (202, [nan] + [0.0] * 31, 1),
             (203, [inf] + [0.0] * 31, 1), (204, [None] + [0.0] * 31, 1), (205, [1.0] * 16, 1),
             (206, [1.0] * 33, 1), (207, [0.0] * 32, 1), (208, [65536.0] * 32, 1),
             (-4, [-0.001] * 32, None)]
    return rows + [(300 + i, [0.1] * 32, 7) for i in range(60)]


@pytest.mark.parametrize("case", ["sample", "awkward", "few", "empty"])
def test_query(spark, sf_dir, tmp_path, monkeypatch, case):
    if case != "sample":
        monkeypatch.setattr(codes, "CHUNK", 20)
        rows = {"awkward": awkward(), "few": awkward()[:7], "empty": []}[case]
        sf_dir = save(tmp_path, vectors(spark, rows).repartition(3), "embeddings")
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        "vec_id", "embedding", "label").collect()]
    got = result(spark, sf_dir)
    assert got == brute(rows)
    if case == "sample":
        twin = duckdb.connect()
        twin.execute(f"create view embeddings as from read_parquet('{sf_dir}/embeddings.parquet')")
        assert sorted(twin.execute(registry.ORACLE_SQL["op13_codes"]).fetchall(), key=str) == got


def test_hilbert_curve_takes_single_steps():
    for dims, bits in ((2, 3), (3, 2), (1, 4), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), axis=-1).reshape(-1, dims)
        place = codes.hilbert_index(grid, bits)
        assert sorted(place) == list(range(len(grid)))
        steps = np.abs(np.diff(grid[np.argsort(place)], axis=0)).sum(axis=1)
        assert (steps == 1).all()


def test_shortlists_hold_all_nearest_entries_and_save_work(monkeypatch):
    monkeypatch.setattr(codes, "BLOCK", 8)
    chance = np.random.default_rng(1)
    chunk = codes.Chunk(np.round(chance.normal(size=(500, 48)) * 40).astype(np.int64))
    books = np.stack([chunk.part(p)[:64] for p in range(16)])
    books[:, 10] = books[:, 40]  # ties
    listed = 0
    for p in range(16):
        short = chunk.shortlists(p, books[p])
        listed += short.mean()
        far = ((chunk.part(p)[:, None] - books[p]) ** 2).sum(axis=2)
        for block, rows in enumerate(np.split(chunk.order[p], chunk.starts[1:])):
            nearest = far[rows] == far[rows].min(axis=1)[:, None]
            assert not (nearest.any(axis=0) & ~short[block]).any()
    assert listed / 16 < 0.7
    expected = np.stack([((chunk.part(p)[:, None] - books[p]) ** 2).sum(axis=2).argmin(axis=1)
                         for p in range(16)], axis=1)
    found, errors = chunk.coded(books)
    assert (found == expected).all() and errors.min() >= 0
    sums, counts = np.zeros_like(books), np.zeros(books.shape[:2], dtype=np.int64)
    chunk.add_to(books, sums, counts)
    for p in range(16):
        assert (counts[p] == np.bincount(expected[:, p], minlength=64)).all()
        for e in range(64):
            assert (sums[p, e] == chunk.part(p)[expected[:, p] == e].sum(axis=0)).all()


def test_equal_vectors_are_whole_blocks(monkeypatch):
    """Blocks of one point have one entry left, whose sums are taken from the block."""
    chunk = codes.Chunk(np.tile(np.arange(32), (1000, 1)))
    books = np.stack([np.array([[99, 99], [2 * p, 2 * p + 1]]) for p in range(16)])
    monkeypatch.setattr(codes.Chunk, "compared", lambda self, p, book, short, blocks: (
        (np.zeros(0, dtype=np.int64),) * 3 if not len(blocks) else pytest.fail("compared")))
    sums, counts = np.zeros_like(books), np.zeros(books.shape[:2], dtype=np.int64)
    chunk.add_to(books, sums, counts)
    assert (counts == [[0, 1000]] * 16).all() and sums[3, 1].tolist() == [6000, 7000]
