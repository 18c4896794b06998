import hashlib
import random

import numpy as np
import pytest

from revlens.llm import registry, suffixes
from tests.llm.helpers import TEXTS, awkward_documents, empty_documents, save


def brute(rows):
    """The contract's columns for (doc_id, text) rows."""
    first = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        place = (doc_id is None, doc_id or 0)
        for at in range(len(data) - 99):
            string = data[at:at + 100]
            first[string] = min(first.get(string, (place, at)), (place, at))
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        place = (doc_id is None, doc_id or 0)
        gone = bytearray(len(data))
        for at in range(len(data) - 99):
            if first[data[at:at + 100]] < (place, at):
                gone[at:at + 100] = b"\1" * 100
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(spark, sf_dir):
    return sorted((tuple(r) for r in registry.op8_suffixes(spark, sf_dir).collect()), key=str)


def rows_of(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return [tuple(r) for r in docs.collect()]


@pytest.mark.parametrize("case", ["sample", "awkward", "empty"])
def test_query(spark, sf_dir, tmp_path, case):
    if case != "sample":
        docs = empty_documents(spark) if case == "empty" else awkward_documents(
            spark, [t if t is None else t[:9000] for t in TEXTS])
        sf_dir = save(tmp_path, docs)
    assert result(spark, sf_dir) == brute(rows_of(spark, sf_dir))


def passages(chance, count):
    """Texts over a small alphabet that share passages around the length that decides."""
    def noise(size):
        return "".join(chance.choice("abcdefghij é\n") for _ in range(size))

    shared = [noise(n) for n in (60, 90, 98, 99, 100, 101, 130, 300)]
    texts = []
    for _ in range(count):
        parts = [noise(chance.randint(0, 150))]
        for _ in range(chance.randint(0, 3)):
            passage = chance.choice(shared)
            cut = chance.randint(0, 20)
            parts += [passage[cut:] if chance.random() < 0.5 else passage,
                      noise(chance.randint(0, 60))]
        texts.append("".join(parts))
    texts += [texts[0], texts[1] + texts[2], "x" * 500, "xy" * 260, "x" * 99, "x" * 100]
    return texts


@pytest.mark.parametrize("hot, run, per_range", [
    (4096, 40_000, 60_000), (4096, 50, 40), (3, 70, 40), (1, 1000, 20)])
def test_all_paths(spark, tmp_path, monkeypatch, hot, run, per_range):
    monkeypatch.setattr(suffixes, "HOT", hot)
    monkeypatch.setattr(suffixes, "RUN_RECORDS", run)
    monkeypatch.setattr(suffixes, "RANGE_RECORDS", per_range)
    texts = passages(random.Random(hot * run), 120)
    docs = spark.createDataFrame(
        [(i * 7 % 131, t) for i, t in enumerate(texts)], "doc_id long, text string")
    sf_dir = save(tmp_path, docs.repartition(6))
    assert result(spark, sf_dir) == brute(rows_of(spark, sf_dir))


def test_every_window_has_one_anchor(monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK", 300)
    chance = np.random.default_rng(5)
    sizes = [0, 50, 100, 101, 700, 99, 1500]
    data = chance.integers(97, 100, sum(sizes)).astype(np.uint8)
    _, of, at, most, least = suffixes.anchors_of(data, np.cumsum(sizes))
    windows = sorted((t, a - s) for t, a, m, n in zip(of, at, most, least)
                     for s in range(n, m + 1))
    assert windows == [(t, w) for t, size in enumerate(sizes) for w in range(max(0, size - 99))]


def test_loser_tree_merges_and_knows_prefixes():
    chance = random.Random(9)
    for runs in range(1, 9):
        made = []
        for _ in range(runs):
            strings = sorted(
                bytes(chance.choice(b"ab\0") for _ in range(chance.randint(32, 40)))
                for _ in range(chance.randint(0, 30)))
            made.append([(s, b"before"[:chance.randint(0, 6)], 1, 2, 3, 0) for s in strings])
        blobs = [suffixes.front_coded(r) for r in made]
        merged = list(suffixes.LoserTree([suffixes.decoded(b) for b in blobs]))
        flat = sorted(r[0] for run in made for r in run)
        assert [record[0] for _, record in merged] == flat
        assert sorted(r for _, r in merged) == sorted(r for run in made for r in run)
        assert [c for c, _ in merged][1:] == suffixes.common_prefixes(flat).tolist()[1:]


def test_cut_keeps_texts_apart():
    import pyarrow as pa

    spans = pa.array(
        [[{"start": 1, "end": 3}], None, [{"start": 0, "end": 2}, {"start": 2, "end": 3},
                                          {"start": 4, "end": 5}], [{"start": 0, "end": 3}]],
        pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
    made = suffixes._cut(pa.array(["abc", None, "\u00e9bcd", "xyz"]), spans).to_pylist()
    assert made == [
        {"kept": b"a", "removed": 2, "spans": 1}, None,
        {"kept": b"c", "removed": 4, "spans": 2}, {"kept": b"", "removed": 3, "spans": 1}]
    assert suffixes._cut(pa.array([None], pa.string()), spans[1:2]).to_pylist() == [None]


def test_texts_are_shuffled_once_and_runs_are_small(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    try:
        spark.conf.set(threshold, -1)
        found = suffixes.without_repeats(docs)
        found.collect()
    finally:
        spark.conf.set(threshold, before)
    assert "ReusedExchange" in found._jdf.queryExecution().executedPlan().toString()
    records = [(b"%032d" % n, b"", 1, 2, 3, 0) for n in range(100)]
    own = sum(32 - c for c in suffixes.common_prefixes([r[0] for r in records]).tolist())
    assert len(suffixes.front_coded(records)) <= 100 * 24 + own + 8
