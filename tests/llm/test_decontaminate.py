import hashlib
import random

import duckdb
import numpy as np
import pytest

from revlens.llm import decontaminate, registry
from tests.llm.helpers import LONG, TEXTS, awkward_documents, empty_documents, save


def words_of(text):
    out, word = [], ""
    for c in (text or "") + " ":
        c = chr(ord(c) + 32) if "A" <= c <= "Z" else c
        if "0" <= c <= "9" or "a" <= c <= "z" or ord(c) >= 0x80:
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def brute(docs, items):
    windows = {}
    for item_id, text in items:
        words = words_of(text)
        width = min(len(words), 10)
        for i in range(len(words) - width + 1 if width else 0):
            windows.setdefault(tuple(words[i:i + width]), set()).add(
                "" if item_id is None else str(item_id))
    widths = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        words, hit, found = words_of(text), set(), set()
        for width in widths:
            for i in range(len(words) - width + 1):
                owners = windows.get(tuple(words[i:i + width]))
                if owners:
                    hit |= set(range(i, i + width))
                    found |= owners
        ids = ",".join(sorted(found))
        out.append((doc_id, len(words), len(hit), len(found),
                    hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def result(spark, sf_dir):
    return sorted((tuple(r) for r in registry.op12_decontaminate(spark, sf_dir).collect()), key=str)


def tables(spark, tmp_path, docs, items):
    if isinstance(docs, list):
        docs = spark.createDataFrame(docs, "doc_id long, text string")
    save(tmp_path, docs)
    frame = spark.createDataFrame(items, "item_id long, text string")
    return save(tmp_path, frame.selectExpr("*", "'clash' as doc_id", "1 as block"), "benchmark")


def leaks(chance):
    items = [(i % 17, " ".join(f"w{chance.randint(0, 4)}" for _ in range(chance.randint(0, 25))))
             for i in range(20)]
    docs = []
    for i in range(60):
        parts = []
        for _ in range(chance.randint(0, 5)):
            words = chance.choice(items)[1].split()
            at = chance.randint(0, len(words))
            parts += words[at:at + chance.randint(3, 25)]
            parts += [f"W{chance.randint(0, 4)}" for _ in range(chance.randint(0, 9))]
        docs.append((i, chance.choice((" ", ", ", " - ", "\n")).join(parts)))
    return docs + docs[:5], items


AWKWARD_ITEMS = [
    (1, None), (2, ""), (3, " .,;\n"), (4, "one"), (5, TEXTS[6]), (5, TEXTS[6]), (None, TEXTS[8]),
    (6, LONG), (7, "The QUICK brown-fox jumps over the lazy dog, and runs away from"),
    (8, "kana かな"),
]


@pytest.mark.parametrize("shard_bytes", [200, decontaminate.SHARD_BYTES])
@pytest.mark.parametrize("block_bytes", [300, decontaminate.BLOCK_BYTES])
def test_against_brute_force(spark, tmp_path, monkeypatch, shard_bytes, block_bytes):
    docs, items = leaks(random.Random(shard_bytes + block_bytes))
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)
    blocks = decontaminate._blocks(spark.createDataFrame(items, "item_id long, text string"))
    assert (len(blocks) > 2) == (block_bytes == 300)
    expected = brute(docs, items)
    assert sum(r[5] for r in expected) > 20
    # in this process, so that the size of a shard can be set
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", shard_bytes)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays(
        [pa.array([d for d, _ in docs]), pa.array([t for _, t in docs])], ["doc_id", "text"])
    got = []
    for pieces, n_words, n_hit, found in decontaminate._judged(iter([batch]), blocks):
        ids = [i for p in pieces for i in p.column(0).to_pylist()]
        got += [(i, w, h, len(f), hashlib.sha256(",".join(sorted(f)).encode()).hexdigest(), h > 0)
                for i, w, h, f in zip(ids, n_words.tolist(), n_hit.tolist(), found)]
    assert sorted(got, key=str) == expected


@pytest.mark.parametrize("case", ["sample", "awkward", "empty", "no items", "leaks"])
def test_query(spark, sf_dir, tmp_path, case):
    if case != "sample":
        docs, items = {
            "awkward": lambda: (awkward_documents(spark), AWKWARD_ITEMS),
            "empty": lambda: (empty_documents(spark), AWKWARD_ITEMS),
            "no items": lambda: (awkward_documents(spark), []),
            "leaks": lambda: leaks(random.Random(5)),
        }[case]()
        sf_dir = tables(spark, tmp_path, docs, items)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()
    got = result(spark, sf_dir)
    assert got == brute(docs, items)
    if case == "sample":
        twin = duckdb.connect()
        for name in ("documents", "benchmark"):
            twin.execute(f"create view {name} as from read_parquet('{sf_dir}/{name}.parquet')")
        rows = twin.execute(registry.ORACLE_SQL["op12_decontaminate"]).fetchall()
        assert sorted(rows, key=str) == got


def test_affected_documents_go_with_all_their_columns(spark):
    docs = awkward_documents(spark)
    items = spark.createDataFrame(AWKWARD_ITEMS, "item_id long, text string")
    kept = decontaminate.without_contaminated(docs, items)
    assert kept.schema == docs.schema
    bad = {(r[0], r[1]) for r in brute([tuple(r) for r in docs.select("doc_id", "text").collect()],
                                       AWKWARD_ITEMS) if r[5]}
    expected = [tuple(r) for r in docs.collect()
                if (r.doc_id, len(words_of(r.text))) not in bad]
    assert sorted((tuple(r) for r in kept.collect()), key=str) == sorted(expected, key=str)
    assert 0 < len(expected) < docs.count()


def test_longest_matches(spark):
    item = [f"w{i}" for i in range(40)]
    docs = [(3, " ".join(["x"] + item[:15] + ["y"] + item[12:30])), (1, " ".join(item[12:30])),
            (2, " ".join(item[:15])), (4, " ".join(item[29:])), (5, " ".join(item[5:12]))]
    found = decontaminate.longest_matches(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame([(9, " ".join(item)), (8, "q r s")], "item_id long, text string"))
    assert sorted(tuple(r) for r in found.collect()) == [
        ("9", 0, 15, 2, 0), ("9", 12, 18, 1, 0), ("9", 29, 11, 4, 0)]


def test_suffix_array_and_repeated_words():
    chance = np.random.default_rng(3)
    for tokens in (np.zeros(500, dtype=np.int64), chance.integers(0, 3, 400), np.arange(9)[::-1],
                   np.tile(chance.integers(0, 5, 20), 30)):
        expected = sorted(range(len(tokens)), key=lambda i: tokens[i:].tolist())
        assert decontaminate.suffix_array(tokens).tolist() == expected
    text = b"word " * 30_000
    shard, block = decontaminate.Shard([text, b"other word"]), decontaminate.Items(["1"], [text])
    found = decontaminate.Found(np.zeros(30_002, dtype=bool), [set(), set()])
    decontaminate.search(shard, block, found)
    assert found.hit.sum() == 30_000 and found.items == [{"1"}, set()]


def test_large_numbers_take_the_other_sort(monkeypatch):
    chance = np.random.default_rng(4)
    tokens = chance.integers(0, 4, 300)
    expected = decontaminate.suffix_array(tokens).tolist()
    names = chance.integers(0, 9, 300).astype(np.uint64)
    numbered = [x.tolist() for x in decontaminate._numbered(names)]
    monkeypatch.setattr(decontaminate, "_BITS", 5)
    assert decontaminate.suffix_array(tokens).tolist() == expected
    assert [x.tolist() for x in decontaminate._numbered(names)] == numbered
