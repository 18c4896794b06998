import random

import pytest
import xxhash
from pyspark.sql import functions as F

from revlens.llm import components, registry, simhash
from tests.llm.helpers import awkward_documents, empty_documents, save


def brute_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c == " " or "\t" <= c <= "\r":
            if word:
                words.append(word)
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(
        1 << bit for bit in range(64)
        if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes)
    )


def brute_components(prints, bits=4):
    """{id: smallest id reachable} over {id: fingerprint}."""
    label = {i: i for i in prints}
    ids = sorted(prints)

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                one, two = sorted((root(a), root(b)))
                label[two] = one
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("case", ["sample", "awkward", "empty"])
def test_query(spark, sf_dir, tmp_path, case):
    if case != "sample":
        made = {"awkward": awkward_documents, "empty": empty_documents}[case]
        sf_dir = save(tmp_path, made(spark))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    prints = {i: brute_fingerprint(t) for i, t in docs if i is not None}
    component = brute_components(prints)
    got = registry.op4_simhash(spark, sf_dir).collect()
    assert len(got) == len(docs)
    for row in got:
        if row.doc_id is not None:
            assert row.fingerprint == f"{prints[row.doc_id]:016x}"
            assert row.component_id == component[row.doc_id]


def clustered_prints(chance, clusters, size, most):
    prints = {}
    for _ in range(clusters):
        centre = chance.getrandbits(64)
        for _ in range(size):
            print_ = centre
            for bit in chance.sample(range(64), chance.randint(0, most)):
                print_ ^= 1 << bit
            prints[print_] = None
    return {i: p for i, p in enumerate(prints)}


@pytest.mark.parametrize("limit", [simhash.MOST_VARIANTS, 20_000, 500])
def test_all_links_at_every_prefix_length(spark, monkeypatch, limit):
    monkeypatch.setattr(simhash, "MOST_VARIANTS", limit)
    prints = clustered_prints(random.Random(limit), 4, 12, 4)
    signed = [(p - (1 << 64) if p >> 63 else p, i) for i, p in prints.items()]
    table = spark.createDataFrame(signed, "fp long, id long")
    links = simhash.links(table)
    for a, b in links.distinct().collect():
        assert a < b
    labels = {r.id: r.component for r in components.smallest_reachable(links).collect()}
    assert {i: labels.get(i, i) for i in prints} == brute_components(prints)


def test_components_of_a_long_chain(spark):
    pairs = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = components.smallest_reachable(pairs).collect()
    assert sorted((r.id, r.component) for r in found) == [(i, 0) for i in range(1, 61)]
