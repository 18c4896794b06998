import struct
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.util import PythonEvalType
from tokenizers import Tokenizer

from revlens.llm import packing, registry
from tests.llm.helpers import TEXTS, awkward_documents, empty_documents, save

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("text", [
    *filter(None, TEXTS), "it's they'll I'M x.,", "a<|endoftext|>b <|startoftext|>",
    "İstanbul ΣΑΣ ﬁ é é", "d'accord, l'été. Straße! 3.14 ... a,b", "\x1c\x85 x y",
    "'s 's. 'S, o'.",
])
def test_ids_are_the_tokenizers(tokenizer, text):
    ids = list(packing.word_ids(PATH).ids([text]))[0]
    assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == tokenizer.encode(
        text, add_special_tokens=False).ids


def test_every_simple_character(tokenizer):
    ids_of = packing.WordIds(PATH).ids
    for code in range(1, 0x300):
        text = f"A{chr(code)}b {chr(code)} {chr(code) * 2}1 x{chr(code)}. Y{chr(code)}"
        ids = list(ids_of([text]))[0]
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == tokenizer.encode(
            text, add_special_tokens=False).ids, hex(code)


def check(pieces, docs, tokenizer):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    expected = defaultdict(list)
    for doc_id, text in docs:
        expected[doc_id].append(tokenizer.encode(text or "", add_special_tokens=False).ids + [2])
    assert set(by_doc) == set(expected)
    for doc_id, own in by_doc.items():
        if len(expected[doc_id]) > 1:
            assert sum(p.length for p in own) == sum(map(len, expected[doc_id]))
            continue
        ids, at = expected[doc_id][0], 0
        for p in sorted(own, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids) and p.length > 0
            part = struct.pack(f"<{p.length}I", *ids[at:at + p.length])
            assert p.ids_crc32 == zlib.crc32(part)
            at += p.length
        assert at == len(ids)
    padding = 0
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 4096
        padding += 0 if at.bit_count() == 1 else 4096 - at
    assert padding == 0


@pytest.mark.parametrize("case", ["sample", "awkward", "empty"])
def test_query(spark, sf_dir, tmp_path, tokenizer, case):
    if case != "sample":
        made = {"awkward": awkward_documents, "empty": empty_documents}[case]
        sf_dir = save(tmp_path, made(spark))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    check(registry.op6_packing(spark, sf_dir).collect(), docs, tokenizer)


def test_many_bins(spark, sf_dir, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "BIN_BYTES", 20_000)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    check(registry.op6_packing(spark, sf_dir).collect(), docs, tokenizer)


def test_steps_and_forgotten_words_change_nothing(tokenizer, spark, sf_dir, monkeypatch):
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()] + [None, ""]
    expected = list(packing.WordIds(PATH).ids(texts))
    monkeypatch.setattr(packing, "STEP_BYTES", 3000)
    monkeypatch.setattr(packing, "REMEMBERED", 50)
    assert list(packing.WordIds(PATH).ids(texts)) == expected and len(expected) == len(texts)
    assert list(packing.WordIds(PATH).ids([])) == []


@pytest.mark.parametrize("text, number", [(None, 60_000), ("some equal words", 20_000)])
def test_equal_rows_without_id_share_no_bin(spark, tokenizer, monkeypatch, text, number):
    monkeypatch.setattr(packing, "BIN_BYTES", 200_000)
    docs = spark.range(number).select(
        F.lit(None).cast("long").alias("doc_id"), F.lit(text).cast("string").alias("text"))
    pieces = packing.packed(docs.repartition(4), PATH, 2)
    bins = pieces.groupBy((F.col("sequence_id") / packing.BIN_SEQUENCES).cast("int").alias("bin")).agg(
        F.count("*").alias("n"), F.sum("length").alias("tokens")).collect()
    assert len(bins) >= 8 and max(b.n for b in bins) < 3 * number / len(bins)
    each = len(tokenizer.encode(text or "", add_special_tokens=False).ids) + 1
    assert sum(b.tokens for b in bins) == each * number


def test_costs_are_balanced():
    lengths = sorted([4000, 3000, 1000, 600, 500, 400, 300, 200, 100] * 8, reverse=True)
    placed = packing.balance(lengths, 4096)
    cost = defaultdict(float)
    for _, _, length, sequence, _ in placed:
        cost[sequence] += packing._cost(length, 4096)
    full = [c for s, c in cost.items() if s < sum(lengths) // 4096]
    assert sum(length for _, _, length, _, _ in placed) == sum(lengths)
    assert max(full) <= 2 * 4096 + 1


def test_texts_are_tokenized_once(spark, sf_dir):
    plan = registry.op6_packing(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_pieces_leave_workers_as_arrow(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    cut = packing.cut(docs, PATH, 2, 64)
    rows = cut.groupBy("doc_id").agg(
        F.sum("length").alias("n"), F.max("length").alias("most"),
        F.max("doc_tokens").alias("tokens")).collect()
    assert len(rows) == docs.count() and all(r.n == r.tokens and r.most <= 64 for r in rows)
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert f", {PythonEvalType.SQL_SCALAR_ARROW_ITER_UDF}" in plan
