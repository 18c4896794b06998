import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from revlens.llm import bpe, registry
from tests.llm.helpers import awkward_documents, empty_documents, save

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH),
        special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return bpe.encoder(PATH, public_tokenizers.PATTERN)


def unpacked(ids):
    return list(struct.unpack(f"<{len(ids) // 4}I", ids))


def test_random_texts(encoder, reference):
    chance = random.Random(3)
    signs = " \n\t\r'sredlv aé1漢.,!\x1c\x85 　​ABz😀"
    for _ in range(5000):
        text = "".join(chance.choice(signs) for _ in range(chance.randint(0, 40)))
        assert unpacked(encoder.encode(text)) == reference.encode_ordinary(text), repr(text)


def test_every_character(encoder, reference):
    for code in range(0x30000):
        if not 0xD800 <= code < 0xE000:
            text = f"a{chr(code)}b {chr(code)} {chr(code) * 2}1"
            assert unpacked(encoder.encode(text)) == reference.encode_ordinary(text), hex(code)


def test_many_texts_at_once(reference):
    chance = random.Random(5)
    signs = "    \n\t'sredlv aé1漢.,!\x1c\x85\xa0\u2028\u200bABz😀"
    texts = [None, "", " ", "  ", "a", " a", "a ", "a b", "a b ", "a \n", "a b\n", "a b\n\n c", "a  b c"]
    texts += ["".join(chance.choice(signs) for _ in range(chance.randint(0, 60))) for _ in range(20_000)]
    texts += [f"a{c} {c}b {c} {c * 2}1 d{c}" for c in map(chr, range(0x3100))]
    encoder = bpe.Encoder(bpe.read_ranks(PATH), public_tokenizers.PATTERN)
    for _ in range(2):  # with new words, and with known ones
        for text, ids in zip(texts, encoder.encode_all(texts), strict=True):
            assert unpacked(ids) == reference.encode_ordinary(text or ""), repr(text)


def test_new_words_share_a_queue(reference, monkeypatch):
    chance = random.Random(7)
    text = " ".join("".join(chance.choices("etaoinshrdlu", k=chance.randint(6, 14))) for _ in range(5000))
    encoder = bpe.Encoder(bpe.read_ranks(PATH), public_tokenizers.PATTERN)
    alone, merge = [], encoder.merge
    monkeypatch.setattr(encoder, "merge", lambda piece: alone.append(piece) or merge(piece))
    assert unpacked(encoder.encode(text)) == reference.encode_ordinary(text)
    assert len(alone) < 10


def test_memory_that_overflows(reference, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    monkeypatch.setattr(bpe, "SLICE", 300)
    chance = random.Random(9)
    texts = ["".join(chance.choices("ab  é\n1", k=200)) + "x" * chance.randint(0, 90) for _ in range(300)]
    encoder = bpe.Encoder(bpe.read_ranks(PATH), public_tokenizers.PATTERN)
    for text, ids in zip(texts, encoder.encode_all(texts), strict=True):
        assert unpacked(ids) == reference.encode_ordinary(text), repr(text)
    assert all(len(key) <= bpe.SHORT for key in (*encoder.words, *encoder.pieces))


@pytest.mark.parametrize("seed", range(12))
def test_merged_together_in_any_order_of_ranks(seed):
    chance = random.Random(seed)
    letters = "abc"[:2 + seed % 2]
    tokens = {"".join(chance.choices(letters, k=chance.randint(2, 5))).encode() for _ in range(25)}
    tokens = [bytes([i]) for i in range(256)] + sorted(tokens)
    order = list(range(len(tokens)))
    chance.shuffle(order)
    ranks = dict(zip(tokens, order))
    encoder = bpe.Encoder(ranks, r"\S+|\s+")
    own = tiktoken.Encoding("own", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    pieces = ["".join(chance.choices(letters, k=chance.randint(1, 24))) for _ in range(2000)]
    pieces = [piece for piece in pieces if piece.encode() not in ranks]
    found = encoder.merge_together([piece.encode() for piece in pieces])
    for piece, ids in zip(pieces, found, strict=True):
        assert unpacked(ids) == own.encode_ordinary(piece), piece


def test_long_pretokens(encoder, reference):
    for text in ("a" * 50_000, "ab" * 20_000 + "é" * 9_000, " " * 30_000, "\n " * 9_000):
        assert unpacked(encoder.encode(text)) == reference.encode_ordinary(text)


def test_small_vocabulary_ties():
    ranks = {bytes([i]): i for i in range(256)} | {b"aa": 256, b"aaa": 257, b"ab": 258}
    encoder = bpe.Encoder(ranks, r"\S+|\s+")
    own = tiktoken.Encoding("own", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    for size in range(1, 12):
        for number in range(2 ** size):
            text = "".join("ab"[number >> bit & 1] for bit in range(size))
            assert unpacked(encoder.encode(text)) == own.encode_ordinary(text), text


@pytest.mark.parametrize("case", ["sample", "awkward", "empty"])
def test_query(spark, sf_dir, tmp_path, reference, case):
    if case != "sample":
        made = {"awkward": awkward_documents, "empty": empty_documents}[case]
        sf_dir = save(tmp_path, made(spark))
    got = [tuple(r) for r in registry.op1_bpe(spark, sf_dir).collect()]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    expected = []
    for doc_id, text in docs:
        ids = reference.encode_ordinary(text or "")
        packed = struct.pack(f"<{len(ids)}I", *ids)
        expected.append((doc_id, len(ids), hashlib.sha256(packed).hexdigest(),
                         hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_ids_decode_to_text(spark):
    docs = spark.createDataFrame([("naïve 漢字  text",), (None,)], "text string")
    ids = bpe.encode(F.col("text"), PATH, public_tokenizers.PATTERN)
    out = docs.select("text", bpe.decode(ids, PATH).cast("string").alias("again")).collect()
    assert [tuple(r) for r in out] == [("naïve 漢字  text",) * 2, (None, "")]
