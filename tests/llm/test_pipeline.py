import corpus_pipeline
import pytest

from revlens.llm import lines, packing, secrets
from tests.llm.helpers import awkward_documents, empty_documents, save
from tests.llm.test_lines import brute as brute_lines
from tests.llm.test_quality import brute as brute_quality
from tests.llm.test_simhash import brute_components, brute_fingerprint


def staged(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, frames[-1], sf_dir).write.parquet(f"{tmp_path}/{name}")
        frames.append(spark.read.parquet(f"{tmp_path}/{name}"))
    return frames


def test_every_stage_against_brute_force(spark, sf_dir, tmp_path):
    frames = staged(spark, sf_dir, tmp_path)
    rows = [{r.doc_id: r for r in f.collect()} for f in frames[:5]]
    for frame in frames[:5]:
        assert frame.columns == list(corpus_pipeline.COLUMNS)
    raw, good, unique, single, clean = rows
    # no stratum of the smallest sample has labels enough to select a cutoff
    assert set(good) == {i for i, r in raw.items() if not brute_quality(r.text)[5]}
    assert all(good[i].text == raw[i].text for i in good)
    expected = brute_lines([(i, r.text) for i, r in good.items()])
    assert sorted([(i, r.text) for i, r in unique.items()], key=str) == [e[:2] for e in expected]
    component = brute_components({i: brute_fingerprint(r.text) for i, r in unique.items()})
    assert set(single) == set(component.values())
    for i, row in single.items():
        assert clean[i].text == secrets.redact(row.text)
        assert clean[i].n_chars == len(clean[i].text)
    pieces = frames[5].collect()
    assert {p.doc_id for p in pieces} == set(clean)
    ids_of = packing.word_ids(corpus_pipeline.public_tokenizers.path("word_bpe_49k.json")).ids
    for i, row in clean.items():
        own = sorted((p.start, bytes(p.ids)) for p in pieces if p.doc_id == i)
        assert b"".join(b for _, b in own) == ids_of([row.text])[0] + b"\2\0\0\0"


@pytest.mark.parametrize("make", [awkward_documents, empty_documents])
def test_awkward_tables(spark, tmp_path, make):
    sf_dir = save(tmp_path / "in", make(spark))
    save(tmp_path / "in", spark.createDataFrame(
        [(6, 1, 0), (None, None, None)], "doc_id long, quality int, toxic int"), "labels")
    frames = staged(spark, sf_dir, tmp_path / "out")
    for frame in frames[1:5]:
        assert frame.columns == list(corpus_pipeline.COLUMNS)
    assert frames[5].count() >= frames[4].count()


def test_run_gives_the_last_stage(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "sequence_id", "ids"} <= set(out.columns)
    assert out.count() > 100


def test_documents_keep_their_row_when_all_lines_go(spark):
    docs = spark.createDataFrame(
        [(1, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string")
    kept = lines.without_repeated_lines(docs).select("doc_id", "text").collect()
    assert sorted(map(tuple, kept)) == [(1, "a b c d e f"), (2, "")]
