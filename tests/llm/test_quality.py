import re
from collections import Counter

import pytest

from revlens.llm import quality, registry
from tests.llm.helpers import TEXTS, awkward_documents, empty_documents, save


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(inside), failed)


@pytest.mark.parametrize("case", ["sample", "awkward", "empty"])
def test_query(spark, sf_dir, tmp_path, case):
    if case != "sample":
        table = TEXTS + ["x y z a b " * 30, "a\n\nb\na\r\na\n\x1ca\nb " + "#$% " * 20]
        docs = empty_documents(spark) if case == "empty" else awkward_documents(spark, table)
        sf_dir = save(tmp_path, docs)
        save(tmp_path, spark.createDataFrame(
            [(0, None, 0), (None, 1, 0), (5, 1, None), (5, 1, 0), (99, 1, 0)],
            "doc_id long, quality int, toxic int"), "labels")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = registry.op10_quality(spark, sf_dir).collect()
    assert sorted([tuple(r)[:7] for r in got], key=str) == sorted(
        [(i, *brute(t)) for i, t in docs], key=str)
    assert not any(r.kept and r.base_failed for r in got)


def test_exact_bound():
    # one in a hundred, none of 100: 0.99 ** 100
    assert quality.at_most(0, 100, 0.01) == pytest.approx(0.99 ** 100)
    assert quality.at_most(100, 100, 0.01) == pytest.approx(1)
    assert quality.at_most(1, 50, 0.1) == pytest.approx(0.9 ** 50 + 50 * 0.1 * 0.9 ** 49)


def counts(good, rejected=None):
    return {"stratum": "en", "good": good, "rejected": rejected or [0] * quality.STEPS}


def test_steps_become_stricter_and_end_at_the_strictest():
    steps = [quality.joint_cutoffs(s) for s in range(quality.STEPS)]
    for rule, cutoffs in quality.RULES.items():
        own = [s[rule] for s in steps]
        assert own == sorted(own, reverse=True) and sorted(set(own), reverse=True) == list(cutoffs)


def test_selection_stops_at_the_first_failure():
    rejected = [0, 0, 5, 1000, 0] + [0] * (quality.STEPS - 5)
    assert quality.select_cutoffs([counts(10_000, rejected)]) == [
        ("en", *pair) for pair in quality.joint_cutoffs(2).items()]
    assert quality.select_cutoffs([counts(10_000)]) == [
        ("en", *pair) for pair in quality.joint_cutoffs(quality.STEPS - 1).items()]


def test_too_few_labels_select_nothing():
    assert quality.select_cutoffs([counts(298)]) == []
    assert quality.select_cutoffs([counts(299)])


def test_more_strata_need_more_evidence():
    row = counts(400)
    assert quality.select_cutoffs([row], risk=0.01)
    assert not quality.select_cutoffs([row] * 20, risk=0.01)


def test_the_promise_holds_for_the_union(spark):
    """Selections on many holdouts of a stratum in which every step loses 2 % of good documents."""
    import random

    chance = random.Random(2)
    broken = 0
    for _ in range(400):
        rejected = sum(chance.random() < 0.02 for _ in range(500))
        broken += bool(quality.select_cutoffs([counts(500, [rejected] * quality.STEPS)]))
    assert broken / 400 <= quality.ERROR


def test_the_query_rejects_bad_documents_with_cutoffs_in_force(spark, tmp_path):
    good = [(i, " ".join(f"word{i}x{k} plain" for k in range(20)), "fr") for i in range(500)]
    bad = [(1000 + i, " ".join(f"$$$$$$$$$ buy{i}k{k}" for k in range(20)), "fr") for i in range(50)]
    sf_dir = save(tmp_path, spark.createDataFrame(good + bad, "doc_id long, text string, lang string"))
    labels = [(i, 1, 0) for i in range(500)] + [(1000 + i, 0, 0) for i in range(50)]
    save(tmp_path, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), "labels")
    kept = {r.doc_id: r.kept for r in registry.op10_quality(spark, sf_dir).collect()}
    assert all(kept[i] for i in range(500)) and not any(kept[1000 + i] for i in range(50))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stage = quality.without_rejected(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert {r.doc_id for r in stage.collect()} == set(range(500))


def test_cutoffs_reject_few_good_documents(spark):
    rows = [(i, ("w " * 40 + "#" * (i % 7) + " ab" * i)[:200] + f" {i}", "en") for i in range(4000)]
    rows += [(4000 + i, "buy ### $$$ %%% &&& *** ||| <<< >>> ### $$$ %%% now " + str(i), "en")
             for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    unique = docs.selectExpr("doc_id", "lang", "concat(text, ' ', hex(doc_id * 7919))as text")
    spread = unique.selectExpr(
        "doc_id", "lang",
        "concat_ws(' ', text, transform(sequence(1, 60), x -> hex(xxhash64(doc_id, x)))) as text")
    labels = spark.range(4000).selectExpr("id as doc_id", "1 as quality", "0 as toxic")
    kept = {r.doc_id for r in quality.judged(spread, labels).filter("kept").collect()}
    good = {r.doc_id for r in quality.judged(spread, labels.limit(0)).filter("kept").collect()}
    lost = len([i for i in good if i < 4000 and i not in kept])
    assert lost <= 0.01 * 4000
