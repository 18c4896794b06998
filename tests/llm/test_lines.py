import random
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from revlens.llm import lines, registry
from tests.llm.helpers import TEXTS, awkward_documents, empty_documents, save


def words_of(line):
    out, word = [], ""
    for c in line + " ":
        if c == " " or "\t" <= c <= "\r":
            if word:
                out.append(word)
            word = ""
        else:
            word += c
    return out


def near(a, b):
    """Word edit distance at most one."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def brute(rows, fewest=lines.MIN_WORDS):
    placed = []
    for doc_id, text in rows:
        for n, line in enumerate([] if text is None else text.split("\n")):
            words = words_of(line)
            if words:
                placed.append(((doc_id is None, doc_id or 0, n), words))
    by_size, first = {}, {}
    for place, words in placed:
        by_size.setdefault(len(words), []).append((place, words))
        first[tuple(words)] = min(first.get(tuple(words), place), place)
    gone = {
        place for place, words in placed
        if first[tuple(words)] < place or len(words) >= fewest and any(
            other < place and near(words, w)
            for size in (len(words) - 1, len(words), len(words) + 1) if size >= fewest
            for other, w in by_size.get(size, ()))
    }
    out = []
    for doc_id, text in rows:
        if text is None:
            out.append((doc_id, None, 0, 0))
            continue
        parts = text.split("\n")
        kept = [p for n, p in enumerate(parts) if (doc_id is None, doc_id or 0, n) not in gone]
        out.append((doc_id, "\n".join(kept), len(parts), len(parts) - len(kept)))
    return sorted(out, key=str)


def result(spark, sf_dir):
    return sorted((tuple(r) for r in registry.op5_lines(spark, sf_dir).collect()), key=str)


def near_lines(chance):
    base = [[f"w{chance.randint(0, 9)}" for _ in range(chance.randint(4, 12))] for _ in range(12)]
    texts = []
    for _ in range(50):
        own = []
        for _ in range(chance.randint(1, 6)):
            line = list(chance.choice(base))
            for _ in range(chance.choice((0, 0, 1, 1, 2))):
                at = chance.randrange(len(line))
                kind = chance.randrange(3)
                line[at:at + (kind != 1)] = [] if kind == 0 else [f"w{chance.randint(0, 9)}"]
            own.append(chance.choice((" ", "  ", "\t")).join(line) + chance.choice(("", " ", "\r")))
        texts.append("\n".join(own))
    return texts


@pytest.mark.parametrize("case", ["sample", "awkward", "empty", "near"])
def test_query(spark, sf_dir, tmp_path, case):
    if case != "sample":
        docs = {
            "awkward": lambda: awkward_documents(spark, TEXTS + ["one two three four five\n\n x"]),
            "empty": lambda: empty_documents(spark),
            "near": lambda: spark.createDataFrame(
                [(i * 7 % 53, t) for i, t in enumerate(near_lines(random.Random(8)))],
                "doc_id long, text string"),
        }[case]()
        sf_dir = save(tmp_path, docs)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    expected = brute([tuple(r) for r in docs])
    got = result(spark, sf_dir)
    if case == "awkward":  # the repeated row is the same place
        assert len(got) == len(expected)
    assert got == expected
    if case == "near":
        assert sum(r[3] for r in got) > 40
        twin = duckdb.connect()
        twin.execute(
            f"create view documents as from read_parquet('{sf_dir}/documents.parquet/*.parquet')")
        rows = twin.execute(registry.ORACLE_SQL["op5_lines"]).fetchall()
        assert sorted(rows, key=str) == expected


def test_prefix_hashes_of_long_lines(spark, monkeypatch):
    monkeypatch.setattr(lines, "BLOCK", 4)
    words = [f"w{i % 7}" for i in range(23)]
    frame = spark.createDataFrame([(0, words)], "place long, words array<string>").withColumn(
        "n", F.size("words"))
    found = {(r.m, r.slot): r.variant for r in lines._variants(frame).collect()}
    for slot in range(len(words)):
        rest = words[:slot] + words[slot + 1:]
        one = spark.createDataFrame([(0, rest)], "place long, words array<string>").withColumn(
            "n", F.size("words"))
        if slot % 6 == 0:
            whole = [r.variant for r in lines._variants(one).filter("slot = -1").collect()]
            assert whole == [found[22, slot]]


def test_one_line_of_30000_words(spark, tmp_path):
    """Prefixes by block are computed once a line, so the cost grows with its words alone."""
    words = [f"w{i}" for i in range(30_000)]
    edited = words[:20_000] + ["other"] + words[20_001:]
    rows = [(0, " ".join(words)), (1, " ".join(edited)), (2, " ".join(words[:-2]))]
    sf_dir = save(tmp_path, spark.createDataFrame(rows, "doc_id long, text string"))
    started = time.time()
    got = result(spark, sf_dir)
    assert time.time() - started < 60
    assert [(r[0], r[3]) for r in got] == [(0, 0), (1, 1), (2, 0)]


def test_block_prefixes_are_computed_once(spark):
    frame = spark.createDataFrame([(0, ["a", "b"], 2)], "place long, words array<string>, n int")
    plan = lines._variants(frame)._jdf.queryExecution().optimizedPlan().toString()
    # one generator for each of the two columns of hashes
    assert plan.count("Generate inline(array(struct(") == 2


@pytest.mark.parametrize("a, b, same", [
    ("a b c", "a b c", True), ("a b c", "a x c", True), ("a b c", "b c", True),
    ("a b c", "a b", True), ("a b c", "a b c d", True), ("a b c", "a c b", False),
    ("a b c", "x a b c y", False), ("a b c", "x y c", False), ("a a a", "a a", True),
])
def test_one_edit(spark, a, b, same):
    row = spark.createDataFrame([(a.split(), b.split())], "a array<string>, b array<string>")
    assert row.select(lines.one_edit(F.col("a"), F.col("b"))).first()[0] is same


def test_plan_is_native(spark, sf_dir):
    plan = registry.op5_lines(spark, sf_dir)._jdf.queryExecution().toString()
    assert not any(name in plan for name in ("Python", "Pandas", "ArrowEval", "Cartesian"))


def test_each_row_without_id_is_a_document(spark, monkeypatch):
    same = "a b c d e f\n\none two three four five six"
    near_one = "zero\na b c d e g\nq w e r t y"
    other = "q w e r t y u\nshort"
    rows = [(None, same, i) for i in range(4)] + [(None, near_one, 4), (None, other, 5),
                                                 (None, None, 6), (3, "q w e r t y", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, at long").repartition(3)
    places = []
    named = lines._named_lines

    def kept_names(docs, min_words):
        out = named(docs, min_words)
        places.extend(out.select("doc", "place").collect())
        return out

    monkeypatch.setattr(lines, "_named_lines", kept_names)
    found = lines.without_repeated_lines(docs)
    assert found.columns == ["doc_id", "text", "at", "line_counts"]
    got = {r.at: r.text for r in found.collect()}
    # lines of one word's edit go too, so one row in all keeps the line of letters
    texts = [got[i] for i in range(4)]
    assert sorted(texts)[:3] == ["", "", ""]
    assert sum("one two three four five six" in t for t in texts) == 1
    assert sum("a b c d e" in t for t in got.values() if t) == 1
    assert got[4].split("\n")[0] == "zero" and "q w e" not in got[4]
    assert got[5] == "short" and got[6] is None and got[7] == "q w e r t y"
    # arrays by document hold the lines of one row
    assert len({p.doc for p in places}) == 7 and len({p.place for p in places}) == len(places)


def test_words_are_not_split_to_name_a_line(spark):
    rows = [(1, " one\ttwo  three four\x0bfive \nshort line\n \t\n"), (2, None), (3, "a b c d e f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn(
        "_row_without_id", F.lit(None).cast("decimal(38,0)"))
    found = lines._lines(docs)
    assert sorted((int(r.doc), r.line_no, r.n, r.plain) for r in found.collect()) == [
        (1, 0, 5, "one two three four five"), (1, 1, 2, "short line"), (3, 0, 6, "a b c d e f")]
    named = lines._named_lines(docs, 5)
    assert [(r.k1 is None, r.k3 is None) for r in named.orderBy("place").collect()] == [
        (False, True), (True, True), (False, False)]
    plan = named._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1


def test_fetched_lines_split_a_text_once(spark):
    rows = [(1, "a b c d e\nx"), (2, "a b c d f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn(
        "_row_without_id", F.lit(None).cast("decimal(38,0)"))
    sieved = lines._sieved(lines._distinct_lines(lines._named_lines(docs, 5)))
    found = lines._fetched(docs, lines.materialized(sieved, "test-sieved"))
    assert sorted(" ".join(r.words) for r in found.collect()) == ["a b c d e", "a b c d f"]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(text") == 1
