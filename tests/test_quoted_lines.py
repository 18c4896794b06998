"""CSV with line breaks in its texts: byte ranges give what reading whole files gives."""

import io
import random

import pytest

from revlens.runtime import fresh_path, list_files
from revlens.sources import files, quoted_lines

SCHEMA = "a string, b string, c string"


def awkward_csv(chance, rows, line_end="\n"):
    pieces = ["x", "word", '""', "\n", ",", " ", "é漢", '""\n""', "\n\n\n", "long text " * 5]
    plain = ["x", "wo rd", "5\" disk", "", "'", "é"]
    out = ["a,b,c"]
    for _ in range(rows):
        fields = []
        for _ in range(3):
            if chance.random() < 0.5:
                fields.append('"' + "".join(chance.choice(pieces) for _ in range(chance.randint(0, 6))) + '"')
            else:
                fields.append(chance.choice(plain))
        out.append(",".join(fields))
    return line_end.join(out)


def whole(spark, path):
    reader = spark.read.schema(SCHEMA).options(**files.CSV_OPTIONS).option("multiLine", "true")
    return sorted((tuple(r) for r in reader.csv(path).collect()), key=str)


def by_ranges(spark, path, monkeypatch, size):
    monkeypatch.setattr(quoted_lines.records, "__defaults__", (True, size))
    return sorted((tuple(r) for r in files.read_csv(spark, path, SCHEMA).collect()), key=str)


@pytest.mark.parametrize("size", [7, 64, 1000, 1 << 20])
def test_every_range_size_gives_the_same_records(size):
    chance = random.Random(size)
    for n in range(40):
        data = awkward_csv(chance, chance.randint(0, 12)).encode() + b"\n" * (n % 2)
        expected = [bytes(r) for r in quoted_lines.records_of(
            io.BytesIO(data), 0, len(data), len(data), False)]
        assert b"".join(expected) == data
        state, got = False, []
        for start in range(0, len(data), size):
            end = min(start + size, len(data))
            got += quoted_lines.records_of(io.BytesIO(data), start, end, len(data), state)
            region, _ = quoted_lines._region(io.BytesIO(data), start, end, len(data))
            state = quoted_lines.quoted_spans(region, state)[1] if region else state
        assert got == expected


@pytest.mark.parametrize("size", [40, 300])
def test_rows_equal_the_multiline_reader(spark, tmp_path, monkeypatch, size):
    chance = random.Random(3)
    for n in range(3):
        (tmp_path / f"{n}.csv").write_bytes(awkward_csv(chance, 30 * n).encode())
    (tmp_path / "none.csv").write_bytes(b"")
    (tmp_path / "_hidden.csv").write_bytes(b"a,b,c\nno,no,no\n")
    got = by_ranges(spark, str(tmp_path), monkeypatch, size)
    assert got == whole(spark, str(tmp_path)) and len(got) == 90


def test_one_large_file_is_many_tasks(spark, tmp_path, monkeypatch):
    (tmp_path / "one.csv").write_text(awkward_csv(random.Random(1), 400))
    path = str(tmp_path)
    expected = whole(spark, path)
    monkeypatch.setattr(quoted_lines.records, "__defaults__", (True, 2000))
    rows = files.read_csv(spark, path, SCHEMA)
    size = list_files(spark, path)[0][1]
    assert size > 5 * 2000
    assert sorted((tuple(r) for r in rows.collect()), key=str) == expected
    # more than one task does the work
    from pyspark.sql import functions as F

    assert rows.select(F.spark_partition_id().alias("p")).distinct().count() > 3


def test_a_text_over_several_ranges_and_states_turned(spark, tmp_path, monkeypatch):
    long = "line of text\n" * 200
    text = f'a,b,c\n1,"{long}",x\n2,"{long}""{long}",y\n3,,\n'
    (tmp_path / "one.csv").write_text(text)
    got = by_ranges(spark, str(tmp_path), monkeypatch, 100)
    assert got == [("1", long, "x"), ("2", f'{long}"{long}', "y"), ("3", None, None)]
    assert got == whole(spark, str(tmp_path))


def test_compressed_files_are_read_whole(spark):
    path = fresh_path(spark, "gzip")
    rows = spark.createDataFrame([("1", "a\nb", "c")], SCHEMA)
    rows.write.options(**files.CSV_OPTIONS).option("compression", "gzip").csv(path)
    assert [tuple(r) for r in files.read_csv(spark, path, SCHEMA).collect()] == [("1", "a\nb", "c")]
    assert not quoted_lines.splittable(["x.csv.gz"]) and not quoted_lines.splittable(["odd://x.csv"])


def test_bytes_that_are_no_text_are_replaced(spark, tmp_path):
    (tmp_path / "one.csv").write_bytes(b'a,b,c\n\xff,"b\nb",c\n')
    assert whole(spark, str(tmp_path)) == sorted(
        (tuple(r) for r in files.read_csv(spark, str(tmp_path), SCHEMA).collect()), key=str)
