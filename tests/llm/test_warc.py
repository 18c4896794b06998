import gzip
import hashlib
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from revlens.llm import registry, warc
from tests.llm.helpers import save


def awkward_pages(spark):
    big = "<p>" + "ü" * 700 + "</p>"
    rows = [
        (1, "http://a/1", big), (2, "http://a/2 b\r\nX: y", big), (7, None, big), (3, "u", None),
        (4, "u", ""), (5, "u", "short"), (6, "u", "short"), (8, "u", "x" * 999),
        (9, "u", "x" * 999), (10, "u", "y" * 1000), (11, "u", "y" * 1000),
        (12, "u", "WARC/1.1\r\n\r\n" * 200), (13, "u", "z" * 300_000),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    return pages.select("*", *[F.lit("clash").alias(c) for c in (
        "payload", "response", "n", "record_id", "payload_sha1", "target_uri")])


def brute(rows):
    best = {}
    for page_id, html in rows:
        data = (html or "").encode()
        if len(data) >= 1000:
            best[data] = max(best.get(data, page_id), page_id)
    out = []
    for page_id, html in rows:
        data = (html or "").encode()
        first = best.get(data, page_id)
        out.append((page_id, len(data), hashlib.sha1(data).hexdigest(),
                    "response" if first == page_id else "revisit",
                    None if first == page_id else first))
    return sorted(out)


@pytest.mark.parametrize("case", ["sample", "awkward", "empty"])
def test_query_and_twin(spark, sf_dir, tmp_path, case):
    if case != "sample":
        pages = awkward_pages(spark)
        sf_dir = save(tmp_path, pages.limit(0) if case == "empty" else pages, "pages")
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet")
            .select("page_id", "html").collect()]
    got = registry.op7_warc(spark, sf_dir).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got)) == brute(rows)
    twin = duckdb.connect()
    glob = "/*.parquet" if os.path.isdir(f"{sf_dir}/pages.parquet") else ""
    twin.execute(f"create view pages as from read_parquet('{sf_dir}/pages.parquet{glob}')")
    assert sorted(twin.execute(registry.ORACLE_SQL["op7_warc"]).fetchall()) == brute(rows)


def test_nulls_and_repeated_rows(spark, tmp_path):
    big = "q" * 2000
    rows = [(5, "u", big), (5, "u", big), (None, "u", big), (1, "u", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = registry.op7_warc(spark, save(tmp_path, pages, "pages")).collect()
    assert sorted([(r.page_id, r.record_type, r.refers_to) for r in got], key=str) == sorted(
        [(5, "response", None), (5, "response", None), (None, "revisit", 5), (1, "revisit", 5)],
        key=str)


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_filters_are_pushed_and_payloads_come_back(spark, tmp_path, compression):
    path = str(tmp_path / "archive")
    pages = awkward_pages(spark)
    warc.write(warc.page_records(pages).repartition(3), path, compression=compression,
               file_bytes="2000")
    files = [f for f in os.listdir(path) if f.endswith(".warc" + ".gz" * (compression == "gzip"))]
    assert len(files) >= 3
    frame = warc.load(spark, path, partition_bytes="3000")
    html = {r.page_id: r.html or "" for r in pages.collect()}
    found = frame.filter("record_type = 'response'").collect()
    assert {r.record_id for r in found} == {f"<urn:page:{i}>" for i in html if i not in (1, 2, 10)}
    for row in found:
        page = int(row.record_id.split(":")[-1][:-1])
        assert bytes(row.payload) == html[page].encode()
        assert row.payload_sha1 == hashlib.sha1(html[page].encode()).hexdigest()
    one = frame.filter("record_id in ('<urn:page:7>', '<urn:page:1>') and target_uri is null")
    assert [r.record_id for r in one.collect()] == ["<urn:page:7>"]
    assert frame.filter("target_uri like 'http://a/2%'").collect()[0].target_uri \
        == "http://a/2%20b%0D%0AX:%20y"
    assert frame.filter("payload_bytes > 200000").count() == 1


def test_unwanted_payloads_are_not_decoded(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "archive")
    warc.write(warc.page_records(awkward_pages(spark)).coalesce(1), path)
    decoded = []
    real = warc._Member.payload
    monkeypatch.setattr(
        warc._Member, "payload", lambda self, head: decoded.append(1) or real(self, head))
    reader = warc.WarcReader({"path": path}, [c.split()[0] for c in warc.SCHEMA.split(", ")])
    left = list(reader.pushFilters([warc.EqualTo(("record_type",), "revisit")]))
    rows = [row for part in reader.partitions() for row in reader.read(part)]
    assert left == [] and len(rows) == 3 and not decoded


def test_members_without_skip_length_and_foreign_files(spark, tmp_path):
    row = next(iter(warc.page_records(awkward_pages(spark)).filter(
        "record_id = '<urn:page:13>'").collect()))
    record = warc.record_bytes(row, "2020-01-01T00:00:00Z")
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.warc.gz").write_bytes(gzip.compress(record) + gzip.compress(record))
    (tmp_path / "a" / "notes.txt").write_text("no archive")
    got = warc.load(spark, str(tmp_path / "a")).collect()
    assert [bytes(r.payload) for r in got] == [b"z" * 300_000] * 2


def test_cut_files_are_errors(spark, tmp_path):
    (tmp_path / "a").mkdir()
    row = warc.page_records(awkward_pages(spark)).filter("record_id = '<urn:page:5>'").first()
    record = warc.record_bytes(row, "2020-01-01T00:00:00Z")
    for data in (record[:-10], warc.member_bytes(record)[:-10]):
        (tmp_path / "a" / "x.warc").write_bytes(data)
        with pytest.raises(Exception, match="cut or damaged"):
            warc.load(spark, str(tmp_path / "a")).collect()


def test_files_of_lost_attempts_are_not_read(spark, tmp_path):
    path = str(tmp_path / "archive")
    warc.write(warc.page_records(awkward_pages(spark)), path)
    before = warc.load(spark, path).count()
    (tmp_path / "archive" / "lost.warc.gz").write_bytes(b"half a file")
    assert warc.load(spark, path).count() == before == 13
