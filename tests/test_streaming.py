"""The stream gives what the batch gives, however triggers fall and however often it runs."""

import pytest
from pyspark.sql import functions as F

from revlens.operators.anomalies import windowed_negative_share
from revlens.plans import sample
from revlens.plans.queries import _replayed
from revlens.runtime import fresh_path
from revlens.schemas import MESSAGE
from revlens.sources import commits, message_log, messages, tables
from revlens.streaming import scoring, windows

ONCE = {"availableNow": True}


class Folder:
    def __init__(self, spark):
        self.path = fresh_path(spark, "stream-test")

    def __getattr__(self, name):
        return f"{self.path}/{name}"


def run(spark, stream, folder, checkpoint, scorer=None, **options):
    scorer = scorer or sample.SampleScorer.default(spark)
    running = scoring.start_scoring(
        stream, scorer, folder.scored, folder.counts, f"{folder.path}/{checkpoint}",
        trigger=ONCE, **options,
    )
    running.awaitTermination()
    return tables.read_scored(spark, folder.scored)


def contents(scored):
    return sorted(
        (r.review_id, r.rating, r.sentiment, r.topic.id, r.cluster.name, r.batch_key)
        for r in scored.collect()
    )


@pytest.fixture(scope="module")
def replay(spark, sf_dir):
    return _replayed(spark, sf_dir)


@pytest.fixture(scope="module")
def batch(spark, sf_dir):
    return contents(sample.documents(spark, sf_dir))


def test_stream_equals_batch_and_rerun_changes_nothing(spark, sf_dir, replay, batch):
    folder = Folder(spark)
    stream = messages.file_stream(spark, replay)
    assert contents(run(spark, stream, folder, "c1")) == batch
    # The same checkpoint has nothing left to do; a new one starts over.
    assert contents(run(spark, stream, folder, "c1")) == batch
    assert contents(run(spark, stream, folder, "c2")) == batch
    alerts = {a.alert_id for a in tables.read_alerts(spark, folder.counts).collect()}
    assert alerts == {a.alert_id for a in sample.alerts(spark, sf_dir).collect()}


def _write_lines(spark, path, key, lines):
    rows = spark.createDataFrame([(key, line) for line in lines], "batch_key string, value string")
    rows.coalesce(1).write.mode("append").partitionBy("batch_key").text(path)


def _message(number, rate):
    fields = {name: "" for name in MESSAGE.names}
    fields.update(review_id=f"review_{number}", Review="some text", Category="en", Rate=str(rate))
    return "{" + ",".join(f'"{k}":"{v}"' for k, v in fields.items()) + "}"


def test_batch_in_several_triggers_and_alert_taken_back(spark):
    replay, folder = fresh_path(spark, "replay"), Folder(spark)
    _write_lines(spark, replay, "b1", [_message(i, 1) for i in range(8)] + ["{malformed"])
    stream = messages.file_stream(spark, replay, files_per_trigger=1)
    assert run(spark, stream, folder, "c").count() == 8
    assert [a.message for a in tables.read_alerts(spark, folder.counts).collect()] == [
        "High negative sentiment: 100% in batch"
    ]
    # A second file of the same batch brings the share down to 50 %.
    _write_lines(spark, replay, "b1", [_message(i, 5) for i in range(8, 16)])
    assert run(spark, stream, folder, "c").count() == 16
    assert tables.read_alerts(spark, folder.counts).count() == 0


def test_batch_without_any_text_is_skipped(spark):
    replay, folder = fresh_path(spark, "replay"), Folder(spark)
    _write_lines(spark, replay, "empty", ["{malformed", "{}"])
    _write_lines(spark, replay, "full", [_message(1, 5)])
    stored = run(spark, messages.file_stream(spark, replay, files_per_trigger=1), folder, "c")
    assert [r.review_id for r in stored.collect()] == ["review_1"]


def test_messages_without_origin_are_keyed_by_trigger(spark):
    """What a message queue delivers: only a value column."""
    rows = spark.createDataFrame([(_message(1, 5).encode(),), (_message(2, 1).encode(),)], "value binary")
    folder = Folder(spark)
    scorer = sample.SampleScorer.default(spark)
    for _ in range(2):  # a retried trigger replaces its own rows
        done = scoring.score_batch(scorer, folder.scored, folder.counts, rows, 7, run_id="r")
    assert done == [("1970-01-01", "run-r-7", "run-r-7")]
    assert tables.read_scored(spark, folder.scored).count() == 2
    assert scoring.score_batch(
        scorer, folder.scored, folder.counts, rows.limit(0), 8, run_id="r") == []


def test_a_new_checkpoint_of_a_queue_keeps_older_rows(spark):
    """Trigger numbers begin anew with a checkpoint; the rows stored before must stay."""
    folder = Folder(spark)
    for checkpoint, numbers in (("c1", (1, 2, 3)), ("c2", (4, 5))):
        source = fresh_path(spark, "queue")
        lines = spark.createDataFrame([(_message(i, 1),) for i in numbers], "value string")
        lines.coalesce(1).write.text(source)
        queue = spark.readStream.schema("value string").text(source)
        stored = run(spark, queue, folder, checkpoint)
    assert sorted(r.review_id for r in stored.collect()) == [f"review_{i}" for i in (1, 2, 3, 4, 5)]
    shares = tables.batch_shares(tables.read_counts(spark, folder.counts)).collect()
    assert sorted(r.total_reviews for r in shares) == [2, 3]


def test_repeated_messages_are_scored_once(spark):
    replay, folder = fresh_path(spark, "replay"), Folder(spark)
    timed = _message(1, 5).replace('"timestamp":""', '"timestamp":"2024-01-01 00:00:00"')
    _write_lines(spark, replay, "b", [timed, timed])
    stored = run(spark, messages.file_stream(spark, replay), folder, "c", dedup_within="1 hour")
    assert stored.count() == 1


def _timed(number, rate, time, text="some text", review_id=None):
    message = _message(number, rate).replace("some text", text)
    message = message.replace('"timestamp":""', f'"timestamp":"{time}"')
    return message if review_id is None else message.replace(f"review_{number}", review_id)


def test_only_repeats_are_dropped(spark):
    """Ids begin anew in every replay, and may be missing."""
    replay, folder = fresh_path(spark, "replay"), Folder(spark)
    time = "2024-01-01 00:00:00"
    _write_lines(spark, replay, "b1", [
        _timed(1, 5, time), _timed(1, 5, time), _timed(1, 5, time, "other text"),
        *[_timed(9, 1, time, "no id", "")] * 2, _timed(2, 1, ""), _timed(2, 1, ""),
    ])
    _write_lines(spark, replay, "b2", [_timed(1, 5, time, "third text"), _timed(1, 5, time)])
    stored = run(spark, messages.file_stream(spark, replay), folder, "c", dedup_within="1 hour")
    assert stored.count() == 8


def test_windows_equal_the_batch(spark, sf_dir, replay):
    """Also after the whole replay ran twice."""
    folder = Folder(spark)
    for checkpoint in ("c1", "c2"):
        run(spark, messages.file_stream(spark, replay), folder, checkpoint)
    columns = ["window_start", "total_reviews", "negative_reviews", "negative_pct"]
    counted = windows.window_shares(tables.read_counts(spark, folder.counts), "1 hour")
    expected = windowed_negative_share(sample.documents(spark, sf_dir), "1 hour")
    rows = sorted(map(tuple, counted.select(*columns).collect()))
    assert rows == sorted(map(tuple, expected.select(*columns).collect())) and rows


def test_a_late_batch_of_older_reviews_counts(spark):
    replay, folder = fresh_path(spark, "replay"), Folder(spark)
    for key, day in (("new", "2024-05-02"), ("old", "2024-01-01")):
        _write_lines(spark, replay, key, [_timed(i, 1, f"{day} 10:00:00") for i in range(3)])
        run(spark, messages.file_stream(spark, replay), folder, "c")
    shares = windows.window_shares(tables.read_counts(spark, folder.counts)).collect()
    assert sorted((str(r.window_start)[:10], r.total_reviews) for r in shares) == [
        ("2024-01-01", 3), ("2024-05-02", 3)]


# --- queues ---------------------------------------------------------------------------

def _log(spark, path, numbers, rate=1):
    rows = spark.createDataFrame([(i, _message(i, rate)) for i in numbers], "n long, value string")
    message_log.append(rows, path, "reviews", F.col("n") % 3, F.col("n"))


def drain(spark, log, folder, checkpoint, bound, limit=50):
    """Start the query again and again until nothing is left; rows of each start."""
    seen = []
    for _ in range(limit):
        stream = commits.queue_rows(
            message_log.stream(spark, log, f"{folder.path}/{checkpoint}", max_offsets=bound))
        running = scoring.start_scoring(
            stream, sample.SampleScorer.default(spark), folder.scored, folder.counts,
            f"{folder.path}/{checkpoint}", trigger=ONCE)
        running.awaitTermination()
        rows = sum(p["numInputRows"] for p in running.recentProgress)
        if not rows:
            return seen
        seen.append(rows)
    raise AssertionError("never done")


def offsets(scored):
    return sorted((r.queue_partition, r.queue_offset, r.review_id) for r in scored.collect())


def test_long_messages_are_read_a_few_at_a_time(spark):
    log = fresh_path(spark, "log")
    texts = spark.range(3000).select("id", F.concat("id", F.repeat(F.lit("long "), 4000)).alias("value"))
    message_log.append(texts.unionAll(texts), log, "reviews", F.lit(0), F.col("id"))
    reader = message_log.LogReader({"path": log, "progress": f"{log}-progress.json"})
    (part,) = reader.partitions({"offsets": {"reviews/0": 10}}, reader.latestOffset())
    batches = list(reader.read(part))
    assert max(batch.nbytes for batch in batches) <= 2 * message_log._BATCH_BYTES
    read = [row for batch in batches for row in batch.to_pylist()]
    assert [row["offset"] for row in read] == list(range(10, 6000))
    assert all(row["value"].startswith(f"{row['offset'] // 2}long ") for row in read)


def test_bounded_log_with_restarts_and_two_checkpoints(spark):
    log, folder = fresh_path(spark, "log"), Folder(spark)
    _log(spark, log, range(10))
    seen = drain(spark, log, folder, "c1", bound=4)
    assert sum(seen) == 10 and max(seen) <= 4 and len(seen) >= 3
    expected = sorted((i % 3, i // 3, f"review_{i}") for i in range(10))
    assert offsets(tables.read_scored(spark, folder.scored)) == expected
    # another checkpoint reads the same offsets, and then further ones, with other bounds
    _log(spark, log, range(10, 17))
    drain(spark, log, folder, "c2", bound=7)
    numbers = [*range(10), *range(10, 17)]
    stored = tables.read_scored(spark, folder.scored)
    assert sorted(r.review_id for r in stored.collect()) == sorted(f"review_{i}" for i in numbers)
    assert len({o[:2] for o in offsets(stored)}) == 17
    shares = tables.batch_shares(tables.read_counts(spark, folder.counts)).collect()
    assert sum(r.total_reviews for r in shares) == 17
    # the first checkpoint finds the new offsets stored
    drain(spark, log, folder, "c1", bound=100)
    assert tables.read_scored(spark, folder.scored).count() == 17


def _queue(spark, offsets_, partition=0):
    rows = [(_message(i, 1), "t", partition, i) for i in offsets_]
    return commits.queue_rows(spark.createDataFrame(
        rows, "value string, topic string, partition int, offset long"))


def test_overlapping_ranges_are_stored_once(spark):
    folder, scorer = Folder(spark), sample.SampleScorer.default(spark)

    def commit(*offsets_):
        return scoring.score_batch(
            scorer, folder.scored, folder.counts, _queue(spark, offsets_), 0)

    assert len(commit(0, 1, 2)) == 1
    assert commit(0, 1, 2) == []  # a retried trigger
    commit(5, 6, 7)
    commit(1, 2, 3, 4, 5, 6)
    assert [o for _, o, _ in offsets(tables.read_scored(spark, folder.scored))] == list(range(8))
    log = commits.CommitLog(spark, f"{folder.scored}-commits")
    assert log.latest().ranges == {"t": {"0": [[0, 7]]}} and log.latest().number == 3


def test_a_writer_that_was_slower_scores_the_rest(spark, monkeypatch):
    folder, scorer = Folder(spark), sample.SampleScorer.default(spark)
    add = commits.CommitLog.add

    def other_first(self, manifest):
        monkeypatch.setattr(commits.CommitLog, "add", add)
        scoring.score_batch(scorer, folder.scored, folder.counts, _queue(spark, (0, 1)), 0)
        return add(self, manifest)

    monkeypatch.setattr(commits.CommitLog, "add", other_first)
    scoring.score_batch(scorer, folder.scored, folder.counts, _queue(spark, (0, 1, 2)), 0)
    assert [o for _, o, _ in offsets(tables.read_scored(spark, folder.scored))] == [0, 1, 2]


def test_a_writer_that_dies_after_its_manifest_is_finished_by_the_next(spark, monkeypatch):
    folder, scorer = Folder(spark), sample.SampleScorer.default(spark)
    move = commits.CommitLog._move

    def dies(self, staged, target):
        raise OSError("lost")

    monkeypatch.setattr(commits.CommitLog, "_move", dies)
    with pytest.raises(OSError):
        scoring.score_batch(scorer, folder.scored, folder.counts, _queue(spark, (0, 1)), 0)
    monkeypatch.setattr(commits.CommitLog, "_move", move)
    scoring.score_batch(scorer, folder.scored, folder.counts, _queue(spark, (0, 1, 2)), 0)
    assert [o for _, o, _ in offsets(tables.read_scored(spark, folder.scored))] == [0, 1, 2]
    shares = tables.batch_shares(tables.read_counts(spark, folder.counts)).collect()
    assert sum(r.total_reviews for r in shares) == 3


def test_old_manifests_go_and_the_state_stays(spark, monkeypatch):
    monkeypatch.setattr(commits, "KEPT_MANIFESTS", 2)
    log = commits.CommitLog(spark, fresh_path(spark, "commits"))
    for n in range(1, 5):
        before = log.latest()
        ranges = before.with_ranges([("t", 0, 10 * n, 10 * n + 9), ("u", n, 0, 0)])
        assert log.add(commits.Manifest(n, ranges))
        assert not log.add(commits.Manifest(n, {}))
    assert log._numbers() == [3, 4]
    assert log.latest().ranges["t"] == {"0": [[10, 49]]} and len(log.latest().ranges["u"]) == 4


# --- newest reviews ---------------------------------------------------------------------

def test_newest_reviews_read_the_newest_days_only(spark):
    folder = Folder(spark)
    docs = spark.createDataFrame(
        [(f"review_{d}_{i}", f"2024-01-{d:02d}", "b", f"f{i % 2}", f"2024-01-{d:02d} 00:00:{i:02d}")
         for d in range(1, 11) for i in range(6)],
        "review_id string, ingest_day string, batch_key string, source_file string, processed_at string"
    ).withColumn("processed_at", F.col("processed_at").cast("timestamp")).withColumns({
        "sentiment": F.lit(0.0), "timestamp": F.lit(None).cast("string"),
        "topic": F.struct(F.lit(1).alias("id"), F.lit("t").alias("name")),
        "cluster": F.struct(F.lit(-1).alias("id"), F.lit("c").alias("name"))})
    tables.replace_partitions(docs, folder.scored, tables.SCORED_KEYS, rebalance=True)
    counts = scoring._counts(docs, *tables.SCORED_KEYS)
    tables.replace_partitions(counts, folder.counts, tables.SCORED_KEYS, rebalance=True)
    assert tables.newest_days(spark, folder.counts, 10) == ["2024-01-10", "2024-01-09"]
    assert len(tables.newest_days(spark, folder.counts, 1000)) == 10
    newest = tables.recent_scored(spark, folder.scored, folder.counts, 10)
    got = [r.review_id for r in newest.collect()]
    assert got == [f"review_10_{i}" for i in range(5, -1, -1)] + [
        f"review_9_{i}" for i in range(5, 1, -1)]
    assert {f.split("ingest_day=")[1][:10] for f in newest.inputFiles()} == {
        "2024-01-09", "2024-01-10"}
    assert len(newest.inputFiles()) == 4  # of 20
    assert tables.recent_scored(spark, fresh_path(spark, "none"), fresh_path(spark, "none")).count() == 0


# --- kept shares and drill-downs ----------------------------------------------------------

def test_kept_alerts_equal_summing_everything(spark, sf_dir, replay):
    folder = Folder(spark)
    run(spark, messages.file_stream(spark, replay, files_per_trigger=30), folder, "c",
        shares_path=folder.shares)
    kept = tables.read_kept_alerts(spark, folder.shares).select("alert_id", "message")
    summed = tables.read_alerts(spark, folder.counts).select("alert_id", "message")
    assert sorted(kept.collect()) == sorted(summed.collect()) and kept.count()


def test_a_trigger_touches_its_own_batches_only(spark):
    replay, folder = fresh_path(spark, "replay"), Folder(spark)
    for key in ("b1", "b2"):
        _write_lines(spark, replay, key, [_message(i, 1) for i in range(8)])
    stream = messages.file_stream(spark, replay)
    run(spark, stream, folder, "c", shares_path=folder.shares)
    before = {f: t for f, t in _files(spark, f"{folder.shares}/batches")}
    _write_lines(spark, replay, "b1", [_message(i, 5) for i in range(8, 16)])
    run(spark, stream, folder, "c", shares_path=folder.shares)
    assert [a.alert_id for a in tables.read_kept_alerts(spark, folder.shares).collect()] == ["b2"]
    after = {f: t for f, t in _files(spark, f"{folder.shares}/batches")}
    assert {f for f in after if "batch_key=b2" in f} == {f for f in before if "batch_key=b2" in f}
    assert not {f for f in after if "batch_key=b1" in f} & set(before)


def _files(spark, path):
    from revlens.runtime import list_files

    return list_files(spark, path)


def test_drilldowns_pass_over_row_groups(spark):
    path = fresh_path(spark, "drilldown")
    rows = spark.range(40_000).selectExpr(
        "id", "concat('topic ', id % 20) as topic_name", "concat('segment ', id % 7) as cluster_name",
        "cast(id % 20 as int) as topic_id", "repeat(md5(cast(id as string)), 4) as review_text")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tables.write_drilldown(rows, path, rows_per_file=1000)
        from revlens.operators import reports

        chosen = reports.topic_drilldown(spark.read.parquet(path), "topic 3")
        assert chosen.count() == 2000
        plan = chosen.select("id")
        plan.collect()
        scan = chosen.select("id")._jdf.queryExecution()
        executed = scan.executedPlan()
        executed.executeCollect()
        leaf = executed.collectLeaves().head()
        read = leaf.metrics().apply("numOutputRows").value()
        assert 2000 <= read <= 8000  # of 40,000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
