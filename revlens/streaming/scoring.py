"""Score a stream of review messages into the scored table and the table of counts."""

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.operators.anomalies import review_counts
from revlens.runtime import run_day, stored_id
from revlens.sources.commits import (
    QUEUE,
    CommitLog,
    Manifest,
    has_queue,
    not_stored,
    stored_ranges,
)
from revlens.sources.messages import decode
from revlens.sources.tables import (
    SCORED_KEYS,
    STAGED,
    folder_of,
    keep_shares,
    read_scored,
    replace_partitions,
)


def score_batch(
    scorer, scored_path: str, counts_path: str, batch: DataFrame, batch_id: int,
    shuffled: bool = False, run_id: str = "",
) -> list:
    """Score one micro-batch, write it once, and count what was written.

    The sink is keyed by the day a source arrived, replay batch and file, so a batch that is run
    again replaces its own rows. Rows of a queue are committed by their offsets (`commit_batch`);
    rows with neither are keyed by run and trigger, since trigger numbers begin anew with every
    checkpoint. Counts have the same keys and come from the folders this trigger has written, whatever
    else the table holds. Returns the keys it has seen, at most one per file of the trigger.
    `shuffled` tells that the rows no longer lie by file.
    """
    if has_queue(batch):
        return commit_batch(scorer, scored_path, counts_path, batch)
    if any(key not in batch.columns for key in SCORED_KEYS[1:]):
        origin = f"run-{run_id}-{batch_id}"
        for key in SCORED_KEYS[1:]:
            if key not in batch.columns:
                batch = batch.withColumn(key, F.lit(origin))
    if SCORED_KEYS[0] not in batch.columns:
        # a retry may fall on another day, so the day is the run's
        batch = batch.withColumn(SCORED_KEYS[0], F.lit(run_day(run_id)))
    keys = sorted(tuple(row) for row in batch.select(*SCORED_KEYS).distinct().collect())
    if not keys:
        return keys
    spark = batch.sparkSession
    documents = scorer.documents(decode(batch), keep=tuple(SCORED_KEYS))
    replace_partitions(documents, scored_path, SCORED_KEYS, rebalance=shuffled)
    counts = _counts(read_scored(spark, scored_path, keys), *SCORED_KEYS)
    replace_partitions(counts, counts_path, SCORED_KEYS, rebalance=True)
    return keys


def _counts(scored: DataFrame, *by: str) -> DataFrame:
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return review_counts(scored, *by).withColumn("computed_at", now)


def commit_batch(scorer, scored_path: str, counts_path: str, batch: DataFrame) -> list:
    """Score what no commit holds yet of a trigger's queue messages, and commit it.

    Messages are read once: their offsets and counts come from the scored rows as staged. If
    another writer commits first, the rest of the batch is scored against the new state.
    """
    spark = batch.sparkSession
    log = CommitLog(spark, f"{scored_path}-commits")
    while True:
        before = log.latest()
        number, day = before.number + 1, datetime.now(timezone.utc).strftime("%Y-%m-%d")
        key = (day, f"commit-{number:012d}", f"commit-{number:012d}")
        staged = f"{scored_path}-staged/{uuid.uuid4().hex}"
        fresh = not_stored(batch, before.ranges)
        scorer.documents(decode(fresh), keep=tuple(QUEUE)).write.parquet(f"{staged}/scored")
        stored = spark.read.schema(STAGED).parquet(f"{staged}/scored")
        ranges = stored_ranges(stored)
        if not ranges:
            log.discard(staged)
            return []
        _counts(stored).coalesce(1).write.parquet(f"{staged}/counts")
        moves = [[f"{staged}/{name}", folder_of(path, key)]
                 for name, path in (("scored", scored_path), ("counts", counts_path))]
        if log.add(Manifest(number, before.with_ranges(ranges), moves)):
            log.discard(staged)
            return [key]
        log.discard(staged)


def start_scoring(
    messages: DataFrame, scorer, scored_path: str, counts_path: str, checkpoint: str,
    trigger: dict | None = None, dedup_within: str | None = None, shares_path: str | None = None,
):
    """Start the query. `trigger` is passed to writeStream.trigger; default every 10 seconds.

    `dedup_within` drops a message that is sent again within that time of its event. With
    `shares_path` the shares of touched batches are kept up to date there after each trigger.
    """
    run_id = stored_id(messages.sparkSession, f"{checkpoint}-run")

    def process(batch, batch_id):
        if dedup_within:
            # State must be read and written once per batch, so the result is kept.
            batch = batch.persist()
        try:
            keys = score_batch(
                scorer, scored_path, counts_path, batch, batch_id,
                shuffled=bool(dedup_within), run_id=run_id)
        finally:
            if dedup_within:
                batch.unpersist()
        if shares_path:
            keep_shares(batch.sparkSession, counts_path, shares_path, keys)

    if dedup_within:
        messages = deduplicated(messages, dedup_within)
    return (
        messages.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .foreachBatch(process)
        .start()
    )


def deduplicated(messages: DataFrame, within: str) -> DataFrame:
    """Each message once, as far as repeats arrive within the given event time.

    Review ids begin anew in every replay, so a repeat is a message with the same id and the same
    text in the same batch. Messages without id or readable time are all kept.
    """
    payload = F.from_json(F.col("value").cast("string"), "review_id string, timestamp string")
    timed = messages.select("*", payload.alias("_p")).select(
        *messages.columns,
        F.col("_p.review_id").alias("_review_id"),
        F.try_to_timestamp("_p.timestamp").alias("_event_time"),
        F.xxhash64("value").alias("_payload"),
    )
    known = (F.coalesce("_review_id", F.lit("")) != "") & F.col("_event_time").isNotNull()
    same = ["_review_id", "_payload", *[c for c in messages.columns if c == "batch_key"]]
    once = timed.filter(known).withWatermark("_event_time", within)
    once = once.dropDuplicatesWithinWatermark(same)
    return once.select(*messages.columns).union(timed.filter(~known).select(*messages.columns))
