"""Jobs from the command line, normally through spark-submit:

    train   --csv PATH --root PATH                 train all models on labelled reviews
    replay  --csv PATH --staged PATH (--out PATH | --servers H:P --topic T)
    score   --root PATH (--replay PATH | --log PATH | --servers H:P --topic T) [--once]
            [--dedup "1 hour"]
    windows --root PATH [--length "1 day"]         negative share per window of all counted reviews
    report  --root PATH --name NAME [--out PATH]   write a whole report; without --out, preview it
            [--value TOPIC_OR_SEGMENT] [--dismissed PATH]
"""

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from revlens.operators import documents, reports
from revlens.plans.scoring import ReviewScorer
from revlens.plans.training import train_from_csv
from revlens.runtime import path_exists, release_materialized
from revlens.schemas import EVALUATION
from revlens.sources import commits, files, message_log, messages, tables
from revlens.streaming import scoring, windows

REVIEW_REPORTS = {name: getattr(reports, name) for name in (
    "kpi_summary", "segment_count", "sentiment_distribution", "topic_counts", "top_topics",
    "topic_sentiment_crosstab", "topic_summary", "distinct_topics", "distinct_segments",
    "topic_sentiment_breakdown", "segment_counts", "segment_counts_by_id", "recent_reviews",
)}
EVALUATION_REPORTS = {
    "latest_evaluation": reports.current_evaluation, "training_history": reports.training_history,
}

DRILLDOWNS = {
    "topic_drilldown": reports.topic_drilldown, "segment_drilldown": reports.segment_drilldown,
}


def train(spark, args):
    print(train_from_csv(spark, args.csv, args.root, multiline=not args.single_line))


def replay(spark, args):
    rows = files.read_csv(spark, args.csv, multiline=not args.single_line)
    sent = messages.encode(files.stage(rows, args.staged, source=args.csv), keep=("row_key",))
    if args.out:
        # One batch per partition that wrote the staged rows.
        part = F.shiftright("row_key", 33).cast("string")
        messages.write_replay(sent.withColumn("batch_key", F.concat(F.lit("part-"), part)), args.out)
    else:
        messages.publish(sent, args.servers, args.topic)


def _trigger(args):
    return {"availableNow": True} if args.once else {"processingTime": args.every}


def score(spark, args):
    if args.replay:
        stream = messages.file_stream(spark, args.replay, args.files_per_trigger)
    elif args.log:
        stream = commits.queue_rows(message_log.stream(
            spark, args.log, f"{args.root}/checkpoints/score", args.offsets_per_trigger))
    else:
        stream = commits.queue_rows(messages.kafka_stream(
            spark, args.servers, args.topic, most_per_trigger=args.offsets_per_trigger))
    scoring.start_scoring(
        stream, ReviewScorer.load(spark, args.root), f"{args.root}/scored", f"{args.root}/counts",
        f"{args.root}/checkpoints/score", _trigger(args), args.dedup, f"{args.root}/shares",
    ).awaitTermination()


def window_shares(spark, args):
    shares = windows.window_shares(tables.read_counts(spark, f"{args.root}/counts"), args.length)
    shares.write.mode("overwrite").parquet(f"{args.root}/window_shares")


def report(spark, args):
    if args.name == "recent_reviews":
        result = documents.reportable(
            tables.recent_scored(spark, f"{args.root}/scored", f"{args.root}/counts"))
    elif args.name in REVIEW_REPORTS:
        scored = documents.reportable(tables.read_scored(spark, f"{args.root}/scored"))
        result = REVIEW_REPORTS[args.name](scored)
    elif args.name in EVALUATION_REPORTS:
        evaluations = spark.read.schema(EVALUATION).parquet(f"{args.root}/evaluations")
        result = EVALUATION_REPORTS[args.name](evaluations)
    elif args.name in DRILLDOWNS:
        scored = documents.reportable(tables.read_scored(spark, f"{args.root}/scored"))
        result = DRILLDOWNS[args.name](scored, args.value)
    else:
        kept = path_exists(spark, f"{args.root}/shares/batches")
        alerts = (tables.read_kept_alerts(spark, f"{args.root}/shares") if kept
                  else tables.read_alerts(spark, f"{args.root}/counts"))
        if args.name == "open_alerts":
            dismissed = spark.read.schema("alert_id string").parquet(args.dismissed)
            result = reports.open_alerts(alerts, dismissed)
        else:
            result = reports.recent_alerts(alerts)
    if args.out:
        result.write.mode("overwrite").parquet(args.out)
    else:
        result.show(args.preview, truncate=False)


def parser():
    top = argparse.ArgumentParser(prog="revlens", description=__doc__,
                                  formatter_class=argparse.RawDescriptionHelpFormatter)
    jobs = top.add_subparsers(required=True)

    def job(name, run, *required):
        added = jobs.add_parser(name)
        added.set_defaults(run=run)
        for option in required:
            added.add_argument(f"--{option}", required=True)
        return added

    trains = job("train", train, "csv", "root")
    replays = job("replay", replay, "csv", "staged")
    scores = job("score", score, "root")
    windowed = job("windows", window_shares, "root")
    reported = job("report", report, "root")
    for added in (trains, replays):
        added.add_argument("--single-line", action="store_true")
    replays.add_argument("--out")
    scores.add_argument("--replay")
    scores.add_argument("--log")
    scores.add_argument("--files-per-trigger", type=int, default=1000)
    scores.add_argument("--dedup")
    for added in (replays, scores):
        added.add_argument("--servers")
        added.add_argument("--topic")
    scores.add_argument("--once", action="store_true")
    scores.add_argument("--every", default="10 seconds")
    scores.add_argument("--offsets-per-trigger", type=int, default=1_000_000)
    windowed.add_argument("--length", default="1 day")
    names = [*REVIEW_REPORTS, *EVALUATION_REPORTS, *DRILLDOWNS, "recent_alerts", "open_alerts"]
    reported.add_argument("--name", required=True, choices=names)
    reported.add_argument("--out")
    reported.add_argument("--preview", type=int, default=50)
    reported.add_argument("--value")
    reported.add_argument("--dismissed")
    return top


def main(argv=None):
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("revlens").getOrCreate()
    try:
        args.run(spark, args)
    finally:
        release_materialized(spark)


if __name__ == "__main__":
    main()
