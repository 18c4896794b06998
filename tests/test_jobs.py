"""The command line jobs, one after the other, as a user runs them."""

from revlens import __main__ as jobs
from revlens.plans import sample
from revlens.runtime import fresh_path
from revlens.sources import files, tables


def test_train_replay_score_report(spark, sf_dir, capsys, monkeypatch):
    from revlens.plans import train_sentiment

    one = train_sentiment.full_grid()[7:8]
    monkeypatch.setattr(train_sentiment, "full_grid", lambda: one)
    root = fresh_path(spark, "jobs")
    reviews = sample.reviews(spark, sf_dir).select(*files.TRAINING_FILE.names)
    files.write_csv(reviews, f"{root}/csv")

    jobs.main(["train", "--csv", f"{root}/csv", "--root", root])
    assert "f1_score" in capsys.readouterr().out
    jobs.main(["replay", "--csv", f"{root}/csv", "--staged", f"{root}/to_send", "--out", f"{root}/replay"])
    for _ in range(2):
        jobs.main(["score", "--root", root, "--replay", f"{root}/replay", "--once"])
    scored = tables.read_scored(spark, f"{root}/scored")
    assert scored.count() == sample.prepared(spark, sf_dir).count()
    assert scored.select("review_id").distinct().count() == scored.count()

    for name in ("kpi_summary", "topic_summary", "recent_alerts", "training_history"):
        jobs.main(["report", "--root", root, "--name", name])
    shown = capsys.readouterr().out
    jobs.main(["windows", "--root", root])
    assert spark.read.parquet(f"{root}/window_shares").columns[0] == "window_start"
    spark.createDataFrame([("none",)], "alert_id string").write.parquet(f"{root}/dismissed")
    for name, extra in (
        ("recent_reviews", []), ("topic_drilldown", ["--value", "Price & Value"]),
        ("segment_drilldown", ["--value", "Critical Issues"]),
        ("open_alerts", ["--dismissed", f"{root}/dismissed"]),
    ):
        out = f"{root}/out/{name}"
        jobs.main(["report", "--root", root, "--name", name, "--out", out, *extra])
        assert spark.read.parquet(out).count() >= 0
    assert spark.read.parquet(f"{root}/out/recent_reviews").count() == scored.count()
    assert "total_reviews" in shown and "avg_rating" in shown and "log_perplexity" in shown
