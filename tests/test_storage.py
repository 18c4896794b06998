"""Files, messages, lookups and models through storage."""

import json

import pytest
from pyspark.sql import functions as F

from revlens import schemas
from revlens.plans import sample
from revlens.plans.scoring import ReviewScorer
from revlens.plans.train_sentiment import full_grid
from revlens.plans.training import train_all
from revlens.runtime import fresh_path
from revlens.sources import files, lookups, messages, models


def test_csv_round_trip_keeps_quotes_and_line_breaks(spark):
    rows = [("p", "c", "1", "4", 'He said "fine", then\nleft ', " lead", "positive"),
            ("p", "c", None, None, None, None, None)]
    path = fresh_path(spark, "csv")
    files.write_csv(spark.createDataFrame(rows, schemas.TRAINING_FILE), path)
    assert sorted(map(tuple, files.read_csv(spark, path).collect()), key=str) == sorted(rows, key=str)


def test_staging_is_done_once(spark):
    path = fresh_path(spark, "staged")
    first = files.stage(spark.range(100).repartition(7), path)
    again = files.stage(spark.range(5), path)
    assert first.count() == again.count() == 100
    assert again.select("row_key").distinct().count() == 100


def test_another_source_is_staged_anew(spark):
    path, first, second = (fresh_path(spark, n) for n in ("staged", "one", "two"))
    spark.range(3).write.csv(first)
    spark.range(5).write.csv(second)

    def staged(source):
        return files.stage(spark.read.schema("id long").csv(source), path, source=source).count()

    assert [staged(first), staged(first), staged(second), staged(second)] == [3, 3, 5, 5]
    spark.range(2).write.mode("append").csv(second)
    assert staged(second) == 7


def test_numbering_is_consecutive_and_follows_the_row_key(spark):
    staged = files.stage(spark.range(1000).repartition(9), fresh_path(spark, "staged"))
    numbered = files.numbered(staged, "n").orderBy("row_key").select("n").collect()
    assert [r.n for r in numbered] == list(range(1, 1001))


def test_messages_of_unnumbered_rows(spark):
    rows = spark.createDataFrame([("P", "Good")] * 5, "Product string, Review string")
    sent = messages.encode(files.stage(rows, fresh_path(spark, "staged")))
    decoded = [json.loads(r.value) for r in sent.collect()]
    assert sorted(m["review_id"] for m in decoded) == [f"review_{i}" for i in range(1, 6)]
    assert list(decoded[0]) == schemas.MESSAGE.names
    assert (decoded[0]["Product"], decoded[0]["Rate"]) == ("P", "")
    assert decoded[0]["timestamp"][4] == "-"


def test_malformed_messages_become_null_and_can_be_kept(spark):
    rows = spark.createDataFrame([('{"review_id": "r1", "Rate": 4}',), ("{nonsense",)], "value string")
    assert [r.review_id for r in messages.decode(rows).collect()] == ["r1", None]
    kept = messages.decode(rows, keep_corrupt=True).collect()
    assert [r[messages.CORRUPT] for r in kept] == [None, "{nonsense"]
    assert messages.CORRUPT not in schemas.MESSAGE.names


def test_lookup_defaults_and_saved_names(spark):
    path = fresh_path(spark, "topics")
    assert lookups.topic_names(spark, path).count() == 3
    saved = spark.createDataFrame(
        [(0, "Mine", [("w", 0.5)], ["w"])], schemas.TOPIC_INTERPRETATION
    )
    lookups.save_interpretations(saved, path)
    assert [tuple(r) for r in lookups.topic_names(spark, path).collect()] == [(0, "Mine")]
    assert lookups.read_topic_interpretations(spark, path).first().top_words[0].word == "w"


def test_evaluations_append(spark):
    path = fresh_path(spark, "evaluations")
    metrics = {"accuracy": 0.91234567, "f1_score": 0.9, "precision": 0.8, "recall": 0.7,
               "silhouette": 0.5}
    models.append_evaluation(spark, path, {**metrics, "log_perplexity": -7.123456})
    models.append_evaluation(spark, path, metrics)
    rows = spark.read.schema(schemas.EVALUATION).parquet(path).collect()
    assert {r.topic_modeling_logPerplexity_score for r in rows} == {-7.1235, None}
    assert {r.accuracy for r in rows} == {0.9123}


@pytest.fixture(scope="module")
def trained(spark, sf_dir):
    root = fresh_path(spark, "models")
    metrics = train_all(sample.reviews(spark, sf_dir), root, "review_id", full_grid()[7:8])
    return root, metrics


def test_training_leaves_everything_scoring_needs(spark, trained):
    root, metrics = trained
    assert 0 <= metrics["f1_score"] <= 1 and metrics["log_perplexity"] <= 0
    assert set(models.load_models(spark, root)) == {"sentiment", "topic", "clustering"}
    for kind, (name, algorithm) in models.MODEL_KINDS.items():
        row = models.read_metadata(spark, root, kind).first()
        assert (row.model_id, row.algorithm) == (name, algorithm)
    assert lookups.topic_names(spark, f"{root}/topic_interpretations").count() == 5
    assert lookups.segment_names(spark, f"{root}/cluster_interpretations").count() >= 2
    assert spark.read.parquet(f"{root}/evaluations").count() == 1


def test_scoring_with_each_model_missing(spark, sf_dir, trained):
    full = ReviewScorer.load(spark, trained[0])
    reviews = sample.reviews(spark, sf_dir, labelled=False)
    expected = sample.prepared(spark, sf_dir).count()
    for missing in ("none", "sentiment", "topic", "clustering"):
        kept = {kind: model for kind, model in full.models.items() if kind != missing}
        scorer = ReviewScorer(full.topic_names, full.segment_names, kept)
        rows = scorer.documents(reviews).collect()
        assert len(rows) == expected
        sentiments = {r.sentiment for r in rows}
        assert sentiments <= {-1.0} if missing == "sentiment" else sentiments <= {0.0, 1.0}
        assert {r.topic.id for r in rows} <= ({0} if missing == "topic" else set(range(5)))
        if missing == "clustering":
            assert {r.cluster.id for r in rows} == {0, 1, 2}
        assert all(r.sentiment_label in ("Positive", "Negative", "Unknown") for r in rows)


def test_same_data_same_topics(prepared, topic_model):
    from revlens.plans.train_topics import train_topics

    _, score = topic_model
    _, again = train_topics(prepared)
    assert score == pytest.approx(again, rel=1e-6)


def test_topic_shares_sum_to_one(prepared, topic_model):
    from pyspark.ml.functions import vector_to_array

    scored = topic_model[0].transform(prepared).select(
        vector_to_array("topicDistribution").alias("s"),
        F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, x: a + x).alias("words"),
    )
    # A text without any vocabulary word has no topic at all.
    expected = F.when(F.col("words") > 0, 1.0).otherwise(0.0)
    total = F.aggregate("s", F.lit(0.0), lambda a, x: a + x)
    assert scored.filter((F.size("s") != 5) | (F.abs(total - expected) > 1e-6)).count() == 0
    assert scored.filter("words > 0").count() > 0


def test_split_is_stable_and_near_its_shares(spark):
    from revlens.operators.splits import with_fold, with_split

    rows = spark.range(20000).select(F.concat(F.lit("r"), "id").alias("key"))
    once = with_fold(with_split(rows, "key"), "key")
    again = with_fold(with_split(rows.repartition(13), "key"), "key")
    assert once.exceptAll(again).count() == 0
    shares = {r["split"]: r["count"] / 20000 for r in once.groupBy("split").count().collect()}
    assert shares == pytest.approx({"train": 0.7, "validation": 0.15, "test": 0.15}, abs=0.01)
    folds = [r["count"] / 20000 for r in once.groupBy("fold").count().collect()]
    assert len(folds) == 3 and folds == pytest.approx([1 / 3] * 3, abs=0.01)
