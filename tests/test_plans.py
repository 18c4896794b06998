"""Physical plans: one cleaning per text, no Python, no cross join, sized broadcasts."""

import pytest
from pyspark.sql import functions as F

from revlens.plans import sample, train_segments
from revlens.plans.oracle import oracle_sql
from revlens.plans.queries import REGISTRY
from revlens.sources.lookups import default_topic_names

MODELS_OR_STREAMS = {
    "grid_search", "sentiment_predictions", "topic_distribution", "topic_terms",
    "topic_interpretations", "kmeans_sweep", "segment_assignments", "model_metadata",
    "stream_scored", "stream_replayed", "stream_alerts", "stream_dedup", "windowed_anomaly_stream",
    "scan_reviews_csv", "stage_and_number", "interpretation_lookup",
}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - MODELS_OR_STREAMS))
def test_plan(spark, sf_dir, name):
    plan = plan_of(REGISTRY[name](spark, sf_dir))
    for slow in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                 "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert slow not in plan
    assert "Scan ExistingRDD" not in plan, "rows of unknown size"


def test_texts_are_cleaned_once(spark, sf_dir):
    plan = plan_of(sample.report_rows(spark, sf_dir))
    assert plan.count(r"\bnan\b") == 2  # review and summary


def test_only_needed_columns_are_read(spark, sf_dir):
    plan = plan_of(REGISTRY["numeric_rating"](spark, sf_dir))
    assert "text" not in plan.split("ReadSchema: ")[1].split(">")[0]


def test_names_are_not_joined(spark, sf_dir):
    """Five hot keys would carry all texts; names of any origin reach the rows as a map."""
    from revlens.operators.documents import with_name
    from revlens.plans.queries import _segment_profiles

    rows = sample.annotated(spark, sf_dir)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        names = _segment_profiles(spark, sf_dir).selectExpr("cluster_id as id", "name")
        plan = plan_of(with_name(rows, "cluster_pred", names, "Cluster"))
        assert "SortMergeJoin" in plan
        assert not [x for x in plan.splitlines() if "Join" in x and "cluster_pred" in x]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_every_query_has_sql_or_trains_or_hashes():
    without = set(REGISTRY) - set(oracle_sql())
    assert without == {
        "grid_search", "sentiment_predictions", "topic_distribution", "topic_terms",
        "topic_interpretations", "kmeans_sweep", "segment_assignments", "model_metadata",
        "split_counts", "hash_segment",
    }
    assert set(oracle_sql()) <= set(REGISTRY)


def test_segments_do_not_depend_on_the_layout(spark, prepared):
    """Files, cores and earlier shuffles decide nothing about a model."""
    from pyspark.sql import functions as F

    from revlens.plans import train_segments

    rows = prepared.withColumn("topic_probabilities", F.lit(None).cast("array<double>"))
    found = []
    for partitions in (8, 64, 200):
        dealt = rows.repartition(partitions, F.rand(partitions))
        _, scaled = train_segments.scaled_features(dealt)
        found.append([(k, score) for k, score, _ in train_segments.sweep(scaled)])
    assert found[0] == found[1] == found[2]


def test_models_before_segments_are_not_run_by_a_filter(spark, sf_dir, prepared, topic_model):
    model, _, profiles = train_segments.train_segments(topic_model[0].transform(prepared))
    names = profiles.select(F.col("cluster_id").alias("id"), "name")
    scorer = sample.ReviewScorer(
        default_topic_names(spark), names, {"topic": topic_model[0], "clustering": model})
    scored = scorer.documents(sample.reviews(spark, sf_dir, labelled=False))
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert "UDF" in plan
    assert not [line for line in plan.splitlines() if "Filter" in line and "UDF" in line]
    assert scored.count() == sample.prepared(spark, sf_dir).count()
