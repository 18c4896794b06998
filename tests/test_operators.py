"""Operators against brute force or Spark ML on small inputs."""

import math

import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, CountVectorizer, StopWordsRemover
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from revlens.fixed_values import ENGLISH_STOP_WORDS, TOPIC_THEMES
from revlens.operators import anomalies, documents, features, quality, reports, segments, tokens, topics
from revlens.operators.prepare import prepare_reviews
from revlens.plans.queries import EMBEDDING_SIZE
from revlens.plans.sample import table
from revlens.runtime import small_table
from revlens.sources import lookups

REVIEW = "Review string, Summary string, Rate string, Sentiment string"


# --- prepare ------------------------------------------------------------------

def test_prepare_keeps_rows_with_text_and_label(spark):
    rows = [
        ("Good", None, "4", "positive"), ("", None, "4", "positive"), ("nan", "NaN", "4", "positive"),
        ("fine", "", "x", "neutral"), (None, "bad", None, "Negative"), ("a", "", "nan", None),
    ]
    reviews = spark.createDataFrame(rows, REVIEW)
    training = prepare_reviews(reviews, training=True).collect()
    assert {(r.text_combined, r.sentiment_label, r.Rate_num) for r in training} == {
        ("good ", 1, 4.0), (" bad", 0, 0.0)
    }
    scoring = prepare_reviews(reviews, training=False)
    assert scoring.count() == 4
    assert {r.sentiment_label for r in scoring.collect()} == {0}
    assert {r.review_length for r in scoring.collect()} == {4.0, 0.0, 1.0}


def test_prepare_without_optional_columns(spark):
    bare = spark.createDataFrame([("Good", "one")], "Review string, Summary string")
    row = prepare_reviews(bare, training=True).first()
    assert (row.sentiment_label, row.Rate_num) == (0, 0.0)


# --- tokens -------------------------------------------------------------------

def test_stop_words_are_sparks_own():
    assert sorted(ENGLISH_STOP_WORDS) == sorted(StopWordsRemover.loadDefaultStopWords("english"))


def test_topic_stop_words():
    words = tokens.topic_stop_words()
    assert {"good", "really", "the", "wow"} <= set(words)
    assert not {"i", "a", "s", "t"} & set(words)


TEXTS = [("a b a", 1), ("b c", 2), ("c c c", 3), ("a", 4), ("", 5)]


@pytest.fixture(scope="module")
def small_texts(spark):
    rows = spark.createDataFrame(TEXTS, "text string, id int")
    return rows.withColumn("terms", F.filter(F.split("text", " "), lambda t: t != ""))


def test_term_statistics(small_texts):
    rows = tokens.term_statistics(small_texts, "terms").collect()
    assert {(r.term, r.term_count, r.doc_count) for r in rows} == {
        ("a", 3, 2), ("b", 2, 2), ("c", 4, 2)
    }


def test_vocabulary_and_idf_match_spark_ml(small_texts):
    for min_df, max_df in ((1, None), (3, None), (2, 0.4), (1, 0.3)):
        ours = tokens.vocabulary(small_texts, "terms", 50, min_df, max_df)
        limit = {} if max_df is None else {"maxDF": max_df}
        theirs = CountVectorizer(
            inputCol="terms", outputCol="v", vocabSize=50, minDF=min_df, **limit
        ).fit(small_texts)
        assert {r.term for r in ours.collect()} == set(theirs.vocabulary)
    vectorizer = CountVectorizer(inputCol="terms", outputCol="v", vocabSize=50).fit(small_texts)
    idf = IDF(inputCol="v", outputCol="w").fit(vectorizer.transform(small_texts))
    expected = dict(zip(vectorizer.vocabulary, idf.idf.toArray()))
    ours = tokens.idf_weights(small_texts, tokens.vocabulary(small_texts, "terms", 50, 1))
    for row in ours.collect():
        assert row.idf == pytest.approx(expected[row.term])


def test_bigrams_of_short_texts(spark):
    rows = spark.createDataFrame([("good phone",), ("good ",), (" phone",)], "text_combined string")
    assert [r.bigrams for r in tokens.with_bigrams(rows).collect()] == [
        ["good phone"], [], [" phone"]
    ]


# --- features and quality -----------------------------------------------------

def test_standardized(spark):
    rows = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, b double")
    scaled = features.standardized(rows, ["a", "b"]).orderBy("a").collect()
    assert [(r.scaled_a, r.scaled_b) for r in scaled] == [(-1.0, 0.0), (0.0, 0.0), (1.0, 0.0)]


def test_segment_features_never_null(spark):
    rows = spark.createDataFrame(
        [("a b ", None, None, None, float("nan"))],
        "text_combined string, Review string, Summary string, label double, Rate_num float",
    )
    row = features.segment_features(rows, "label").select(*features.SEGMENT_INPUTS).first()
    assert tuple(row) == (4.0, 0.0, 0.0, 0.0, 0.0, 3.0, 0.2, 0.2, 0.2, 0.2, 0.2)


def test_metrics_match_spark_ml(spark):
    pairs = [(1, 1.0)] * 7 + [(1, 0.0)] * 3 + [(0, 0.0)] * 4 + [(0, 1.0)] * 2 + [(0, -1.0)]
    rows = spark.createDataFrame(pairs, "label int, prediction double")
    ours = quality.classifier_metrics(quality.confusion(rows, "label", "prediction")).first()
    names = {"accuracy": "accuracy", "f1_score": "f1", "precision": "weightedPrecision",
             "recall": "weightedRecall"}
    for name, theirs in names.items():
        evaluator = MulticlassClassificationEvaluator(labelCol="label", metricName=theirs)
        assert ours[name] == pytest.approx(evaluator.evaluate(rows)), name


def test_silhouette_matches_spark_ml(spark, sf_dir):
    points = table(spark, sf_dir, "embeddings").select("embedding", F.col("label").alias("prediction"))
    ours = quality.silhouette(points, "prediction", "embedding", EMBEDDING_SIZE).first()
    vectors = points.withColumn("features", array_to_vector(F.col("embedding").cast("array<double>")))
    assert ours.silhouette == pytest.approx(ClusteringEvaluator().evaluate(vectors), abs=1e-9)


def test_silhouette_of_a_single_point_is_zero(spark):
    rows = [(0, [0.0, 0.0]), (1, [5.0, 0.0]), (1, [5.0, 1.0])]
    points = spark.createDataFrame(rows, "c int, v array<double>")
    scored = quality.point_silhouettes(points, "c", "v", 2)
    assert {r.silhouette for r in scored.filter("c = 0").collect()} == {0.0}


# --- topics -------------------------------------------------------------------

WORDS = {
    0: "delivery shipping arrived slow box",             # one theme
    1: "price money product quality odd",                # tie, earlier theme wins
    2: "battery random words here only",                 # overlap below two
    3: "service support help battery camera",            # larger overlap wins
    4: "lonely",                                         # a single word
}


@pytest.fixture(scope="module")
def fixed_terms(spark):
    rows = [
        (topic, rank, word, 1.0 / rank)
        for topic, words in WORDS.items() for rank, word in enumerate(words.split(), start=1)
    ]
    return spark.createDataFrame(rows, "topic int, rank int, word string, weight double")


def test_topic_names(spark, fixed_terms):
    names = topics.topic_names(fixed_terms, topics.theme_table(spark)).collect()
    assert {r.topic: r.name for r in names} == {
        0: "Delivery & Shipping", 1: "Price & Value", 2: "Battery & Random",
        3: "Customer Service", 4: "Lonely",
    }


def test_topic_interpretations(spark, fixed_terms):
    rows = topics.topic_interpretations(fixed_terms, topics.theme_table(spark)).collect()
    first = next(r for r in rows if r.topic_id == 0)
    assert first.keywords == WORDS[0].split()
    assert [w.word for w in first.top_words] == WORDS[0].split()
    assert first.top_words[1].weight == 0.5


def test_theme_overlap_counts_distinct_words(spark, fixed_terms):
    overlap = topics.theme_overlap(fixed_terms, topics.theme_table(spark)).collect()
    found = {(r.topic, r.theme): r.overlap for r in overlap}
    for topic, words in WORDS.items():
        for theme, keywords in TOPIC_THEMES.items():
            expected = len(set(words.split()) & set(keywords))
            assert found.get((topic, theme), 0) == expected


def test_topic_terms_drop_positions_outside_the_vocabulary(spark):
    described = spark.createDataFrame(
        [(0, [1, 9], [0.7, 0.3])], "topic int, termIndices array<int>, termWeights array<double>"
    )
    words = small_table(spark, [(0, "a"), (1, "b")], "term_index int, word string")
    assert [tuple(r) for r in topics.topic_terms(described, words).collect()] == [(0, 1, "b", 0.7)]


def test_strongest_terms(spark):
    rows = [("x", f"w{i:03d}", i // 2) for i in range(300)] + [("y", "only", 1)]
    statistics = spark.createDataFrame(rows, "group string, term string, term_count long")
    top = topics.strongest_terms(statistics, "group", 4).orderBy("topic", "rank").collect()
    assert [r.word for r in top] == ["w298", "w299", "w296", "w297", "only"]


# --- segments -----------------------------------------------------------------

@pytest.mark.parametrize("sentiment, rating, length, name", [
    (0.2, 2.0, 100.0, "Critical Issues"),
    (0.3, 2.0, 100.0, "Complaints & Concerns"),
    (0.2, 2.5, 100.0, "Complaints & Concerns"),
    (0.5, 3.0, 100.0, "Mixed Feedback"),
    (0.8, 4.5, 100.0, "Satisfied Customers"),
    (0.7, 4.5, 100.0, "Generally Positive"),
    (0.8, 4.0, 100.0, "Generally Positive"),
    (0.6, 3.5, 100.0, "Mixed Feedback"),
    (0.8, 4.5, 201.0, "Satisfied Customers (Detailed)"),
    (0.8, 4.5, 200.0, "Satisfied Customers"),
    (0.8, 4.5, 49.0, "Satisfied Customers (Brief)"),
    (0.8, 4.5, 50.0, "Satisfied Customers"),
    (None, None, None, "Critical Issues (Brief)"),
])
def test_segment_names(spark, sentiment, rating, length, name):
    rows = spark.createDataFrame(
        [(sentiment, rating, length)], "avg_sentiment double, avg_rating double, avg_length double"
    )
    row = segments.with_segment_names(rows).first()
    assert row.name == name
    assert row.description.endswith("Detailed reviews") == name.endswith("(Detailed)")
    assert row.description.endswith("Brief feedback") == name.endswith("(Brief)")


def test_hash_segment_survives_the_smallest_hash(spark):
    ids = spark.range(2000).select(F.concat(F.lit("review_"), "id").alias("r"))
    assert {r[0] for r in ids.select(segments.hash_segment(F.col("r"))).collect()} == {0, 1, 2}


def test_nearest_center_matches_kmeans(spark, sf_dir):
    points = table(spark, sf_dir, "embeddings").select(
        F.col("embedding").cast("array<double>").alias("v")
    )
    vectors = points.withColumn("features", array_to_vector("v"))
    model = KMeans(k=4, seed=1).fit(vectors)
    centers = spark.createDataFrame(
        [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())],
        "center int, position array<double>",
    )
    both = segments.nearest_center(model.transform(vectors), "v", centers)
    assert both.filter("nearest <> prediction").count() == 0


# --- documents and reports ----------------------------------------------------

def test_names_default_to_the_id(spark):
    rows = spark.createDataFrame([(0,), (7,), (-1,)], "topic_pred int")
    named = documents.with_name(rows, "topic_pred", lookups.default_topic_names(spark), "Topic")
    assert {r.topic_pred: r.topic_pred_name for r in named.collect()} == {
        0: "Product Quality", 7: "Topic 7", -1: "Topic -1"
    }


def test_flattened_accepts_both_forms(spark):
    nested = spark.sql("select named_struct('id', 2, 'name', 'X') topic, cast(null as struct<id:int,name:string>) cluster")
    assert tuple(documents.flattened(nested).first()[2:]) == (2, "X", -1, "Unknown")
    plain = spark.sql("select 2 topic, -1 cluster")
    assert tuple(documents.flattened(plain).first()[2:]) == (2, "Topic 2", -1, "Unknown")
    missing = spark.sql("select 1 a")
    assert tuple(documents.flattened(missing).first()[1:]) == (-1, "Unknown", -1, "Unknown")


DOCS = [
    ("a", "text", 4.0, 1.0, 0, "T0", 0, "S"), ("b", "text", 9.0, 0.0, 0, "T0", 1, "S"),
    ("c", "text", None, -1.0, 1, "T1", 1, "S"), ("d", "", 4.0, 1.0, 0, "T0", 0, "S"),
    ("e", None, 4.0, 1.0, 0, "T0", 0, "S"), ("f", "Unknown", 4.0, 1.0, 0, "T0", 0, "S"),
    ("g", "text", 2.0, 0.0, -1, "Unknown", -1, "Unknown"),
]


@pytest.fixture(scope="module")
def report(spark):
    rows = spark.createDataFrame(
        DOCS, "review_id string, review_text string, rating double, sentiment double, "
        "t int, tn string, c int, cn string",
    )
    nested = rows.withColumns({
        "topic": F.struct(F.col("t").alias("id"), F.col("tn").alias("name")),
        "cluster": F.struct(F.col("c").alias("id"), F.col("cn").alias("name")),
    })
    return documents.reportable(nested)


def test_reportable(report):
    assert {r.review_id: r.rating for r in report.collect()} == {"a": 4, "b": 5, "c": 3, "g": 2}


def test_reports(report):
    kpi = reports.kpi_summary(report).first()
    assert (kpi.total_reviews, kpi.positive_reviews, kpi.negative_reviews) == (4, 1, 2)
    assert kpi.positive_pct == pytest.approx(33.3333)
    assert reports.segment_count(report).first()[0] == 2
    assert [tuple(r) for r in reports.topic_counts(report).collect()] == [("T0", 2), ("T1", 1)]
    assert [tuple(r) for r in reports.top_topics(report, 2).collect()] == [("T0", 2), ("T1", 1)]
    assert [tuple(r) for r in reports.topic_summary(report).collect()] == [
        ("T0", 2, 0.5, 4.5), ("T1", 1, -1.0, 3.0)
    ]
    cross = reports.topic_sentiment_crosstab(report).orderBy("topic_name").collect()
    assert [tuple(r) for r in cross] == [("T0", 1, 1, 0), ("T1", 0, 0, 1)]
    assert [tuple(r) for r in reports.segment_counts(report).collect()] == [("S", 3)]
    assert [tuple(r) for r in reports.segment_counts_by_id(report).collect()] == [
        (0, "Segment 0", 1), (1, "Segment 1", 2)
    ]
    assert reports.topic_drilldown(report, "T0").count() == 2
    assert reports.segment_drilldown(report, 1).count() == 2


def test_reports_on_nothing(report):
    kpi = reports.kpi_summary(report.filter("false")).first()
    assert tuple(kpi) == (0, 0, 0, 0.0, 0.0)


def test_evaluation_display(spark):
    rows = [("2024-01-01T10:00:00", 0.9, 0.5, None), ("2024-03-01T10:30:00", 0.8125, 0.25, -3.5)]
    evaluations = spark.createDataFrame(
        [(d, a, a, a, a, s, p) for d, a, s, p in rows],
        "training_date string, accuracy double, f1_score double, precision double, recall double, "
        "clustering_Silhouette_score double, topic_modeling_logPerplexity_score double",
    )
    current = reports.current_evaluation(evaluations).first()
    assert (current.accuracy, current.f1_score, current.log_perplexity, current.last_trained) == (
        "81.3%", "0.813", "-3.500", "2024-03-01 10:30"
    )
    history = reports.training_history(evaluations).collect()
    assert [r.date for r in history] == ["2024-03-01T10:30:00", "2024-01-01T10:00:00"]
    assert history[1].log_perplexity is None


def test_open_alerts_take_the_newest_first(spark):
    rows = [(str(i), f"2024-01-{i:02d}") for i in range(1, 6)]
    alerts = spark.createDataFrame(rows, "alert_id string, timestamp string")
    dismissed = spark.createDataFrame([("5",), ("1",)], "alert_id string")
    left = reports.open_alerts(alerts, dismissed).collect()
    assert {(r.alert_id, r.level) for r in left} == {("4", "warning"), ("3", "warning")}


# --- anomalies ----------------------------------------------------------------

def test_alert_only_strictly_above_the_threshold(spark):
    rows = [("at", 0.0)] * 7 + [("at", 1.0)] * 3 + [("over", 0.0)] * 5 + [("over", -1.0)] * 2
    scored = spark.createDataFrame(rows, "batch_key string, sentiment double")
    raised = anomalies.anomalous(anomalies.negative_share(scored, "batch_key"))
    alerts = anomalies.alert_documents(raised, F.lit("now"), keep=("batch_key",)).collect()
    assert [(a.type, a.message, a.batch_key) for a in alerts] == [
        ("high_negative", "High negative sentiment: 71% in batch", "over")
    ]


def test_idf_formula(small_texts):
    weights = tokens.idf_weights(small_texts, tokens.vocabulary(small_texts, "terms", 1, 1))
    assert weights.first().idf == pytest.approx(math.log((5 + 1) / (2 + 1)))


def test_vectorizer_order_is_total(small_texts):
    model = tokens.vectorizer(small_texts, "terms", "v", 2, 1)
    assert model.vocabulary == ["c", "a"]
    counts = model.transform(small_texts).orderBy("id").collect()
    assert [list(r.v.toArray()) for r in counts] == [[0, 2], [1, 0], [3, 0], [0, 1], [0, 0]]


@pytest.mark.parametrize("size", [1, 2, 7, 50, 333, 1999, 2000, 5000])
def test_vocabulary_selection_equals_sorting(spark, size):
    """Counts over three digits of the histogram, and many ties."""
    import random

    chance = random.Random(5)
    counts = [chance.choice([1, 1, 1, 2, 3, 900, 1024, 1025, 5000, 2_000_000, 1 << 31])
              for _ in range(2000)]
    rows = [(f"t{i * 7919 % 2000}", n, 1) for i, n in enumerate(counts)]
    statistics = spark.createDataFrame(
        rows, "term string, term_count long, doc_count long").repartition(5)
    got = tokens.most_frequent(statistics, size)
    expected = sorted(rows, key=lambda r: (-r[1], r[0]))[:size]
    assert sorted(map(tuple, got.collect())) == sorted(expected)


def test_no_task_gathers_the_candidates_of_all_others(spark):
    rows = spark.range(3000).select(
        F.concat(F.lit("t"), "id").alias("term"), F.lit(4).cast("long").alias("term_count"),
        F.lit(4).cast("long").alias("doc_count"))
    plan = tokens.most_frequent(rows, 100)._jdf.queryExecution().toString()
    assert "TakeOrdered" not in plan and "GlobalLimit" not in plan


def test_a_document_sends_one_row_per_occurrence(spark):
    rows = spark.createDataFrame(
        [(["b", "a", "b"], 1), (["b"], 1), ([], 1), (["a", "a"], 2)], "terms array<string>, fold int")
    counted = tokens.term_counts_by(rows, "terms", "fold")
    assert "array_distinct" not in counted._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, counted.collect()), key=str) == [
        (1, "a", 1, 1), (1, "b", 3, 2), (1, None, 0, 3), (2, "a", 2, 1), (2, None, 0, 1)]
