"""Registered queries: (spark, sf_dir) -> DataFrame over the sample tables."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.fixed_values import (
    BIGRAM_MIN_DF,
    BIGRAM_VOCABULARY,
    TOPIC_MAX_DF,
    TOPIC_MIN_DF,
    TOPIC_VOCABULARY,
)
from revlens.functions import (
    alert_level,
    first_argmax,
    known_prediction,
    label_of,
    model_rating,
    name_of,
    report_rating,
    sink_rating,
)
from revlens.operators import documents as docs
from revlens.operators import features, prepare, quality, reports, segments, splits, tokens, topics
from revlens.operators.anomalies import (
    anomalous,
    alert_message,
    different_in,
    negative_share,
    windowed_negative_share,
)
from revlens.functions.text import cleaned
from revlens import schemas
from revlens.plans import sample, train_segments, train_sentiment, train_topics, training
from revlens.runtime import fresh_path, materialized, small_table
from revlens.sources import commits, files, lookups, message_log, messages, models, tables
from revlens.streaming import scoring, windows

EMBEDDING_SIZE = 64
LEARNED_THEME_TERMS = 20

REGISTRY = {}


def query(function):
    REGISTRY[function.__name__] = function
    return function


# --- sources ------------------------------------------------------------------

@query
def scan_reviews_csv(spark, sf_dir) -> DataFrame:
    path = fresh_path(spark, "csv")
    columns = files.TRAINING_FILE.names
    files.write_csv(sample.reviews(spark, sf_dir).select(*columns), path)
    return files.read_csv(spark, path)


@query
def stage_and_number(spark, sf_dir) -> DataFrame:
    staged = files.stage(sample.reviews(spark, sf_dir, labelled=False), fresh_path(spark, "staged"))
    numbered = files.numbered(staged, "n")
    return numbered.agg(
        F.count("*").alias("reviews"), F.min("n").alias("first"), F.max("n").alias("last"),
        F.countDistinct("n").alias("numbers"),
    )


@query
def replay_messages(spark, sf_dir) -> DataFrame:
    return messages.encode(sample.reviews(spark, sf_dir, labelled=False))


@query
def json_decode(spark, sf_dir) -> DataFrame:
    return messages.decode(messages.encode(sample.reviews(spark, sf_dir, labelled=False)))


@query
def malformed_messages(spark, sf_dir) -> DataFrame:
    """Every review sent once as broken text and once properly; the broken ones are put aside."""
    rows = sample.reviews(spark, sf_dir, labelled=False)
    broken = rows.select(F.concat(F.lit("{"), "review_id").alias("value"))
    decoded = messages.decode(broken.unionAll(messages.encode(rows)), keep_corrupt=True)
    return decoded.groupBy(F.col(messages.CORRUPT).isNotNull().alias("malformed")).agg(
        F.count("*").alias("messages"), F.count("review_id").alias("with_id")
    )


@query
def interpretation_lookup(spark, sf_dir) -> DataFrame:
    """Segment names saved by one job and read by another."""
    path = fresh_path(spark, "segments")
    profiles = _segment_profiles(spark, sf_dir)
    lookups.save_interpretations(segments.segment_interpretations(profiles), path)
    return lookups.segment_names(spark, path)


# --- scalar expressions -------------------------------------------------------

@query
def label_sentiment(spark, sf_dir) -> DataFrame:
    return sample.reviews(spark, sf_dir).select(
        "review_id", label_of(F.col("Sentiment")).alias("sentiment_label")
    )


@query
def clean_text(spark, sf_dir) -> DataFrame:
    return prepare.with_text(sample.reviews(spark, sf_dir, labelled=False)).select(
        "review_id", "cleaned_review", "cleaned_summary"
    )


@query
def combine_text(spark, sf_dir) -> DataFrame:
    return prepare.with_text(sample.reviews(spark, sf_dir, labelled=False)).select(
        "review_id", "text_combined", F.length("text_combined").cast("long").alias("n_chars")
    )


@query
def text_lengths(spark, sf_dir) -> DataFrame:
    return prepare.with_numbers(sample.reviews(spark, sf_dir, labelled=False)).select(
        "review_id", F.col("review_length").cast("double").alias("review_length"),
        F.col("summary_length").cast("double").alias("summary_length"),
    )


def _ratings(spark, sf_dir, rating) -> DataFrame:
    return sample.reviews(spark, sf_dir, labelled=False).select(
        "review_id", "Rate", rating.cast("double").alias("rating")
    )


@query
def numeric_rating(spark, sf_dir) -> DataFrame:
    return _ratings(spark, sf_dir, model_rating(F.col("Rate")))


@query
def clamp_rating(spark, sf_dir) -> DataFrame:
    return _ratings(spark, sf_dir, sink_rating(F.col("Rate")))


@query
def report_rating_query(spark, sf_dir) -> DataFrame:
    return _ratings(spark, sf_dir, report_rating(F.col("Rate")))


REGISTRY["report_rating"] = REGISTRY.pop("report_rating_query")


@query
def sanitize_prediction(spark, sf_dir) -> DataFrame:
    """Ratings in place of predictions: only 0 and 1 are known classes."""
    return sample.reviews(spark, sf_dir, labelled=False).select(
        "review_id",
        known_prediction(model_rating(F.col("Rate")).cast("double")).alias("sentiment_pred"),
    )


@query
def name_sentiment(spark, sf_dir) -> DataFrame:
    return sample.reviews(spark, sf_dir).select(
        "review_id", name_of(label_of(F.col("Sentiment"))).alias("sentiment_name")
    )


@query
def hash_segment(spark, sf_dir) -> DataFrame:
    return sample.reviews(spark, sf_dir, labelled=False).select(
        "review_id", segments.hash_segment(F.col("review_id")).alias("cluster_pred")
    )


@query
def cluster_features(spark, sf_dir) -> DataFrame:
    rows = features.segment_features(sample.annotated(spark, sf_dir), "sentiment_pred")
    return rows.select("review_id", *features.SEGMENT_INPUTS)


@query
def dominant_topic(spark, sf_dir) -> DataFrame:
    vectors = sample.table(spark, sf_dir, "embeddings")
    return vectors.select("vec_id", first_argmax(F.col("embedding")).alias("topic_pred"))


@query
def alert_level_query(spark, sf_dir) -> DataFrame:
    return sample.alerts(spark, sf_dir).select(
        "alert_id", alert_level(F.col("severity")).alias("level")
    )


REGISTRY["alert_level"] = REGISTRY.pop("alert_level_query")


# --- filters and counts -------------------------------------------------------

@query
def training_rows(spark, sf_dir) -> DataFrame:
    return sample.prepared(spark, sf_dir, training=True).select(
        "review_id", "sentiment_label", "text_combined",
        F.col("Rate_num").cast("double").alias("Rate_num"),
    )


@query
def scoring_rows(spark, sf_dir) -> DataFrame:
    return sample.prepared(spark, sf_dir).select("review_id", "sentiment_label", "text_combined")


@query
def row_counts(spark, sf_dir) -> DataFrame:
    """How many reviews have a text, a label, both."""
    labelled = prepare.with_text(prepare.with_label(sample.reviews(spark, sf_dir), True))
    return labelled.agg(
        F.count("*").alias("reviews"),
        F.count_if(prepare.has_text()).alias("scoring_rows"),
        F.count_if(prepare.has_label()).alias("labelled_rows"),
        F.count_if(prepare.has_text() & prepare.has_label()).alias("training_rows"),
    )


@query
def observed_counts(spark, sf_dir) -> DataFrame:
    """Rows kept and dropped, observed while the training rows are written."""
    counts = prepare.RowCounts()
    rows = prepare.prepare_reviews(sample.reviews(spark, sf_dir), training=True, counts=counts)
    materialized(rows.select("review_id", "text_combined"), "observed")
    found = counts.get()
    return small_table(
        spark, [tuple(found.values())], ", ".join(f"{name} bigint" for name in found))


@query
def label_counts(spark, sf_dir) -> DataFrame:
    return training.label_counts(sample.prepared(spark, sf_dir, training=True))


@query
def reportable_reviews(spark, sf_dir) -> DataFrame:
    return sample.report_rows(spark, sf_dir).select("review_id", "review_text", "rating")


# --- documents and lookups ----------------------------------------------------

def _readable(documents: DataFrame) -> DataFrame:
    """Nested fields as JSON text, for comparison with SQL."""
    return documents.select(
        "review_id", "product", "category", "review_text", "summary", "rating", "sentiment",
        "sentiment_label", F.to_json("topic").alias("topic"), F.to_json("cluster").alias("cluster"),
        "timestamp",
    )


@query
def scored_documents(spark, sf_dir) -> DataFrame:
    return _readable(sample.documents(spark, sf_dir))


@query
def topic_name_lookup(spark, sf_dir) -> DataFrame:
    names = lookups.default_topic_names(spark)
    named = docs.with_name(sample.annotated(spark, sf_dir), "topic_pred", names, "Topic")
    return named.select("review_id", "topic_pred", F.col("topic_pred_name").alias("topic_name"))


@query
def segment_name_lookup(spark, sf_dir) -> DataFrame:
    names = lookups.default_segment_names(spark)
    named = docs.with_name(sample.annotated(spark, sf_dir), "cluster_pred", names, "Cluster")
    return named.select(
        "review_id", "cluster_pred", F.col("cluster_pred_name").alias("cluster_name")
    )


FLAT = ["review_id", "topic_id", "topic_name", "cluster_id", "cluster_name"]


@query
def flatten_documents(spark, sf_dir) -> DataFrame:
    return docs.flattened(sample.documents(spark, sf_dir)).select(*FLAT)


@query
def flatten_plain_ids(spark, sf_dir) -> DataFrame:
    """Documents of the older form, whose topic and cluster are plain ids."""
    older = sample.documents(spark, sf_dir).withColumns(
        {"topic": F.col("topic.id"), "cluster": F.col("cluster.id")}
    )
    return docs.flattened(older).select(*FLAT)


@query
def document_defaults(spark, sf_dir) -> DataFrame:
    """Documents without sentiment, rating, topic or cluster."""
    bare = sample.documents(spark, sf_dir).select("review_id", "review_text", "product")
    return docs.reportable(bare).select(
        "review_id", "product", "category", "sentiment", "rating", "topic_id", "topic_name",
        "cluster_id", "cluster_name",
    )


# --- anomalies and alerts -----------------------------------------------------

@query
def batch_anomaly(spark, sf_dir) -> DataFrame:
    raised = anomalous(sample.batch_shares(spark, sf_dir))
    return raised.select(
        "batch_key", "total_reviews", "negative_reviews",
        F.round("negative_pct", 4).alias("negative_pct"),
        alert_message(F.col("negative_pct")).alias("message"),
    )


@query
def windowed_anomaly(spark, sf_dir) -> DataFrame:
    return _window_rows(windowed_negative_share(sample.documents(spark, sf_dir), "1 hour"))


def _window_rows(shares: DataFrame) -> DataFrame:
    return shares.select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        "total_reviews", "negative_reviews", F.round("negative_pct", 4).alias("negative_pct"),
        (F.col("negative_pct") > 70).alias("alert"),
    )


@query
def recent_alerts(spark, sf_dir) -> DataFrame:
    newest = reports.recent_alerts(sample.alerts(spark, sf_dir))
    return newest.select("alert_id", "type", "message", "timestamp", "level")


@query
def open_alerts(spark, sf_dir) -> DataFrame:
    """Alerts on Spanish batches have been dismissed."""
    alerts = sample.alerts(spark, sf_dir)
    dismissed = alerts.filter(F.col("alert_id").startswith("es-")).select("alert_id")
    return reports.open_alerts(alerts, dismissed).select("alert_id", "message", "timestamp")


# --- reports ------------------------------------------------------------------

def _report(name, build):
    REGISTRY[name] = lambda spark, sf_dir: build(sample.report_rows(spark, sf_dir))


for _name in (
    "kpi_summary", "segment_count", "sentiment_distribution", "topic_counts", "top_topics",
    "topic_sentiment_crosstab", "topic_summary", "distinct_topics", "distinct_segments",
    "topic_sentiment_breakdown", "segment_counts", "segment_counts_by_id",
):
    _report(_name, getattr(reports, _name))


@query
def report_page(spark, sf_dir) -> DataFrame:
    """The whole report page from one scan, its numbers in one column."""
    groups = materialized(reports.page_groups(sample.report_rows(spark, sf_dir)), "page")
    rows = None
    for name, table in reports.report_page(groups).items():
        keys = [c for c in table.columns if c.endswith(("_name", "_label"))]
        numbers = F.array(*[F.struct(F.lit(c).alias("number"), F.col(c).cast("double").alias("value"))
                            for c in table.columns if c not in keys])
        part = table.select(F.lit(name).alias("report"), (F.col(keys[0]) if keys else F.lit(""))
                            .alias("item"), F.inline(numbers))
        rows = part if rows is None else rows.unionByName(part)
    return rows


@query
def topic_drilldown(spark, sf_dir) -> DataFrame:
    chosen = reports.topic_drilldown(sample.report_rows(spark, sf_dir), "Price & Value")
    return chosen.select("review_id", "product", "sentiment_label", "rating", "review_text")


@query
def segment_drilldown(spark, sf_dir) -> DataFrame:
    chosen = reports.segment_drilldown(sample.report_rows(spark, sf_dir), "Mixed Feedback")
    return chosen.select("review_id", "product", "sentiment_label", "rating", "review_text")


@query
def segment_drilldown_by_id(spark, sf_dir) -> DataFrame:
    chosen = reports.segment_drilldown(sample.report_rows(spark, sf_dir), 3)
    return chosen.select("review_id", "product", "sentiment_label", "rating", "review_text")


@query
def recent_reviews(spark, sf_dir) -> DataFrame:
    newest = reports.recent_reviews(sample.documents(spark, sf_dir))
    return newest.select("review_id", "timestamp", "product", "rating", "sentiment_label")


@query
def latest_evaluation(spark, sf_dir) -> DataFrame:
    return reports.current_evaluation(sample.evaluations(spark, sf_dir))


@query
def training_history(spark, sf_dir) -> DataFrame:
    return reports.training_history(sample.evaluations(spark, sf_dir))


# --- text operators -----------------------------------------------------------

def _joined(rows: DataFrame, column: str) -> DataFrame:
    return rows.select(
        "review_id", F.size(column).cast("long").alias("n_tokens"),
        F.array_join(column, "|").alias("tokens"),
    )


@query
def tokenize(spark, sf_dir) -> DataFrame:
    return _joined(tokens.tokenizer().transform(sample.prepared(spark, sf_dir)), "words")


@query
def remove_stopwords(spark, sf_dir) -> DataFrame:
    words = tokens.tokenizer().transform(sample.prepared(spark, sf_dir))
    return _joined(tokens.stop_word_remover().transform(words), "words_filtered")


@query
def bigrams(spark, sf_dir) -> DataFrame:
    return _joined(tokens.with_bigrams(sample.prepared(spark, sf_dir)), "bigrams")


@query
def tokenize_regex(spark, sf_dir) -> DataFrame:
    return _joined(tokens.topic_tokenizer().transform(sample.prepared(spark, sf_dir)), "words")


@query
def remove_topic_stopwords(spark, sf_dir) -> DataFrame:
    return _joined(tokens.with_topic_words(sample.prepared(spark, sf_dir)), "filtered")


def _bigram_vocabulary(spark, sf_dir):
    rows = tokens.with_bigrams(sample.prepared(spark, sf_dir, training=True))
    return rows, *tokens.vocabulary_of(rows, "bigrams", BIGRAM_VOCABULARY, BIGRAM_MIN_DF)


@query
def vocabulary(spark, sf_dir) -> DataFrame:
    return _bigram_vocabulary(spark, sf_dir)[1]


@query
def idf_weights(spark, sf_dir) -> DataFrame:
    rows, terms, total = _bigram_vocabulary(spark, sf_dir)
    return tokens.idf_weights(rows, terms, total).withColumn("idf", F.round("idf", 6))


@query
def topic_vocabulary(spark, sf_dir) -> DataFrame:
    rows = tokens.with_topic_words(sample.prepared(spark, sf_dir, training=True))
    return tokens.vocabulary(rows, "filtered", TOPIC_VOCABULARY, TOPIC_MIN_DF, TOPIC_MAX_DF)


@query
def standardize(spark, sf_dir) -> DataFrame:
    rows = features.standardized(
        sample.prepared(spark, sf_dir, training=True), prepare.NUMERIC_INPUTS
    )
    return rows.select(
        "review_id",
        *[F.round(f"scaled_{c}", 4).alias(f"scaled_{c}") for c in prepare.NUMERIC_INPUTS],
    )


# --- quality ------------------------------------------------------------------

@query
def classifier_metrics(spark, sf_dir) -> DataFrame:
    counts = quality.confusion(
        sample.predictions(spark, sf_dir), "sentiment_label", "sentiment_pred"
    )
    metrics = quality.classifier_metrics(counts)
    return metrics.select(*[F.round(c, 6).alias(c) for c in metrics.columns])


def _embeddings(spark, sf_dir) -> DataFrame:
    return sample.table(spark, sf_dir, "embeddings")


@query
def silhouette(spark, sf_dir) -> DataFrame:
    score = quality.silhouette(_embeddings(spark, sf_dir), "label", "embedding", EMBEDDING_SIZE)
    return score.withColumn("silhouette", F.round("silhouette", 6))


@query
def kmeans_assign(spark, sf_dir) -> DataFrame:
    """Nearest of the mean vectors of the labels."""
    points = _embeddings(spark, sf_dir).withColumn(
        "embedding", F.col("embedding").cast("array<double>")
    )
    moments = quality.cluster_moments(points, "label", "embedding", EMBEDDING_SIZE)
    centers = moments.select(
        F.col("cluster").alias("center"),
        F.transform("total", lambda x: x / F.col("n")).alias("position"),
    )
    return segments.nearest_center(points, "embedding", centers).select("vec_id", "label", "nearest")


# --- topics and segments ------------------------------------------------------

def _topic_terms_by_count(spark, sf_dir) -> DataFrame:
    """The most used words of each rule-based topic."""
    rows = tokens.with_topic_words(sample.annotated(spark, sf_dir))
    counts = tokens.term_counts(rows, "filtered", "topic_pred")
    return topics.strongest_terms(counts, "topic_pred")


def _themes(spark, sf_dir) -> DataFrame:
    """The built-in themes, and after them one learned from each role's conversation turns."""
    turns = sample.table(spark, sf_dir, "conversations").select(
        "role", cleaned(F.col("text")).alias("text_combined")
    )
    counts = tokens.term_counts(tokens.with_topic_words(turns), "filtered", "role")
    learned = topics.strongest_terms(counts, "role", LEARNED_THEME_TERMS)
    built_in = topics.theme_table(spark)
    later = F.ascii("topic") + 100
    return built_in.unionByName(learned.select(
        later.alias("theme_order"), F.initcap("topic").alias("theme"), F.col("word").alias("keyword")
    ))


@query
def topic_words(spark, sf_dir) -> DataFrame:
    return _topic_terms_by_count(spark, sf_dir)


@query
def topic_theme_overlap(spark, sf_dir) -> DataFrame:
    overlap = topics.theme_overlap(_topic_terms_by_count(spark, sf_dir), _themes(spark, sf_dir))
    return overlap.select("topic", "theme", F.col("overlap").cast("long").alias("overlap"))


@query
def topic_naming(spark, sf_dir) -> DataFrame:
    """Named with the learned themes."""
    names = topics.topic_names(_topic_terms_by_count(spark, sf_dir), _themes(spark, sf_dir))
    return names.select("topic", "name", F.col("overlap").cast("long").alias("overlap"))


@query
def topic_naming_fallback(spark, sf_dir) -> DataFrame:
    """Named with the built-in themes, which this vocabulary hardly meets."""
    names = topics.topic_names(_topic_terms_by_count(spark, sf_dir), topics.theme_table(spark))
    return names.select("topic", "name")


def _segment_profiles(spark, sf_dir) -> DataFrame:
    members = features.segment_features(sample.annotated(spark, sf_dir), "sentiment_pred")
    return segments.segment_profiles(members, "cluster_pred")


@query
def cluster_profile(spark, sf_dir) -> DataFrame:
    return _segment_profiles(spark, sf_dir)


@query
def segment_naming(spark, sf_dir) -> DataFrame:
    """Many small groups of reviews, so that every naming rule has a case."""
    by = ["Product", "Category", "sentiment_pred"]
    members = features.segment_features(sample.annotated(spark, sf_dir), "sentiment_pred")
    statistics = members.groupBy(*by).agg(
        F.avg("sentiment_score").alias("avg_sentiment"), F.avg("rate_score").alias("avg_rating"),
        F.avg("text_len").alias("avg_length"),
    )
    return segments.with_segment_names(statistics).select(
        F.col("Product").alias("product"), F.col("Category").alias("category"),
        F.col("sentiment_pred").alias("sentiment"), "name", "description",
    )


# --- models -------------------------------------------------------------------

@query
def split_counts(spark, sf_dir) -> DataFrame:
    rows = splits.with_fold(
        splits.with_split(sample.prepared(spark, sf_dir, training=True), "review_id"), "review_id"
    )
    return rows.groupBy("split", "fold").agg(F.count("*").alias("reviews"))


def _training_rows(spark, sf_dir) -> DataFrame:
    return materialized(sample.prepared(spark, sf_dir, training=True), "prepared")


@query
def grid_search(spark, sf_dir) -> DataFrame:
    rows = _training_rows(spark, sf_dir).select("review_id", *train_sentiment.MODEL_INPUTS)
    return train_sentiment.grid_search(rows, "review_id", train_sentiment.full_grid(), parallel=8)


@query
def sentiment_predictions(spark, sf_dir) -> DataFrame:
    """The middle setting of the grid, applied to every review."""
    grid = train_sentiment.full_grid()
    model, _ = train_sentiment.train_sentiment(
        _training_rows(spark, sf_dir), "review_id", grid[len(grid) // 2:len(grid) // 2 + 1]
    )
    scored = model.transform(sample.prepared(spark, sf_dir))
    known = known_prediction(F.col("prediction"))
    return scored.select(
        "review_id", known.alias("sentiment_pred"), name_of(known).alias("sentiment_label")
    )


@query
def topic_distribution(spark, sf_dir) -> DataFrame:
    rows = _training_rows(spark, sf_dir)
    model, _ = train_topics.train_topics(rows)
    shares = vector_to_array("topicDistribution")
    scored = model.transform(sample.prepared(spark, sf_dir))
    return scored.select("review_id", shares.alias("shares"), first_argmax(shares).alias("topic"))


@query
def topic_terms(spark, sf_dir) -> DataFrame:
    model, _ = train_topics.train_topics(_training_rows(spark, sf_dir))
    return train_topics.described_terms(model, spark)


@query
def topic_interpretations(spark, sf_dir) -> DataFrame:
    model, _ = train_topics.train_topics(_training_rows(spark, sf_dir))
    return train_topics.interpret_topics(model, spark, _themes(spark, sf_dir))


@query
def kmeans_sweep(spark, sf_dir) -> DataFrame:
    """Silhouette of each number of segments."""
    _, scaled = train_segments.scaled_features(_training_rows(spark, sf_dir))
    scores = [(k, float(score)) for k, score, _ in train_segments.sweep(scaled)]
    return spark.createDataFrame(scores, "segments int, silhouette double")


@query
def segment_assignments(spark, sf_dir) -> DataFrame:
    """Every review scored with a topic and a segment model, and without a sentiment model."""
    rows = _training_rows(spark, sf_dir)
    topic_model, _ = train_topics.train_topics(rows)
    segment_model, _, profiles = train_segments.train_segments(topic_model.transform(rows))
    names = profiles.select(F.col("cluster_id").alias("id"), "name")
    scorer = sample.ReviewScorer(
        lookups.default_topic_names(spark), names,
        {"topic": topic_model, "clustering": segment_model},
    )
    return _readable(scorer.documents(sample.reviews(spark, sf_dir, labelled=False)))


@query
def scored_by_models(spark, sf_dir) -> DataFrame:
    """Every review scored by three trained models, loaded as a scoring job loads them, beside
    what the training job has stored about itself."""
    root = fresh_path(spark, "trained")
    grid = train_sentiment.full_grid()
    training.train_all(sample.reviews(spark, sf_dir), root, "review_id", grid[7:8])
    scorer = sample.ReviewScorer.load(spark, root)
    evaluation = spark.read.schema(schemas.EVALUATION).parquet(f"{root}/evaluations")
    topic_names = lookups.read_topic_interpretations(spark, f"{root}/topic_interpretations")
    known = topic_names.select(F.col("topic_id").alias("_topic"), F.col("name").alias("_name"))
    documents = scorer.documents(sample.reviews(spark, sf_dir, labelled=False))
    stored = evaluation.agg(F.first(F.struct(
        "reviews", "unlabelled", "without_text", "training_rows"))).scalar()
    return documents.join(known, F.col("topic.id") == F.col("_topic"), "left").withColumn(
        "_stored", stored).select(
        "review_id", "product", "rating",
        (F.col("sentiment").isin(0.0, 1.0)
         & (F.col("sentiment_label") == name_of(F.col("sentiment")))).alias("sentiment_known"),
        F.col("topic.name").eqNullSafe(F.col("_name")).alias("topic_known"),
        F.col("cluster.id").between(0, 4).alias("segment_known"), "_stored.*")


@query
def model_metadata(spark, sf_dir) -> DataFrame:
    """Metadata of a segment model trained on the reviews, as saved and read back."""
    root = fresh_path(spark, "models")
    model, score, _ = train_segments.train_segments(_training_rows(spark, sf_dir))
    models.save_model(spark, root, "clustering", model, score)
    return models.read_metadata(spark, root, "clustering")


# --- streams ------------------------------------------------------------------

def _replayed(spark, sf_dir, copies: int = 1) -> str:
    """Every review as a message, `copies` times, in one folder per batch."""
    rows = sample.reviews(spark, sf_dir, labelled=False).withColumn("batch_key", sample.batch_key())
    sent = messages.encode(rows, keep=("batch_key",))
    if copies > 1:
        sent = sent.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    path = fresh_path(spark, "replay")
    messages.write_replay(sent, path)
    return path


def _scored_stream(spark, replay, folder, runs: int = 1, dedup_within=None):
    """Score the replay to its end; further runs start over with no memory of the first."""
    for run in range(runs):
        running = scoring.start_scoring(
            messages.file_stream(spark, replay), sample.SampleScorer.default(spark),
            f"{folder}/scored", f"{folder}/counts", f"{folder}/checkpoint-{run}",
            trigger={"availableNow": True}, dedup_within=dedup_within,
        )
        running.awaitTermination()
    return tables.read_scored(spark, f"{folder}/scored")


@query
def stream_scored(spark, sf_dir) -> DataFrame:
    folder = fresh_path(spark, "stream")
    return _readable(_scored_stream(spark, _replayed(spark, sf_dir), folder))


@query
def stream_replayed(spark, sf_dir) -> DataFrame:
    """The same replay scored twice into one table: every batch replaces its own rows."""
    folder = fresh_path(spark, "stream")
    scored = _scored_stream(spark, _replayed(spark, sf_dir), folder, runs=2)
    return negative_share(scored, "batch_key").select(
        "batch_key", "total_reviews", "negative_reviews"
    )


STREAMED_PARTITIONS = 4


@query
def stream_offsets(spark, sf_dir) -> DataFrame:
    """Every review in a log of four partitions, scored in bounded triggers by two checkpoints that
    start, stop and start again: each review is stored once, with its offset."""
    log, folder = fresh_path(spark, "log"), fresh_path(spark, "stream")
    rows = sample.reviews(spark, sf_dir, labelled=False)
    number = F.substring("review_id", 8, 20).cast("long")
    sent = messages.encode(rows.withColumn("_n", number), keep=("_n",))
    message_log.append(sent, log, "reviews", F.col("_n") % STREAMED_PARTITIONS, F.col("_n"))
    bound = max(1, rows.count() * 3 // 5)
    for checkpoint in ("first", "first", "second", "second"):
        stream = message_log.stream(spark, log, f"{folder}/{checkpoint}", bound)
        scoring.start_scoring(
            commits.queue_rows(stream), sample.SampleScorer.default(spark), f"{folder}/scored",
            f"{folder}/counts", f"{folder}/{checkpoint}", trigger={"availableNow": True},
        ).awaitTermination()
    return tables.read_scored(spark, f"{folder}/scored").select(
        "review_id", "queue_partition", "queue_offset", "rating", "sentiment_label")


@query
def stream_different(spark, sf_dir) -> DataFrame:
    """Different topics and segments by day, from the sketches beside the stream's counts."""
    folder = fresh_path(spark, "stream")
    _scored_stream(spark, _replayed(spark, sf_dir), folder)
    counts = tables.read_counts(spark, f"{folder}/counts").filter(F.col("minute").isNotNull())
    return different_in(counts, F.date_format("minute", "yyyy-MM-dd").alias("day"))


@query
def stream_alerts(spark, sf_dir) -> DataFrame:
    folder = fresh_path(spark, "stream")
    _scored_stream(spark, _replayed(spark, sf_dir), folder)
    return tables.read_alerts(spark, f"{folder}/counts").select("alert_id", "type", "message")


@query
def stream_kept_alerts(spark, sf_dir) -> DataFrame:
    """Alerts from shares kept up to date trigger by trigger, a few files at a time."""
    folder, replay = fresh_path(spark, "stream"), _replayed(spark, sf_dir)
    running = scoring.start_scoring(
        messages.file_stream(spark, replay, files_per_trigger=40), sample.SampleScorer.default(spark),
        f"{folder}/scored", f"{folder}/counts", f"{folder}/checkpoint",
        trigger={"availableNow": True}, shares_path=f"{folder}/shares")
    running.awaitTermination()
    return tables.read_kept_alerts(spark, f"{folder}/shares").select("alert_id", "type", "message")


@query
def stored_drilldown(spark, sf_dir) -> DataFrame:
    """One segment of one topic, from reviews written for drilling down."""
    path = fresh_path(spark, "drilldown")
    tables.write_drilldown(sample.report_rows(spark, sf_dir), path)
    rows = reports.topic_drilldown(spark.read.parquet(path), "Price & Value")
    return reports.segment_drilldown(rows, "Mixed Feedback").select(
        "review_id", "product", "sentiment_label", "rating", "review_text")


@query
def stream_dedup(spark, sf_dir) -> DataFrame:
    """Every message is sent twice and scored once."""
    folder = fresh_path(spark, "stream")
    replay = _replayed(spark, sf_dir, copies=2)
    scored = _scored_stream(spark, replay, folder, dedup_within="60 days")
    return scored.select("review_id", "product", "rating", "sentiment_label")


@query
def windowed_anomaly_stream(spark, sf_dir) -> DataFrame:
    """Hourly shares from the counts of a stream that was scored twice."""
    folder = fresh_path(spark, "stream")
    _scored_stream(spark, _replayed(spark, sf_dir), folder, runs=2)
    counts = tables.read_counts(spark, f"{folder}/counts")
    return _window_rows(windows.window_shares(counts, "1 hour"))
