"""Topic model: word counts into online LDA, and what each topic means."""

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import LDA
from pyspark.sql import DataFrame

from revlens.fixed_values import (
    SEED,
    TOPIC_COUNT,
    TOPIC_MAX_DF,
    TOPIC_MAX_ITER,
    TOPIC_MIN_DF,
    TOPIC_TERMS,
    TOPIC_VOCABULARY,
)
from revlens.operators import tokens
from revlens.operators.topics import theme_table, topic_interpretations, topic_terms
from revlens.runtime import materialized


def word_counter(texts: DataFrame) -> PipelineModel:
    """Topic words of a text, and how often each vocabulary word is among them."""
    counter = tokens.vectorizer(
        tokens.with_topic_words(texts), "filtered", "features",
        TOPIC_VOCABULARY, TOPIC_MIN_DF, TOPIC_MAX_DF,
    )
    return PipelineModel(
        stages=[tokens.topic_tokenizer(), tokens.topic_stop_word_remover(), counter]
    )


def train_topics(prepared: DataFrame):
    """The topic pipeline and its score, the log perplexity as a negative number.

    Lower perplexity is better, so a larger score is better. LDA passes over the
    word counts once per iteration; they are written once, and cached from there.
    """
    texts = prepared.select("text_combined")
    words = word_counter(texts)
    counted = words.transform(texts).select("features")
    counts = materialized(counted, "topic-counts").persist(StorageLevel.MEMORY_AND_DISK)
    lda = LDA(featuresCol="features", k=TOPIC_COUNT, maxIter=TOPIC_MAX_ITER, optimizer="online",
              seed=SEED).fit(counts)
    score = -abs(lda.logPerplexity(counts))
    counts.unpersist()
    return PipelineModel(stages=[*words.stages, lda]), score


def described_terms(model: PipelineModel, spark) -> DataFrame:
    """Topic, rank, word and weight of the strongest terms of a fitted topic pipeline."""
    vectorizer, lda = model.stages[-2], model.stages[-1]
    # At most TOPIC_VOCABULARY words, which the model holds on the driver anyway.
    words = spark.createDataFrame(
        list(enumerate(vectorizer.vocabulary)), "term_index int, word string"
    )
    return topic_terms(lda.describeTopics(TOPIC_TERMS), words)


def interpret_topics(model: PipelineModel, spark, themes: DataFrame | None = None) -> DataFrame:
    return topic_interpretations(described_terms(model, spark), themes or theme_table(spark))
