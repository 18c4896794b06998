"""What a topic is about: its strongest terms, the themes they vote for, its name."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revlens.fixed_values import THEME_MIN_OVERLAP, TOPIC_KEYWORDS, TOPIC_TERMS, TOPIC_THEMES
from revlens.runtime import small_table


def theme_table(spark: SparkSession) -> DataFrame:
    """The built-in themes, one row per theme and keyword, in order of preference."""
    rows = [
        (order, theme, word)
        for order, (theme, words) in enumerate(TOPIC_THEMES.items(), start=1)
        for word in sorted(set(words))
    ]
    return small_table(spark, rows, "theme_order int, theme string, keyword string")


def topic_terms(described: DataFrame, words: DataFrame) -> DataFrame:
    """One row per topic and term, strongest first, from term positions and weights.

    `described` has topic, termIndices, termWeights; `words` has term_index, word.
    A position outside the vocabulary is dropped.
    """
    pairs = F.arrays_zip("termIndices", "termWeights")
    listed = described.select("topic", F.posexplode(pairs).alias("place", "pair")).select(
        "topic",
        (F.col("place") + 1).alias("rank"),
        F.col("pair.termIndices").alias("term_index"),
        F.col("pair.termWeights").alias("weight"),
    )
    return listed.join(words, "term_index").select("topic", "rank", "word", "weight")


def strongest_terms(counts: DataFrame, topic: str, count: int = TOPIC_TERMS) -> DataFrame:
    """The most used terms of each group, as topic, rank, word, weight.

    The window ranks within a topic in two steps, first per slice of its terms, so
    one topic with most of the terms is not sorted by a single task.
    """
    order = [F.desc("term_count"), F.asc("term")]
    sliced = counts.withColumn("_slice", F.pmod(F.xxhash64("term"), F.lit(64)))
    within = Window.partitionBy(topic, "_slice").orderBy(*order)
    first = sliced.withColumn("rank", F.row_number().over(within)).filter(F.col("rank") <= count)
    overall = Window.partitionBy(topic).orderBy(*order)
    return (
        first.withColumn("rank", F.row_number().over(overall))
        .filter(F.col("rank") <= count)
        .select(F.col(topic).alias("topic"), "rank", F.col("term").alias("word"),
                F.col("term_count").cast("double").alias("weight"))
    )


def theme_overlap(terms: DataFrame, themes: DataFrame) -> DataFrame:
    """How many distinct keywords of each theme are among the terms of each topic."""
    return (
        terms.join(themes, terms["word"] == themes["keyword"])
        .groupBy("topic", "theme_order", "theme")
        .agg(F.countDistinct("word").alias("overlap"))
    )


def topic_names(terms: DataFrame, themes: DataFrame) -> DataFrame:
    """Name each topic after its best theme, or after its two strongest words.

    The first theme in order wins a tie. With a single word the name is that word.
    """
    # The left join keeps terms without a theme, so one pass over the terms finds
    # both the votes and the leading words.
    votes = (
        terms.join(themes, terms["word"] == themes["keyword"], "left")
        .groupBy("topic", "theme_order", "theme")
        .agg(
            F.countDistinct("keyword").alias("overlap"),
            F.max(F.when(F.col("rank") == 1, F.col("word"))).alias("first"),
            F.max(F.when(F.col("rank") == 2, F.col("word"))).alias("second"),
        )
    )
    named = votes.groupBy("topic").agg(
        F.min(F.struct((-F.col("overlap")).alias("against"), "theme_order", "theme")).alias("best"),
        F.max("first").alias("first"),
        F.max("second").alias("second"),
    )
    matched = -F.col("best.against")
    return named.select(
        "topic",
        F.when(matched >= THEME_MIN_OVERLAP, F.col("best.theme"))
        .otherwise(F.concat_ws(" & ", F.initcap("first"), F.initcap("second"))).alias("name"),
        matched.cast("int").alias("overlap"),
    )


def topic_interpretations(terms: DataFrame, themes: DataFrame) -> DataFrame:
    """One row per topic: name, all its terms with weights, and the leading keywords."""
    ranked = F.array_sort(F.collect_list(F.struct("rank", "word", "weight")))
    listed = terms.groupBy("topic").agg(ranked.alias("ranked"))
    words = F.transform(
        "ranked", lambda t: F.struct(t["word"].alias("word"), t["weight"].alias("weight"))
    )
    keywords = F.slice(F.transform("ranked", lambda t: t["word"]), 1, TOPIC_KEYWORDS)
    return listed.join(topic_names(terms, themes), "topic").select(
        F.col("topic").alias("topic_id"), "name", words.alias("top_words"),
        keywords.alias("keywords"),
    )
