"""Token lists and term statistics."""

from pyspark.ml.feature import (
    CountVectorizerModel,
    NGram,
    RegexTokenizer,
    StopWordsRemover,
    Tokenizer,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.fixed_values import (
    ENGLISH_STOP_WORDS,
    TOPIC_DOMAIN_WORDS,
    TOPIC_MIN_TOKEN,
    TOPIC_SENTIMENT_WORDS,
)
from revlens.runtime import materialized
from revlens.sources.files import numbered


def tokenizer():
    return Tokenizer(inputCol="text_combined", outputCol="words")


def stop_word_remover():
    return StopWordsRemover(
        inputCol="words", outputCol="words_filtered", stopWords=ENGLISH_STOP_WORDS
    )


def bigrams():
    return NGram(n=2, inputCol="words_filtered", outputCol="bigrams")


def topic_tokenizer():
    return RegexTokenizer(
        inputCol="text_combined", outputCol="words", pattern=r"\W+", minTokenLength=TOPIC_MIN_TOKEN
    )


def topic_stop_words():
    """English stop words, sentiment words and domain words; the remover ignores case."""
    words = {*ENGLISH_STOP_WORDS, *TOPIC_SENTIMENT_WORDS, *TOPIC_DOMAIN_WORDS}
    return sorted(word for word in words if len(word) >= 2)


def topic_stop_word_remover():
    return StopWordsRemover(
        inputCol="words", outputCol="filtered", stopWords=topic_stop_words()
    )


def with_bigrams(prepared: DataFrame) -> DataFrame:
    for stage in (tokenizer(), stop_word_remover(), bigrams()):
        prepared = stage.transform(prepared)
    return prepared


def with_topic_words(prepared: DataFrame) -> DataFrame:
    return topic_stop_word_remover().transform(topic_tokenizer().transform(prepared))


def term_counts(documents: DataFrame, terms: str, *by) -> DataFrame:
    """Occurrences of each term, within the groups `by`."""
    rows = documents.select(*by, F.explode(terms).alias("term"))
    return rows.groupBy(*by, "term").agg(F.count("*").alias("term_count"))


def term_counts_by(documents: DataFrame, terms: str, *by) -> DataFrame:
    """Per term, within the groups `by`: occurrences and documents; the NULL term counts all
    documents.

    Each document sends one row per occurrence, the first of which counts the document, and one
    for itself, so one aggregation, combined on the map side, yields all counts. Counting distinct
    documents would need a second shuffle by document and term, and counting all of them a
    second pass over the texts. In sorted terms, a first occurrence differs from the one before.
    """
    def row(term, used, seen):
        return F.struct(term.alias("term"), used.alias("used"), seen.alias("seen"))

    ordered = documents.select(*by, F.sort_array(terms).alias("_terms"))
    occurrences = F.transform("_terms", lambda t, i: row(t, F.lit(1), F.when(
        (i > 0) & t.eqNullSafe(F.get("_terms", i - 1)), 0).otherwise(1)))
    itself = F.array(row(F.lit(None).cast("string"), F.lit(0), F.lit(1)))
    counted = ordered.select(*by, F.inline(F.concat(occurrences, itself)))
    return counted.groupBy(*by, "term").agg(
        F.sum("used").alias("term_count"), F.sum("seen").alias("doc_count"))


def term_statistics(documents: DataFrame, terms: str) -> DataFrame:
    """Per term: occurrences and documents."""
    return term_counts_by(documents, terms).filter(F.col("term").isNotNull())


def most_frequent(statistics: DataFrame, size: int) -> DataFrame:
    """The `size` terms with the largest term_count, ties by term, of stored statistics.

    The cut is found in histograms of the counts, ten bits at a time. Terms above it are taken as
    they lie; only those that tie with it are sorted, in ranges, and numbered. So no task holds
    more than its share, however many terms there are.
    """
    largest, number = statistics.agg(F.max("term_count"), F.count("*")).first()
    if number <= size:
        return statistics
    shift, prefix, wanted = max(0, (largest.bit_length() - 1) // 10 * 10), 0, size
    while True:
        here = statistics.filter(F.shiftright("term_count", shift + 10) == prefix)
        digit = F.shiftright("term_count", shift).bitwiseAND(F.lit(1023))
        histogram = here.groupBy(digit.alias("digit")).count().collect()
        for digit, count in sorted(((r["digit"], r["count"]) for r in histogram), reverse=True):
            if count >= wanted:
                prefix = prefix * 1024 + digit
                break
            wanted -= count
        if not shift:
            break
        shift -= 10
    above = statistics.filter(F.col("term_count") > prefix)
    ties = statistics.filter(F.col("term_count") == prefix).orderBy("term")
    ties = materialized(ties.withColumn("row_key", F.monotonically_increasing_id()), "ties")
    first = numbered(ties, "_place").filter(F.col("_place") <= wanted)
    return above.unionByName(first.select(*statistics.columns))


def vocabulary_of(
    documents: DataFrame, terms: str, size: int, min_df: int, max_df: float | None = None
) -> tuple[DataFrame, int]:
    """The most frequent terms among those found in enough and not in too many documents, in
    order, and the number of documents. `max_df` is a share of all documents and inclusive."""
    counted = materialized(
        term_counts_by(documents, terms).filter(
            F.col("term").isNull() | (F.col("doc_count") >= min_df)), "term-statistics")
    whole = counted.filter(F.col("term").isNull()).first()
    total = whole["doc_count"] if whole else 0
    found = counted.filter(F.col("term").isNotNull())
    if max_df is not None:
        found = found.filter(F.col("doc_count") <= total * max_df)
    return most_frequent(found, size).orderBy(F.desc("term_count"), "term"), total


def vocabulary(
    documents: DataFrame, terms: str, size: int, min_df: int, max_df: float | None = None
) -> DataFrame:
    return vocabulary_of(documents, terms, size, min_df, max_df)[0]


def vectorizer(
    documents: DataFrame, terms: str, output: str, size: int, min_df: int,
    max_df: float | None = None,
) -> CountVectorizerModel:
    """Term counts over the vocabulary above.

    Its order is total, so equal data gives equal positions; the library's own fit
    leaves ties open, and a seeded topic model would differ from run to run. At most
    `size` words come to the driver, where the model keeps them anyway.
    """
    words = [row["term"] for row in vocabulary(documents, terms, size, min_df, max_df).collect()]
    return CountVectorizerModel.from_vocabulary(words, inputCol=terms, outputCol=output)


def idf_weights(documents: DataFrame, terms: DataFrame, total: int | None = None) -> DataFrame:
    """Inverse document frequency of each vocabulary term. `total`, the number of documents, saves
    counting them."""
    number = documents.agg(F.count("*")).scalar() if total is None else F.lit(total)
    weight = F.log((number + 1.0) / (F.col("doc_count") + 1.0))
    return terms.select("term", "doc_count", weight.alias("idf"))
