"""From raw reviews to rows a model can use."""

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from revlens.functions import cleaned, combined, label_of, length_or_zero, model_rating

NUMERIC_INPUTS = ["Rate_num", "review_length", "summary_length"]


def with_label(reviews: DataFrame, training: bool) -> DataFrame:
    """`sentiment_label` from `Sentiment` when training on labelled rows, else 0."""
    labelled = training and "Sentiment" in reviews.columns
    label = label_of(F.col("Sentiment")) if labelled else F.lit(0)
    return reviews.withColumn("sentiment_label", label)


def with_text(reviews: DataFrame) -> DataFrame:
    """Cleaned texts, and the two of them combined."""
    # The empty-text filter refers to the cleaned columns. An ordinary projection
    # would let Spark push that filter below it and clean every text twice; a
    # one-element generator keeps the cleaning in one place.
    texts = F.struct(
        cleaned(F.col("Review")).alias("cleaned_review"),
        cleaned(F.col("Summary")).alias("cleaned_summary"),
    )
    once = reviews.select("*", F.inline(F.array(texts)))
    return once.withColumn(
        "text_combined", combined(F.col("cleaned_review"), F.col("cleaned_summary"))
    )


def with_numbers(reviews: DataFrame) -> DataFrame:
    """Rating and raw text lengths as floats, never NULL or NaN."""
    rating = model_rating(F.col("Rate")) if "Rate" in reviews.columns else F.lit(0.0).cast("float")
    return reviews.withColumns({
        "Rate_num": rating,
        "review_length": length_or_zero(F.col("Review")).cast("float"),
        "summary_length": length_or_zero(F.col("Summary")).cast("float"),
    })


def has_text() -> Column:
    """Two empty texts still make one blank, so one character is not text."""
    return F.length("text_combined") > 1


def has_label() -> Column:
    return F.col("sentiment_label") >= 0


class RowCounts:
    """Rows kept and dropped, observed while the prepared rows are written or read first."""

    def __init__(self):
        self.labels, self.texts = Observation(), Observation()

    def get(self) -> dict:
        """Waits for that job."""
        labels, texts = self.labels.get, self.texts.get
        return {
            "reviews": labels["reviews"], "unlabelled": labels["reviews"] - labels["labelled"],
            "without_text": texts["reviews"] - texts["with_text"],
            "training_rows": texts["with_text"],
        }


def prepare_reviews(
    reviews: DataFrame, training: bool, counts: RowCounts | None = None,
) -> DataFrame:
    """All of the above; only labelled rows with text are kept for training. `counts` observes
    what goes, in the same job."""
    labelled = with_label(reviews, training)
    if counts:
        labelled = labelled.observe(
            counts.labels, F.count("*").alias("reviews"), F.count_if(has_label()).alias("labelled"))
    if training:
        labelled = labelled.filter(has_label())
    texts = with_text(labelled)
    if counts:
        texts = texts.observe(
            counts.texts, F.count("*").alias("reviews"), F.count_if(has_text()).alias("with_text"))
    return with_numbers(texts.filter(has_text()))
