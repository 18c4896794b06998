"""Small inputs that every operator must take."""

from pyspark.sql import functions as F

LONG = "word " * 30_000 + "x" * 40_000
TEXTS = [
    None, "", " \n\t ", "one", "One TWO three", "same line of text here\nsame line of text here",
    "a b c d e f g h i j k l m n o p", "a b c d e f g h i j k l m n o p",
    "ünïcödé wörds   and 漢字 kana かな 😀 end", LONG, LONG + " end",
    "the quick brown fox jumps over the lazy dog and runs away from here",
    "the quick brown fox jumps over the lazy dog and runs away from home",
]


def awkward_documents(spark, table=TEXTS):
    """Nulls, empty and long texts, ties, a repeated row, and columns whose names clash."""
    rows = [(i, text, None if i % 3 else "en") for i, text in enumerate(table)]
    rows += [rows[6], (None, "text without an id", "en"), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return docs.select(
        "*", F.lit("src").alias("source"), F.length("text").cast("long").alias("n_chars"),
        *[F.lit("clash").alias(c) for c in (
            "id", "ids", "fp", "bin", "prefix", "stratum", "component_id", "kept", "line",
            "words", "n_words", "start", "length", "pieces", "found", "component", "hash")],
    )


def empty_documents(spark):
    return spark.createDataFrame(
        [], "doc_id long, text string, lang string, source string, n_chars long")


def save(path, df, name="documents"):
    """A table in a folder like those that queries read."""
    df.write.parquet(f"{path}/{name}.parquet")
    return str(path)
