"""From raw documents to packed training sequences, in five stages.

Each stage works on all rows that the one before it kept, as written in the shared folder, so a
lost executor costs at most a stage. Stages 1 to 4 return the columns of `documents`.

1. quality_rules: documents that fail the fixed limits or a risk-controlled cutoff go.
2. line_dedup: lines that stand earlier in the corpus, up to one word, go; documents stay.
3. simhash_near_dedup: of documents linked by fingerprints at most 4 bits apart, the one with the
   smallest doc_id stays.
4. secret_scans: secrets are replaced by a mark.
5. packing: texts become pieces of token ids in sequences of 4096.

Defined results: null, empty and very short texts fail the quality rules and go. Columns beside those of
`documents` are left behind at each stage, so their names clash with nothing. Documents without an id are
judged like others; for lines each is a document of its own, after all those with an id, and near-dedup
keeps them all. Rows that share a doc_id are one place for lines, and near-dedup keeps one of them. Ties go to what stands earlier. An empty table gives no pieces, an
empty table of labels leaves the fixed limits. What each operator makes of a case stands in its docstring.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm import lines, packing, quality, secrets, simhash
from revlens.runtime import fresh_path

END_ID = 2
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of documents, n_chars counted anew."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.without_rejected(docs.select(*COLUMNS), labels)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _documents(lines.without_repeated_lines(docs.select(*COLUMNS)))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.without_near_duplicates(docs.select(*COLUMNS))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common = secrets.common_words(docs)
    return _documents(docs.withColumn("text", secrets.redacted(F.col("text"), common)))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"), END_ID)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("secret_scans", secret_scans),
    ("packing", packed_sequences),
]

# Fingerprints, binomial tests and token ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
