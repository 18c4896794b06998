"""Review files: CSV in, a staged parquet copy with a stable row key, CSV out."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.runtime import files_state, list_files, materialized, path_exists
from revlens.schemas import TRAINING_FILE
from revlens.sources import quoted_lines

# CSV conventions. Texts hold quotes, line breaks and outer blanks.
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_csv(spark: SparkSession, path: str, schema=TRAINING_FILE, multiline=True) -> DataFrame:
    """Review files with a header. An explicit schema saves the scan that inference takes.

    With `multiline` a text may hold line breaks. Such files are cut into records by byte ranges
    in many tasks; only compressed files, and stores that Python cannot open, are read one file per
    task. Without it, lines are records, which saves the pass that finds the quotes.
    """
    if multiline and quoted_lines.splittable([name for name, _ in list_files(spark, path)]):
        fields = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        options = {k: v for k, v in CSV_OPTIONS.items() if k != "header"}
        ddl = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in fields)
        parsed = F.from_csv("value", ddl, options)
        rows = quoted_lines.records(spark, path).select(parsed.alias("row"))
        return rows.select("row.*")
    reader = spark.read.schema(schema).options(**CSV_OPTIONS)
    return reader.option("multiLine", str(multiline).lower()).csv(path)


def write_csv(reviews: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    writer = reviews.write.options(**CSV_OPTIONS).option("maxRecordsPerFile", rows_per_file)
    writer.csv(path)


def stage(reviews: DataFrame, path: str, source: str = "") -> DataFrame:
    """A parquet copy with a stable `row_key`, written only if it is not there yet.

    The key is assigned once and then stored, so splits and numbering that are
    derived from it stay the same when a lost task is run again. `source` is the path that the
    reviews were read from: its files' names, sizes and times are stored beside the copy, and
    a copy of anything else is replaced.
    """
    spark = reviews.sparkSession
    state = files_state(spark, source) if source else ""
    beside = f"{path}-source"
    staged = path_exists(spark, f"{path}/_SUCCESS") and (
        not source or path_exists(spark, beside) and spark.read.text(beside).first()[0] == state)
    if not staged:
        keyed = reviews.withColumn("row_key", F.monotonically_increasing_id())
        keyed.write.mode("overwrite").parquet(path)
        if source:
            spark.range(1).select(F.lit(state)).coalesce(1).write.mode("overwrite").text(beside)
    return spark.read.parquet(path)


def numbered(staged: DataFrame, name: str = "row_number") -> DataFrame:
    """Consecutive numbers from 1 in the order of `row_key`, without sorting.

    The upper bits of the key are the partition that wrote the row, the lower 33
    its place there. Only the row counts per partition are summed up in order. They
    are written first: Spark then knows how few they are and does not shuffle the
    reviews to join them.
    """
    part = F.shiftright("row_key", 33)
    counts = staged.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    offsets = materialized(counts.select("_part", start), "offsets")
    place = F.col("row_key").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        staged.withColumn("_part", part)
        .join(offsets, "_part")
        .withColumn(name, F.col("_start") + place + 1)
        .drop("_part", "_start")
    )
