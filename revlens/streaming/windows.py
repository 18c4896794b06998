"""Alerts per event-time window over the counts that the scoring stream keeps."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.operators.anomalies import share_of_counts


def window_shares(counts: DataFrame, length: str = "1 day") -> DataFrame:
    """Negative share of each window, of whole minutes, over everything counted so far.

    Counts are kept by file and replaced when a file is scored again. So a batch that runs twice
    counts once, a batch that comes late still counts, and the newest window is there too: it
    changes as long as reviews of its time arrive. Reviews without a readable time
    belong to no window.
    """
    shares = share_of_counts(
        counts.filter(F.col("minute").isNotNull()), F.window("minute", length).alias("period"))
    return shares.select(
        F.col("period.start").alias("window_start"), F.col("period.end").alias("window_end"),
        "total_reviews", "negative_reviews", "negative_pct",
    )
