"""Text formats of reports and alerts.

Numbers are rounded half up in decimal before they are printed, as SQL engines do; a
printf on the binary value can differ in the last digit of an exact decimal tie.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent_text(share: Column) -> Column:
    """A fraction as a percentage with one decimal; a missing one counts as 0."""
    return F.format_string("%.1f%%", F.round(F.coalesce(share, F.lit(0.0)) * 100.0, 1))


def decimal_text(value: Column) -> Column:
    return F.format_string("%.3f", F.round(F.coalesce(value, F.lit(0.0)), 3))


def alert_level(severity: Column) -> Column:
    high = F.lower(F.coalesce(severity, F.lit(""))).contains("high")
    return F.when(high, F.lit("error")).otherwise(F.lit("warning"))


def training_day(date: Column) -> Column:
    """An ISO date to the minute, in its own time zone; other text is cut to 19 characters."""
    wall_clock = F.regexp_replace(date, r"(Z|[+-]\d\d:\d\d)$", "")
    parsed = F.try_to_timestamp(wall_clock)
    return F.coalesce(F.date_format(parsed, "yyyy-MM-dd HH:mm"), F.substring(date, 1, 19))
