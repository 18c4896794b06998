"""The three readings of a star rating, which differ in how they treat a missing one."""

from pyspark.sql import Column
from pyspark.sql import functions as F

LOWEST, HIGHEST, MIDDLE = 1.0, 5.0, 3.0


def _number(rate: Column, kind: str) -> Column:
    """The rating as a number; NULL if it is empty, not a number, or NaN."""
    parsed = rate.try_cast(kind)
    return F.when(~F.isnan(parsed), parsed)


def model_rating(rate: Column) -> Column:
    """Model input: as given, 0 when missing."""
    return F.coalesce(_number(rate, "float"), F.lit(0.0).cast("float"))


def sink_rating(rate: Column) -> Column:
    """Stored rating: within 1 to 5, 3 when missing."""
    stars = F.coalesce(_number(rate, "double"), F.lit(MIDDLE))
    return F.greatest(F.lit(LOWEST), F.least(F.lit(HIGHEST), stars))


def report_rating(rating: Column) -> Column:
    """Reported rating. Clamping first leaves a missing rating missing; it then becomes 3."""
    number = _number(rating, "double")
    clamped = F.when(number.isNotNull(), F.greatest(F.lit(LOWEST), F.least(F.lit(HIGHEST), number)))
    return F.coalesce(clamped, F.lit(MIDDLE))
