"""Text cleaning as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# What cleaning deletes and collapses. The text is lower case by
# then, so a-z is every letter. The blank pattern matches only runs that are not
# already one blank: rewriting each single blank would double the cost of cleaning.
NOT_A_LETTER = r"[^a-z\s]+"
MISSING_WORD = r"\bnan\b"
BLANK_RUN = r" \s+|[\t\n\x0B\f\r]\s*"


def cleaned(text: Column) -> Column:
    """Lower case letters and single blanks only; NULL becomes empty.

    Characters are deleted, not replaced: "don't" becomes "dont".
    """
    letters = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), NOT_A_LETTER, "")
    named = F.regexp_replace(letters, MISSING_WORD, "")
    return F.trim(F.regexp_replace(named, BLANK_RUN, " "))


def combined(review: Column, summary: Column) -> Column:
    """Cleaned review and summary around one blank, which is there even if both are empty."""
    return F.concat_ws(" ", review, summary)


def length_or_zero(text: Column) -> Column:
    return F.coalesce(F.length(text), F.lit(0))
