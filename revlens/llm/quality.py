"""Quality rules whose cutoffs are chosen with a guaranteed bound on false rejections.

A rule rejects a text whose measure exceeds a cutoff. Cutoffs are selected on a labelled holdout,
separately for each stratum (a language): all rules go together through one fixed sequence of joint
cutoffs, from lax to strict. A step is accepted while an exact binomial test shows that its rules
together reject at most `RISK` of the good documents; the first failure ends the search, so the steps
of a stratum share one error budget and need not divide the risk. The budget `ERROR` is divided among
the strata (Bonferroni), so with probability 1 - ERROR no stratum loses more than RISK of its good
documents. A stratum with too few labelled documents to show this keeps the fixed limits alone.

Fixed limits ("base") hold besides: at least 10 words, at most 20 % of words in repeated
5-word windows.

Defined results: null and empty texts have no words and fail the base; a null language is a
stratum of its own; labels without a document, null labels and documents without label take no
part in the selection; a document labelled several times counts as good if all its labels say so; an
empty table of labels leaves the base rules only. Counts over all labelled rows are made by Spark, as
counts per stratum and step; only these counts are tested.
"""

import math
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import materialized, texts

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
RISK = 0.01
ERROR = 0.05
SYMBOLS = "#*$%&|<>"
# Measures in thousandths, laxest cutoff first.
RULES = {
    "symbol_share": (500, 400, 300, 250, 200, 150, 100, 80, 60, 50, 40, 30, 20),
    "dup_line_share": (800, 700, 600, 500, 400, 300, 250, 200, 150, 100),
    "repeat_share": (200, 180, 160, 140, 120, 100, 80, 60),
    "mean_word_chars": (40_000, 30_000, 25_000, 20_000, 18_000, 16_000, 14_000, 12_000),
}
STEPS = max(map(len, RULES.values()))
MEASURES = "struct<n_words: long, word_chars: long, n_symbols: long, n_dup_lines: long, " \
    "n_repeat_words: long, n_lines: long>"


def measure(text: str | None) -> tuple[int, int, int, int, int, int]:
    if not text:
        return 0, 0, 0, 0, 0, 0
    raw = text.encode()
    words = raw.split()
    count = len(words)
    # code points: bytes that do not continue a character
    word_chars = len(text) - (len(raw) - sum(map(len, words)))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    duplicates = len(lines) - len(set(lines))
    return count, word_chars, symbols, duplicates, _repeated(words), len(lines)


def _repeated(words: list[bytes]) -> int:
    """Words inside windows that occur twice or more, the first one included."""
    count = len(words) - WINDOW + 1
    if count < 2:
        return 0
    joined = b" ".join(words)
    ends, at = [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[:count - 1])]
    windows = [joined[a:b] for a, b in zip(starts, ends[WINDOW - 1:])]
    if len(set(windows)) == count:
        return 0
    first: dict[bytes, int] = {}
    inside = bytearray(len(words))
    for i, window in enumerate(windows):
        other = first.setdefault(window, i)
        if other != i:
            inside[i:i + WINDOW] = inside[other:other + WINDOW] = b"\1" * WINDOW
    return sum(inside)


def measures(text: Column) -> Column:
    """The struct MEASURES of a text column."""

    @F.pandas_udf(MEASURES)
    def measured(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(
                [measure(text) for text in batch],
                columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "n_lines"],
            )

    return measured(text)


def _thousandths(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.expr(f"{part} * 1000 div {whole}")).otherwise(F.lit(0))


def _shares(measured: DataFrame) -> DataFrame:
    return measured.withColumns({
        "symbol_share": _thousandths("n_symbols", "word_chars"),
        "dup_line_share": _thousandths("n_dup_lines", "n_lines"),
        "repeat_share": _thousandths("n_repeat_words", "n_words"),
        "mean_word_chars": _thousandths("word_chars", "n_words"),
        "base_failed": (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
    })


def without_rejected(docs: DataFrame, labels: DataFrame, risk: float = RISK,
                     error: float = ERROR) -> DataFrame:
    """The documents that `judged` keeps, with their own columns. Texts are measured again
    rather than shuffled to meet a verdict."""
    chosen = cutoffs(materialized(measured_documents(docs), "measures"), labels, risk, error)
    stratum = F.coalesce(F.col("_docs.lang"), F.lit("")).alias("stratum")
    measured = _shares(
        docs.select(F.struct(*docs.columns).alias("_docs"))
        .withColumn("_m", measures(F.coalesce(F.col("_docs.text"), F.lit(""))))
        .select("_docs", stratum, "_m.*"))
    kept = ~F.col("base_failed") & ~rejected_by(chosen)
    return measured.filter(kept).select("_docs.*")


def measured_documents(docs: DataFrame) -> DataFrame:
    """doc_id, stratum, the measures and their shares, base_failed."""
    rows = texts(docs, F.coalesce(F.col("lang"), F.lit("")).alias("stratum"))
    return _shares(rows.select("doc_id", "stratum", measures(F.col("text")).alias("m"))
                   .select("doc_id", "stratum", "m.*"))


def at_most(rejected: int, good: int, risk: float) -> float:
    """Exact probability of so few rejections among good documents, were their rate `risk`."""
    if not good:
        return 1.0
    log = [
        math.lgamma(good + 1) - math.lgamma(k + 1) - math.lgamma(good - k + 1)
        + k * math.log(risk) + (good - k) * math.log1p(-risk)
        for k in range(rejected + 1)
    ]
    return min(1.0, math.fsum(map(math.exp, log)))


def joint_cutoffs(step: int) -> dict[str, int]:
    """Each rule's cutoff at a step: all rules take their own sequences evenly."""
    return {rule: cutoffs[step * (len(cutoffs) - 1) // (STEPS - 1)]
            for rule, cutoffs in RULES.items()}


def select_cutoffs(counts: list, risk: float = RISK, error: float = ERROR) -> list[tuple]:
    """(stratum, rule, cutoff) from rows (stratum, good, [rejected by each step])."""
    chosen = []
    for row in counts:
        best = None
        for step, rejected in enumerate(row["rejected"]):
            # more rejections than expected at the risk can never pass
            if rejected > risk * row["good"] or at_most(
                    rejected, row["good"], risk) > error / len(counts):
                break
            best = step
        if best is not None:
            chosen += [(row["stratum"], *pair) for pair in joint_cutoffs(best).items()]
    return chosen


def cutoffs(measured: DataFrame, labels: DataFrame, risk: float = RISK,
            error: float = ERROR) -> list[tuple]:
    """Select on the documents that `labels` calls good and that pass the base rules."""
    good = (
        labels.filter("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min(((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0))
                   .cast("int")).alias("good"))
        .filter("good = 1").select("doc_id")
    )
    def rejected(step):
        beyond = [F.col(rule) > cutoff for rule, cutoff in joint_cutoffs(step).items()]
        return F.count_if(reduce(Column.__or__, beyond))

    counted = (
        measured.filter("not base_failed").join(good, "doc_id", "left_semi").groupBy("stratum")
        .agg(F.count("*").alias("good"),
             F.array(*[rejected(step) for step in range(STEPS)]).alias("rejected"))
    )
    # Nothing can be shown safe in a smaller stratum; so few rows, one per tested language, go on.
    fewest = math.log(error) / math.log1p(-risk)
    return select_cutoffs(counted.filter(F.col("good") >= fewest).collect(), risk, error)


def rejected_by(chosen: list[tuple]) -> Column:
    """True where a selected cutoff rejects."""
    verdict = F.lit(False)
    for stratum, rule, cutoff in chosen:
        verdict |= (F.col("stratum") == stratum) & (F.col(rule) > cutoff)
    return verdict


def judged(docs: DataFrame, labels: DataFrame, risk: float = RISK,
           error: float = ERROR) -> DataFrame:
    """One row per document with its measures, base_failed and kept."""
    measured = materialized(measured_documents(docs), "measures")
    verdict = rejected_by(cutoffs(measured, labels, risk, error))
    return measured.withColumn("kept", ~F.col("base_failed") & ~verdict)
