"""Secrets in texts: fixed shapes, and values that would take many guesses.

Fixed shapes ("base") are assignments of a long value to a credential's name, access key ids, and
long hexadecimal runs. The method adds values that stand in a credential's context but have
none of these shapes, such as `pass is Tr0ub4dor&3xQ`: a dynamic program finds the cheapest way to
guess a value, segmenting it into common words, dates, repeated parts, walks over a keyboard
and brute force, and values that still cost more than `MIN_LOG10_GUESSES` are reported.

Common words are a short list that guessers try first, then the corpus's own: runs of three to
`MOST_WORD_CHARS` ASCII letters that stand in at least `MIN_DOCUMENTS` documents, the `MOST_WORDS`
in most documents, ranked by that count. Values in a credential's context are left out of the
count, so that a secret does not become a word by being copied.

Defined results: null and empty texts have no spans. Offsets count code points, ends are
exclusive. Values of every length are judged by the same program, which stops at the place where
every way to go on already costs enough.
"""

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.operators.tokens import most_frequent
from revlens.runtime import materialized

# The shapes.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "guess")
ASSIGN_CHARS = 12

# Contexts in which a value is judged by its guess cost.
CONTEXT = re.compile(
    r"""(?<![A-Za-z])(?:password|passwd|passphrase|passcode|pass|pwd|secret|token|api[_-]?key"""
    r"""|credentials?|auth|private[_-]?key|pin)["']?(?:\x20*(?:[:=]|=>|:=)|\x20+is)\x20*"""
    r"""["']?([!-~]{8,})""",
    re.ASCII | re.IGNORECASE,
)
CONTEXT_HINT = re.compile(r"pass|pwd|secret|token|api|credential|auth|private|pin", re.IGNORECASE)
MIN_LOG10_GUESSES = 10.0
MIN_DOCUMENTS = 3
MOST_WORDS = 200_000
MOST_WORD_CHARS = 64
CACHED_CHARS = 128  # costs of longer values are computed each time, so that the cache stays small
LONGEST_PERIOD = 16  # a longer part costs more than the threshold by itself

# Words that guessers try first, most common first: the rank is the number of guesses.
COMMON_WORDS = (
    "password 123456 qwerty admin welcome login letmein monkey dragon master secret token user "
    "test root guest hello love sunshine princess football baseball shadow superman example "
    "changeme default server client access public private service account system backup "
    "your here none null true false value string number name enter please never share change "
    "reset required must should with this that from have been will the and for you are not"
).split()
KEYBOARD_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
SHIFTED = str.maketrans('~!@#$%^&*()_+{}|:"<>?', "`1234567890-=[]\\;',./")
LEET = str.maketrans("@4301$5!7", "aaeoissit")
DATE = re.compile(
    r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])"
    r"|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d|(?:19|20)\d\d"
)
_BETWEEN = math.log10(2)
_STEPS = {size: math.log10(size) for size in (10, 26, 33)}
_PLACE = {
    key: (row, column + row / 2)
    for row, keys in enumerate(KEYBOARD_ROWS) for column, key in enumerate(keys)
}


class Words:
    """Words by rank, the built-in ones first, and the longest one by its first three letters."""

    def __init__(self, more: str = ""):
        self.rank: dict[str, int] = {}
        self.longest: dict[str, int] = {}
        for word in (*COMMON_WORDS, *more.split()):
            self.rank.setdefault(word, len(self.rank) + 1)
            self.longest[word[:3]] = max(len(word), self.longest.get(word[:3], 0))


_BUILT_IN = Words()


@lru_cache(maxsize=2)
def _words(more: str) -> Words:
    return Words(more)


def common_words(docs: DataFrame) -> str:
    """The words of `text` that are common in the corpus, most common first, joined by blanks.

    They are selected in Spark, so the driver gets these `MOST_WORDS` words and no task's candidates."""
    text = F.coalesce(F.col("text"), F.lit(""))
    # Java's pattern, without the look-behind: whatever may be a value is left out
    values = "(?i)" + CONTEXT.pattern.replace("(?<![A-Za-z])", "")
    rest = F.when(
        text.rlike("(?i)" + CONTEXT_HINT.pattern), F.regexp_replace(text, values, " ")
    ).otherwise(text)
    found = F.regexp_extract_all(
        F.lower(rest), F.lit("(?<![a-z0-9])[a-z]{3,}+(?![0-9])"), F.lit(0))
    counted = (
        docs.select(F.explode(F.array_distinct(found)).alias("word"))
        .filter(F.length("word") <= MOST_WORD_CHARS)
        .groupBy(F.col("word").alias("term")).agg(F.count("*").alias("term_count"))
        .filter(F.col("term_count") >= MIN_DOCUMENTS)
    )
    rows = most_frequent(materialized(counted, "words"), MOST_WORDS).collect()
    return " ".join(r["term"] for r in sorted(rows, key=lambda r: (-r["term_count"], r["term"])))


def _alphabet(char: str) -> int:
    if char.isdigit():
        return 10
    return 26 if char.isalpha() else 33


def _next_to(a: str, b: str) -> bool:
    one, two = _PLACE.get(a), _PLACE.get(b)
    return (
        one is not None and two is not None and one != two
        and abs(one[0] - two[0]) <= 1 and abs(one[1] - two[1]) <= 1
    )


def _segments(value: str, enough: float = math.inf,
              words: Words = _BUILT_IN) -> Iterator[tuple[int, int, float]]:
    """(start, end, log10 of the guesses) of every part that is not guessed by brute force, by
    start. Parts that cost `enough` by themselves may be left out."""
    lower = value.lower()
    plain = lower.translate(LEET)
    keys = lower.translate(SHIFTED)
    size = len(value)
    before = [0.0, *accumulate(_STEPS[_alphabet(c)] for c in value)]
    matched = [0] * (LONGEST_PERIOD + 1)  # up to where the value equals itself shifted by a period
    for start in range(size):
        longest = max(words.longest.get(text[start:start + 3], 0) for text in (lower, plain))
        for end in range(start + 3, min(size, start + longest) + 1):
            for text, twist in ((lower, 1), (plain, 4)):
                rank = words.rank.get(text[start:end])
                if rank:
                    capitals = 1 if value[start:end].islower() else 2
                    yield start, end, math.log10(rank * twist * capitals + 1)
                    break
        date = DATE.match(value, start)
        if date:
            yield start, date.end(), math.log10(
                366 * 120 * 4 if date.end() - start > 4 else 120)
        end, turns = start + 1, 0
        while end < size and _next_to(keys[end - 1], keys[end]):
            if end - start > 1 and (
                keys[end] == keys[end - 2] or _PLACE[keys[end]][0] != _PLACE[keys[end - 1]][0]
            ):
                turns += 1
            end += 1
            if end - start >= 3:
                cost = math.log10(47 * (end - start) * 6.0 ** (turns + 1))
                if cost >= enough:
                    break  # longer walks cost more
                yield start, end, cost
        for period in range(1, min(LONGEST_PERIOD, (size - start) // 2) + 1):
            end = max(matched[period], start)
            while end + period < size and value[end] == value[end + period]:
                end += 1
            matched[period] = end
            times = (end - start) // period + 1
            if times > 1 and times * period > 2:
                own = before[start + period] - before[start]
                yield start, start + times * period, own + math.log10(times)


def _cheapest(value: str, enough: float, words: Words) -> float:
    """Cost of the cheapest segmentation; each further segment doubles the guesses. At `enough` or
    above, a lower bound of it: whichever way leads past a place costs that much up to there."""
    if not value:
        return 0.0
    size = len(value)
    parts = _segments(value, enough, words)
    part = next(parts, None)
    cheapest = [0.0] + [math.inf] * size
    brute = math.inf  # cheapest with brute force up to here
    ahead: list[tuple[float, int]] = []  # costs of segments that end further on
    for at, char in enumerate(value):
        while part and part[0] == at:
            cost, end = cheapest[at] + part[2] + _BETWEEN, part[1]
            if cost < cheapest[end]:
                cheapest[end] = cost
                heappush(ahead, (cost, end))
            part = next(parts, None)
        brute = min(brute, cheapest[at] + _BETWEEN) + _STEPS[_alphabet(char)]
        cheapest[at + 1] = min(cheapest[at + 1], brute)
        while ahead and ahead[0][1] <= at + 1:
            heappop(ahead)
        least = min(cheapest[at + 1], ahead[0][0]) if ahead else cheapest[at + 1]
        if least >= enough:
            return least
    return cheapest[size]


@lru_cache(maxsize=50_000)
def _cached(value: str, enough: float, words: Words) -> float:
    return _cheapest(value, enough, words)


def log10_guesses(value: str, enough: float = math.inf, words: Words = _BUILT_IN) -> float:
    return (_cached if len(value) <= CACHED_CHARS else _cheapest)(value, enough, words)


def spans(text: str | None, min_guesses: float = MIN_LOG10_GUESSES,
          words: Words = _BUILT_IN) -> list[tuple]:
    """(start, kind's place in KINDS, end), in order."""
    if not text:
        return []
    found = []
    lower = text.lower()
    if CONTEXT_HINT.search(lower):
        for match in ASSIGN.finditer(text):
            if len(match[2]) >= ASSIGN_CHARS:
                found.append((match.start(), 0, match.end()))
        starts, ends = [s[0] for s in found], [s[2] for s in found]
        for match in CONTEXT.finditer(text):
            value = match[1].rstrip("\"'`,;.)]}")
            start, end = match.start(1), match.start(1) + len(value)
            base = bisect_right(starts, start) - 1
            if len(value) < 8 or base >= 0 and start < ends[base]:
                continue  # a base span already has it
            if log10_guesses(value, min_guesses, words) >= min_guesses:
                found.append((start, 3, end))
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def redact(text: str | None, mark: str = "[SECRET]", words: Words = _BUILT_IN) -> str | None:
    """The text with every span, overlapping ones together, replaced by the mark."""
    found = spans(text, words=words)
    if not found:
        return text
    out, end = [], 0
    for start, _, stop in found:
        if start >= end:
            out += [text[end:start], mark]
        end = max(end, stop)
    return "".join(out) + text[end:]


def scan(text: Column, common: str = "") -> Column:
    """array<struct<kind, start, end>> of a text column, by start and kind, with the corpus's
    `common_words`."""

    @F.pandas_udf("array<struct<kind: string, start: long, end: long>>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([
                [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans(text, words=_words(common))]
                for text in batch
            ], dtype=object)

    return found(text)


def redacted(text: Column, common: str = "") -> Column:
    @F.pandas_udf("string")
    def without(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([redact(text, words=_words(common)) for text in batch], dtype=object)

    return without(text)
