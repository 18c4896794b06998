"""Benchmark decontamination with suffix arrays of the training texts.

Words are runs of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]` after lower-casing A-Z. A test item's windows are its
runs of `WINDOW` words (a shorter item is one window), and a document's word is hit if it lies in
any occurrence of a window.

Each task gathers the documents it reads into shards of about `SHARD_BYTES` (a longer text is a
shard of its own) and builds the shard's suffix array over words: positions sorted by the words that
follow, by prefix doubling that touches only suffixes still tied. Each document ends in a mark of its
own, so nothing matches across documents; equal texts of a shard enter it once. Two binary searches
per test suffix bound the range of training suffixes that begin with its window; ranges of different
windows are disjoint, so hits are marked in time linear in the shard, however often a passage recurs.
Words are named by 64-bit hashes, and found windows are compared byte by byte before they count.

Training texts are never shuffled. Test items reach the tasks as broadcasts of bounded size: blocks of
about `BLOCK_BYTES`, as many as the table needs, which a task searches one after another. A single item
is never cut, so a block is at most `BLOCK_BYTES` plus what hashing and the last item add.

Defined results: a null or empty text has no words, is never hit and stays; rows that share a doc_id are
judged one by one; items without words match nothing; rows that share an item_id are one item (found if
any of them is), and all items without an id are one item, listed as an empty string. An empty table of
items leaves every document as it is.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlens.llm.common import bounded_batches, materialized

WINDOW = 10
SHARD_BYTES = 6 << 20
BLOCK_BYTES = 8 << 20
# Sorting packs two ranks and a position into 63 bits; larger shards take a slower sort.
_BITS = 21
_COMPARED = 1 << 20  # words compared at once

_BLANK = 0x20
_LOWER = bytes(
    c if c >= 0x80 or chr(c).isdigit() or "a" <= chr(c) <= "z"
    else c + 0x20 if "A" <= chr(c) <= "Z" else _BLANK
    for c in range(256)
)


# ---------------------------------------------------------------------------------- words


@dataclass
class Words:
    """The words of several texts: lower-cased bytes, each word's bounds, hash and text."""

    data: bytes
    starts: np.ndarray
    ends: np.ndarray
    names: np.ndarray
    text_of: np.ndarray
    n_texts: int

    def counts(self) -> np.ndarray:
        return np.bincount(self.text_of, minlength=self.n_texts)

    def run(self, first: int, count: int) -> bytes:
        """So many words, joined by single blanks."""
        return b" ".join(self.data[self.starts[first]:self.ends[first + count - 1]].split())


def words_of(texts: list[bytes]) -> Words:
    data = b" ".join(texts).translate(_LOWER) + b" " * 8
    chars = np.frombuffer(data, dtype=np.uint8)
    inside = np.empty(len(chars) + 1, dtype=bool)
    inside[0] = False
    np.not_equal(chars, _BLANK, out=inside[1:])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    text_ends = np.cumsum(lengths + 1)
    text_of = np.searchsorted(text_ends, starts, side="right")
    return Words(data, starts, ends, _names(data, starts, ends), text_of, len(texts))


def _names(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words, eight bytes at a time."""
    eights = np.ndarray((max(0, len(data) - 7),), dtype="<u8", buffer=data, strides=(1,))
    lengths = ends - starts
    names = lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    at, rest, rows = starts, lengths, None
    while len(at):
        piece = eights[at]
        short = np.minimum(rest, 8).astype(np.uint64)
        piece &= np.uint64(0xFFFFFFFFFFFFFFFF) >> ((np.uint64(8) - short) * np.uint64(8))
        mixed = (names if rows is None else names[rows]) ^ piece
        mixed *= np.uint64(0xFF51AFD7ED558CCD)
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xC4CEB9FE1A85EC53)
        mixed ^= mixed >> np.uint64(29)
        if rows is None:
            names = mixed
        else:
            names[rows] = mixed
        longer = np.flatnonzero(rest > 8)
        rows = longer if rows is None else rows[longer]
        at, rest = at[longer] + 8, rest[longer] - 8
    return names


# -------------------------------------------------------------------------- suffix arrays


def _sorted_positions(high: np.ndarray, low: np.ndarray, positions: np.ndarray):
    """Positions sorted by (high, low), and where a new pair begins."""
    bound = 1 << _BITS
    if max(high.max(), low.max(), positions.max()) < bound:
        packed = (high << (2 * _BITS)) | (low << _BITS) | positions
        packed.sort()
        pairs = packed >> _BITS
        order = packed & (bound - 1)
    else:
        pairs = (high << 32) | low
        by = np.argsort(pairs, kind="stable")
        pairs, order = pairs[by], positions[by]
    new = np.empty(len(pairs), dtype=bool)
    new[0] = True
    np.not_equal(pairs[1:], pairs[:-1], out=new[1:])
    return order, new


def suffix_array(tokens: np.ndarray) -> np.ndarray:
    """Positions of all suffixes in order. Tokens are small non-negative numbers."""
    n = len(tokens)
    if not n:
        return np.zeros(0, dtype=np.int64)
    following = np.zeros(n, dtype=np.int64)
    following[:-1] = tokens[1:] + 1
    order, new = _sorted_positions(tokens.astype(np.int64), following, np.arange(n))
    # a rank is where a group of tied suffixes begins, so that it stays when others are split
    rank = np.zeros(n + 1, dtype=np.int64)
    group = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank[order] = group + 1  # zero stands for the end of all texts
    sorted_by = 2
    places = _tied(new, np.arange(n))
    while len(places):
        tied = order[places]
        later = rank[np.minimum(tied + sorted_by, n)]
        tied, new = _sorted_positions(rank[tied], later, tied)
        order[places] = tied
        rank[tied] = np.maximum.accumulate(np.where(new, places, 0)) + 1
        places = _tied(new, places)
        sorted_by *= 2
    return order


def _tied(new: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The places of groups of more than one."""
    last = np.empty(len(new), dtype=bool)
    last[:-1] = new[1:]
    last[-1] = True
    return places[~(new & last)]


def _numbered(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of words in the order of their hashes, and the sorted different hashes."""
    n = len(names)
    if 0 < n < 1 << _BITS:
        kept = np.uint64(_BITS + 1)  # 42 bits of the hash and the position make 63
        packed = ((names >> kept) << np.uint64(_BITS)) | np.arange(n, dtype=np.uint64)
        packed.sort()
        order = (packed & np.uint64((1 << _BITS) - 1)).astype(np.int64)
        ordered = names[order]
        if (ordered[1:] >= ordered[:-1]).all():  # else different hashes agree in 42 bits
            new = np.empty(n, dtype=bool)
            new[0] = True
            np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
            numbers = np.empty(n, dtype=np.int64)
            numbers[order] = np.cumsum(new) - 1
            return numbers, ordered[new]
    different, numbers = np.unique(names, return_inverse=True)
    return numbers.astype(np.int64), different


class Shard:
    """The suffix array of several texts."""

    def __init__(self, texts: list[bytes]):
        self.words = words = words_of(texts)
        numbers, self.vocabulary = _numbered(words.names)
        # a mark of its own after each text; marks sort after all words
        n = len(numbers)
        self.tokens = np.empty(n + words.n_texts, dtype=np.int64)
        self.place_of = np.arange(n) + words.text_of
        marks = np.ones(len(self.tokens), dtype=bool)
        marks[self.place_of] = False
        self.tokens[self.place_of] = numbers
        self.tokens[marks] = len(self.vocabulary) + np.arange(words.n_texts)
        self.word_at = np.cumsum(~marks) - 1
        order = suffix_array(self.tokens)
        self.order = order[~marks[order]]

    def number(self, names: np.ndarray) -> np.ndarray:
        """The numbers of words given by their hashes, -1 for words that the shard lacks."""
        if not len(self.vocabulary):
            return np.full(len(names), -1)
        at = np.minimum(np.searchsorted(self.vocabulary, names), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == names, at, -1)

    def bound(self, wanted: np.ndarray, at: np.ndarray, widths: np.ndarray, after: bool):
        """By binary search: how many training suffixes come before (or, with `after`, before or
        begin with) each run of `widths` words from `at` on in `wanted`."""
        low = np.zeros(len(at), dtype=np.int64)
        high = np.full(len(at), len(self.order), dtype=np.int64)
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            middle = (low[open_] + high[open_]) >> 1
            sign, _ = self._compared(self.order[middle], wanted, at[open_], widths[open_])
            before = sign < 0 if not after else sign <= 0
            low[open_[before]] = middle[before] + 1
            high[open_[~before]] = middle[~before]

    def _compared(self, places, wanted, at, widths, known=0):
        """The order of training suffixes against runs of words (-1, 0 or 1), and how many
        words agree. Compares twice as many words in each round, within bounded memory."""
        sign = np.zeros(len(places), dtype=np.int8)
        agree = np.minimum(known, widths)
        rows = np.flatnonzero(agree < widths)
        step = 1
        while len(rows):
            ahead = agree[rows, None] + np.arange(step)
            own = self.tokens[np.minimum(places[rows, None] + ahead, len(self.tokens) - 1)]
            other = wanted[np.minimum(at[rows, None] + ahead, len(wanted) - 1)]
            differ = (own != other) & (ahead < widths[rows, None])
            first = differ.argmax(axis=1)
            each = np.arange(len(rows))
            ended = differ[each, first]
            less = own[each, first] < other[each, first]
            sign[rows[ended]] = np.where(less[ended], -1, 1)
            agree[rows] = np.where(ended, agree[rows] + first,
                                   np.minimum(agree[rows] + step, widths[rows]))
            rows = rows[~ended]
            rows = rows[agree[rows] < widths[rows]]
            step = max(1, min(2 * step, _COMPARED // max(1, len(rows))))
        return sign, agree

    def longest(self, wanted, at, widths, low, high):
        """The longest match of each run of words among training suffixes low to high (by
        binary search, its neighbours in order): its words, and where it lies."""
        low, high, first, last = low.copy(), high.copy(), low, high
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_]) >> 1
            sign, _ = self._compared(self.order[middle], wanted, at[open_], widths[open_], WINDOW)
            before = sign < 0
            low[open_[before]] = middle[before] + 1
            high[open_[~before]] = middle[~before]
        best = np.zeros(len(at), dtype=np.int64)
        place = np.zeros(len(at), dtype=np.int64)
        for step in (-1, 0):  # the suffixes before and after
            near = low + step
            rows = np.flatnonzero((near >= first) & (near < last))
            _, agree = self._compared(self.order[near[rows]], wanted, at[rows], widths[rows])
            better = agree > best[rows]
            best[rows[better]] = agree[better]
            place[rows[better]] = self.order[near[rows[better]]]
        return best, place


# --------------------------------------------------------------------------------- items


class Items:
    """A block of test items: their suffixes that begin a window, and their different windows."""

    def __init__(self, ids: list[str], texts: list[bytes]):
        self.ids = ids
        self.words = words = words_of(texts)
        self.names, self.name_of = np.unique(words.names, return_inverse=True)
        counts = words.counts()
        ends = np.cumsum(counts)
        width = np.minimum(counts, WINDOW)[words.text_of]
        position = np.arange(len(words.names))
        begins = np.flatnonzero(position + width <= ends[words.text_of])
        self.at, self.width, self.item = begins, width[begins], words.text_of[begins]
        self.rest = ends[self.item] - begins
        self.first = begins - (ends - counts)[self.item]
        self._number_windows(texts)
        self._class_windows()

    def _number_windows(self, texts: list[bytes]) -> None:
        """Equal windows get one number: they are neighbours in the items' own suffix array."""
        shard = Shard(texts)
        own = np.full(len(shard.tokens), -1)
        own[shard.place_of[self.at]] = np.arange(len(self.at))
        sorted_ = own[shard.order]
        sorted_ = sorted_[sorted_ >= 0]
        places, width = shard.place_of[self.at[sorted_]], self.width[sorted_]
        new = np.ones(len(sorted_), dtype=bool)
        new[1:] = width[1:] != width[:-1]
        for step in range(WINDOW):
            rows = np.flatnonzero(~new & (width > step))
            new[rows] = shard.tokens[places[rows] + step] != shard.tokens[places[rows - 1] + step]
        self.window = np.empty(len(sorted_), dtype=np.int64)
        self.window[sorted_] = np.cumsum(new) - 1
        self.sample = sorted_[new]  # one place of each window

    def _class_windows(self) -> None:
        """Windows of the same items share a class, so that a passage adds its items once."""
        pairs = np.unique(np.stack([self.window, self.item]), axis=1)
        count = np.bincount(pairs[0], minlength=len(self.sample))
        self.class_of = np.empty(len(self.sample), dtype=np.int64)
        alone = count[pairs[0]] == 1
        self.class_of[pairs[0][alone]] = pairs[1][alone]
        self.classes = [(i,) for i in range(len(self.ids))]
        shared: dict[tuple, int] = {}
        first = np.cumsum(count) - count
        for window in np.flatnonzero(count > 1).tolist():
            items = tuple(pairs[1][first[window]:first[window] + count[window]].tolist())
            self.class_of[window] = shared.setdefault(items, len(self.classes) + len(shared))
        self.classes += list(shared)


@dataclass
class Found:
    """What windows hit in a shard: the words, and for each text the ids of items found."""

    hit: np.ndarray
    items: list[set]


def search(shard: Shard, block: Items, found: Found) -> None:
    """Mark the words that occurrences of the block's windows cover."""
    if not len(block.at) or not len(shard.order):
        return
    wanted = shard.number(block.names)[block.name_of]
    windows = _present(wanted, block.at[block.sample], block.width[block.sample])
    at, widths = block.at[block.sample[windows]], block.width[block.sample[windows]]
    low = shard.bound(wanted, at, widths, after=False)
    sizes = shard.bound(wanted, at, widths, after=True) - low
    # every occurrence, range by range
    which = np.repeat(np.arange(len(sizes)), sizes)
    within = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    first = shard.word_at[shard.order[low[which] + within]]
    same = np.fromiter(
        (shard.words.run(f, w) == block.words.run(a, w) for f, a, w in zip(
            first.tolist(), at[which].tolist(), widths[which].tolist())),
        dtype=bool, count=len(first))
    which, first = which[same], first[same]
    change = np.zeros(len(found.hit) + 1, dtype=np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, first + widths[which], -1)
    found.hit |= np.cumsum(change[:-1]) > 0
    pairs = np.unique(np.stack([shard.words.text_of[first], block.class_of[windows[which]]]), axis=1)
    for text, items in pairs.T.tolist():
        found.items[text].update(block.ids[i] for i in block.classes[items])


def _present(wanted: np.ndarray, at: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """The runs all of whose words the shard has."""
    missing = np.concatenate([[0], np.cumsum(wanted < 0)])
    return np.flatnonzero(missing[at + widths] == missing[at])


def longest_in_shard(shard: Shard, block: Items) -> list[tuple]:
    """The longest match of every test suffix whose window the shard has, without those that the
    match of the suffix before includes: (item id, its word, words, text, the text's word)."""
    if not len(block.at) or not len(shard.order):
        return []
    wanted = shard.number(block.names)[block.name_of]
    rows = _present(wanted, block.at, block.width)
    low = shard.bound(wanted, block.at[rows], block.width[rows], after=False)
    high = shard.bound(wanted, block.at[rows], block.width[rows], after=True)
    rows, low, high = rows[low < high], low[low < high], high[low < high]
    at, item = block.at[rows], block.item[rows]
    best, places = shard.longest(wanted, at, block.rest[rows], low, high)
    included = np.zeros(len(rows), dtype=bool)
    included[1:] = (item[1:] == item[:-1]) & (at[1:] == at[:-1] + 1) & (
        at[1:] + best[1:] == at[:-1] + best[:-1])
    first_word = np.searchsorted(shard.words.text_of, np.arange(shard.words.n_texts))
    out = []
    for n in np.flatnonzero(~included).tolist():
        word, words = int(shard.word_at[places[n]]), int(best[n])
        if shard.words.run(word, words) == block.words.run(at[n], words):
            text = int(shard.words.text_of[word])
            out.append((block.ids[item[n]], int(block.first[rows[n]]), words, text,
                        int(word - first_word[text])))
    return out


# -------------------------------------------------------------------------------- tables


def _blocks(benchmark: DataFrame) -> list:
    """The items as broadcasts of bounded size."""
    spark = benchmark.sparkSession
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
        F.col("text").cast("binary").alias("text"),
    ).filter("length(text) > 0")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    number = -(-size // BLOCK_BYTES)
    if number > 1:
        items = materialized(
            items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(number)))
            .repartitionByRange(number, "block"), "benchmark-blocks")
    sent = []
    for n in range(number):
        rows = (items.filter(F.col("block") == n) if number > 1 else items).collect()
        sent.append(spark.sparkContext.broadcast(
            Items([r.item_id for r in rows], [bytes(r.text) for r in rows])))
    return sent


def _each(blocks: list) -> Iterator[Items]:
    """The blocks one after another; with several, no more than one is kept in memory."""
    for block in blocks:
        yield block.value
        if len(blocks) > 1:
            vars(block).pop("_value", None)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes], list[int]]]:
    """Pieces of batches with about SHARD_BYTES of text in all, their different texts, and the
    number of each row's text."""
    pieces, numbers, rows, size = [], {}, [], 0
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index("text")).cast(pa.binary()).to_pylist()
        first = 0
        for n, text in enumerate(texts):
            text = text or b""
            rows.append(numbers.setdefault(text, len(numbers)))
            size += len(text) + 1
            if size >= SHARD_BYTES:
                pieces.append(batch.slice(first, n + 1 - first))
                yield pieces, list(numbers), rows
                pieces, numbers, rows, size, first = [], {}, [], 0, n + 1
        if first < len(texts):
            pieces.append(batch.slice(first))
    if pieces:
        yield pieces, list(numbers), rows


def _judged(batches: Iterator[pa.RecordBatch], blocks: list):
    """Each shard's pieces and, by row: words, words hit, items found."""
    for pieces, texts, rows in _shards(batches):
        shard = Shard(texts)
        found = Found(np.zeros(len(shard.words.starts), dtype=bool), [set() for _ in texts])
        for block in _each(blocks):
            search(shard, block, found)
        n_words = shard.words.counts()
        n_hit = np.bincount(shard.words.text_of[found.hit], minlength=len(texts))
        yield pieces, n_words[rows], n_hit[rows], [found.items[r] for r in rows]


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_hit (words in occurrences of windows) and items (the
    sorted ids, as strings, of test items with a window in it)."""
    blocks = _blocks(benchmark)

    def judge(batches):
        for pieces, n_words, n_hit, items in _judged(batches, blocks):
            ids = pa.concat_arrays([p.column(0) for p in pieces])
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                 pa.array([sorted(i) for i in items], pa.list_(pa.string()))],
                ["doc_id", "n_words", "n_hit", "items"])

    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        judge, "doc_id long, n_words long, n_hit long, items array<string>")


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, with all their columns, that hold no window of any test item."""
    blocks = _blocks(benchmark)

    def clean(batches):
        for pieces, _, n_hit, _ in _judged(batches, blocks):
            at = 0
            for piece in pieces:
                yield piece.filter(pa.array(n_hit[at:at + len(piece)] == 0))
                at += len(piece)

    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(clean, docs.schema)


def longest_matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The longest verbatim matches of test items in the corpus, and a place of each: item_id,
    item_word (where it begins in the item), n_words, doc_id, doc_word. Matches inside another
    of the same item are left out; of several places the smallest doc_id and word is named."""
    blocks = _blocks(benchmark)

    def longest(batches):
        for pieces, texts, rows in _shards(batches):
            ids = pa.concat_arrays([p.column(0) for p in pieces]).to_pylist()
            least = {}
            for text, doc in zip(rows, ids):
                own = least.get(text)
                least[text] = doc if own is None or (doc is not None and doc < own) else own
            shard = Shard(texts)
            for block in _each(blocks):
                found = [(i, f, w, least[t], d) for i, f, w, t, d in longest_in_shard(shard, block)]
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(column, kind) for column, kind in zip(
                            zip(*found), (pa.string(),) + (pa.int64(),) * 4)],
                        ["item_id", "item_word", "n_words", "doc_id", "doc_word"])

    bounded_batches(docs.sparkSession)
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        longest, "item_id string, item_word long, n_words long, doc_id long, doc_word long")
    best = found.groupBy("item_id", "item_word").agg(F.min_by(
        F.struct("n_words", "doc_id", "doc_word"),
        F.struct(-F.col("n_words"), F.col("doc_id").isNull(), "doc_id", "doc_word")).alias("best"))
    best = best.select("item_id", "item_word", "best.*")
    earlier = Window.partitionBy("item_id").orderBy("item_word").rowsBetween(
        Window.unboundedPreceding, -1)
    end = F.col("item_word") + F.col("n_words")
    return best.withColumn("_reached", F.max(end).over(earlier)).filter(
        F.col("_reached").isNull() | (end > F.col("_reached"))).drop("_reached")
