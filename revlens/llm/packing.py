"""Cost-balanced packing of tokenized documents into training sequences.

Attention makes a piece of n tokens cost n + n * n / capacity: a linear and a quadratic part.
Pieces as long as a sequence fill one each. The rest of every document is dealt, by a hash
of the piece and its place in the table, into bins of about `BIN_BYTES` of text; in a bin the pieces go in descending length
(so descending cost) to the sequence of lowest cost that still has room. Where no sequence can take
a piece whole, it is cut at the roomiest one's end. A bin has exactly as many places as tokens:
full sequences, and for what is left over shorter ones whose lengths are powers of two, so that
nothing is padded.

Defined results: null and empty texts hold the end id alone; equal rows are packed each for
itself, in whatever bins they fall; an empty table gives no pieces. The number of bins follows the bytes
of all texts and the number of documents, so a bin's size does not grow with the input.
"""

import re
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import bounded_batches, texts

CAPACITY = 4096
BIN_BYTES = 4_000_000
# What a document counts for beside its text: its end id, and its row in a bin.
DOCUMENT_BYTES = 64
# A worker keeps at most twice so many words, and works on so many bytes of text at once.
REMEMBERED = 60_000
STEP_BYTES = 2 << 20
BATCH_BYTES = 4 << 20
# Ids of a bin's sequences follow each other; a bin never has this many.
BIN_SEQUENCES = 1 << 24
PIECES = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, "
    "sequence_id long, offset long"
)
_MARKS = ".,"
# The sign that stands for each byte: itself if it prints, else the next one after 255.
_UNPRINTED = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
_BYTE_SIGNS = {b: 256 + n for n, b in enumerate(_UNPRINTED)}
# Characters whose normal form or lower case may depend on others, and separators of information,
# which are white space to one library and not to another.
_SEPARATORS = "\x1c\x1d\x1e\x1f"
_INTRICATE = "[\u0250-\U0010ffff]"


class WordIds:
    """Ids of texts by a tokenizer whose pieces never span white space.

    Blank-separated words are looked up. A new word of letters, with or without a mark that is split
    off anyway, goes straight to the tokenizer's merges; others go through its whole chain. Texts with characters whose normal form
    may depend on others, with separators of information, or with the literal name of a special token, go to it whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.signs = [*_SEPARATORS, *special]
        self.beyond = re.compile(_INTRICATE)
        self.words: dict[str, bytes] = {}  # recent, and those before them
        self.older: dict[str, bytes] = {}
        self.marks = {mark: self._ask(mark) for mark in _MARKS}

    def _intricate(self, text: str) -> bool:
        if any(sign in text for sign in self.signs):
            return True
        try:
            text.encode("latin-1")  # much faster than looking at each character
        except UnicodeEncodeError:
            return bool(self.beyond.search(text))
        return False

    def _ask(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def _letters(self, word: str) -> bytes:
        seen = word if word.isascii() else word.encode().decode("latin-1").translate(_BYTE_SIGNS)
        return array("I", [t.id for t in self.merges.tokenize(seen)]).tobytes()

    def _new(self, word: str) -> bytes:
        """Ids of a word that is not among the recent ones."""
        ids = self.older.pop(word, None)
        if ids is None:
            stem = word[:-1]
            if word.isalpha():
                ids = self._letters(word)
            elif word[-1] in _MARKS and stem.isalpha():
                ids = (self.words.get(stem) or self._new(stem)) + self.marks[word[-1]]
            else:
                ids = self._ask(word)
        self.words[word] = ids
        return ids

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text."""
        return list(self.steps(texts))

    def steps(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text, some texts at a time."""
        at, size = 0, 0
        for n, text in enumerate(texts):
            size += len(text or "")
            if size >= STEP_BYTES or n == len(texts) - 1:
                yield from self._ids(texts[at:n + 1])
                at, size = n + 1, 0

    def _ids(self, texts: list[str | None]) -> list[bytes]:
        """Arrow splits the texts and finds their different words, so that Python sees each of
        these once."""
        simple = [
            "" if not text or self._intricate(text) else text.lower() for text in texts]
        split = pc.utf8_split_whitespace(pa.array(simple, pa.large_string()))
        places = pc.dictionary_encode(split.flatten())
        if len(self.words) >= REMEMBERED:
            self.older, self.words = self.words, {}
        known, new = self.words.get, self._new
        different = places.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = [known(word) or new(word) if word else b"" for word in different]
        lengths = np.fromiter(map(len, found), dtype=np.int32, count=len(found)) // 4
        starts = np.cumsum(lengths, dtype=np.int32) - lengths
        of_word = places.indices.to_numpy()
        taken = lengths[of_word]
        ends = np.zeros(len(taken) + 1, dtype=np.int32)  # of at most 2 GB of text
        np.cumsum(taken, out=ends[1:])
        source = np.repeat(starts[of_word] - ends[:-1], taken)
        source += np.arange(ends[-1], dtype=np.int32)
        ids = np.frombuffer(b"".join(found), dtype="<u4")[source]
        bounds = ends[split.offsets.to_numpy()]
        return [
            self._ask(text) if text and not plain else ids[a:b].tobytes()
            for text, plain, a, b in zip(texts, simple, bounds[:-1], bounds[1:])
        ]


@cache
def word_ids(path: str) -> WordIds:
    """One for each Python worker."""
    return WordIds(path)


def cut(docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """Documents as pieces of at most `capacity` ids, in order, the end id last: doc_id,
    start, length, ids (little-endian unsigned 32-bit), doc_tokens."""
    end = np.array([end_id], dtype="<u4").tobytes()
    width = 4 * capacity

    def pieces(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        steps = word_ids(path).steps
        for batch in batches:
            found, bounds = [], [0]
            for ids in steps(batch.to_pylist()):
                ids += end
                if len(ids) <= width:
                    found.append(ids)
                else:
                    found += [ids[at:at + width] for at in range(0, len(ids), width)]
                bounds.append(len(found))
            yield pa.ListArray.from_arrays(
                pa.array(bounds, pa.int32()), pa.array(found, pa.binary()))

    pieces = F.arrow_udf(pieces, "array<binary>")
    ids_length = (F.octet_length("ids") / 4).cast("long")
    last = F.octet_length(F.element_at("pieces", -1)) / 4
    rows = texts(docs)
    bounded_batches(docs.sparkSession, BATCH_BYTES)
    return (
        rows.select("doc_id", pieces(F.col("text")).alias("pieces"))
        .withColumn("doc_tokens", ((F.size("pieces") - 1) * capacity + last).cast("long"))
        # outer, though there always is a piece: a plain explode would make Spark filter on the
        # pieces first, and tokenize every text twice
        .select("doc_id", "doc_tokens", F.posexplode_outer("pieces").alias("n", "ids"))
        .select("doc_id", (F.col("n").cast("long") * capacity).alias("start"),
                ids_length.alias("length"), "ids", "doc_tokens")
    )


def _cost(length, capacity: int):
    return length + length * length / capacity


def sequence_lengths(tokens: int, capacity: int) -> list[int]:
    """Full sequences, then powers of two for what is left."""
    left = tokens % capacity
    return [capacity] * (tokens // capacity) + [
        1 << bit for bit in range(left.bit_length() - 1, -1, -1) if left >> bit & 1
    ]


def balance(lengths: list[int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(piece, start in it, length, sequence, offset) for pieces below the capacity.

    `lengths` descend. What a cut leaves is placed at once, as if it came next."""
    size = np.array(sequence_lengths(sum(lengths), capacity), dtype=np.int64)
    room, cost = size.copy(), np.zeros(len(size))
    placed = []
    for piece, length in enumerate(lengths):
        start = 0
        while length:
            fits = np.flatnonzero(room >= length)
            if len(fits):
                at = fits[np.argmin(cost[fits])]
                part = length
            else:
                at = np.argmax(room)
                part = int(room[at])
            placed.append((piece, start, part, int(at), int(size[at] - room[at])))
            room[at] -= part
            cost[at] += _cost(part, capacity)
            start += part
            length -= part
    return placed


def pack(pieces: DataFrame, total_bytes: int, capacity: int = CAPACITY) -> DataFrame:
    """Assign the pieces of `cut` to sequences, with the columns PIECES. `total_bytes`, the
    size of all texts and documents, sets the number of bins."""
    bins = max(1, -(-total_bytes // BIN_BYTES))

    names = [c.split()[0] for c in PIECES.split(", ")]
    schema = pa.schema([
        (name, pa.binary() if name == "ids" else pa.int64()) for name in names])

    def fill(key: tuple, group: pa.Table) -> pa.Table:
        pieces = group.select(["doc_id", "start", "length", "ids", "doc_tokens"]).to_pylist()
        pieces.sort(key=lambda r: (-r["length"], r["doc_id"] is None, r["doc_id"] or 0, r["start"]))
        full = [r for r in pieces if r["length"] == capacity]
        rest = pieces[len(full):]
        first = key[0].as_py() * BIN_SEQUENCES
        rows = [{**r, "sequence_id": first + n, "offset": 0} for n, r in enumerate(full)]
        first += len(full)
        for piece, start, length, sequence, offset in balance(
                [r["length"] for r in rest], capacity):
            r = rest[piece]
            rows.append({
                **r, "start": r["start"] + start, "length": length,
                "ids": r["ids"][4 * start:4 * (start + length)],
                "sequence_id": first + sequence, "offset": offset,
            })
        return pa.Table.from_pylist(rows, schema=schema)

    # the place keeps equal rows, such as many without id, out of one bin
    spread = F.xxhash64("doc_id", "start", F.monotonically_increasing_id())
    return (
        pieces.withColumn("bin", F.pmod(spread, F.lit(bins)))
        .groupBy("bin").applyInArrow(fill, PIECES)
    )


def packed(docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    number, size = docs.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    size = (size or 0) + DOCUMENT_BYTES * number
    return pack(cut(docs, path, end_id, capacity), size, capacity)
