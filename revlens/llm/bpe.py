"""Byte-level BPE with a rank queue: encode texts to ids and ids back to bytes.

A queue holds the mergeable pairs of one pre-token, or of all pre-tokens of a slice of texts that are new.
Every merge rank has a bucket of positions in the linked list of parts; a bitmap of two levels, 256 ranks to a
bit of the upper one, marks the ranks whose buckets are not empty, so that the next rank is
found by two find-first-set steps whatever the length of the list. A merge never searches the
queue for the pairs it destroys: their entries stay and are skipped when they come up.
A pre-token of n bytes takes O(n log n) steps, also when it is a megabyte without a blank.

Pre-tokens do not touch each other, so new ones of up to `SHORT` bytes lie in one list, apart by a cell that
merges with nothing, and a bucket is merged in one step on arrays: a step per rank, not one per merge.
Longer ones, or a few, are merged one entry at a time.

Defined results: null and empty texts have no ids; special tokens are ordinary text; the
pattern is applied to whole texts; equal rows give equal results. Texts travel in Arrow batches,
rows of one text each, without any shuffle. Each Python worker remembers the ids of about
`REMEMBERED` blank-separated words and as many pre-tokens, and those of one slice more; the memory is
emptied when full and changes no result.
"""

import base64
import re
from collections.abc import Iterable, Iterator
from functools import cache
from heapq import heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

REMEMBERED = 200_000
# Words and pre-tokens beyond this are neither remembered nor merged with others.
SHORT = 64
# So many new pre-tokens at least are merged together.
MANY = 1000
# Characters of texts whose new pre-tokens are merged together.
SLICE = 1_000_000
WORD_BITS = 8
WORD_MASK = (1 << WORD_BITS) - 1
# Separators of information that one regular-expression library counts as white space and
# another does not: texts with them are cut by the pattern alone.
_UNCLEAR = re.compile("[\x1c-\x1f]")
_SINGLE_BLANK = re.compile(r"(?<=\S) (?=\S)")
# White space as the Unicode property has it.
_WHITE = "\t-\r \x85\xa0  -     　"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {
            base64.b64decode(token): int(rank)
            for token, rank in (line.split() for line in lines if line.strip())
        }


class RankQueue:
    """Positions by merge rank: `low` has a bit for each rank, `top` one for each word of `low`.

    Empty again after every use, so one queue serves all. `Encoder.merge` works on
    its parts directly: a call for every push and pop would double the time."""

    def __init__(self, ranks: int):
        self.buckets: dict[int, list] = {}
        self.low = [0] * ((ranks >> WORD_BITS) + 1)
        self.top = 0

    def push(self, positions: np.ndarray, ranks: np.ndarray) -> None:
        """Each position into the bucket of its rank."""
        order = np.argsort(ranks, kind="stable")
        positions, ranks = positions[order], ranks[order]
        starts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        starts = [0, *starts.tolist(), len(ranks)]
        buckets, low = self.buckets, self.low
        for rank, start, end in zip(ranks[starts[:-1]].tolist(), starts, starts[1:]):
            if rank in buckets:
                buckets[rank].append(positions[start:end])
            else:
                buckets[rank] = [positions[start:end]]
                low[rank >> WORD_BITS] |= 1 << (rank & WORD_MASK)
                self.top |= 1 << (rank >> WORD_BITS)

    def pop(self) -> tuple[int, np.ndarray]:
        """The lowest rank and its positions in ascending order."""
        word = (self.top & -self.top).bit_length() - 1
        bits = self.low[word]
        rank = (word << WORD_BITS) + (bits & -bits).bit_length() - 1
        self.low[word] = bits = bits & (bits - 1)
        if not bits:
            self.top &= self.top - 1
        bucket = self.buckets.pop(rank)
        return rank, np.sort(bucket[0] if len(bucket) == 1 else np.concatenate(bucket))


class Pairs:
    """The rank of a part followed by another, for arrays of parts.

    A part is a token's id, or for a byte without one `size` and the byte; `none` is no part.
    `falling` has the parts that are in a pair of lower rank than their own."""

    def __init__(self, ranks: dict[bytes, int]):
        self.size = max(ranks.values(), default=-1) + 1
        self.none = self.size + 256
        parts = {bytes([b]): self.size + b for b in range(256)} | ranks
        self.of_byte = np.array([parts[bytes([b])] for b in range(256)], dtype=np.int32)
        self.of_bytes = np.full(1 << 16, -1, dtype=np.int32)
        self.falling = set()
        found = []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = parts.get(token[:cut]), parts.get(token[cut:])
                if left is None or right is None:
                    continue
                found.append((left, right, rank))
                self.falling.update(part for part in (left, right) if part >= rank)
            if len(token) == 2:
                self.of_bytes[token[0] << 8 | token[1]] = rank
        left, right, rank = np.array(found, dtype=np.int32).reshape(-1, 3).T
        bounds = np.arange(self.none + 2)
        order = np.argsort(left, kind="stable")
        self.rights, self.right_ranks = right[order], rank[order]
        self.right_bounds = np.searchsorted(left[order], bounds).tolist()
        order = np.argsort(right, kind="stable")
        self.lefts, self.left_ranks = left[order], rank[order]
        self.left_bounds = np.searchsorted(right[order], bounds).tolist()
        self.row = np.full(self.none + 1, -1, dtype=np.int32)

    def with_right(self, part: int, rights: np.ndarray) -> np.ndarray:
        """Ranks of one part followed by each of `rights`, -1 for none."""
        start, end = self.right_bounds[part], self.right_bounds[part + 1]
        return self._look_up(self.rights[start:end], self.right_ranks[start:end], rights)

    def with_left(self, part: int, lefts: np.ndarray) -> np.ndarray:
        """Ranks of each of `lefts` followed by one part, -1 for none."""
        start, end = self.left_bounds[part], self.left_bounds[part + 1]
        return self._look_up(self.lefts[start:end], self.left_ranks[start:end], lefts)

    def _look_up(self, others: np.ndarray, ranks: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        row = self.row
        row[others] = ranks
        found = row[wanted]
        row[others] = -1
        return found


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(_plain_white_space(pattern))
        self.queue = RankQueue(max(ranks.values(), default=0) + 1)
        self.pairs = Pairs(ranks)
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one pre-token."""
        rank_of = self.ranks.get
        whole = rank_of(piece)
        if whole is not None:
            return [whole]
        buckets, low, top = self.queue.buckets, self.queue.low, 0
        size = len(piece)
        after = list(range(1, size + 2))
        before = list(range(-1, size))
        rank_at = [rank_of(piece[i:i + 2]) for i in range(size - 1)]
        rank_at += (None, None)
        for i, rank in enumerate(rank_at):
            if rank is not None:
                if rank in buckets:
                    buckets[rank].append(i)
                else:
                    buckets[rank] = [i]
                    low[rank >> WORD_BITS] |= 1 << (rank & WORD_MASK)
                    top |= 1 << (rank >> WORD_BITS)
        while top:
            word = (top & -top).bit_length() - 1
            bits = low[word]
            rank = (word << WORD_BITS) + (bits & -bits).bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                i = heappop(bucket)
            else:
                i = bucket[0]
                del buckets[rank]
                low[word] = bits = bits & (bits - 1)
                if not bits:
                    top &= top - 1
            if rank_at[i] != rank:
                continue  # stale: a merge has changed the pair since
            taken = after[i]
            end = after[taken]
            rank_at[taken] = None
            after[i] = end
            before[end] = i
            # the two pairs that the new part makes
            found = rank_at[i] = rank_of(piece[i:after[end]]) if end < size else None
            if found is not None:
                if found in buckets:
                    heappush(buckets[found], i)
                else:
                    buckets[found] = [i]
                    low[found >> WORD_BITS] |= 1 << (found & WORD_MASK)
                    top |= 1 << (found >> WORD_BITS)
            if i:
                left = before[i]
                found = rank_at[left] = rank_of(piece[left:end])
                if found is not None:
                    if found in buckets:
                        heappush(buckets[found], left)
                    else:
                        buckets[found] = [left]
                        low[found >> WORD_BITS] |= 1 << (found & WORD_MASK)
                        top |= 1 << (found >> WORD_BITS)
        ids, i = [], 0
        while i < size:
            ids.append(rank_of(piece[i:after[i]]))
            i = after[i]
        return ids

    def merge_together(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each of many pre-tokens, none of which is a token as a whole."""
        pairs, queue = self.pairs, self.queue
        laid = np.frombuffer(b"\0" + b"\0".join(pieces) + b"\0", dtype=np.uint8)
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)) + 1)
        ids = pairs.of_byte[laid]
        ids[0] = ids[ends] = pairs.none
        rank_at = np.full(len(laid), -1, dtype=np.int32)
        rank_at[:-1] = pairs.of_bytes[laid[:-1].astype(np.int32) << 8 | laid[1:]]
        rank_at[0] = rank_at[ends] = rank_at[ends - 1] = -1
        after = np.arange(1, len(laid) + 1, dtype=np.int32)
        before = np.arange(-1, len(laid) - 1, dtype=np.int32)
        i = np.flatnonzero(rank_at >= 0).astype(np.int32)
        if len(i):
            queue.push(i, rank_at[i])
        while queue.top:
            rank, i = queue.pop()
            i = i[rank_at[i] == rank]  # others are stale: a merge has changed the pair since
            if not len(i):
                continue
            if len(i) > 1:
                # Pairs that share a part wait for the earlier one; if this merge may make a pair of
                # lower rank, so do all but the first of a pre-token.
                waits = np.zeros(len(i), dtype=bool)
                if rank in pairs.falling:
                    piece = np.searchsorted(ends, i)
                    waits[1:] = piece[1:] == piece[:-1]
                else:
                    waits[1:] = after[i[:-1]] == i[1:]
                if waits.any():
                    rest = i[waits]
                    queue.push(rest, np.full(len(rest), rank, dtype=np.int32))
                    i = i[~waits]
            taken = after[i]
            end = after[taken]
            rank_at[taken] = ids[taken] = -1
            ids[i] = rank
            after[i] = end
            before[end] = i
            left = before[i]
            # the two pairs that each new part makes; one between two new parts is pushed once
            rank_at[left] = pairs.with_left(rank, ids[left])
            rank_at[i] = pairs.with_right(rank, ids[end])
            once = np.ones(len(i), dtype=bool)
            once[1:] = left[1:] != i[:-1]
            i = np.concatenate((i, left[once]))
            found = rank_at[i]
            pushed = found >= 0
            if pushed.any():
                queue.push(i[pushed], found[pushed])
        kept = (ids >= 0) & (ids != pairs.none)
        if (ids[kept] >= pairs.size).any():
            raise ValueError("a byte has no token")
        packed = ids[kept].astype("<u4").tobytes()
        stops = (4 * np.cumsum(kept)[ends]).tolist()
        return [packed[start:stop] for start, stop in zip([0, *stops], stops)]

    def merge_all(self, pieces: Iterable[str]) -> dict[str, bytes]:
        """The ids of pre-tokens."""
        found, short = {}, {}
        for piece in pieces:
            raw = piece.encode()
            whole = self.ranks.get(raw)
            if whole is not None:
                found[piece] = whole.to_bytes(4, "little")
            elif len(raw) <= SHORT:
                short[piece] = raw
            else:
                found[piece] = _packed(self.merge(raw))
        if len(short) < MANY:
            found.update((piece, _packed(self.merge(raw))) for piece, raw in short.items())
        else:
            found.update(zip(short, self.merge_together(list(short.values()))))
        return found

    def _pieces(self, text: str) -> bytes:
        found = []
        for piece in self.pattern.findall(text):
            ids = self.pieces.get(piece)
            if ids is None:
                ids = _packed(self.merge(piece.encode()))
                if len(piece) <= SHORT:
                    if len(self.pieces) >= REMEMBERED:
                        self.pieces.clear()
                    self.pieces[piece] = ids
            found.append(ids)
        return b"".join(found)

    def _learn(self, new: set[str]) -> None:
        """Adds the ids of words, each with a blank before it, to those remembered."""
        if len(self.pieces) >= REMEMBERED:
            self.pieces.clear()
        words = [word for word in new if " " not in word]
        found = self.pattern.findall(" " + " ".join(words)) if words else []
        starts = [k for k, piece in enumerate(found) if piece[0] == " "]
        alone = [word for word in new if " " in word]
        if len(starts) != len(words):  # not with the pattern of this vocabulary
            words, found, starts, alone = [], [], [], list(new)
        for word in alone:
            words.append(word)
            starts.append(len(found))
            found += self.pattern.findall(" " + word)
        pieces = self.pieces
        made = self.merge_all(set(found).difference(pieces))
        pieces.update(made)
        ids = [pieces[piece] for piece in found]
        for word, start, end in zip(words, starts, [*starts[1:], len(found)]):
            self.words[word] = ids[start] if end - start == 1 else b"".join(ids[start:end])
        for piece in made:
            if len(piece) > SHORT:
                del pieces[piece]

    def _cut(self, text: str, new: set[str]) -> tuple[str, list[str], str]:
        """A text's start, its words without the blanks before them, and its end; words that are not
        known are added to `new`. For any text, but slow."""
        start, *words = [text] if _UNCLEAR.search(text) else _SINGLE_BLANK.split(text)
        end = " " + words.pop() if words and words[-1][-1].isspace() else ""
        new.update(set(words).difference(self.words))
        return start, words, end

    def _encode_slice(self, texts: list[str]) -> list[bytes]:
        """A single blank between two other characters always starts a match of its own, so the
        texts may be cut there. Arrow cuts at every blank and lists the different words; a text
        with white space beside a blank shows by an unknown word and is cut by an expression."""
        if len(self.words) >= REMEMBERED:
            self.words.clear()
        framed = [_framed(text) for text in texts]
        cut = pc.split_pattern(pa.array([frame and frame[1] for frame in framed], pa.large_string()), " ")
        coded = cut.flatten().dictionary_encode()
        different = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = {word for word in different if word not in self.words}
        beside = [word for word in new if not word or word.strip() != word]
        new.difference_update(beside)
        bounds = cut.offsets.to_numpy()
        unclear = [False] * len(texts)
        if beside:
            white = pc.is_in(coded.dictionary, value_set=pa.array(beside, pa.large_string()))
            found = np.flatnonzero(white.take(coded.indices).to_numpy(zero_copy_only=False))
            for k in np.searchsorted(bounds, found, side="right").tolist():
                unclear[k - 1] = True
        loose = {k: self._cut(text, new) for k, text in enumerate(texts) if unclear[k] or not framed[k]}
        self._learn(new)
        known = pa.array([self.words.get(word) for word in different], pa.large_binary())
        ids = known.take(coded.indices)
        places = np.frombuffer(ids.buffers()[1], dtype=np.int64)[bounds].tolist()
        tokens = memoryview(ids.buffers()[2] or b"")
        packed = []
        for k, frame in enumerate(framed):
            if k in loose:
                start, words, end = loose[k]
                middle = b"".join(map(self.words.__getitem__, words))
            else:
                start, _, end = frame
                middle = tokens[places[k]:places[k + 1]]
            packed.append(b"".join((self._pieces(start), middle, self._pieces(end))))
        for word in new:
            if len(word) > SHORT:
                del self.words[word]
        return packed

    def encode_all(self, texts: Iterable[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        packed, held, size = [], [], 0
        for text in texts:
            held.append(text or "")
            size += len(held[-1])
            if size >= SLICE:
                packed += self._encode_slice(held)
                held, size = [], 0
        return packed + self._encode_slice(held)

    def encode(self, text: str | None) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        return self.encode_all((text,))[0]


class Decoder:
    def __init__(self, ranks: dict[bytes, int]):
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)))[:-1]
        self.bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def decode(self, packed: bytes | None) -> bytes:
        if not packed:
            return b""
        ids = np.frombuffer(packed, dtype="<u4")
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        from_token = np.repeat(self.starts[ids] - (ends - lengths), lengths)
        return self.bytes[from_token + np.arange(ends[-1])].tobytes()


def _plain_white_space(pattern: str) -> str:
    """The pattern with white space spelled out, so that libraries agree on it."""
    out, in_class, i = [], False, 0
    while i < len(pattern):
        pair = pattern[i:i + 2]
        if pair == r"\s":
            out.append(_WHITE if in_class else f"[{_WHITE}]")
        elif pair == r"\S":
            out.append(f"[^{_WHITE}]")
        elif pair[0] == "\\":
            out.append(pair)
        else:
            in_class = pair[0] == "[" or in_class and pair[0] != "]"
            out.append(pair[0])
            i += 1
            continue
        i += 2
    return "".join(out)


def _framed(text: str) -> tuple[str, str, str] | None:
    """A text's start before the first blank, its words with a blank between them, and an end
    with white space; None if there are no words, or white space beside the outer blanks."""
    stop = len(text.rstrip())
    first = text.find(" ")
    last = text.rfind(" ", 0, stop) if stop < len(text) else stop
    if not 0 < first < last or text[first - 1].isspace() or text[last + 1:last + 2].isspace() \
            or _UNCLEAR.search(text):
        return None
    return text[:first], text[first + 1:last], text[last:]


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


@cache
def encoder(path: str, pattern: str) -> Encoder:
    """One for each Python worker."""
    return Encoder(read_ranks(path), pattern)


@cache
def decoder(path: str) -> Decoder:
    return Decoder(read_ranks(path))


def encode(text: Column, path: str, pattern: str) -> Column:
    """Ids of a text column, packed as little-endian unsigned 32-bit integers (binary)."""

    @F.pandas_udf("binary")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode_all = encoder(path, pattern).encode_all
        for batch in batches:
            yield pd.Series(encode_all(batch), dtype=object)

    return ids(text)


def decode(packed: Column, path: str) -> Column:
    """The bytes behind packed ids. An id outside the vocabulary is an error."""

    @F.pandas_udf("binary")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        decode_ids = decoder(path).decode
        for batch in batches:
            yield pd.Series([decode_ids(ids) for ids in batch], dtype=object)

    return decoded(packed)
