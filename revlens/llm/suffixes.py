"""Removal of repeated passages by a distributed merge sort of suffixes.

Every byte that lies in a string of `LENGTH` bytes which also starts earlier in the corpus goes.
Suffixes are sorted in runs, one or more to a task; runs travel front-coded (each suffix without the
prefix it shares with the one before) to the task of their range, where a loser tree merges them.
The tree knows each head's common prefix with the last suffix out, so equal prefixes are never
compared again, and the merged order comes out with its common-prefix lengths, which decide.

Sorting the suffixes of all positions would send the corpus a hundred times over. Two steps
keep it small without losing a match:

- Anchors. Each window of LENGTH bytes is represented by the place in it where a hash over `GRAM`
  bytes is least (the leftmost if several are). Equal windows have it at the same offset, so only
  anchors are sorted, one for about every 35 positions, with the bytes before them that their
  windows need. Two windows are equal if their anchors' suffixes and the bytes before agree far enough.
- Sieve. An anchor whose hash occurs once in the corpus has no equal window anywhere. Only anchors
  whose hash occurs twice or more are sorted.

In a run, windows that another window of the run precedes are settled at once; an anchor all of whose
windows are settled is not sent, so thousands of copies shrink to one per run. A hash that more
than `HOT` anchors have (a passage in many different contexts) would put them all in one range; their
windows are sorted each by itself instead, and ranges are cut by whole windows.

Defined results: null and empty texts have no bytes; texts shorter than LENGTH lose nothing;
"earlier" is a smaller doc_id, or an earlier start where doc_ids are equal; rows that share both
(repeated rows) do not precede each other; rows without id come last.
"""

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import materialized, texts

LENGTH = 100
GRAM = 32
HOT = 4096
RUN_RECORDS = 120_000
RANGE_RECORDS = 60_000
SAMPLES_PER_RANGE = 32
_BEFORE = LENGTH - GRAM  # bytes before an anchor that its windows may need
CHUNK = 1 << 17  # its hashes stay in a core's cache
_LAST = (1 << 63) - 1
_BASE = np.uint64(0x9E3779B97F4A7C15)
# A run's record beside its bytes, column by column: what a suffix shares with the one before, its size,
# that of the bytes before it, least, anchor in the text, doc, row.
_COLUMNS = ("u1", "u1", "u1", "u1", "<u4", "<i8", "<i8")


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes at each position, by doubling."""
    hashes = data.astype(np.uint64) + np.uint64(1)
    power, width = _BASE, 1
    with np.errstate(over="ignore"):
        while width < GRAM:
            hashes = hashes[:-width] * power + hashes[width:]
            power, width = power * power, 2 * width
        hashes ^= hashes >> np.uint64(33)
        hashes *= np.uint64(0xFF51AFD7ED558CCD)
        hashes ^= hashes >> np.uint64(29)
    return hashes


def _least(hashes: np.ndarray, span: int) -> np.ndarray:
    """Index of the least hash among `span` at each position, the leftmost if several.

    The index takes the place of a hash's lowest bits, so one minimum finds both; what
    is least by the other bits is as good as any choice that the bytes alone decide."""
    mask = np.uint64((1 << len(hashes).bit_length()) - 1)
    values = (hashes & ~mask) | np.arange(len(hashes), dtype=np.uint64)
    width = 1
    while width < span:
        step = min(width, span - width)
        values = np.minimum(values[:-step], values[step:])
        width += step
    return (values & mask).astype(np.int64)


def anchors_of(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(hash, text's index, anchor in it, most and least bytes before it that its windows need)
    over texts that stand one after the other in `data` and end at `ends`."""
    out = []
    starts = np.concatenate(([0], ends[:-1]))
    across = np.arange(1, LENGTH)
    for at in range(0, max(0, len(data) - LENGTH + 1), CHUNK):
        part = data[at:at + CHUNK + LENGTH - 1]
        if len(part) < LENGTH:
            continue
        hashes = _gram_hashes(part)
        least = _least(hashes, LENGTH - GRAM + 1)
        inside = np.ones(len(least), dtype=bool)
        near = ends[np.searchsorted(ends, at, side="right"):
                    np.searchsorted(ends, at + len(part), side="right")]
        over = (np.unique(near)[:, None] - across - at).ravel()
        inside[over[(over >= 0) & (over < len(least))]] = False
        window = np.flatnonzero(inside)
        if not len(window):
            continue
        least = least[window]
        fresh = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        last = np.concatenate((fresh[1:], [len(least)])) - 1
        anchor = least[fresh]
        of = np.searchsorted(ends, anchor + at, side="right")
        out.append((hashes[anchor].view(np.int64), of, anchor + at - starts[of],
                    anchor - window[fresh], anchor - window[last]))
    if not out:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty, empty, empty
    return tuple(np.concatenate(column) for column in zip(*out))


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string column and the end of each text."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[
        column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets[1:] - offsets[0]


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            gram, of, at, most, least = anchors_of(*_bytes_of(batch.column("text")))
            rows = batch.column("row").to_numpy(zero_copy_only=False)[of]
            yield pa.RecordBatch.from_arrays(
                [pa.array(gram), pa.array(rows), pa.array((at << 14) | (most << 7) | least)],
                names=["gram", "row", "place"])


def settled(common: np.ndarray, before: np.ndarray, before_size: np.ndarray, doc: np.ndarray,
            at: np.ndarray, least: np.ndarray) -> np.ndarray:
    """For anchors in the order of their suffixes: which windows an equal one precedes.

    `common` holds each suffix's common prefix with the one above it, `before` the bytes before
    each anchor, nearest first. Column t of the result stands for the window that starts t bytes
    before the anchor; an anchor has windows from `least` to `before_size`."""
    size = len(doc)
    width = before.shape[1]
    result = np.zeros((size, width + 1), dtype=bool)
    if size < 2:
        return result
    by_before = np.argsort(
        np.ascontiguousarray(before).view(f"S{width}").ravel(), kind="stable")
    ordered = before[by_before]
    differ = ordered[1:] != ordered[:-1]
    agree = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    by_place = np.lexsort((at, doc))
    # places by their order; rows that share a place are the same in it
    rank = np.empty(size, dtype=np.int64)
    rank[by_place] = np.cumsum(np.concatenate(([False], (
        (doc[by_place[1:]] != doc[by_place[:-1]]) | (at[by_place[1:]] != at[by_place[:-1]])))))
    left = np.empty(size, dtype=np.int64)
    for t in range(width + 1):
        rows = np.flatnonzero((least <= t) & (t <= before_size))
        if len(rows) < 2:
            continue
        right = np.cumsum(common < LENGTH - t)
        left[by_before] = np.concatenate(([0], np.cumsum(agree < t)))
        key = right[rows] * size + left[rows]
        order = np.argsort(key)
        rows, key = rows[order], key[order]
        fresh = np.concatenate(([True], key[1:] != key[:-1]))
        first = np.minimum.reduceat(rank[rows], np.flatnonzero(fresh))
        later = rank[rows] != first[np.cumsum(fresh) - 1]
        result[rows[later], t] = True
    return result


def _intervals(flags: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """(anchor's index, start, end) of the bytes that settled windows cover."""
    edges = np.diff(np.pad(flags.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    who, first = np.nonzero(edges == 1)
    last = np.nonzero(edges == -1)[1] - 1
    return who, at[who] - last, at[who] - first + LENGTH


class Suffixes:
    """Anchors with all that decides their windows, column by column: `table` has the suffixes and
    `before` the bytes before them (nearest first), both filled up with zeros."""

    FIELDS = ("table", "size", "before", "before_size", "doc", "row", "at", "least")

    def __init__(self, *columns: np.ndarray, common: np.ndarray | None = None):
        for name, column in zip(self.FIELDS, columns, strict=True):
            setattr(self, name, column)
        # with the suffix above; known once they are sorted
        self.common = common

    def __len__(self) -> int:
        return len(self.size)

    def taken(self, rows, common: np.ndarray | None = None) -> "Suffixes":
        return Suffixes(*(getattr(self, name)[rows] for name in self.FIELDS), common=common)

    @staticmethod
    def joined(parts: list["Suffixes"]) -> "Suffixes":
        if len(parts) == 1:
            return parts[0]
        return Suffixes(*(
            np.concatenate([getattr(part, name) for part in parts]) for name in Suffixes.FIELDS))

    def ordered(self) -> "Suffixes":
        # the size ends a suffix, so that zeros in a text and those filled up differ
        keys = np.concatenate([self.table, self.size[:, None].astype(np.uint8)], axis=1)
        order = np.argsort(keys.view(f"S{keys.shape[1]}").ravel())
        out = self.taken(order)
        out.common = _common(out.table, out.size)
        return out

    def suffixes(self) -> list[bytes]:
        data, width = self.table.tobytes(), self.table.shape[1]
        return [data[at:at + size] for at, size in
                zip(range(0, len(data), width), self.size.tolist())]

    def settle(self) -> np.ndarray:
        """Flags of windows, worked out only where anchors have company."""
        flags = np.zeros((len(self), self.before.shape[1] + 1), dtype=bool)
        near = self.common >= GRAM
        company = near | np.concatenate((near[1:], [False]))
        some = np.flatnonzero(company)
        if len(some):
            flags[some] = settled(
                self.common[some], self.before[some], self.before_size[some], self.doc[some],
                self.at[some], self.least[some])
        return flags

    def unsettled(self, flags: np.ndarray) -> np.ndarray:
        t = np.arange(flags.shape[1])
        own = (self.least[:, None] <= t) & (t <= self.before_size[:, None])
        return np.flatnonzero((own & ~flags).any(axis=1))

    def coded(self) -> bytes:
        """Sorted ones front-coded: each suffix without what it shares with the one before."""
        columns = (self.common, self.size, self.before_size, self.least, self.at, self.doc, self.row)
        at, back = np.arange(self.table.shape[1]), np.arange(self.before.shape[1])
        own = (self.common[:, None] <= at) & (at < self.size[:, None])
        return b"".join([
            len(self).to_bytes(8, "little"),
            *(column.astype(kind).tobytes() for column, kind in zip(columns, _COLUMNS)),
            self.table[own].tobytes(), self.before[back < self.before_size[:, None]].tobytes(),
        ])

    @staticmethod
    def of(blob: bytes) -> "Suffixes":
        """What `coded` made a blob of."""
        number, offset, columns = int.from_bytes(blob[:8], "little"), 8, []
        for kind in _COLUMNS:
            column = np.frombuffer(blob, dtype=kind, count=number, offset=offset)
            offset += column.nbytes
            columns.append(column.astype(np.int64))
        common, size, before_size, least, at, doc, row = columns
        bytes_ = np.frombuffer(blob, dtype=np.uint8, offset=offset)
        place, back = np.arange(LENGTH), np.arange(_BEFORE)
        table = np.zeros((number, LENGTH), dtype=np.uint8)
        fresh = common[:, None] <= place
        own = fresh & (place < size[:, None])
        split = int(np.count_nonzero(own))
        table[own] = bytes_[:split]
        # a shared byte stands in the last suffix that brought its own at this place
        source = np.where(fresh, np.arange(number, dtype=np.int32)[:, None], np.int32(0))
        np.maximum.accumulate(source, axis=0, out=source)
        table = np.take_along_axis(table, source, axis=0)
        before = np.zeros((number, _BEFORE), dtype=np.uint8)
        before[back < before_size[:, None]] = bytes_[split:]
        return Suffixes(table, size, before, before_size, doc, row, at, least, common=common)


def _common(table: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Common prefix of each row with the one above it; 0 for the first."""
    differ = table[1:] != table[:-1]
    agree = np.where(differ.any(axis=1), differ.argmax(axis=1), table.shape[1])
    return np.concatenate(
        ([0], np.minimum(agree, np.minimum(size[1:], size[:-1])))).astype(np.int64)[:len(table)]


def _table(strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    joined = b"".join([s.ljust(width, b"\0") for s in strings])
    return (np.frombuffer(joined, dtype=np.uint8).reshape(len(strings), width),
            np.array([len(s) for s in strings], dtype=np.int64))


def common_prefixes(suffixes: list[bytes]) -> np.ndarray:
    """Of each suffix with the one above it; 0 for the first."""
    return _common(*_table(suffixes, LENGTH))


def front_coded(records: list[tuple]) -> bytes:
    """Sorted records (suffix, bytes before, doc, row, at, least) as `Suffixes.coded` has them."""
    table, size = _table([r[0] for r in records], LENGTH)
    before, before_size = _table([r[1][::-1] for r in records], _BEFORE)
    rest = [np.array([r[k] for r in records], dtype=np.int64) for k in (2, 3, 4, 5)]
    return Suffixes(table, size, before, before_size, *rest, common=_common(table, size)).coded()


def decoded(blob: bytes) -> Iterator[tuple[bytes, int, tuple]]:
    """(suffix, common prefix with the one before, record) of a front-coded run."""
    run = Suffixes.of(blob)
    for n, suffix in enumerate(run.suffixes()):
        before = run.before[n, :run.before_size[n]].tobytes()[::-1]
        yield suffix, int(run.common[n]), (
            suffix, before, *(int(c[n]) for c in (run.doc, run.row, run.at, run.least)))


def _first_difference(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix; the first `known` bytes agree."""
    size = min(len(a), len(b))
    differ = int.from_bytes(a[known:size], "big") ^ int.from_bytes(b[known:size], "big")
    return size - (differ.bit_length() + 7) // 8


class LoserTree:
    """Merges runs of (suffix, common prefix with the one before, record).

    A node keeps the loser of its match and the loser's common prefix with the winner. The
    heads' prefixes are all known against the last suffix out, so the longer one wins without a
    look at the bytes, and equal ones are compared from there on. A run that has ended has a common
    prefix below all others."""

    def __init__(self, runs: list[Iterator[tuple[bytes, int, tuple]]]):
        self.runs = [iter(run) for run in runs]
        heads = [next(run, None) for run in self.runs]
        self.heads = [head and head[0] for head in heads]
        self.records = [head and head[2] for head in heads]
        self.common = [-1 if head is None else 0 for head in heads]
        self.losers = [-1] * max(1, len(runs))
        self.winner = self._play_all(1) if runs else -1

    def _play_all(self, node: int) -> int:
        if node >= len(self.runs):
            return node - len(self.runs)
        a, b = self._play_all(2 * node), self._play_all(2 * node + 1)
        if self.common[a] == self.common[b] and self.common[a] >= 0:
            a_wins = self._a_wins(a, b, self.common[a])
        else:
            a_wins = self.common[a] > self.common[b]
        self.losers[node] = b if a_wins else a
        return a if a_wins else b

    def _a_wins(self, a: int, b: int, known: int) -> bool:
        """Compare heads that agree so far; the loser's common prefix becomes that with the winner."""
        one, two = self.heads[a], self.heads[b]
        if one == two:
            self.common[b] = len(two)
            return True
        if one[known:known + 1] == two[known:known + 1]:
            known = _first_difference(one, two, known + 1)
        a_wins = one < two
        self.common[b if a_wins else a] = known
        return a_wins

    def __iter__(self) -> Iterator[tuple[int, tuple]]:
        """(common prefix with the last one out, record)."""
        common, losers, heads, records = self.common, self.losers, self.heads, self.records
        runs, size, best = self.runs, len(self.runs), self.winner
        while best >= 0 and common[best] >= 0:
            yield common[best], records[best]
            head = next(runs[best], None)
            if head is None:
                heads[best] = records[best] = None
                own = common[best] = -1
            else:
                heads[best], own, records[best] = head
                common[best] = own
            node = (best + size) >> 1
            while node:
                other = losers[node]
                theirs = common[other]
                if theirs > own or theirs == own >= 0 and not self._a_wins(best, other, own):
                    losers[node], best, own = best, other, theirs
                node >>= 1
        self.winner = best


_SENT = "range int, records binary, spans binary"
_SPANS = pa.schema([("row", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])


def _gathered(batch: pa.RecordBatch) -> Iterator[tuple[bool, Suffixes]]:
    """(hot, anchors or single windows) of a batch's places, at most RUN_RECORDS or so at a time."""
    raw, ends = _bytes_of(batch.column("text"))
    starts = np.concatenate(([0], ends[:-1]))
    padded = np.concatenate((np.zeros(_BEFORE, np.uint8), raw, np.zeros(LENGTH, np.uint8)))
    strings = np.lib.stride_tricks.sliding_window_view(padded, LENGTH)
    backs = np.lib.stride_tricks.sliding_window_view(padded, _BEFORE)
    found = batch.column("found")
    places = found.flatten().to_numpy(zero_copy_only=False)
    of = np.repeat(np.arange(batch.num_rows), np.diff(found.offsets.to_numpy()))
    doc, row = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "row"))
    for hot in (False, True):
        mine = np.flatnonzero((places < 0) == hot)
        packed = np.abs(places[mine]) - 1
        at, most, least = packed >> 14, packed >> 7 & 127, packed & 127
        number = most - least + 1 if hot else np.ones(len(mine), dtype=np.int64)
        step = (np.cumsum(number) - number) // RUN_RECORDS
        for some in np.split(np.arange(len(mine)), np.flatnonzero(np.diff(step)) + 1):
            if not len(some):
                continue
            text, a, m, n = of[mine[some]], at[some], most[some], least[some]
            if hot:
                count = number[some]
                nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                text, a = np.repeat(text, count), np.repeat(a - m, count) + nth
                m = n = np.zeros(len(a), dtype=np.int64)
            place = starts[text] + a
            # a copy, as the bytes after a suffix are cut off
            table = strings[place + _BEFORE]
            table[np.arange(LENGTH) >= LENGTH - n[:, None]] = 0
            back = backs[place][:, ::-1].copy()
            back[np.arange(_BEFORE) >= m[:, None]] = 0
            yield hot, Suffixes(table, LENGTH - n, back, m, doc[text], row[text], a, n)


def _runs(splitters: list[bytes]):
    """Sort anchors in runs, settle what a run can, and send the rest to their ranges."""
    heads = [s[:GRAM] for s in splitters]

    def send(some: list[Suffixes], hot: bool) -> pa.RecordBatch:
        run = Suffixes.joined(some).ordered()
        flags = run.settle()
        who, start, end = _intervals(flags, run.at)
        spans = np.stack([run.row[who], start, end], axis=1).astype("<i8")
        left = run.taken(run.unsettled(flags))
        # anchors of one hash stay together; single windows are cut at any byte
        strings = left.suffixes() if hot else [s[:GRAM] for s in left.suffixes()]
        cuts = [0, *(bisect_left(strings, s) for s in (splitters if hot else heads)), len(left)]
        targets = []
        for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if a < b:
                own = left.taken(slice(a, b))
                own.common = _common(own.table, own.size)
                targets.append((n, own.coded()))
        shares = np.array_split(spans, max(1, len(targets)))
        targets = targets or [(0, b"")]
        return pa.RecordBatch.from_arrays([
            pa.array([2 * r + hot for r, _ in targets], pa.int32()),
            pa.array([own for _, own in targets], pa.binary()),
            pa.array([share.tobytes() for share in shares], pa.binary()),
        ], names=["range", "records", "spans"])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[bool, list[Suffixes]] = {False: [], True: []}
        for batch in batches:
            for hot, some in _gathered(batch):
                waiting[hot].append(some)
                if sum(map(len, waiting[hot])) >= RUN_RECORDS:
                    yield send(waiting[hot], hot)
                    waiting[hot] = []
        for hot, some in waiting.items():
            if some:
                yield send(some, hot)

    return sort


def _merge(key: tuple, runs: pa.Table) -> pa.Table:
    """Merge the runs of a range, settle their windows; all spans of bytes to remove."""
    spans = [b"".join(runs.column("spans").to_pylist())]
    parts = [Suffixes.of(blob) for blob in runs.column("records").to_pylist() if blob]
    at, inputs = 0, []
    for part in parts:
        inputs.append(zip(part.suffixes(), part.common.tolist(), range(at, at + len(part))))
        at += len(part)
    if parts:
        merged = np.array(list(LoserTree(inputs)), dtype=np.int64)
        common, order = merged.T
        records = Suffixes.joined(parts)
        # settled some at a time, never between suffixes that may share a window
        whole = LENGTH if key[0].as_py() % 2 else GRAM
        start = 0
        for end in [*np.flatnonzero(common < whole).tolist(), len(order)]:
            if end - start >= RUN_RECORDS or end == len(order) > start:
                shared = common[start:end].copy()
                shared[0] = 0
                group = records.taken(order[start:end], shared)
                who, first, last = _intervals(group.settle(), group.at)
                spans.append(np.stack([group.row[who], first, last], axis=1).astype("<i8").tobytes())
                start = end
    table = np.frombuffer(b"".join(spans), dtype="<i8").reshape(-1, 3)
    return pa.table([pa.array(column) for column in table.T], schema=_SPANS)


def repeated_spans(rows: DataFrame) -> DataFrame:
    """(row, start, end): bytes of rows (doc_id, text, row) that an earlier string covers."""
    anchors = rows.select("row", "text").mapInArrow(_anchors, "gram long, row long, place long")
    # stored, so that the join can split a hash that very many anchors have
    twice = materialized(
        anchors.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1"), "repeated-hashes")
    place = F.col("place") + 1  # the sign marks the hot ones
    found = materialized(
        anchors.join(twice, "gram")
        .select("row", F.when(F.col("n") > HOT, -place).otherwise(place).alias("place"))
        .groupBy("row").agg(F.collect_set("place").alias("found")),
        "repeated-anchors",
    )
    total = found.agg(F.sum(F.size("found"))).first()[0] or 0
    ranges = -(-total // RANGE_RECORDS)
    splitters = _splitters(rows, ranges)
    doc = F.coalesce("doc_id", F.lit(_LAST)).alias("doc")
    # rows go with the columns that the caller joins again, so that one shuffle serves both
    sent = rows.join(found, "row").select(doc, "row", "text", "found").mapInArrow(
        _runs(splitters), _SENT)
    return sent.groupBy("range").applyInArrow(_merge, "row long, start long, end long")


def _splitters(rows: DataFrame, ranges: int) -> list[bytes]:
    """Limits of ranges from strings at hashed places of hashed rows: SAMPLES_PER_RANGE for
    each range, whatever the size of the table."""
    if ranges < 2:
        return []
    wanted = ranges * SAMPLES_PER_RANGE
    long = rows.filter(F.octet_length("text") >= LENGTH)
    share = min(1.0, wanted / max(1, rows.count()))
    at = F.pmod(F.xxhash64("row", F.lit(1)), F.octet_length("text") - LENGTH + 1).cast("int") + 1
    sample = (
        long.filter(F.pmod(F.xxhash64("row"), F.lit(1 << 30)) < int(share * (1 << 30)))
        .select(F.substring(F.col("text").cast("binary"), at, F.lit(LENGTH)).alias("s"))
        .limit(2 * wanted).collect()
    )
    strings = sorted({bytes(r.s) for r in sample})
    return [strings[len(strings) * n // ranges] for n in range(1, ranges)] if strings else []


def _cut(texts_: pa.Array, spans: pa.Array) -> pa.Array:
    """What stays of each text without the bytes of its spans; null where there are none."""
    none = (spans.is_null().to_numpy(zero_copy_only=False)
            | texts_.is_null().to_numpy(zero_copy_only=False))
    raw, ends = _bytes_of(texts_.fill_null(""))
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64)[:len(ends)]
    flat = spans.flatten()
    of = np.repeat(np.arange(len(spans)), spans.value_lengths().fill_null(0).to_numpy())
    start, end = (starts[of] + flat.field(n).to_numpy() for n in (0, 1))
    # one more place to a text, so that the spans of two texts never touch
    edges = np.zeros(len(raw) + len(ends) + 1, dtype=np.int32)
    np.add.at(edges, start + of, 1)
    np.add.at(edges, end + of, -1)
    gone = np.cumsum(edges[:-1]) > 0
    bounds = ends + np.arange(len(ends))  # the added place of each text
    first = gone & ~np.concatenate(([False], gone[:-1]))
    number = np.diff(np.concatenate(([0], np.cumsum(first)[bounds])))
    gone = np.delete(gone, bounds)
    removed = np.diff(np.concatenate(([0], np.concatenate(([0], np.cumsum(gone)))[ends])))
    offsets = np.concatenate(([0], np.cumsum(ends - starts - removed))).astype(np.int32)
    kept = pa.Array.from_buffers(
        pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(raw[~gone])])
    return pa.StructArray.from_arrays(
        [kept, pa.array(removed, pa.int64()), pa.array(number, pa.int64())],
        names=["kept", "removed", "spans"], mask=pa.array(none))


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (binary, the bytes that stay)."""
    cut = F.arrow_udf(_cut, "struct<kept: binary, removed: long, spans: long>")
    rows = texts(docs).select(
        "doc_id", "text", F.xxhash64("doc_id", "text").alias("row"))
    spans = repeated_spans(rows).groupBy("row").agg(
        F.collect_set(F.struct("start", "end")).alias("spans"))
    whole = F.col("text").cast("binary")
    return (
        rows.join(spans, "row", "left")
        .withColumn("cut", cut(F.when(F.col("spans").isNotNull(), F.col("text")), F.col("spans")))
        .select(
            "doc_id", F.octet_length(whole).cast("long").alias("n_bytes"),
            F.coalesce("cut.removed", F.lit(0).cast("long")).alias("n_removed"),
            F.coalesce("cut.spans", F.lit(0).cast("long")).alias("n_spans"),
            F.coalesce("cut.kept", whole).alias("kept"),
        )
    )
