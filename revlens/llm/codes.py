"""Vector code compression: product codes of integer vectors, learned in exact arithmetic.

Components become floor(256 * x), vectors are cut into `PARTS` equal parts, and every part has a
codebook of up to `ENTRIES` entries, at first those parts of the smallest vec_ids. Each round assigns all
parts to their nearest entries (ties to the lower index) and moves each entry to the floor of its parts'
mean; entries without parts stay. A last assignment gives the codes.

Vectors are stored once, in chunks of `CHUNK` rows as the tasks read them. In a chunk the parts of
each position are sorted along a Hilbert curve and cut into flat blocks of `BLOCK`, which keep their
smallest and largest components and their sums. In a round, the distances of a block's box to the
entries leave a shortlist: entries whose least distance is no more than the least of all entries'
largest distances, so the nearest entry of every part, with its ties, is on it. If one entry is left, the
block's sums are added to it unseen; otherwise the parts are compared with the shortlist alone, in 64-bit
integers.

No vector is shuffled. Each task sends sums per entry; the driver sees a codebook, never rows.

Defined results: vectors that are null, empty, hold null or non-finite components or components of
65,536 and more (their squares would leave 64 bits), whose length is no multiple of `PARTS`, or whose
length is not the commonest of the others, take no part. Rows that share a vec_id are rows of their own,
ordered by their vectors; rows without vec_id come last. With fewer rows than entries, the codebooks are
as short. An empty table gives no rows.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlens.llm.common import bounded_batches, materialized

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
CHUNK = 8192
BLOCK = 32
LARGEST = 1 << 16
_GROUPS = 256


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, label and values (array<long>) of the rows that take part."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    ).filter(
        f"size(embedding) > 0 and size(embedding) % {PARTS} = 0"
        f" and not exists(embedding, x -> x is null or isnan(x) or abs(x) >= {LARGEST})"
    )
    commonest = rows.groupBy(F.size("embedding").alias("dims")).count().orderBy(
        F.desc("count"), "dims").first()
    return rows.filter(F.size("embedding") == (commonest.dims if commonest else 0)).select(
        "vec_id", "label",
        F.transform("embedding", lambda x: F.floor(x * SCALE).cast("long")).alias("values"))


# -------------------------------------------------------------------------------- blocks


def hilbert_index(coordinates: np.ndarray, bits: int) -> np.ndarray:
    """Places on a Hilbert curve of points with coordinates of so many bits, by Skilling's
    transform: undo the rotations from the highest bit down, then take the Gray code."""
    axes = [c.astype(np.int64) for c in coordinates.T]
    bit = 1 << (bits - 1)
    while bit > 1:
        lower = bit - 1
        for n, axis in enumerate(axes):
            set_ = (axis & bit) != 0
            swapped = np.where(set_, 0, (axes[0] ^ axis) & lower)
            axes[0] = np.where(set_, axes[0] ^ lower, axes[0] ^ swapped)
            if n:
                axes[n] = axis ^ swapped
        bit >>= 1
    for n in range(1, len(axes)):
        axes[n] = axes[n] ^ axes[n - 1]
    turned = np.zeros_like(axes[0])
    bit = 1 << (bits - 1)
    while bit > 1:
        turned ^= np.where(axes[-1] & bit, bit - 1, 0)
        bit >>= 1
    place = np.zeros_like(axes[0])
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            place = (place << 1) | (((axis ^ turned) >> level) & 1)
    return place


def _hilbert_order(points: np.ndarray) -> np.ndarray:
    dims = min(points.shape[1], 31)
    bits = min(8, 62 // dims)
    points = points[:, :dims]
    low = points.min(axis=0)
    span = np.maximum(points.max(axis=0) - low, 1)
    return np.argsort(hilbert_index((points - low) * ((1 << bits) - 1) // span, bits),
                      kind="stable")


class Chunk:
    """Some vectors, and the blocks of each part position."""

    def __init__(self, values: np.ndarray, order=None, low=None, high=None, sums=None):
        self.values = values
        self.width = values.shape[1] // PARTS
        self.starts = np.arange(0, len(values), BLOCK)
        self.sizes = np.diff(np.append(self.starts, len(values)))
        if order is None:
            order = np.stack([_hilbert_order(self.part(p)) for p in range(PARTS)])
            sorted_ = [self.part(p)[order[p]] for p in range(PARTS)]
            low, high, sums = (
                np.stack([f.reduceat(s, self.starts, axis=0) for s in sorted_])
                for f in (np.minimum, np.maximum, np.add))
        self.order, self.low, self.high, self.sums = order, low, high, sums

    def part(self, position: int) -> np.ndarray:
        return self.values[:, position * self.width:(position + 1) * self.width]

    def shortlists(self, position: int, book: np.ndarray) -> np.ndarray:
        """For each block, which entries can be the nearest of one of its parts."""
        below = self.low[position][:, None, :] - book
        above = book - self.high[position][:, None, :]
        nearest = np.maximum(np.maximum(below, above), 0)
        farthest = np.maximum(np.abs(below), np.abs(above))
        least = (nearest * nearest).sum(axis=2)
        return least <= (farthest * farthest).sum(axis=2).min(axis=1)[:, None]

    def compared(self, position: int, book: np.ndarray, short: np.ndarray, blocks: np.ndarray):
        """The nearest entries and squared distances of the parts in these blocks: their rows,
        entries and distances."""
        rows = [np.zeros(0, dtype=np.int64)]
        entries, distances = [rows[0]], [rows[0]]
        points = self.part(position)
        for block in blocks.tolist():
            own = self.order[position][self.starts[block]:self.starts[block] + self.sizes[block]]
            listed = np.flatnonzero(short[block])
            apart = points[own][:, None, :] - book[listed]
            squares = (apart * apart).sum(axis=2)
            best = squares.argmin(axis=1)  # the first of equals, so the lowest index
            rows.append(own)
            entries.append(listed[best])
            distances.append(squares[np.arange(len(own)), best])
        return np.concatenate(rows), np.concatenate(entries), np.concatenate(distances)

    def add_to(self, books: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> None:
        """Add each part to the sums and counts of its nearest entry."""
        for position, book in enumerate(books):
            short = self.shortlists(position, book)
            single = short.sum(axis=1) == 1
            entry = short[single].argmax(axis=1)
            np.add.at(sums[position], entry, self.sums[position][single])
            np.add.at(counts[position], entry, self.sizes[single])
            rows, entries, _ = self.compared(position, book, short, np.flatnonzero(~single))
            np.add.at(sums[position], entries, self.part(position)[rows])
            np.add.at(counts[position], entries, 1)

    def coded(self, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each vector's entries, and its squared distance to them."""
        codes = np.zeros((len(self.values), PARTS), dtype=np.int64)
        errors = np.zeros(len(self.values), dtype=np.int64)
        for position, book in enumerate(books):
            short = self.shortlists(position, book)
            rows, entries, distances = self.compared(
                position, book, short, np.arange(len(self.starts)))
            codes[rows, position] = entries
            errors[rows] += distances
        return codes, errors


# -------------------------------------------------------------------------------- tables

_STORED = ("vec_ids array<long>, labels array<long>, dims int, values binary, sorted binary, "
           "low binary, high binary, sums binary")


def _chunks(rows: DataFrame) -> DataFrame:
    """The vectors in chunks with their blocks, stored."""

    def stored(batch: pa.Table) -> pa.RecordBatch:
        column = batch.column("values").combine_chunks()
        values = column.flatten().to_numpy().reshape(len(batch), -1)
        chunk = Chunk(values)
        arrays = [values, chunk.order, chunk.low, chunk.high, chunk.sums]
        return pa.RecordBatch.from_arrays(
            [pa.array([batch.column(c).to_pylist()], pa.list_(pa.int64()))
             for c in ("vec_id", "label")]
            + [pa.array([values.shape[1]], pa.int32())]
            + [pa.array([np.ascontiguousarray(a, dtype=np.int64).tobytes()], pa.binary())
               for a in arrays],
            names=[field.split()[0] for field in _STORED.split(", ")])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            at = 0
            while at < len(batch):
                piece = batch.slice(at, CHUNK - size)
                held.append(piece)
                at, size = at + len(piece), size + len(piece)
                if size == CHUNK:
                    yield stored(pa.Table.from_batches(held))
                    held, size = [], 0
        if size:
            yield stored(pa.Table.from_batches(held))

    bounded_batches(rows.sparkSession)
    return materialized(rows.mapInArrow(gather, _STORED), "vector-chunks")


def _opened(batches: Iterator[pa.RecordBatch]):
    """Stored chunks with their ids and labels."""
    for batch in batches:
        for row in batch.to_pylist():
            n, dims = len(row["vec_ids"]), row["dims"]

            def array(name, *shape):
                return np.frombuffer(row[name], dtype=np.int64).reshape(shape)

            boxes = (PARTS, -1, dims // PARTS)
            yield row, Chunk(
                array("values", n, dims), array("sorted", PARTS, n), array("low", *boxes),
                array("high", *boxes), array("sums", *boxes))


def _first_books(rows: DataFrame) -> np.ndarray:
    """The parts of the smallest vec_ids. No task sends more than it may have to, and the
    driver gets the entries alone."""
    order = [F.asc_nulls_last("vec_id"), F.asc("values")]
    group = F.pmod(F.spark_partition_id(), F.lit(_GROUPS))
    least = rows.select("vec_id", "values", group.alias("group")).withColumn(
        "n", F.row_number().over(Window.partitionBy("group").orderBy(*order))
    ).filter(F.col("n") <= ENTRIES)
    found = [r["values"] for r in least.orderBy(*order).limit(ENTRIES).collect()]
    if not found:
        return np.zeros((PARTS, 0, 1), dtype=np.int64)
    found = np.array(found, dtype=np.int64)
    return found.reshape(len(found), PARTS, -1).transpose(1, 0, 2).copy()


def _moved(chunks: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round."""

    def sums(batches):
        total, counts = np.zeros_like(books), np.zeros(books.shape[:2], dtype=np.int64)
        for _, chunk in _opened(batches):
            chunk.add_to(books, total, counts)
        position, entry = np.nonzero(counts)
        width = books.shape[2]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(position, width), pa.int32()),
             pa.array(np.repeat(entry, width), pa.int32()),
             pa.array(np.tile(np.arange(width), len(position)), pa.int32()),
             pa.array(np.repeat(counts[position, entry], width), pa.int64()),
             pa.array(total[position, entry].reshape(-1), pa.int64())],
            names=["part", "entry", "at", "number", "total"])

    bounded_batches(chunks.sparkSession)
    found = chunks.mapInArrow(sums, "part int, entry int, at int, number long, total long")
    whole = "decimal(38,0)"
    rows = found.groupBy("part", "entry", "at").agg(
        F.sum(F.col("number").cast(whole)).alias("number"),
        F.sum(F.col("total").cast(whole)).alias("total")).collect()
    moved = books.copy()
    for r in rows:
        moved[r.part, r.entry, r["at"]] = int(r.total) // int(r.number)
    return moved


def learn(chunks: DataFrame, books: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (part, entry, component) after so many rounds."""
    for _ in range(rounds):
        books = _moved(chunks, books)
    return books


def encoded(chunks: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code (entries in part order, two hex digits each) and error (squared
    distance) of every stored vector."""

    def code(batches):
        for row, chunk in _opened(batches):
            codes, errors = chunk.coded(books)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["vec_ids"], pa.int64()), pa.array(row["labels"], pa.int64()),
                 pa.array([bytes(c).hex() for c in codes.astype(np.uint8)], pa.string()),
                 pa.array(errors, pa.int64())], names=["vec_id", "label", "code", "error"])

    bounded_batches(chunks.sparkSession)
    return chunks.mapInArrow(code, "vec_id long, label long, code string, error long")


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all components as decimal numbers, by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compress(vectors: DataFrame) -> DataFrame:
    """vec_id, label, code, error, label_error (errors summed over equal labels, nulls
    together) and codebooks_sha256 of every vector that takes part."""
    rows = integer_vectors(vectors)
    chunks = _chunks(rows)
    books = learn(chunks, _first_books(rows))
    codes = materialized(encoded(chunks, books), "vector-codes")
    by_label = codes.groupBy("label").agg(F.try_sum("error").alias("label_error"))
    by_label = by_label.withColumnRenamed("label", "_label")
    return codes.join(by_label, F.col("label").eqNullSafe(F.col("_label"))).drop("_label").withColumn(
        "codebooks_sha256", F.lit(books_digest(books)))
