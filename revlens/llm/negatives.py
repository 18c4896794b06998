"""Hard-negative mining with an STR-packed R-tree.

Components become floor(256 * x); a row's score is its integer inner product with the anchor, higher
first, ties to the smaller vec_id. An anchor's positives are its best rows of the same label; for
each positive, its negatives are the best rows of other labels whose score lies in a window around the
positive's: `low` to `high` hundredths of it.

The rows are packed by sort-tile-recursive order: Spark cuts them into slabs by the first component and
ranges of the second (ties by vec_id, so equal vectors are cut too), each task packs its range into
subtrees of at most `SUBTREE` rows, tiling them along the axes on which they spread most, into
pages of `PAGE` rows under nodes of `FAN` children. Every node keeps its minimum bounding box and its smallest
vec_id. The subtrees are stored.

A box bounds each coordinate's product with the anchor's, so it gives an interval of inner products.
A search keeps a queue of nodes by their upper bound, opens the best first, and drops nodes whose
interval misses all score windows, or lies strictly below the last of enough results (or ties with it while
all vec_ids are larger). Anchors meet the subtrees in blocks: each subtree with up to `ANCHORS` anchors is
one unit of work of bounded size, and the best of all units are taken by a window per anchor.

Scores are exact: products of floats are used only where no sum can leave 53 bits, otherwise 64-bit integers.

Defined results: rows without label or vec_id, rows whose vector is null, empty or holds null or
non-finite components or components of 65,536 and more (their products would leave 64 bits), and rows
whose vector has another length than the commonest, take no part. Rows that share a vec_id are one row: the one
with the smallest label, then vector. An anchor without positives, or a positive without negatives,
gives no rows; so does an empty table. A window around a negative score is empty, as its ends are.
"""

import bisect
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.llm.common import bounded_batches, materialized

SCALE = 256
LARGEST = 1 << 16
SUBTREE = 8192
PAGE = 64
FAN = 16
TILED_AXES = 4
ANCHORS = 256
MOST_SLABS = 32


def integer_rows(vectors: DataFrame, label: Column) -> DataFrame:
    """vec_id, label and values (array<long>) of the rows that take part, one for each vec_id.
    `label` gives a row's label from its columns vec_id and label."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    ).filter(
        "vec_id is not null and label is not null and size(embedding) > 0"
        f" and not exists(embedding, x -> x is null or isnan(x) or abs(x) >= {LARGEST})"
    )
    commonest = rows.groupBy(F.size("embedding").alias("dims")).count().orderBy(
        F.desc("count"), "dims").first()
    values = F.transform("embedding", lambda x: F.floor(x * SCALE).cast("long"))
    return rows.filter(F.size("embedding") == (commonest.dims if commonest else 0)).select(
        "vec_id", label.alias("label"), values.alias("values"),
    ).groupBy("vec_id").agg(F.min(F.struct("label", "values")).alias("row")).select(
        "vec_id", "row.label", "row.values")


# --------------------------------------------------------------------------------- trees


def str_order(points: np.ndarray, page: int) -> np.ndarray:
    """Rows in sort-tile-recursive order: sorted along one axis, cut into slabs, each slab
    sorted along the next axis, and so on, the widest-spread axes first."""
    axes = np.argsort(-points.var(axis=0), kind="stable")[:TILED_AXES]

    def tiled(rows: np.ndarray, left: int) -> list[np.ndarray]:
        rows = rows[np.argsort(points[rows, axes[len(axes) - left]], kind="stable")]
        pages = -(-len(rows) // page)
        if left == 1 or pages <= 1:
            return [rows]
        slabs = int(np.ceil(pages ** (1 / left)))
        size = -(-pages // slabs) * page
        return [tile for at in range(0, len(rows), size)
                for tile in tiled(rows[at:at + size], left - 1)]

    return np.concatenate(tiled(np.arange(len(points)), len(axes)))


class Tree:
    """Rows in packed order, and the boxes of all nodes: pages of PAGE rows first, then each level
    of nodes with FAN children, the root last."""

    def __init__(self, vec_ids, labels, values, low=None, high=None):
        self.vec_ids, self.labels, self.values = vec_ids, labels, values
        starts = np.arange(0, len(values), PAGE)
        self.pages = len(starts)
        self.level_starts = [0]
        least = [np.minimum.reduceat(vec_ids, starts)]
        if low is None:
            low = [np.minimum.reduceat(values, starts, axis=0)]
            high = [np.maximum.reduceat(values, starts, axis=0)]
        while len(least[-1]) > 1:
            starts = np.arange(0, len(least[-1]), FAN)
            self.level_starts.append(self.level_starts[-1] + len(least[-1]))
            least.append(np.minimum.reduceat(least[-1], starts))
            if isinstance(low, list):
                low.append(np.minimum.reduceat(low[-1], starts, axis=0))
                high.append(np.maximum.reduceat(high[-1], starts, axis=0))
        self.least = np.concatenate(least)
        self.low, self.high = (
            np.concatenate(x) if isinstance(x, list) else x for x in (low, high))

    def children(self, node: int) -> range:
        """The nodes below a node that is no page."""
        level = bisect.bisect_right(self.level_starts, node) - 1
        first = self.level_starts[level - 1] + (node - self.level_starts[level]) * FAN
        return range(first, min(first + FAN, self.level_starts[level]))

    def rows(self, page: int) -> slice:
        return slice(page * PAGE, (page + 1) * PAGE)

    def bounds(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each box's smallest and largest possible score for each anchor."""
        plus, minus = np.maximum(anchors, 0), np.minimum(anchors, 0)
        return (_products(plus, self.low) + _products(minus, self.high),
                _products(plus, self.high) + _products(minus, self.low))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows. Floats are exact, and much faster, up to 53 bits."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), dtype=np.int64)
    if int(np.abs(a).max()) * int(np.abs(b).max()) * a.shape[1] < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


class Best:
    """The best so many rows in a score window."""

    def __init__(self, low: int | None, high: int | None, count: int):
        self.low, self.high, self.count = low, high, count
        self.rows: list[tuple[int, int]] = []  # (-score, vec_id), the best first

    def admits(self, low: int, high: int, least_id: int) -> bool:
        """Can a box with scores low to high and vec_ids from least_id on hold a result?"""
        if self.low is not None and (high < self.low or low > self.high):
            return False
        return len(self.rows) < self.count or (-high, least_id) < self.rows[-1]

    def add(self, scores: np.ndarray, vec_ids: np.ndarray) -> None:
        if self.low is not None:
            inside = (scores >= self.low) & (scores <= self.high)
            scores, vec_ids = scores[inside], vec_ids[inside]
        if len(self.rows) == self.count:
            inside = scores >= -self.rows[-1][0]
            scores, vec_ids = scores[inside], vec_ids[inside]
        if len(scores):
            self.rows = sorted(self.rows + list(zip((-scores).tolist(), vec_ids.tolist())))
            del self.rows[self.count:]


def best_first(tree: Tree, anchor: np.ndarray, low: np.ndarray, high: np.ndarray,
               allowed: np.ndarray, wanted: list[Best]) -> int:
    """Fill `wanted` with the best allowed rows, and count the pages opened. `low` and `high`
    are the bounds of all nodes for this anchor."""
    root = len(tree.least) - 1
    queue = [(-int(high[root]), root)]
    visited = 0
    while queue:
        _, node = heapq.heappop(queue)
        box = int(low[node]), int(high[node]), int(tree.least[node])
        open_ = [w for w in wanted if w.admits(*box)]
        if not open_:
            continue
        if node >= tree.pages:
            for child in tree.children(node):
                box = int(low[child]), int(high[child]), int(tree.least[child])
                if any(w.admits(*box) for w in open_):
                    heapq.heappush(queue, (-box[1], child))
            continue
        visited += 1
        rows = tree.rows(node)
        usable = allowed[rows]
        if usable.any():
            scores = (tree.values[rows] @ anchor)[usable]
            vec_ids = tree.vec_ids[rows][usable]
            for w in open_:
                w.add(scores, vec_ids)
    return visited


# -------------------------------------------------------------------------------- tables

_STORED = "unit int, dims int, vec_ids binary, labels binary, values binary, low binary, high binary"


def packed(rows: DataFrame) -> DataFrame:
    """The rows in stored subtrees; `unit` numbers the ranges that Spark has cut."""
    number = max(1, -(-rows.count() // SUBTREE))
    slabs = min(MOST_SLABS, int(np.sqrt(number)))
    first, second = F.col("values")[0], F.coalesce(F.get("values", F.lit(1)), F.lit(0))
    cuts = rows.select(first.cast("double").alias("x")).approxQuantile(
        "x", [i / slabs for i in range(1, slabs)], 0.25 / slabs) if slabs > 1 else []
    slab = F.lit(0)
    for cut in sorted(set(cuts)):
        slab += (first > cut).cast("int")
    ranged = rows.withColumns({"slab": slab, "second": second}).repartitionByRange(
        number, "slab", "second", "vec_id").select("vec_id", "label", "values")

    def subtree(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        vec_ids, labels = (table.column(c).to_numpy() for c in ("vec_id", "label"))
        values = table.column("values").combine_chunks().flatten().to_numpy().reshape(
            len(table), -1)
        order = str_order(values, PAGE)
        tree = Tree(vec_ids[order], labels[order], values[order])
        return pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()], pa.int32()),
             pa.array([values.shape[1]], pa.int32())]
            + [pa.array([np.ascontiguousarray(a, dtype=np.int64).tobytes()], pa.binary())
               for a in (tree.vec_ids, tree.labels, tree.values, tree.low, tree.high)],
            names=[field.split()[0] for field in _STORED.split(", ")])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            at = 0
            while at < len(batch):
                held.append(batch.slice(at, SUBTREE - size))
                at, size = at + len(held[-1]), size + len(held[-1])
                if size == SUBTREE:
                    yield subtree(held)
                    held, size = [], 0
        if size:
            yield subtree(held)

    bounded_batches(rows.sparkSession)
    return materialized(ranged.mapInArrow(pack, _STORED), "subtrees")


def _opened(subtrees: pa.Table) -> Iterator[Tree]:
    for row in subtrees.to_pylist():
        def array(name, *shape):
            return np.frombuffer(row[name], dtype=np.int64).reshape(shape)

        yield Tree(array("vec_ids", -1), array("labels", -1), array("values", -1, row["dims"]),
                   array("low", -1, row["dims"]), array("high", -1, row["dims"]))


def _searched(subtrees: DataFrame, anchors: DataFrame, search, schema: str) -> DataFrame:
    """What search(anchor's row, its values, trees with their bounds) finds in all units.

    Neighbouring ranges make one unit if they are smaller than a subtree may be, so that the results
    of units grow with the rows, not with the number of partitions."""
    ranges, rows = subtrees.agg(
        F.max("unit") + 1, F.sum(F.octet_length("vec_ids") / 8)).first()
    blocks = max(1, -(-anchors.count() // ANCHORS))
    if ranges is None:
        return subtrees.sparkSession.createDataFrame([], schema)
    units = min(ranges, -(-int(rows) // SUBTREE))
    names = [field.split()[0] for field in schema.split(", ")]

    def met(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if len(left) and len(right):
            values = right.column("values").combine_chunks().flatten().to_numpy().reshape(
                len(right), -1)
            trees = [(tree, *tree.bounds(values)) for tree in _opened(left)]
            for n, row in enumerate(
                    right.drop_columns(["values", "unit", "block"]).to_pylist()):
                own = [(tree, low[n], high[n]) for tree, low, high in trees]
                own.sort(key=lambda found: -found[2][-1])  # the best root first
                found += search(row, values[n], own)
        columns = list(zip(*found)) if found else [()] * len(names)
        return pa.table({name: pa.array(column, pa.int64())
                         for name, column in zip(names, columns)})

    keys = ["unit", "block"]
    unit = F.floor(F.col("unit") * units / ranges).cast("int")
    left = subtrees.withColumn("unit", unit).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = anchors.withColumn(
        "block", F.pmod(F.xxhash64("anchor_id"), F.lit(blocks)).cast("int")
    ).withColumn("unit", F.explode(F.sequence(F.lit(0), F.lit(units - 1))))
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(met, schema)


def _ranked(found: DataFrame, keys: list[str], score: str, vec_id: str, count: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc(score), vec_id)
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count)


def positives(subtrees: DataFrame, anchors: DataFrame, count: int) -> DataFrame:
    """anchor_id, positive_id, positive_score: each anchor's best other rows of its label."""

    def search(anchor, values, trees):
        best = Best(None, None, count)
        for tree, low, high in trees:
            allowed = (tree.labels == anchor["label"]) & (tree.vec_ids != anchor["anchor_id"])
            best_first(tree, values, low, high, allowed, [best])
        return [(anchor["anchor_id"], vec_id, -score) for score, vec_id in best.rows]

    found = _searched(subtrees, anchors, search,
                      "anchor_id long, positive_id long, positive_score long")
    return _ranked(found, ["anchor_id"], "positive_score", "positive_id", count).drop("rank")


def negatives(subtrees: DataFrame, anchors: DataFrame, found: DataFrame, low: int, high: int,
              count: int) -> DataFrame:
    """anchor_id, positive_id, positive_score, rank, negative_id, negative_score: for each
    positive, the best rows of other labels whose score is `low` to `high` hundredths of its."""
    listed = found.groupBy("anchor_id").agg(
        F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))

    def search(anchor, values, trees):
        by_score = {}
        for positive in anchor["positives"]:
            score = positive["positive_score"]
            ends = -(-low * score // 100), high * score // 100
            if ends[0] <= ends[1]:
                by_score.setdefault(score, Best(*ends, count))
        for tree, box_low, box_high in trees:
            best_first(tree, values, box_low, box_high, tree.labels != anchor["label"],
                       list(by_score.values()))
        return [(anchor["anchor_id"], p["positive_id"], p["positive_score"], vec_id, -score)
                for p in anchor["positives"] if p["positive_score"] in by_score
                for score, vec_id in by_score[p["positive_score"]].rows]

    out = _searched(
        subtrees, anchors.join(listed, "anchor_id"), search,
        "anchor_id long, positive_id long, positive_score long, negative_id long, "
        "negative_score long")
    return _ranked(out, ["anchor_id", "positive_id"], "negative_score", "negative_id", count)


def mine(vectors: DataFrame, label: Column, anchors: str, positive_count: int = 5,
         negative_count: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.
    `label` gives a row's label, from its vec_id and label; `anchors` is the condition on vec_id that
    makes a row an anchor; `low` and `high` are hundredths of the positive's score."""
    rows = materialized(integer_rows(vectors, label), "negative-rows")
    subtrees = packed(rows)
    asked = rows.filter(anchors).select(F.col("vec_id").alias("anchor_id"), "label", "values")
    best = materialized(positives(subtrees, asked, positive_count), "positives")
    return negatives(subtrees, asked, best, low, high, negative_count).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
        "positive_score", "negative_score")
