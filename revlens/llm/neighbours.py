"""Nearest neighbours by learned partitions.

A model is fitted on a bounded sample (`SAMPLE` rows, the ones whose ids hash lowest): the
sample's neighbour graph is partitioned into `PARTS` parts of nearly equal size that cut few
edges, and a small network learns to tell a vector's part. The network then places every row of the table
in its most probable part, and sends every query to its several most probable ones, where all rows
are reranked by the exact cosine. How many parts a query visits is measured, not guessed: it is the
smallest number that finds `TARGET` of the true neighbours of `HELD_OUT` further sampled rows, which are
compared with every row of the table.

Parts are cut into blocks of rows and of queries, so a part (or a vector) that holds most rows is
many tasks of bounded size. Only the sample and counts per part reach the driver.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components, rows
without id, and vectors of another length than the commonest take no part. Rows that share an id
count as one candidate, with the best score; a query's own id is no candidate. If a table has
fewer rows than asked for, all are returned; ties go to the smaller id; an empty table gives none.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 4096
HELD_OUT = 256
PARTS = 32
GRAPH_DEGREE = 10
HIDDEN = 128
EPOCHS = 30
TARGET = 0.96
SLACK = 1.1
BLOCK_ROWS = 8192
BLOCK_QUERIES = 1024
SEED = 11
_FOUND = "query_id long, vec_id long, score double"


@dataclass
class Router:
    """The fitted network: probabilities of the parts for unit vectors."""

    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: np.ndarray

    def scores(self, unit: np.ndarray) -> np.ndarray:
        hidden = np.maximum(unit @ self.first + self.first_bias, 0)
        return hidden @ self.second + self.second_bias

    def parts(self, unit: np.ndarray) -> np.ndarray:
        """Every part for each row, the most probable first."""
        return np.argsort(-self.scores(unit), axis=1, kind="stable")


def _matrix(vectors) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in vectors])


def _unit(rows: np.ndarray) -> np.ndarray:
    largest = np.abs(rows).max(axis=1, keepdims=True)
    rows = rows / largest
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _graph(unit: np.ndarray, degree: int) -> np.ndarray:
    """The nearest rows of each row."""
    degree = min(degree, len(unit) - 1)
    near = np.empty((len(unit), degree), dtype=np.int64)
    for at in range(0, len(unit), 1024):
        likeness = unit[at:at + 1024] @ unit.T
        likeness[np.arange(len(likeness)), np.arange(at, at + len(likeness))] = -np.inf
        near[at:at + 1024] = np.argpartition(-likeness, degree - 1, axis=1)[:, :degree]
    return near


def partition_graph(unit: np.ndarray, near: np.ndarray, parts: int, rounds: int = 8) -> np.ndarray:
    """A part for each row: balanced halves along main axes, then moves that cut fewer edges and
    keep every part within its size."""
    label = np.zeros(len(unit), dtype=np.int64)
    pieces = [np.arange(len(unit))]
    while len(pieces) < parts:
        halves = []
        for piece in pieces:
            centred = unit[piece] - unit[piece].mean(axis=0)
            axis = np.linalg.eigh(centred.T @ centred)[1][:, -1]
            order = piece[np.argsort(centred @ axis, kind="stable")]
            halves += [order[:len(order) // 2], order[len(order) // 2:]]
        pieces = halves
    for n, piece in enumerate(pieces):
        label[piece] = n
    around: list[list[int]] = [list(row) for row in near]
    for row, others in enumerate(near):
        for other in others:
            around[other].append(row)
    size = np.bincount(label, minlength=parts)
    most = int(np.ceil(len(unit) / parts * SLACK))
    for _ in range(rounds):
        moved = 0
        for row, others in enumerate(around):
            own = label[row]
            edges = np.bincount(label[others], minlength=parts)
            best = int(np.argmax(np.where(size < most, edges, -1)))
            if best != own and edges[best] > edges[own]:
                label[row] = best
                size[own] -= 1
                size[best] += 1
                moved += 1
        if not moved:
            break
    return label


def train(unit: np.ndarray, label: np.ndarray, parts: int) -> Router:
    """A network of one hidden layer, by Adam on the cross entropy."""
    chance = np.random.default_rng(SEED)
    dims = unit.shape[1]
    weights = [
        chance.normal(0, np.sqrt(2 / dims), (dims, HIDDEN)), np.zeros(HIDDEN),
        chance.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, parts)), np.zeros(parts),
    ]
    first = [np.zeros_like(w) for w in weights]
    second = [np.zeros_like(w) for w in weights]
    step = 0
    for _ in range(EPOCHS):
        order = chance.permutation(len(unit))
        for at in range(0, len(order), 256):
            rows = order[at:at + 256]
            x = unit[rows]
            hidden = np.maximum(x @ weights[0] + weights[1], 0)
            logits = hidden @ weights[2] + weights[3]
            logits -= logits.max(axis=1, keepdims=True)
            slope = np.exp(logits)
            slope /= slope.sum(axis=1, keepdims=True)
            slope[np.arange(len(rows)), label[rows]] -= 1
            slope /= len(rows)
            back = (slope @ weights[2].T) * (hidden > 0)
            gradients = [x.T @ back, back.sum(0), hidden.T @ slope, slope.sum(0)]
            step += 1
            for w, g, m, v in zip(weights, gradients, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= 0.003 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Router(*weights)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (array<double>) of the rows that take part."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    ).filter(
        "vec_id is not null and size(embedding) > 0"
        " and not exists(embedding, x -> x is null or isnan(x) or abs(x) = double('infinity'))"
        " and exists(embedding, x -> x <> 0)"
    )
    commonest = rows.groupBy(F.size("embedding").alias("dims")).count().orderBy(
        F.desc("count"), "dims").first()
    return rows.filter(F.size("embedding") == (commonest.dims if commonest else 0))


def _sample(rows: DataFrame, total: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of about so many rows, the ones whose ids hash lowest."""
    share = min(1.0, wanted / max(1, total))
    chosen = rows.filter(
        F.pmod(F.xxhash64("vec_id"), F.lit(1 << 40)) < int(share * (1 << 40))
    ).limit(2 * wanted).toPandas().sort_values("vec_id")
    if chosen.empty:
        return np.zeros(0, dtype=np.int64), np.zeros((0, 1))
    return chosen["vec_id"].to_numpy(), _matrix(chosen["embedding"])


def _nearest(query_ids, queries, ids, rows, k: int) -> list[tuple[int, int, float]]:
    """The k best of the rows for each query by the exact cosine: (query, row's id, score).

    A matrix product finds all rows within rounding of the k best; their cosines are then
    computed anew in one fixed order, so that equal vectors get equal scores."""
    found = []
    likeness = _unit(queries) @ _unit(rows).T
    lengths = np.sqrt((rows * rows).sum(axis=1))
    for n, query in enumerate(queries):
        row = likeness[n]
        row[ids == query_ids[n]] = -np.inf
        least = -np.inf
        wanted = k
        while wanted < len(row):  # repeated ids count once
            least = np.partition(row, len(row) - wanted)[len(row) - wanted]
            if len(np.unique(ids[row >= least])) >= k:
                break
            wanted, least = wanted * 4, -np.inf
        near = np.flatnonzero((row >= least - 1e-9) & (row > -np.inf))
        score = (rows[near] * query).sum(axis=1) / (
            lengths[near] * np.sqrt((query * query).sum()))
        seen = set()
        for at in np.lexsort((ids[near], -score)):
            other = int(ids[near[at]])
            if other not in seen:
                seen.add(other)
                found.append((int(query_ids[n]), other, float(score[at])))
                if len(seen) == k:
                    break
    return found


def _visits(rows: DataFrame, router: Router, ids: np.ndarray, held: np.ndarray, k: int) -> int:
    """Parts to visit: compare the held-out rows with all rows, and see where their true
    neighbours lie."""
    if not len(ids):
        return PARTS

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                own, vectors = batch["vec_id"].to_numpy(), _matrix(batch["embedding"])
                part = dict(zip(own, router.parts(_unit(vectors))[:, 0]))
                yield pd.DataFrame(
                    [(q, i, s, part[i]) for q, i, s in _nearest(ids, held, own, vectors, k)],
                    columns=["query_id", "vec_id", "score", "part"])

    true = _best(rows.mapInPandas(best, _FOUND + ", part int"), k, "part").toPandas()
    order = {q: list(parts) for q, parts in zip(ids, router.parts(_unit(held)))}
    places = np.sort([order[q].index(p) + 1 for q, p in zip(true["query_id"], true["part"])])
    if not len(places):
        return PARTS
    return int(places[min(len(places) - 1, int(np.ceil(TARGET * len(places))) - 1)])


def _best(found: DataFrame, k: int, *more: str) -> DataFrame:
    """The k best rows of each query. A query has k rows from each block it met."""
    once = found.groupBy("query_id", "vec_id").agg(
        F.max("score").alias("score"), *[F.max(c).alias(c) for c in more])
    ranked = F.row_number().over(
        _by_query().orderBy(F.desc("score"), "vec_id"))
    return once.withColumn("rank", ranked).filter(F.col("rank") <= k)


def _by_query():
    from pyspark.sql import Window

    return Window.partitionBy("query_id")


def fit(rows: DataFrame, k: int) -> tuple[Router, int]:
    """The network and the number of parts to visit."""
    total = rows.count()
    ids, sample = _sample(rows, total, SAMPLE + HELD_OUT)
    if len(ids) < 2 * PARTS:  # too few rows to learn from: everything is one part's worth
        dims = sample.shape[1]
        router = Router(np.zeros((dims, 1)), np.zeros(1), np.zeros((1, PARTS)), np.zeros(PARTS))
        return router, PARTS
    held = np.zeros(len(ids), dtype=bool)
    held[:: max(2, len(ids) // HELD_OUT)] = True
    learned = _unit(sample[~held])
    label = partition_graph(learned, _graph(learned, GRAPH_DEGREE), PARTS)
    router = train(learned, label, PARTS)
    return router, _visits(rows, router, ids[held], sample[held], k)


def search(vectors: DataFrame, queries: str, k: int) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of each query's k nearest rows found.
    `queries` is the condition on vec_id that makes a row a query."""
    rows = usable(vectors)
    router, visits = fit(rows, k)

    @F.pandas_udf("int")
    def home(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(router.parts(_unit(_matrix(batch)))[:, 0] if len(batch) else [],
                            dtype="int32")

    placed = rows.withColumn("part", home("embedding"))
    asked = rows.filter(queries).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    held = {r.part: r["count"] for r in placed.groupBy("part").count().collect()}
    sizes = np.array([held.get(p, 0) for p in range(PARTS)])

    @F.pandas_udf("array<int>")
    def route(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            if not len(batch):
                yield pd.Series([], dtype=object)
                continue
            order = router.parts(_unit(_matrix(batch)))
            met = np.cumsum(sizes[order], axis=1)
            # a table of few rows still has k candidates beside the query
            needed = (met < min(k + 1, sizes.sum())).sum(axis=1) + 1
            yield pd.Series([row[:max(visits, n)].tolist() for row, n in zip(order, needed)])

    routed = asked.select("vec_id", "embedding", F.explode(route("embedding")).alias("part"))
    number = asked.count()
    blocks = F.array(*[F.lit(int(max(1, -(-n // BLOCK_ROWS)))) for n in sizes])
    turns = max(1, -(-number // BLOCK_QUERIES))
    row_block = F.pmod(F.xxhash64("vec_id"), F.element_at(blocks, F.col("part") + 1))
    candidates = placed.select(
        "part", row_block.cast("int").alias("block"), "vec_id", "embedding",
        F.explode(F.sequence(F.lit(0), F.lit(turns - 1))).alias("turn"))
    query_turn = F.pmod(F.xxhash64("vec_id"), F.lit(turns)).cast("int")
    visitors = routed.select(
        "part", query_turn.alias("turn"), "vec_id", "embedding",
        F.explode(F.sequence(F.lit(0), F.element_at(blocks, F.col("part") + 1) - 1)).alias("block"))

    def rerank(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            found = _nearest(
                left["vec_id"].to_numpy(), _matrix(left["embedding"]),
                right["vec_id"].to_numpy(), _matrix(right["embedding"]), k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    keys = ["part", "block", "turn"]
    found = visitors.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInPandas(
        rerank, _FOUND)
    return _best(found, k).select("query_id", F.col("rank").cast("int").alias("rank"),
                                  "vec_id", "score")
